"""DuckDB SQL for the registered queries, written against the derived inputs."""

from __future__ import annotations

from oracle.constants import (
    BLOCK_HEADERS, BRANDS_A, BRANDS_B_ONLY, COLUMNS, DEFAULT_JOURNEY, EXCLUDED_PAGES, INFLUENCE, JOURNEY_RULES, LETTER_POINTS, NO_REGISTRATION,
    NOISE_POINTS, SIZE_JOURNEY, SLOT_LAYOUT, TIERS,
)
from oracle import rules, slots
from oracle.inputs import SLOT_COLUMNS, query

RUN_DATE = "DATE '2024-01-31'"
FIT = "Make, Model, Width, Profile, Rim"
PIVOT = ["SKU"] + [f"SKU{i}" for i in range(2, 21)]


def nn(expr: str) -> str:
    return f"nullif({expr}, '')"


def ext(c: str, pattern: str, group: int = 1) -> str:
    return nn(f"regexp_extract({c}, '{pattern}', {group})")


def rounded(x: str, places: int) -> str:
    f = f"1e{places}::DOUBLE"
    return f"(sign({x}) * floor(abs({x}) * {f} + 0.5) / {f})"


def exact(agg: str, x: str) -> str:
    total = f"CAST(sum(CAST({x} AS DECIMAL(20, 6))) AS DOUBLE)"
    return total if agg == "sum" else f"({total} / CAST(nullif(count({x}), 0) AS DOUBLE))"


def alnum(c: str) -> str:
    return f"regexp_replace(lower(trim({c})), '[^a-z0-9]', '', 'g')"


def size_part(c: str) -> str:
    return ext(c, r"^\d+/\d+\s*[A-Z]?\d+", 0)


def long(c: str) -> str:
    return rf"CASE WHEN regexp_full_match({c}, '\s*[+-]?[0-9]+\s*') THEN TRY_CAST({c} AS BIGINT) END"


def size_key(c: str) -> str:
    return f"replace(lower(trim({c})), ' ', '')"


def vehicle_key(c: str) -> str:
    return rf"lower(regexp_replace({c}, '[^\p{{L}}\p{{N}}]', '', 'g'))"


def points(c: str, table, test: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} {test.format(v)} THEN {p}::DOUBLE" for v, p in table) + " ELSE 0::DOUBLE END"


LOOSE = r"(\d{2,3})[/\\](\d{2,3}(?:\.\d+)?)\s*[A-Z]*\s*(\d{2})"


def spaced(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(coalesce({c}, ''), '(\d)([A-Za-z]{{0,2}})[rR](\d)', '\1 \2R\3', 'g'), '\s+', ' ', 'g'))"


# ---------------------------------------------------------------- scores

SCORED = f"""
  SELECT *, ntile(100) OVER (ORDER BY TyreRank DESC, ProductId NULLS FIRST, GRADE, SIZE, BRAND, Model, WET_GRIP NULLS FIRST, FUEL NULLS FIRST,
      NOISE_REDUCTION, SEASONAL_PERFORMANCE, OFFER, OE, AWARD_SCORE, RunflatStatus) AS Percentile
  FROM (SELECT *, ({points("AWARD_SCORE", [("Award", 10)], "= '{}'")} * 1.0::DOUBLE + {points("FUEL", LETTER_POINTS, "= '{}'")} * 1.0::DOUBLE
      + {points("NOISE_REDUCTION", NOISE_POINTS, "LIKE '%{}'")} * 0.1::DOUBLE + {points("OE", [("Yes", 10)], "= '{}'")} * 1.0::DOUBLE
      + 0::DOUBLE * 0.5::DOUBLE + {points("WET_GRIP", LETTER_POINTS, "= '{}'")} * 0.5::DOUBLE) AS TyreRank FROM offers)"""
OFFERS = f"""
  SELECT ProductId, Grade AS GRADE, Size AS SIZE, Manufacturer AS BRAND, Model, WetGrip AS WET_GRIP, Fuel AS FUEL, Noise AS NOISE_REDUCTION,
    Season AS SEASONAL_PERFORMANCE, Offer AS OFFER, OE, AwardScore AS AWARD_SCORE,
    CASE WHEN lower(run_flat) = 'runflat' THEN 'Runflat' ELSE 'Non-Runflat' END AS RunflatStatus,
    {exact("avg", "Price")} AS PRICE,
    {exact("avg", "Price")} / nullif(({exact("avg", "PrevPrice7")} + {exact("avg", "PrevPrice28")}) / 2.0::DOUBLE, 0) AS PRICEFLUCTUATION,
    {ext("Size", r"^(\d+/\d+\s*R\d+)")} AS StrippedSize
  FROM products LEFT JOIN catalogue ON CAST(ProductId AS VARCHAR) = SKU
  GROUP BY ALL"""
TIERED = "SELECT *, CASE " + " ".join(f"WHEN Percentile <= {b} THEN '{t}'" for b, t in TIERS) + " ELSE 'Unclassified' END AS TyreScore FROM ranked"
SCORE_STEPS = {"offers": OFFERS, "ranked": SCORED, "scored": TIERED}

SOLD = f"""
  SELECT s.ProductId, trim(upper(CarMake || CarModel)) AS Vehicle, CAST(Units AS BIGINT) AS Units, CAST(AvgPrice AS DOUBLE) AS AvgPrice,
    Grade, {size_part("Size")} AS SizePart, run_flat
  FROM sales s JOIN products p ON s.ProductId = CAST(p.ProductId AS VARCHAR) LEFT JOIN catalogue c ON c.SKU = s.ProductId
  WHERE CAST(Units AS BIGINT) > 0"""


def share(part: str, whole: str) -> str:
    return rounded(f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100::DOUBLE)", 2)


FIT_PRICE = f"SELECT Vehicle, SizePart, {exact('avg', 'AvgPrice')} AS p FROM sold WHERE SizePart IS NOT NULL GROUP BY 1, 2"
ANY_PRICE = f"SELECT SizePart, {exact('avg', 'AvgPrice')} AS p FROM sold GROUP BY 1"
GRADES = """
  SELECT Vehicle, SizePart, coalesce(max(pct) FILTER (Grade = 'Premium'), 0) AS PremiumShare, coalesce(max(pct) FILTER (Grade = 'MidRange'), 0) AS MidRangeShare,
    coalesce(max(pct) FILTER (Grade = 'Budget'), 0) AS BudgetShare
  FROM (SELECT Vehicle, SizePart, Grade, """ + share("sum(Units)", "sum(sum(Units)) OVER (PARTITION BY Vehicle, SizePart)") + """ AS pct
    FROM sold WHERE SizePart IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2"""
RUNFLAT = f"""SELECT Vehicle, SizePart, {share("sum(CASE WHEN lower(run_flat) = 'runflat' THEN Units ELSE 0 END)", "sum(Units)")} AS RunflatShare
  FROM sold WHERE SizePart IS NOT NULL GROUP BY 1, 2"""
MARKET_STEPS = {"sold": SOLD, "fit_price": FIT_PRICE, "any_price": ANY_PRICE, "grades": GRADES, "flats": RUNFLAT}
CLICKSTREAM = f"""
  SELECT item_id AS SKU, replace(list_id, '-', '/') || ' R' || {ext("list_id", "([0-9]+)$")} AS Size,
    coalesce(upper(replace(vehicle, ' ', '')), 'NO SALES YET') AS Vehicle,
    count(*) FILTER (event_name = 'add_to_cart') AS ADDTOCART, count(*) FILTER (event_name = 'view_item_list') AS PRODUCTLISTVIEWS
  FROM clicks WHERE regexp_full_match(item_id, '[0-9]+') AND event_date BETWEEN '20231031' AND '20240131' GROUP BY 1, 2, 3"""
RATE = "(CAST(coalesce(o.Orders, 0) AS DOUBLE) / nullif(CAST(coalesce(cs.PRODUCTLISTVIEWS, 0) AS DOUBLE), 0) * 100::DOUBLE)"
OUTPUT = f"""
  SELECT TyreScore, t.ProductId, GRADE, BRAND, Model, WET_GRIP, FUEL, NOISE_REDUCTION, SEASONAL_PERFORMANCE, t.OE, AWARD_SCORE, RunflatStatus,
    {", ".join(f"coalesce(CAST(i.{c} AS VARCHAR), 'NO SALES YET') AS {c}" for c in INFLUENCE)},
    coalesce(o.Vehicle, 'NO SALES YET') AS Vehicle, t.SIZE, PRICE, OFFER, {rounded("coalesce(PRICEFLUCTUATION, 1::DOUBLE)", 2)} AS PRICEFLUCTUATION,
    coalesce(o.Orders, 0) AS Orders, coalesce(o.Units, 0) AS Units,
    coalesce(nullif({rounded("fp.p", 2)}, 0), {rounded("ap.p", 2)}) AS GoldilocksZone,
    coalesce(PremiumShare, 0::DOUBLE) AS PremiumShare, coalesce(MidRangeShare, 0::DOUBLE) AS MidRangeShare, coalesce(BudgetShare, 0::DOUBLE) AS BudgetShare,
    coalesce(RunflatShare, 0::DOUBLE) AS RunflatShare, CASE WHEN o.Vehicle IS NULL THEN 'Potential' ELSE 'Active' END AS SalesStatus,
    coalesce(cs.PRODUCTLISTVIEWS, 0) AS PRODUCTLISTVIEWS,
    {rounded(f"CASE WHEN {RATE} IS NULL THEN 0::DOUBLE WHEN {RATE} >= 1 THEN 0.14::DOUBLE ELSE {RATE} END", 3)} AS CLICKSTREAMRATE
  FROM scored t
  LEFT JOIN (SELECT ProductId, trim(upper(CarMake || CarModel)) AS Vehicle, {long("Orders")} AS Orders, {long("Units")} AS Units FROM sales) o
    ON o.ProductId = CAST(t.ProductId AS VARCHAR)
  LEFT JOIN clickstream cs ON cs.SKU = CAST(t.ProductId AS VARCHAR) AND cs.Vehicle = o.Vehicle
  LEFT JOIN fit_price fp ON fp.Vehicle = o.Vehicle AND fp.SizePart = {size_part("t.SIZE")}
  LEFT JOIN any_price ap ON ap.SizePart = {size_part("t.SIZE")}
  LEFT JOIN grades g ON g.Vehicle = o.Vehicle AND g.SizePart = {size_part("t.SIZE")}
  LEFT JOIN flats f ON f.Vehicle = o.Vehicle AND f.SizePart = {size_part("t.SIZE")}
  LEFT JOIN influence i ON upper(regexp_replace(trim(o.Vehicle), '\\s+', '', 'g')) = upper(i.Vehicle)
  WHERE t.ProductId IS NOT NULL AND WET_GRIP IS NOT NULL"""
OUTPUT_READS = ("products", "catalogue", "sales", "clicks", "influence")
OUTPUT_STEPS = {**SCORE_STEPS, **MARKET_STEPS, "clickstream": CLICKSTREAM, "output": OUTPUT}


def over_output(final: str, *reads: str, **steps: str) -> str:
    return query(final, *OUTPUT_READS, *reads, **{**OUTPUT_STEPS, "keyed": KEYED}, **steps)


KEYED = f"SELECT *, {size_key('SIZE')} AS size_key, {vehicle_key('Vehicle')} AS vehicle_key FROM output"
CANDIDATE_ORDER = (
    "TyreScore, Units DESC, ProductId, Vehicle, OFFER NULLS FIRST, PRICE NULLS FIRST, Segment NULLS FIRST, PRODUCTLISTVIEWS NULLS FIRST"
)

# ---------------------------------------------------------------- slot reports

TOKENS = SLOT_COLUMNS[:20]


def enriched(where: str = "") -> str:
    cells = " UNION ALL ".join(
        f"SELECT Vehicle, Size, {i} AS token_position, {long(c)} AS product_id FROM wide {where}" for i, c in enumerate(TOKENS, 1)
    )
    return f"""
      SELECT CarMake AS Make, CarModel AS Model, u.Vehicle, u.Size, {ext("u.Size", "^([0-9]+)")} AS Width, {ext("u.Size", "/([0-9]+)\\s")} AS Profile,
        {ext("u.Size", "R([0-9]+)$")} AS Rim, m.Segment, m.Category, token_position, u.product_id, Manufacturer, Model_Name, OE
      FROM ({cells}) u LEFT JOIN mapping m ON {alnum("u.Vehicle")} = {alnum("m.vehicle")}
      LEFT JOIN (SELECT Manufacturer, Model_Name, OE, {long("Product_ID")} AS pid FROM report_catalogue) c ON c.pid = u.product_id
      WHERE u.product_id IS NOT NULL"""


JOINED = "Make || Model || Width || Profile || Rim"
CAM = f"upper({alnum(JOINED)})"
LISTED = f"SELECT DISTINCT upper({alnum('CAM')}) AS k FROM manual"
LISTED_SPACES = r"SELECT DISTINCT upper(regexp_replace(CAM, '\s+', '', 'g')) AS k FROM manual"
DISTINCT = f"SELECT {FIT}, count(DISTINCT product_id) AS n FROM e GROUP BY {FIT}"
SLOT_READS = ("wide", "mapping", "report_catalogue", "manual")


def token_fact(match: str) -> str:
    return f"""
    SELECT {RUN_DATE} AS snapshot_date, Manufacturer, Make, Model, Vehicle, Size, Segment, Category, Model_Name, OE,
      coalesce(OE <> '', false) AS has_oe, product_id AS sku, token_position,
      CASE WHEN token_position <= 4 THEN 'Hotbox ' || token_position ELSE 'Waves' END AS token_bucket, token_position <= 4 AS is_hotbox,
      CASE WHEN token_position <= 4 THEN token_position END AS hotbox_n, upper(regexp_replace(trim({JOINED}), '\\s+', '', 'g')) AS CAM,
      CASE WHEN {match} IN (SELECT k FROM listed) THEN 'manual' ELSE 'AIM' END AS CAMSource,
      (SELECT n FROM d WHERE {" AND ".join(f"d.{c} IS NOT DISTINCT FROM e.{c}" for c in FIT.split(", "))}) AS distinct_sku_count
    FROM e"""


def wide_report(keys: str, value: str, extra: str, listed: str, tail: str) -> str:
    cells = ", ".join(f"max({value}) FILTER (token_position = {i}) AS {n}" for i, n in enumerate(PIVOT, 1))
    return f"""
    SELECT {RUN_DATE} AS Today, a.*, {CAM.replace("Make", "a.Make").replace("Model", "a.Model")} AS CAM, n AS distinct_sku_count,
      CASE WHEN {CAM} IN (SELECT k FROM {listed}) THEN 'manual' ELSE 'AIM' END AS CAMSource{tail}
    FROM (SELECT {keys}, {cells}{extra} FROM e GROUP BY {keys}) a LEFT JOIN d USING ({FIT})"""


ANALYSIS = f"""
    SELECT {RUN_DATE} AS Today, *, {CAM} AS CAM, CASE WHEN {CAM} IN (SELECT k FROM listed) THEN 'manual' ELSE 'AIM' END AS CAMSource
    FROM (SELECT {FIT}, Segment, Category, {", ".join(f"max(coalesce(Manufacturer, '') || '-' || coalesce(Model_Name, '') || '-' || product_id) FILTER (token_position = {i}) AS {n}" for i, n in enumerate(PIVOT, 1))}
      FROM e GROUP BY {FIT}, Segment, Category) LEFT JOIN (SELECT {FIT}, n AS distinct_sku_count FROM d) USING ({FIT})"""
SLUG = r"lower('aim-' || regexp_replace(Make, '\s+', '', 'g') || '-' || regexp_replace(Model, '\s+', '', 'g') || '-' || Width || '-' || Profile || '-' || Rim)"
DASHBOARD = f"""
    SELECT {RUN_DATE} AS Today, *, {CAM} AS CAM, CASE WHEN {CAM} IN (SELECT k FROM listed) THEN 'manual' ELSE 'AIM' END AS CAMSource,
      'UK' AS Country, '' AS Year, 4 AS CAMUSlot, {", ".join(f"'' AS RibbonName{n[3:]}" for n in PIVOT)}
    FROM (SELECT {FIT}, {SLUG} AS TakeoverName, Segment, Category, Size, Vehicle,
        {", ".join(f"max(product_id) FILTER (token_position = {i}) AS {n}" for i, n in enumerate(PIVOT, 1))},
        min(Manufacturer) AS Manufacturer, min(Model_Name) AS ModelName, min(OE) AS OE
      FROM e GROUP BY ALL) LEFT JOIN (SELECT {FIT}, n AS distinct_sku_count FROM d) USING ({FIT})"""

SIZE_FILE = f"""
    SELECT product_id, slot AS slot_number, 'AIM_Size' AS Rationale, 'AIM_Size' AS Initiative, 'AIM_Size' AS Notes, {RUN_DATE} AS Start_date,
      CAST({RUN_DATE} + INTERVAL 30 DAY AS DATE) AS Review_date, Brand, Width || '/' || Profile || ' R' || Rim AS Size
    FROM (SELECT *, row_number() OVER (PARTITION BY Width, Profile, Rim ORDER BY cnt DESC, product_id) AS rnk
      FROM (SELECT {ext("Size", "^([0-9]+)")} AS Width, {ext("Size", "/([0-9]+)\\s")} AS Profile, {ext("Size", "R([0-9]+)$")} AS Rim, product_id, count(*) AS cnt
        FROM ({" UNION ALL ".join(f"SELECT Size, {c} AS product_id FROM wide" for c in TOKENS)})
        WHERE regexp_full_match(product_id, '[0-9]+') AND length(product_id) >= 8 GROUP BY 1, 2, 3, 4))
    JOIN (VALUES {", ".join(f"({r}, {s}::DOUBLE)" for r, s in SLOT_LAYOUT)}) m(r, slot) ON r = rnk
    JOIN prices ON SKU = product_id AND Brand IS NOT NULL WHERE Width || Profile || Rim IS NOT NULL"""

# ---------------------------------------------------------------- merge

TARGETS = [f"SKU{i}" for i in range(1, 25)]
STAGED = rf"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(Make)), upper(trim(Model)), Width, Profile, Rim
        ORDER BY last_modified DESC NULLS LAST, {", ".join(f"{c} NULLS FIRST" for c in TARGETS)}, Make, Model) AS rn
      FROM (SELECT CarMake AS Make, CarModel AS Model, {ext("upper(Size)", r"^\s*(\d{3})")} AS Width, {ext("upper(Size)", r"^\s*\d{3}\s*/\s*(\d{2})")} AS Profile,
          {ext("upper(Size)", r"R\s*(\d{2})\s*$")} AS Rim, {", ".join(f"nullif(trim({c}), '') AS SKU_{i}" for i, c in enumerate(SLOT_COLUMNS, 1))}, last_modified
        FROM staging s JOIN mapping m ON {alnum("s.Vehicle")} = {alnum("m.vehicle")}
        WHERE regexp_matches(upper(Size), '^\s*\d{{3}}\s*/\s*\d{{2}}\s*[A-Z]*\s*R\s*\d{{2}}\s*$')) x({FIT}, {", ".join(TARGETS)}, last_modified))
    WHERE rn = 1"""
UPDATED = "(t.old = 1 AND s.rn = 1 AND coalesce(s.last_modified >= t.last_modified, false))"
MERGE = f"""
    SELECT {", ".join(f"CASE WHEN t.old IS NULL OR {UPDATED} THEN s.{c} ELSE t.{c} END AS {c}" for c in ("Make", "Model"))},
      {", ".join(f"CASE WHEN t.old IS NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in ("Width", "Profile", "Rim"))},
      {", ".join(f"CASE WHEN t.old IS NULL THEN nullif(s.{c}, '-') WHEN {UPDATED} THEN coalesce(nullif(s.{c}, '-'), t.{c}) ELSE t.{c} END AS {c}" for c in TARGETS)},
      CASE WHEN t.old IS NULL OR {UPDATED} THEN s.last_modified ELSE t.last_modified END AS last_modified
    FROM (SELECT *, 1 AS old FROM target) t FULL JOIN staged s ON upper(trim(t.Make)) = upper(trim(s.Make)) AND upper(trim(t.Model)) = upper(trim(s.Model))
      AND trim(t.Width) = s.Width AND trim(t.Profile) = s.Profile AND trim(t.Rim) = s.Rim"""

# ---------------------------------------------------------------- clickstream

NUMBER = long("list_index")
BASE = f"""
    SELECT *, epoch_us(ts) AS us, CAST(strptime(event_date, '%Y%m%d') AS DATE) AS day, {NUMBER} AS ix FROM clicks
    WHERE user_id IS NOT NULL AND country = 'United Kingdom' AND event_name IN ('view_item_list', 'purchase') AND event_date BETWEEN '20231012' AND '20240130'"""
VIEWS = f"""
    SELECT day AS snapshot_date, us AS visit_ts, user_id, CASE WHEN contains(page, '=') THEN regexp_extract(page, '=([^&?]*)', 1) END AS page_location_cam,
      CASE {" ".join(f"WHEN upper(code) LIKE '{p}' THEN '{l}'" for p, l in JOURNEY_RULES)}
        WHEN upper(trim(vehicle)) = '{NO_REGISTRATION}' THEN '{SIZE_JOURNEY}' ELSE '{DEFAULT_JOURNEY}' END AS journey_category,
      {alnum("clicks_.vehicle")} AS vehicle, CASE WHEN ix = 200 THEN 4 ELSE ix END AS SlotPosition, list_id AS Size, brand AS Manufacturer, category AS ModelName,
      variant AS Variant, item_id AS SKU,
      CASE WHEN ix BETWEEN 1 AND 3 THEN 'Hotbox ' || ix WHEN ix IN (4, 200) THEN 'Hotbox 4' WHEN ix = 99 THEN 'BrandSelector' ELSE 'Waves' END AS MerchandisingPosition
    FROM base clicks_ WHERE event_name = 'view_item_list' AND NOT regexp_matches(page, '{"|".join(EXCLUDED_PAGES)}')"""
BEST = f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, SKU, visit_ts ORDER BY
        coalesce(TRY_CAST({ext("MerchandisingPosition", "Hotbox ([0-9]+)")} AS BIGINT), CASE MerchandisingPosition WHEN 'BrandSelector' THEN 99 ELSE 100 END),
        SlotPosition NULLS FIRST, journey_category, vehicle NULLS FIRST, Size) AS rn FROM views) WHERE rn = 1"""
BOUGHT = """
    SELECT user_id, item_id AS SKU, us AS purchase_ts, txn AS transaction_id, coalesce(quantity, 1) AS Units, coalesce(price, 0) * coalesce(quantity, 1) AS ItemRevenue
    FROM base WHERE event_name = 'purchase'"""
ATTRIBUTED = """
    SELECT transaction_id, user_id, SKU, visit_ts, Units, ItemRevenue FROM (
      SELECT p.*, v.visit_ts, row_number() OVER (PARTITION BY transaction_id, p.user_id, p.SKU ORDER BY v.visit_ts DESC, purchase_ts DESC, Units DESC, ItemRevenue DESC) AS rn
      FROM bought p JOIN best v ON v.user_id = p.user_id AND v.SKU = p.SKU AND v.visit_ts <= p.purchase_ts) WHERE rn = 1"""
MASK = "Date BETWEEN DATE '2024-01-15' AND DATE '2024-01-18'"
METRICS = ("TotalUsers", "Orders", "Purchasers", "PurchasedUnits", "PurchasedRevenue", "UsersUniqueDayJourney")
REPORT = f"""
    SELECT Date, journey_category, Vehicle, Size, SlotPosition, MerchandisingPosition, Manufacturer, ModelName, Variant, SKU, Segment, Pod, Category,
      {", ".join(f"CASE WHEN {MASK} THEN NULL ELSE {m} END AS {m}" for m in METRICS)}
    FROM (SELECT f.* EXCLUDE (vehicle), snapshot_date AS Date, f.vehicle AS Vehicle, Segment, Pod, Category, CASE WHEN day_rank = 1 THEN 1 ELSE 0 END AS TotalUsers,
        CASE WHEN journey_rank = 1 THEN 1 ELSE 0 END AS UsersUniqueDayJourney, coalesce(Orders, 0) AS Orders, coalesce(Purchasers, 0) AS Purchasers,
        coalesce(PurchasedUnits, 0) AS PurchasedUnits, coalesce(PurchasedRevenue, 0) AS PurchasedRevenue
      FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_date, user_id ORDER BY visit_ts, coalesce(SKU, '')) AS day_rank,
          row_number() OVER (PARTITION BY snapshot_date, user_id, journey_category ORDER BY visit_ts, coalesce(SKU, '')) AS journey_rank FROM best) f
      LEFT JOIN (SELECT user_id, SKU, visit_ts, count(DISTINCT transaction_id) AS Orders, count(DISTINCT user_id) AS Purchasers, CAST(sum(Units) AS BIGINT) AS PurchasedUnits,
          {exact("sum", "ItemRevenue")} AS PurchasedRevenue FROM attributed GROUP BY 1, 2, 3) p USING (user_id, SKU, visit_ts)
      LEFT JOIN (SELECT {alnum("vehicle")} AS k, min(Segment) AS Segment, min(Pod) AS Pod, min(Category) AS Category FROM mapping GROUP BY 1) m ON m.k = f.vehicle
      WHERE SKU IS NOT NULL AND snapshot_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-30')"""
EVENT_STEPS = {"base": BASE, "views": VIEWS, "best": BEST, "bought": BOUGHT, "attributed": ATTRIBUTED}

# ---------------------------------------------------------------- answers

SPLIT = r"list_filter(string_split_regex({}, '\s+'), lambda t: t <> '')"
FORMS = r"\d{3}/\d{2}\s*[A-Z]{0,2}R\d{2}|\d{2}/\d{3,4}(?:\.\d{2})?\s*[A-Z]{0,2}R\d{2}|\d{1,2}\.\d{2}\s*[A-Z]{0,2}R\d{2}|\d{1,2}x\d{2}\.\d{2}\s*[A-Z]{0,2}R\d{2}"
CORE = rf"(?is)^(.*?)\b({FORMS})\b(.*)$"
REPAIRED = rf"""
    SELECT * EXCLUDE (v, s, Vehicle, Size), trim(regexp_replace(regexp_replace(CASE WHEN s ~ '(?is).*\b({FORMS})\b.*' THEN trim(v || ' ' || trim(regexp_extract(s, '{CORE}', 1)))
          WHEN v ~ '(?is).*\b({FORMS})\b.*' THEN regexp_extract(v, '{CORE}', 1) || ' ' || regexp_extract(v, '{CORE}', 3) ELSE v END,
        '([A-Za-z])(\d)', '\1 \2', 'g'), '\s+', ' ', 'g')) AS Vehicle,
      {spaced(rf"CASE WHEN s ~ '(?is).*\b({FORMS})\b.*' THEN regexp_extract(s, '{CORE}', 2) WHEN v ~ '(?is).*\b({FORMS})\b.*' THEN regexp_extract(v, '{CORE}', 2) ELSE s END")} AS Size
    FROM (SELECT *, trim(coalesce(Vehicle, '')) AS v, trim(coalesce(Size, '')) AS s FROM answers)"""
SKUS_24 = [f"SKU{i}" for i in range(1, 25)]
DEDUPED = f"""
    SELECT position, Vehicle, Size, HB1, HB2, HB3, HB4,
      {", ".join(f"CASE WHEN cells[{i}] IN ('', '-') OR list_position(cells, cells[{i}]) = {i} THEN cells[{i}] ELSE '-' END AS SKU{i}" for i in range(1, 25))},
      len(list_filter(cells, lambda x: x NOT IN ('', '-'))) - len(list_distinct(list_filter(cells, lambda x: x NOT IN ('', '-')))) AS repeats
    FROM (SELECT *, row_number() OVER (PARTITION BY Vehicle, Size ORDER BY position) AS rn FROM repaired WHERE HB1 <> 'FormatError') WHERE rn = 1"""
MAKE_MODEL = rf"""
    SELECT d.Vehicle, Size, array_to_string(list_transform({SPLIT.format("coalesce(make, 'Unknown')")}, lambda w: upper(w[1]) || lower(w[2:])), ' ') AS Make,
      array_to_string(list_transform({SPLIT.format("CASE WHEN make IS NULL THEN d.Vehicle ELSE substr(d.Vehicle, length(make) + 1) END")}, lambda w: upper(w[1]) || lower(w[2:])), ' ') AS Model,
      {", ".join(f"{ext('upper(Size)', LOOSE, i)} AS {n}" for i, n in enumerate(("Width", "Profile", "Rim"), 1))},
      {", ".join(f"CASE WHEN length(regexp_replace({c}, '[.]0$', '')) = 8 THEN regexp_replace({c}, '[.]0$', '') END AS {c}" for c in SKUS_24)}
    FROM deduped d LEFT JOIN (SELECT Vehicle, arg_max(make, length(make)) AS make FROM (SELECT DISTINCT Vehicle FROM deduped)
      JOIN (SELECT DISTINCT upper(trim(CarMake)) AS make FROM sales) ON starts_with(upper(Vehicle), make) GROUP BY 1) m ON m.Vehicle = d.Vehicle"""

NORM = "coalesce(regexp_replace(lower({}), '[^a-z0-9]', '', 'g'), '')"
ALL_24 = "list_resize({}, 24, '-')"
PARSE_STEPS = {
    "lines": rf"""
      SELECT Vehicle, Size, ln, {SPLIT.format("line")} AS tok FROM (
        SELECT Vehicle, Size, unnest(string_split(trim(raw_text, ' ' || chr(10) || chr(9)), chr(10))) AS line,
          generate_subscripts(string_split(trim(raw_text, ' ' || chr(10) || chr(9)), chr(10)), 1) AS ln FROM raw)""",
    "strict": f"""
      SELECT Vehicle, Size, arg_min(out, [ln, v, w]) AS line FROM (
        SELECT l.Vehicle, l.Size, ln, v, w, array_to_string(list_concat(tok[:v + w], {ALL_24.format("tok[v + w + 1:]")}), ' ') AS out, {ALL_24.format("tok[v + w + 1:]")} AS ids
        FROM (SELECT *, unnest(range(1, len(tok) - 4)) AS v FROM lines WHERE len(tok) >= 6) l, (VALUES (1), (2), (3)) x(w)
        WHERE v + w <= len(tok) AND {NORM.format("array_to_string(tok[:v], ' ')")} = {NORM.format("l.Vehicle")}
          AND {NORM.format("array_to_string(tok[v + 1:v + w], ' ')")} = {NORM.format("l.Size")})
      WHERE len(list_filter(ids, lambda t: NOT regexp_full_match(t, '[0-9]+|-'))) = 0 GROUP BY 1, 2""",
    "entries": rf"""
      SELECT Vehicle, Size, e[list_position(list_transform(e, lambda t: t <> '-'), true):] AS ids, list_position(list_transform(e, lambda t: t <> '-'), true) AS lead FROM (
        SELECT Vehicle, Size, list_filter({SPLIT.format("regexp_replace(raw_text, '[^a-zA-Z0-9-]', ' ', 'g')")}, lambda t: regexp_full_match(t, '[0-9]{{7,8}}|-')) AS e
        FROM raw WHERE contains({NORM.format("raw_text")}, {NORM.format("Vehicle")}) AND contains({NORM.format("raw_text")}, {NORM.format("Size")}))""",
    "loose": f"""
      SELECT Vehicle, Size, array_to_string(list_concat([replace(upper(trim(Vehicle)), ' ', '_'), replace(replace(upper(trim(Size)), '/', ''), ' ', '')], {ALL_24.format("ids")}), ' ') AS line
      FROM entries WHERE lead > 0 AND len(ids) >= 4""",
    "chosen": f"""
      SELECT r.Vehicle, r.Size, CASE WHEN s.line IS NOT NULL THEN 'strict' WHEN l.line IS NOT NULL THEN 'loose' ELSE 'plain' END AS tier,
        coalesce(s.line, l.line, raw_text) AS line, {SPLIT.format("coalesce(s.line, l.line, raw_text, '')")} AS tok
      FROM raw r LEFT JOIN strict s USING (Vehicle, Size) LEFT JOIN loose l USING (Vehicle, Size)""",
    "splits": """
      SELECT Vehicle, Size, min([v, w]) AS hit FROM (SELECT *, unnest(range(1, len(tok) - 4)) AS v FROM chosen WHERE len(tok) >= 6), (VALUES (1), (2), (3)) x(w)
      WHERE v + w + 4 <= len(tok) AND len(list_filter(tok[v + w + 1:v + w + 4], lambda t: NOT regexp_full_match(t, '[0-9]{7,8}|-'))) = 0 GROUP BY 1, 2""",
    "parsed": """
      SELECT Vehicle, Size, tier, line, CASE WHEN hit IS NULL THEN 'ERROR_VEHICLE' ELSE array_to_string(tok[:hit[1]], ' ') END AS parsed_vehicle,
        CASE WHEN hit IS NULL THEN 'ERROR_SIZE' ELSE array_to_string(tok[hit[1] + 1:hit[1] + hit[2]], '') END AS parsed_size,
        CASE WHEN hit IS NULL THEN list_transform(range(24), lambda i: CASE WHEN coalesce(line, '') = '' THEN 'Error' ELSE 'FormatError' END)
          ELSE tok[hit[1] + hit[2] + 1:hit[1] + hit[2] + 24] END AS ids
      FROM chosen LEFT JOIN splits USING (Vehicle, Size)""",
}
FIRSTS = """SELECT {keys}, list(CAST(ProductId AS VARCHAR) ORDER BY rn) AS ids FROM (
      SELECT {keys}, ProductId, row_number() OVER (PARTITION BY {keys} ORDER BY TyreScore, u DESC, ProductId) AS rn FROM (
        SELECT {keys}, ProductId, min(TyreScore) AS TyreScore, arg_min(Units, [TyreScore, lpad(CAST(1000000000 - Units AS VARCHAR), 12, '0')]) AS u FROM keyed GROUP BY {keys}, ProductId))
      GROUP BY {keys}"""
BACKFILL_STEPS = {
    **PARSE_STEPS,
    "own_ids": FIRSTS.format(keys="size_key, vehicle_key"),
    "any_ids": FIRSTS.format(keys="size_key"),
    "kept": f"""
      SELECT p.*, coalesce(o.ids, a.ids, []) AS cands, list_transform(ids_, lambda x, i: CASE WHEN regexp_full_match(x, '[0-9]{{7,8}}') AND list_position(ids_, x) = i THEN x END) AS keep
      FROM (SELECT *, ids AS ids_, {size_key("Size")} AS sk, {vehicle_key("Vehicle")} AS vk FROM parsed) p
      LEFT JOIN own_ids o ON o.size_key = sk AND o.vehicle_key = vk LEFT JOIN any_ids a ON a.size_key = sk""",
    "unused": "SELECT *, list_filter(cands, lambda c: NOT coalesce(list_contains(keep, c), false)) AS free FROM kept",
    "filled": """
      SELECT *, list_resize(list_transform(keep, lambda x, i: coalesce(x, free[len(list_filter(keep[:i], lambda y: y IS NULL))], '-')), 24, '-') AS slots FROM unused""",
}
BACKFILL = f"""
    SELECT Vehicle, Size, {", ".join(f"CASE WHEN bad THEN '{'Error' if i <= 4 else '-'}' ELSE slots[{i}] END AS {c}" for i, c in enumerate(SLOT_COLUMNS, 1))},
      ok AND NOT bad AS success, CASE WHEN bad THEN 'NO_RESULTS' WHEN NOT ok THEN 'UPSTREAM_ERROR' END AS error_code
    FROM (SELECT *, coalesce(contains(line, 'NoDataError'), false) AS bad, len(list_filter(slots[:4], lambda t: NOT regexp_full_match(t, '[0-9]{{7,8}}'))) = 0 AS ok FROM filled)"""

# ---------------------------------------------------------------- selection

PCT = 0.15
POOL = f"""
    SELECT size_key, vehicle_key, id, row_number() OVER (PARTITION BY size_key, vehicle_key ORDER BY tier, pts DESC, u DESC, id) AS n FROM (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY size_key, vehicle_key, id ORDER BY tier, pts DESC, u DESC, a, b, runflat) AS first_row FROM (
        SELECT size_key, vehicle_key, CAST(ProductId AS VARCHAR) AS id, TyreScore AS tier, Units AS u, RunflatStatus = 'Runflat' AS runflat,
          (CASE WHEN lower(OFFER) IN ('onoffer', '1', 'true') THEN 2 ELSE 0 END + CASE WHEN PRICE BETWEEN GoldilocksZone * {1 - PCT}::DOUBLE AND GoldilocksZone * {1 + PCT}::DOUBLE THEN 2 ELSE 0 END
            + CASE WHEN PRICEFLUCTUATION > 1.1 THEN -1 WHEN PRICEFLUCTUATION < 0.9 THEN 1 ELSE 0 END) AS pts,
          SalesStatus = 'Active' AND GRADE IN ('Premium', 'MidRange') AND lower(BRAND) IN ({", ".join(f"'{b.lower()}'" for b in BRANDS_A)}) AS a,
          SalesStatus = 'Active' AND lower(BRAND) IN ({", ".join(f"'{b.lower()}'" for b in BRANDS_A + BRANDS_B_ONLY)}) AS b
        FROM keyed)) WHERE first_row = 1 AND a)"""

CONFIG = "Model, Search_Enabled, Thinking_Budget"
DIGITS = "list_filter(tokens, lambda t: t <> '-')"


def oracle() -> dict[str, str]:
    out: dict[str, str] = {}
    s = "Size"
    out["size_parts"] = query(
        f"""SELECT DISTINCT Size, {size_part(s)} AS size_part, {ext(s, r"^(\d+/\d+\s*R\d+)")} AS stripped, {ext(s, "^([0-9]+)")} AS width, {ext(s, r"/(\d+)\s")} AS profile,
        {ext(s, "R([0-9]+)$")} AS rim, {ext("upper(Size)", r"^\s*(\d{3})")} AS up_width, {ext("upper(Size)", r"^\s*\d{3}\s*/\s*(\d{2})")} AS up_profile,
        {ext("upper(Size)", r"R\s*(\d{2})\s*$")} AS up_rim, {", ".join(f"{ext('upper(Size)', LOOSE, i)} AS loose_{i}" for i in (1, 2, 3))}, {size_key(s)} AS size_key, {spaced(s)} AS spaced,
        regexp_matches(upper(Size), '^\\s*\\d{{3}}\\s*/\\s*\\d{{2}}\\s*[A-Z]*\\s*R\\s*\\d{{2}}\\s*$') AS strict FROM products""",
        "products",
    )
    out["vehicle_keys"] = query(
        f"""SELECT vehicle, trim(upper(CarMake || CarModel)) AS sales, upper(replace(vehicle, ' ', '')) AS click, {alnum("vehicle")} AS alnum, {vehicle_key("vehicle")} AS letters,
        upper(regexp_replace(vehicle, '[\\s/-]+', '', 'g')) AS stripped, array_to_string(list_transform(string_split(vehicle, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
        length(vehicle) // 4 AS tokens, vehicle AS page_token FROM mapping""",
        "mapping",
    )
    out["cam_keys"] = query(
        rf"""SELECT {FIT}, {CAM} AS alnum, upper(regexp_replace(trim({JOINED}), '\s+', '', 'g')) AS spaces, upper(regexp_replace(trim({JOINED}), '[^a-z0-9]', '', 'g')) AS capitals,
        {SLUG} AS slug FROM target""",
        "target",
    )
    out["tyre_score"] = query(
        "SELECT ProductId, GRADE, SIZE, StrippedSize, BRAND, Model, WET_GRIP, FUEL, NOISE_REDUCTION, PRICE, OFFER, PRICEFLUCTUATION, RunflatStatus, TyreRank, Percentile, TyreScore FROM scored",
        "products", "catalogue", **SCORE_STEPS,
    )
    market_reads = ("products", "catalogue", "sales")
    out["price_zone"] = query(
        f"SELECT Vehicle, SizePart, coalesce(nullif({rounded('f.p', 2)}, 0), {rounded('a.p', 2)}) AS GoldilocksZone FROM fit_price f LEFT JOIN any_price a USING (SizePart)",
        *market_reads, sold=SOLD, fit_price=FIT_PRICE, any_price=ANY_PRICE,
    )
    out["grade_share_pivot"] = query("SELECT * FROM grades", *market_reads, sold=SOLD, grades=GRADES)
    out["runflat_share"] = query("SELECT * FROM flats", *market_reads, sold=SOLD, flats=RUNFLAT)
    out["clickstream"] = query(CLICKSTREAM, "clicks")
    out["score_output"] = query(f"SELECT {', '.join(COLUMNS)} FROM output", *OUTPUT_READS, **OUTPUT_STEPS)
    token_steps = {"e": enriched(), "d": DISTINCT, "listed": LISTED}
    out["token_fact"] = query(token_fact(CAM), *SLOT_READS, **token_steps)
    capitals = f"upper(regexp_replace(trim({JOINED}), '[^a-z0-9]', '', 'g'))"
    out["token_fact_strict"] = query(token_fact(capitals), *SLOT_READS, **token_steps)
    out["analysis_wide"] = query(ANALYSIS, *SLOT_READS, e=enriched(), d=DISTINCT, listed=LISTED_SPACES)
    out["dashboard_wide"] = query(DASHBOARD, *SLOT_READS, e=enriched("WHERE HB1 <> '0'"), d=DISTINCT, listed=LISTED)
    out["size_file"] = query(SIZE_FILE, "wide", "prices")
    out["cam_merge"] = query(MERGE, "staging", "target", "mapping", staged=STAGED)
    out["journey"] = query(
        """SELECT journey_category, MerchandisingPosition, SlotPosition, page_location_cam, count(*) AS views, count(DISTINCT user_id) AS users FROM views GROUP BY 1, 2, 3, 4""",
        "clicks", base=BASE, views=VIEWS,
    )
    out["best_placement"] = query("SELECT * FROM best", "clicks", base=BASE, views=VIEWS, best=BEST)
    out["asof_purchase"] = query("SELECT * FROM attributed", "clicks", **EVENT_STEPS)
    out["merch_report"] = query(REPORT, "clicks", "mapping", **EVENT_STEPS)
    out["rolling_replace"] = """
      WITH d AS (SELECT CAST(ts AS DATE) AS Date, event_type FROM events)
      SELECT Date, count(*) AS n, 'old' AS origin FROM d WHERE Date NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-30' GROUP BY 1
      UNION ALL SELECT Date, count(*), 'new' FROM d WHERE Date BETWEEN DATE '2024-01-10' AND DATE '2024-01-30' AND event_type = 'purchase' AND day(Date) % 5 <> 2 GROUP BY 1"""
    ranked = f"SELECT size_key, ProductId, Vehicle, TyreScore, Units, OFFER, row_number() OVER (PARTITION BY size_key ORDER BY {CANDIDATE_ORDER}) AS rank FROM keyed"
    out["top100_candidates"] = over_output(f"SELECT * FROM ({ranked}) WHERE rank <= 100")
    out["bulk_candidates"] = over_output(f"{ranked} WHERE size_key IN (SELECT {size_key('Size')} FROM asked)", "asked")
    tiers = [("size_key NOT LIKE '165%'", True), ("size_key NOT LIKE '165%'", False), ("true", True), ("true", False)]
    parts = []
    for i, (where, narrow) in enumerate(tiers):
        on = "k.size_key = r.size_key" + (" AND k.vehicle_key = r.vehicle_key" if narrow else "")
        parts.append(
            f"SELECT r.size_key, r.vehicle_key, {i} AS tier, ProductId, TyreScore, Units FROM req r JOIN (SELECT * FROM keyed WHERE {where}) k ON {on}"
        )
    out["tiered_candidates"] = over_output(
        """SELECT size_key, vehicle_key, tier, count(*) AS n, count(DISTINCT ProductId) AS products, min(TyreScore) AS best, CAST(sum(Units) AS BIGINT) AS units
        FROM (SELECT *, min(tier) OVER (PARTITION BY size_key, vehicle_key) AS best_tier FROM hits) WHERE tier = best_tier GROUP BY 1, 2, 3""",
        "asked",
        req=f"SELECT DISTINCT {size_key('Size')} AS size_key, {vehicle_key('Vehicle')} AS vehicle_key FROM asked",
        hits=" UNION ALL ".join(parts),
    )
    cells = ", ".join(f"replace(coalesce(CAST({c} AS VARCHAR), 'None'), '|', '/')" for c in COLUMNS)
    head = "|".join(BLOCK_HEADERS)
    numbered = f"SELECT size_key, vehicle_key, row_number() OVER (PARTITION BY size_key ORDER BY {CANDIDATE_ORDER}) AS line_no, concat_ws('|', {cells}) AS line FROM keyed"
    out["text_block"] = over_output(
        f"SELECT DISTINCT size_key, 0 AS line_no, '{head}' AS line FROM keyed UNION ALL SELECT size_key, line_no, line FROM ({numbered})"
    )
    out["request_blocks"] = over_output(
        f"""SELECT size_key, vehicle_key, tier, n + 1 AS lines, chars + n + {len(head)} AS chars, (chars + n + {len(head)}) // 4 AS tokens FROM (
          SELECT r.size_key, r.vehicle_key, CASE WHEN own > 0 THEN 0 ELSE 1 END AS tier, CASE WHEN own > 0 THEN own ELSE n END AS n,
            CAST(CASE WHEN own > 0 THEN own_chars ELSE chars END AS BIGINT) AS chars FROM (
            SELECT r.size_key, r.vehicle_key, count(*) AS n, sum(length(line)) AS chars, count(*) FILTER (k.vehicle_key = r.vehicle_key) AS own,
              sum(length(line)) FILTER (k.vehicle_key = r.vehicle_key) AS own_chars
            FROM (SELECT DISTINCT {size_key('Size')} AS size_key, {vehicle_key('Vehicle')} AS vehicle_key FROM asked) r JOIN ({numbered}) k USING (size_key) GROUP BY 1, 2) r)""",
        "asked",
    )
    wanted = f"SELECT {size_key('Size')} AS size_key, {vehicle_key('Vehicle')} AS vehicle_key, min(Segment) AS Segment FROM asked GROUP BY 1, 2"
    dashes = "[" + ", ".join(["'-'"] * 24) + "]"
    cells = ", ".join(f"slots[{i}] AS {c}" for i, c in enumerate(SLOT_COLUMNS, 1))
    told = f"""SELECT Vehicle, Size, {cells}, len(list_filter(slots[1:4], lambda x: NOT regexp_full_match(x, '[0-9]{{7,8}}'))) = 0 AS success
      FROM (SELECT a.Vehicle, a.Size, coalesce(c.slots, {dashes}) AS slots FROM asked a
        LEFT JOIN chosen_slots c ON c.size_key = {size_key("a.Size")} AND c.vehicle_key = {vehicle_key("a.Vehicle")})"""

    def selected(final: str, match: str, enhanced: bool, **more) -> str:
        return over_output(final, "asked", wanted=wanted, **slots.answers(match, enhanced, lambda c: exact("avg", c), **more))

    out["hotbox_slots"] = selected(told, "false", False)
    out["hotbox_runflat_makes"] = selected(told, "false", False, makes=("nation1", "nation2"))
    out["hotbox_slots_promoted"] = selected(told, "lower(BRAND) = 'michelin'", True)
    boxes = " UNION ALL ".join(f"SELECT Vehicle, Size, {i} AS box, HB{i} AS id FROM ({told})" for i in range(1, 5))
    out["hotbox_violations"] = selected(
        f"""SELECT CAST(sum(other_size) AS BIGINT) AS other_size, CAST(sum(not_in_set_a) AS BIGINT) AS not_in_set_a, CAST(sum(not_in_set_b) AS BIGINT) AS not_in_set_b,
          CAST(sum(budget_too_high) AS BIGINT) AS budget_too_high, CAST(sum(greatest(budgets - 1, 0)) AS BIGINT) AS too_many_budget, CAST(sum(boxes - ids) AS BIGINT) AS repeated
        FROM (SELECT count(*) FILTER (f.id IS NULL) AS other_size, count(*) FILTER (box < 4 AND NOT f.a) AS not_in_set_a, count(*) FILTER (box = 4 AND NOT f.b) AS not_in_set_b,
            count(*) FILTER (box < 4 AND f.budget) AS budget_too_high, count(*) FILTER (f.budget) AS budgets, count(*) AS boxes, count(DISTINCT t.id) AS ids
          FROM ({boxes}) t LEFT JOIN (SELECT size_key, id, bool_or(a) AS a, bool_or(b) AS b, bool_or(grade = 'Budget') AS budget FROM feat GROUP BY 1, 2) f
            ON f.size_key = {size_key("t.Size")} AND f.id = t.id WHERE t.id <> '-' GROUP BY t.Vehicle, t.Size)""",
        "lower(SEASONAL_PERFORMANCE) = 'winter'", True,
    )
    out["best_of_pool"] = over_output(
        f"""SELECT size_key, vehicle_key, {", ".join(f"max(id) FILTER (n = {i}) AS HB{i}" for i in (1, 2, 3))} FROM (SELECT DISTINCT size_key, vehicle_key FROM keyed)
        LEFT JOIN ({POOL}) USING (size_key, vehicle_key) GROUP BY 1, 2"""
    )
    average = lambda c: exact("avg", c)
    out["enhancer_similar"] = over_output(rules.SIMILAR, **rules.SIMILAR_STEPS)
    out["cousin_vehicles"] = over_output(rules.COUSINS, **rules.COUSIN_STEPS)
    out["cousin_products"] = over_output(rules.COUSIN_PRODUCTS, **rules.COUSIN_STEPS)
    answered = f"SELECT Vehicle, Size, {size_key('Size')} AS size_key, {vehicle_key('Vehicle')} AS vehicle_key, {', '.join(SLOT_COLUMNS)} FROM ({told})"
    michelin = slots.answers("lower(BRAND) = 'michelin'", True, average) | rules.context(rules.damaged(answered))
    out["slot_breaks"] = over_output(rules.FOUND, "asked", wanted=wanted, **michelin)
    out["slot_repair"] = over_output(rules.REPAIRED, "asked", wanted=wanted, **michelin, **rules.REPAIR_STEPS)
    plainly = slots.answers("false", False, average) | rules.context(answered)
    out["own_breaks"] = over_output(f"SELECT rule, count(*) AS count FROM ({rules.FOUND}) GROUP BY 1", "asked", wanted=wanted, **plainly)
    ranked_by, steps = rules.influence(average)
    out["influence_ranks"] = over_output(ranked_by, **steps)
    seats, steps = rules.quotas(slots.rows("false"), average)
    out["grade_quotas"] = over_output(seats, "asked", wanted=wanted, **steps)
    out["parse_output"] = query(
        "SELECT Vehicle, Size, tier, parsed_vehicle, parsed_size, array_to_string(ids, ' ') AS ids FROM parsed", "raw", **PARSE_STEPS
    )
    out["backfill"] = over_output(BACKFILL, "raw", **BACKFILL_STEPS)
    out["repair_size"] = query("SELECT position, Vehicle, Size FROM repaired", "answers", repaired=REPAIRED)
    out["dedup_rows"] = query("SELECT * FROM deduped", "answers", repaired=REPAIRED, deduped=DEDUPED)
    out["make_model"] = query(MAKE_MODEL, "answers", "sales", repaired=REPAIRED, deduped=DEDUPED)
    out["reconcile"] = query(
        """SELECT position, Vehicle, CASE WHEN retried THEN 'r' || HB1 ELSE HB1 END AS HB1, ok OR retried AS success
        FROM (SELECT *, NOT ok AND position % 2 = 0 AS retried FROM (SELECT *, success AND position % 3 <> 0 AS ok FROM answers))""",
        "answers",
    )
    out["outcome_counts"] = query(
        """SELECT *, CAST(sum(attempted) OVER w AS BIGINT) AS total_attempted, CAST(sum(succeeded) OVER w AS BIGINT) AS total_succeeded, CAST(sum(failed) OVER w AS BIGINT) AS total_failed
        FROM (SELECT position // 100 AS batch, count(*) AS attempted, count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed FROM answers GROUP BY 1) WINDOW w AS (ORDER BY batch)""",
        "answers",
    )
    keys = f"{CONFIG}, Vehicle, Size"
    out["consistency"] = query(
        f"""SELECT {keys}, CAST(sum(n) AS BIGINT) AS runs, count(*) AS answers, {rounded("(CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100::DOUBLE)", 2)} AS consistency_pct
        FROM (SELECT {keys}, array_to_string(tokens, ' ') AS a, count(*) AS n FROM runs WHERE Success GROUP BY ALL) GROUP BY {keys}""",
        "runs",
    )
    for name, group, n in (("top_skus", keys, 3), ("top_skus_by_vehicle", "Vehicle, Size", 5)):
        out[name] = query(
            f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY n DESC, sku) AS rank FROM
            (SELECT {group}, sku, count(*) AS n FROM (SELECT {group}, unnest({DIGITS}) AS sku FROM runs WHERE Success) GROUP BY ALL)) WHERE rank <= {n}""",
            "runs",
        )
    out["richness"] = query(
        f"SELECT {CONFIG}, count(DISTINCT sku) AS unique_skus FROM (SELECT {CONFIG}, unnest({DIGITS}) AS sku FROM runs WHERE Success) GROUP BY {CONFIG}", "runs"
    )
    out["quality"] = over_output(
        f"""SELECT {CONFIG}, {rounded("(CAST(sum(best) AS DOUBLE) / count(*))", 4)} AS best_count, {rounded("(CAST(sum(best) AS DOUBLE) / count(*) / 20::DOUBLE * 100::DOUBLE)", 4)} AS best_pct, count(*) AS runs
        FROM (SELECT Run_ID, {CONFIG}, count(*) FILTER (contains(tier, 'BEST')) AS best FROM (SELECT Run_ID, {CONFIG}, unnest({DIGITS}) AS sku FROM runs WHERE Success)
          LEFT JOIN (SELECT CAST(ProductId AS VARCHAR) AS sku, min(TyreScore) AS tier FROM (SELECT *, rank() OVER (PARTITION BY ProductId ORDER BY Units DESC) AS r FROM output) WHERE r = 1 GROUP BY 1) USING (sku) GROUP BY ALL)
        GROUP BY {CONFIG}""",
        "runs",
    )
    out["unmatched_skus"] = over_output(
        f"SELECT DISTINCT sku FROM (SELECT unnest({DIGITS}) AS sku FROM runs WHERE Success) WHERE sku NOT IN (SELECT CAST(ProductId AS VARCHAR) FROM output)", "runs"
    )
    out["cost"] = query(
        f"""SELECT Model, n AS runs, i AS tokens_in, o AS tokens_out,
          {rounded("(i / 1e6::DOUBLE * CASE Model WHEN 'model-large' THEN 0.3::DOUBLE ELSE 0 END + o / 1e6::DOUBLE * CASE Model WHEN 'model-large' THEN 2.5::DOUBLE ELSE 0 END)", 5)} AS cost
        FROM (SELECT Model, count(*) AS n, CAST(sum(Input_Tokens) AS BIGINT) AS i, CAST(sum(Output_Tokens) AS BIGINT) AS o FROM runs GROUP BY 1)""",
        "runs",
    )
    out["job_cost"] = query(
        f"""SELECT 'run-1' AS run_id, 'GLOBAL' AS mode, n AS cams_attempted, g AS cams_succeeded, i AS prompt_token_count, o AS candidates_token_count, t AS total_token_count,
          {rounded("(i * (0.072505::DOUBLE / 1e6::DOUBLE) + o * (0.29002::DOUBLE / 1e6::DOUBLE))", 5)} AS estimated_cost_gbp
        FROM (SELECT count(*) AS n, count(*) FILTER (Success) AS g, CAST(sum(Input_Tokens) AS BIGINT) AS i, CAST(sum(Output_Tokens) AS BIGINT) AS o, CAST(sum(Total_Tokens) AS BIGINT) AS t FROM runs)""",
        "runs",
    )
    out["list_diff"] = query(
        """SELECT position, array_to_string(list_filter(ref, lambda x: NOT list_contains(got, x)), ' ') AS missing, array_to_string(list_filter(got, lambda x: NOT list_contains(ref, x)), ' ') AS added,
          array_to_string(moved, ' ') AS out_of_order, len(moved) = 0 AS is_sorted, len(ref) AS count_ref, len(got) AS count_res
        FROM (SELECT *, list_filter(common, lambda x, i: i > 1 AND list_position(ref, x) < list_position(ref, common[i - 1])) AS moved
          FROM (SELECT *, list_filter(got, lambda x: list_contains(ref, x)) AS common
            FROM (SELECT position, cells AS got, list_filter(back, lambda x, i: list_position(back, x) = i) AS ref
              FROM (SELECT *, list_transform(list_reverse(cells), lambda x, i: CASE WHEN i = 5 THEN '99999999' ELSE x END) AS back
                FROM (SELECT position, list_filter(cells, lambda x: trim(x) <> '') AS cells FROM answers)))))""",
        "answers",
    )
    slot_list = "[" + ", ".join(SLOT_COLUMNS) + "]"
    numeric = "list_filter({}, lambda t: regexp_full_match(t, '[0-9]+'))"
    repeats = "len({0}) {1} len(list_distinct({0}))"
    boxes, skus = numeric.format("a[:4]"), numeric.format("a[5:]")
    out["slot_checks"] = query(
        f"""SELECT Vehicle, Size, len(list_filter(a, lambda t: t IN ('-', '', 'nan'))) AS missing, {repeats.format(numeric.format("a"), "<>")} AS has_repeats, len({numeric.format("a")}) < 20 AS too_few,
          len(list_filter(a, lambda t: NOT regexp_full_match(t, '[0-9]{{7,8}}'))) = 0 AS all_numeric, {repeats.format(boxes, "=")} AS hotboxes_distinct, {repeats.format(skus, "=")} AS skus_distinct,
          len(list_filter(a[:4], lambda t: NOT regexp_full_match(t, '[0-9]{{7,8}}'))) = 0 AS success FROM (SELECT Vehicle, Size, {slot_list} AS a FROM wide)""",
        "wide",
    )
    out["vehicle_sizes"] = query(
        """SELECT Vehicle, Size, row_number() OVER (PARTITION BY Vehicle ORDER BY list_transform(regexp_extract_all(Size, '[0-9]+'), lambda x: CAST(x AS BIGINT)), Size) AS ordinal
        FROM (SELECT DISTINCT upper(Vehicle) AS Vehicle, Size FROM fits)""",
        "fits",
    )
    out["vehicle_list"] = query("SELECT DISTINCT Vehicle FROM fits", "fits")
    out["fit_page"] = query(
        """SELECT * FROM (SELECT upper(Vehicle) AS Vehicle, Size, arg_max(Pod, position) AS Pod, arg_max(Segment, position) AS Segment, min(position) AS position FROM fits GROUP BY 1, 2)
        WHERE lower(Pod) = 'pod1' ORDER BY position LIMIT 20 OFFSET 20""",
        "fits",
    )
    usable = "SELECT * FROM runlist WHERE coalesce(lower(Vehicle) NOT IN ('nan', '', 'none'), true) AND lower(Size) NOT IN ('nan', '', 'none')"
    out["runlist_batches"] = query(f"SELECT *, (row_number() OVER (ORDER BY position) - 1) // 64 AS batch FROM ({usable})", "runlist")
    out["runlist_head"] = query(f"SELECT * FROM ({usable}) ORDER BY CAST(PriorityRank AS DOUBLE), position LIMIT 100", "runlist")
    out["distinct_makes"] = query("SELECT DISTINCT upper(trim(CarMake)) AS Make FROM sales", "sales")
    out["csv_round_trip"] = query(f"SELECT Vehicle, Size, {', '.join(SLOT_COLUMNS)} FROM wide", "wide")
    out["golden_diff"] = query(
        """SELECT position, Vehicle, Size, 'golden' AS side FROM runlist WHERE position % 50 = 7
        UNION ALL SELECT position, 'other', Size, 'current' FROM runlist WHERE position % 50 = 7""",
        "runlist",
    )
    whole = lambda side, kind, key: " UNION ALL ".join(
        f"SELECT {key} AS position, '{kind}' AS kind, '{c}' AS cell, {c if side == 'old' else 'NULL'} AS old, {c if side == 'new' else 'NULL'} AS new FROM runlist WHERE {c} IS NOT NULL"
        f" AND position % {60 if side == 'old' else 70} = {3 if side == 'old' else 5}" for c in ("Vehicle", "Size")
    )
    out["golden_cells"] = query(
        f"""SELECT position, 'changed' AS kind, 'Vehicle' AS cell, Vehicle AS old, 'other' AS new FROM runlist WHERE position % 50 = 7 AND position % 60 <> 3 AND Vehicle IS DISTINCT FROM 'other'
        UNION ALL {whole("old", "missing", "position")} UNION ALL {whole("new", "new", "-position")} UNION ALL SELECT NULL, 'schema', 'note', NULL, 'present'""",
        "runlist",
    )
    out["atomic_window"] = out["rolling_replace"]
    staged = "(7 * length(Vehicle) + length(Size)) % 5"
    out["staging_good"] = query(
        f"SELECT nullif(Vehicle, '') AS Vehicle, nullif(Size, '') AS Size, nullif(HB1, '') AS HB1, nullif(SKU20, '') AS SKU20, TIMESTAMP '2024-01-31 08:00:00' AS last_modified FROM wide WHERE {staged} NOT IN (2, 3)",
        "wide",
    )
    out["staging_bad"] = query(f"SELECT CASE {staged} WHEN 2 THEN 'last_modified is no timestamp_ntz' ELSE 'header' END AS reason, Vehicle, Size FROM wide WHERE {staged} IN (2, 3)", "wide")
    out["london_days"] = """
      SELECT CAST(at_ AS DATE) AS day, min(at_) AS first_at, max(at_) AS last_at, count(*) AS n, CASE CAST(at_ AS DATE) WHEN DATE '2024-03-31' THEN 23 ELSE 24 END AS hours,
        CAST(count(*) * 100 // CASE CAST(at_ AS DATE) WHEN DATE '2024-03-31' THEN 23 ELSE 24 END AS DECIMAL(18, 0)) AS per_100_hours
      FROM (SELECT ts + INTERVAL 61 DAY + CASE WHEN ts + INTERVAL 61 DAY >= TIMESTAMP '2024-03-31 01:00:00' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS at_ FROM events) GROUP BY 1"""
    out["latest_stage"] = query(
        """SELECT run_id, coalesce('stage' || arg_max(stage, [epoch_us(ts), line]) FILTER (stage <> ''), 'unknown') AS stage, count(*) AS entries
        FROM (SELECT *, coalesce(regexp_extract(textPayload, '(?i)Starting Stage\\s+([0-9]+)', 1), '') AS stage FROM log) GROUP BY 1""",
        "log",
    )
    out["recent_log"] = query(
        "SELECT run_id, line, textPayload FROM log WHERE textPayload <> '' AND ts > TIMESTAMP '2024-01-05' ORDER BY ts DESC, line DESC LIMIT 50", "log"
    )
    out["snapshot_latest"] = query(
        f"SELECT * REPLACE (CAST(snapshot_date + INTERVAL 1 DAY AS DATE) AS snapshot_date) FROM ({token_fact(CAM)}) WHERE is_hotbox", *SLOT_READS, **token_steps
    )
    out["json_log"] = query(
        "SELECT run_id, count(*) AS entries, max(textPayload) AS last, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS since FROM log WHERE textPayload <> '' GROUP BY 1", "log"
    )
    out["clean_headers"] = query('SELECT vehicle, CarMake AS "Car_Make", Segment AS seg_ment FROM mapping', "mapping")
    out["report_lines"] = query(
        f"""SELECT row_number() OVER (ORDER BY Make NULLS FIRST, Model NULLS FIRST, {", ".join(f"CAST({c} AS BIGINT) NULLS FIRST" for c in ("Rim", "Width", "Profile"))},
          Segment NULLS FIRST, Category NULLS FIRST, SKU NULLS FIRST) AS line_no, Make, Model, Width, Profile, Rim, Segment, Category, SKU FROM ({ANALYSIS})""",
        *SLOT_READS, e=enriched(), d=DISTINCT, listed=LISTED_SPACES,
    )
    out["size_file_lines"] = query(
        f"SELECT row_number() OVER (ORDER BY slot_number, Size, product_id) AS line_no, slot_number, Size, product_id FROM ({SIZE_FILE})", "wide", "prices"
    )
    out["runlist_first"] = query(f"SELECT * FROM ({usable}) ORDER BY position LIMIT 100", "runlist")
    out["page_records"] = query(
        """SELECT position // 50 AS page, row_number() OVER (PARTITION BY position // 50 ORDER BY position) - 1 AS at, 'all' AS Segment, Vehicle, Size, HB1, HB4,
          array_to_string(list_filter(cells, lambda x: trim(x) <> ''), ' ') AS SKUs, success FROM answers""",
        "answers",
    )
    out["contract_breaks"] = query("SELECT position, 20 - position % 2 AS n, success FROM answers WHERE position % 2 = 1 OR NOT success", "answers")
    out["error_lines"] = query(
        f"SELECT Vehicle, Size, replace(Vehicle, ' ', '_') || ' ' || replace(replace(Size, '/', '-'), ' ', '_') || ' {' '.join(['NoContent'] * 4 + ['-'] * 20)}' AS line FROM asked",
        "asked",
    )
    out["failure_codes"] = query(
        f"""SELECT position, batch, batch % 7 <> 3 AS success, CASE WHEN batch % 7 = 3 THEN 'BATCH_FAILED' WHEN position % 3 = 0 THEN 'TIMEOUT' WHEN position % 3 = 1 THEN 'UPSTREAM_ERROR'
          ELSE 'INTERNAL_ERROR' END AS error_code FROM (SELECT position, (row_number() OVER (ORDER BY position) - 1) // 64 AS batch FROM ({usable}))""",
        "runlist",
    )
    out["segment_rows"] = query("SELECT position, Vehicle, Size, Segment FROM fits WHERE Segment IN ('BUILDING', 'MACHINERY')", "fits")
    out["size_lookup"] = over_output(
        f"SELECT size_key, vehicle_key, ProductId, TyreScore, Units, OFFER FROM keyed WHERE contains(size_key, '175/') ORDER BY {CANDIDATE_ORDER} LIMIT 100"
    )
    days = {
        "snapshot_latest": ("snapshot_date",),
        "token_fact": ("snapshot_date",), "token_fact_strict": ("snapshot_date",), "analysis_wide": ("Today",), "dashboard_wide": ("Today",),
        "size_file": ("Start_date", "Review_date"), "best_placement": ("snapshot_date",), "merch_report": ("Date",),
        "rolling_replace": ("Date",),
    }
    for name, columns in days.items():
        shown = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in columns)
        out[name] = f"SELECT * REPLACE ({shown}) FROM ({out[name]})"
    out["cam_merge"] = f"SELECT * REPLACE (strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified) FROM ({out['cam_merge']})"
    return out

"""DuckDB versions of the derived input tables, as named common table expressions."""

from __future__ import annotations

from oracle.constants import BRANDS, CODES, ID_BASE, SEGMENTS


def texts(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


_SIZE = """(155 + 10 * (p_size % 10)) || '/' || (35 + 5 * (p_size % 8)) || ' '
    || CASE WHEN p_partkey % 13 = 5 THEN 'ZR' ELSE 'R' END || (14 + p_size % 7)
    || CASE WHEN p_partkey % 11 = 7 THEN ' 91V' ELSE '' END"""
_BRAND = f"({texts(BRANDS)})[CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER)]"
_ID = f"(p_partkey + {ID_BASE})"
SLOT_COLUMNS = [f"HB{i}" for i in range(1, 5)] + [f"SKU{i}" for i in range(1, 21)]


def _pick(values, index: str) -> str:
    return f"({texts(values)})[CAST({index} AS INTEGER) + 1]"


def _slots() -> str:
    cells = []
    for i, name in enumerate(SLOT_COLUMNS, start=1):
        cell = f"coalesce(max(ProductId) FILTER (slot = {i}), '-')"
        if name == "HB1":
            cell = f"CASE WHEN (length(Vehicle) + length(Size)) % 11 = 3 THEN '0' ELSE {cell} END"
        if name == "SKU2":
            cell = f"CASE WHEN {cell} = '-' THEN 'none' ELSE {cell} END"
        cells.append(f"{cell} AS {name}")
    return ", ".join(cells)


_N = "length(Vehicle) + CAST(regexp_extract(Size, '^([0-9]+)', 1) AS INTEGER)"
_MANUAL = "CAST(regexp_extract(Vehicle, '_([0-9]+)', 1) AS INTEGER)"


def _size_number(group: int) -> str:
    return f"regexp_extract(Size, '^([0-9]+)/([0-9]+) Z?R([0-9]+)', {group})"


def _result_sku(i: int) -> str:
    return (
        f"CASE WHEN (o_orderkey + {i}) % 17 = 0 THEN '-' WHEN (o_orderkey + {i}) % 23 = 0 THEN '1234567' "
        f"WHEN (o_orderkey + {i}) % 29 = 0 THEN ({ID_BASE // 100} + o_orderkey % 9) || '.0' "
        f"ELSE CAST({ID_BASE} + (o_orderkey * 7 + {i} * (o_orderkey % 3 + 1)) % 40 AS VARCHAR) END"
    )


def _run_token(i: int) -> str:
    variant = "((o_orderkey // 8) % 4)"
    return (
        f"CASE WHEN ({variant} + {i}) % 9 = 4 THEN '-' ELSE "
        f"CAST({ID_BASE} + ({variant} * 11 + {i} * 3 + o_custkey % 5) % 60 AS VARCHAR) END"
    )


_RESULT_SIZE = "(155 + 10 * (o_orderkey % 9)) || '/' || (35 + 5 * (o_orderkey % 6))"
_IDS = "concat_ws(' ', " + ", ".join(f"nullif({c}, 'none')" for c in SLOT_COLUMNS) + ")"
_PACKED = "regexp_replace(Size, '[/ ]', '', 'g')"

# name -> (names it reads, body)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "products": (
        (),
        f"""
        SELECT CASE WHEN p_partkey % 997 <> 996 THEN {_ID} END AS ProductId,
          CASE WHEN p_type IN ('STANDARD', 'LARGE') THEN 'Premium' WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'MidRange' ELSE 'Budget' END AS Grade,
          {_SIZE} AS Size, {_BRAND} AS Manufacturer, p_name AS Model,
          nullif(substr('ABCDEF', CAST(p_partkey % 7 + 1 AS INTEGER), 1), '') AS WetGrip,
          nullif(substr('ABCDEF', CAST(p_partkey % 5 + 1 AS INTEGER), 1), '') AS Fuel,
          (68 + p_partkey % 8) || {_pick(('-A', '-B', '-C', '-D'), 'p_partkey % 4')} AS Noise,
          price AS Price, price * (1 + (p_partkey % 5) * 0.02::DOUBLE) AS PrevPrice7, price * (1 - (p_partkey % 3) * 0.03::DOUBLE) AS PrevPrice28,
          {_pick(('Summer', 'Winter', 'AllSeason'), 'p_partkey % 3')} AS Season,
          CASE WHEN copy = 1 AND p_partkey % 10 = 5 THEN 'ONOFFER' WHEN p_partkey % 4 = 0 THEN 'ONOFFER' WHEN p_partkey % 4 = 1 THEN 'OnOffer' ELSE 'NOTOFFER' END AS Offer,
          CASE WHEN p_partkey % 6 = 0 THEN 'Yes' ELSE 'No' END AS OE,
          CASE WHEN p_partkey % 9 = 0 THEN 'Award' ELSE 'No' END AS AwardScore
        FROM (SELECT p.*, copy, p_retailprice * CASE WHEN copy = 1 AND p_partkey % 10 = 0 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END AS price
              FROM part p, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR p_partkey % 10 IN (0, 5))""",
    ),
    "catalogue": (
        (),
        f"""SELECT CAST({_ID} AS VARCHAR) AS SKU,
          {_pick(('Runflat', 'RUNFLAT', None, 'Standard', 'Standard', 'Standard', '', 'Standard'), 'p_partkey % 8')} AS run_flat
        FROM part WHERE p_partkey % 17 <> 3""",
    ),
    "prices": (
        (),
        f"SELECT CAST({_ID} AS VARCHAR) AS SKU, CASE WHEN p_partkey % 19 <> 0 THEN {_BRAND} END AS Brand FROM part WHERE p_partkey % 29 <> 1",
    ),
    "report_catalogue": (
        (),
        f"""SELECT CASE WHEN p_partkey % 31 = 2 THEN 'x' || p_partkey ELSE CAST({_ID} AS VARCHAR) END AS Product_ID,
          CASE WHEN p_partkey % 14 <> 3 THEN {_BRAND} END AS Manufacturer, p_name AS Model_Name,
          {_pick(('', None, 'Yes', 'No', 'No'), 'p_partkey % 5')} AS OE
        FROM part WHERE p_partkey % 23 <> 5""",
    ),
    "owners": (
        (),
        "SELECT c_custkey, n_nationkey, n_regionkey, n_name AS make, c_mktsegment AS model FROM customer JOIN nation ON c_nationkey = n_nationkey",
    ),
    "vehicles": (("owners",), "SELECT DISTINCT n_nationkey, n_regionkey, make, model FROM owners"),
    "sales": (
        ("owners",),
        f"""
        SELECT CAST(l_partkey + {ID_BASE} AS VARCHAR) AS ProductId, make AS CarMake, model AS CarModel,
          CAST(count(DISTINCT l_orderkey) AS VARCHAR) AS Orders,
          CAST(CASE WHEN l_partkey % 37 = 4 THEN 0 ELSE CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS BIGINT) END AS VARCHAR) AS Units,
          CAST(floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) * 100 + 0.5) / 100 AS VARCHAR) AS AvgPrice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN owners ON o_custkey = c_custkey
        GROUP BY l_partkey, make, model""",
    ),
    "mapping": (
        ("vehicles",),
        f"""SELECT CASE WHEN n_nationkey % 2 = 0 THEN lower(make || ' ' || model) ELSE make || '-' || model END AS vehicle,
          make AS CarMake, model AS CarModel, 'POD' || n_regionkey AS Pod,
          {_pick(('City', 'Family', 'Sport', None), 'n_nationkey % 4')} AS Category, model AS Segment
        FROM vehicles WHERE n_nationkey % 13 <> 12""",
    ),
    "influence": (
        ("vehicles",),
        """SELECT make || model AS Vehicle, CASE WHEN n_nationkey % 7 <> 6 THEN model END AS Segment,
          CAST(10 + n_nationkey * 0.5 AS DOUBLE) AS PRICE_pct, CASE WHEN n_nationkey % 3 <> 1 THEN CAST(20 + n_nationkey * 0.5 AS DOUBLE) END AS GRADE_pct,
          CAST(30 + n_nationkey * 0.25 AS DOUBLE) AS FUEL_pct, CAST(40 + n_nationkey * 0.5 AS DOUBLE) AS WET_GRIP_pct,
          CASE WHEN n_nationkey % 2 = 0 THEN CAST(5 + n_nationkey * 0.5 AS DOUBLE) END AS AWARD_SCORE_pct
        FROM vehicles WHERE n_nationkey % 5 <> 4""",
    ),
    "sellers": (
        ("sales",),
        f"""
        SELECT * FROM (
          SELECT ProductId, CarMake || ' ' || CarModel AS Vehicle, s.Size,
            row_number() OVER (PARTITION BY CarMake, CarModel, s.Size ORDER BY CAST(Units AS BIGINT) DESC, ProductId) AS slot
          FROM sales JOIN (SELECT CAST({_ID} AS VARCHAR) AS pid, {_SIZE} AS Size FROM part) s ON pid = ProductId) WHERE slot <= 24""",
    ),
    "wide": (("sellers",), f"SELECT Vehicle, Size, {_slots()} FROM sellers GROUP BY Vehicle, Size"),
    "manual": (
        ("sellers",),
        f"""
        SELECT CASE WHEN {_MANUAL} % 2 = 0
            THEN concat_ws(' ', replace(split_part(Vehicle, ' ', 1), '_', ''), split_part(Vehicle, ' ', 2), {_size_number(1)}, {_size_number(2)}, {_size_number(3)})
            ELSE replace(split_part(Vehicle, ' ', 1), '_', '') || '-' || lower(split_part(Vehicle, ' ', 2)) || ' ' || {_size_number(1)} || '/' || {_size_number(2)} || ' R' || {_size_number(3)}
          END AS CAM
        FROM sellers WHERE slot = 1 AND (CAST({_size_number(1)} AS INTEGER) + CAST({_size_number(2)} AS INTEGER) + {_MANUAL}) % 7 = 0""",
    ),
    "staging": (
        ("wide",),
        f"""
        SELECT CASE WHEN copy = 1 THEN lower(Vehicle) ELSE Vehicle END AS Vehicle, Size,
          CASE WHEN copy = 1 THEN HB2 ELSE HB1 END AS HB1,
          {", ".join(c if c != "SKU5" else "CASE WHEN n % 5 = 0 THEN '  ' ELSE SKU5 END AS SKU5" for c in SLOT_COLUMNS if c != "HB1")},
          CASE WHEN n % 14 <> 13 THEN TIMESTAMP '2024-01-20' + to_days(CAST(n % 9 AS INTEGER)) + to_hours(copy) END AS last_modified
        FROM (SELECT *, {_N} AS n FROM wide), (VALUES (0), (1)) c(copy) WHERE copy = 0 OR n % 6 = 0""",
    ),
    "target": (
        ("wide",),
        f"""
        SELECT lower(split_part(Vehicle, ' ', 1)) AS Make, ' ' || split_part(Vehicle, ' ', 2) AS Model,
          regexp_extract(Size, '^([0-9]+)', 1) AS Width, regexp_extract(Size, '/([0-9]+)', 1) || ' ' AS Profile, regexp_extract(Size, 'R([0-9]+)', 1) AS Rim,
          {", ".join(f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN '2' || substr({c}, 2, 7) END AS SKU{i}" for i, c in enumerate(SLOT_COLUMNS, 1))},
          CASE WHEN n % 10 <> 7 THEN TIMESTAMP '2024-01-20' + to_days(CAST(n % 9 + CASE n % 4 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS INTEGER)) END AS last_modified
        FROM (SELECT *, {_N} AS n FROM wide) WHERE n % 3 <> 0""",
    ),
    "clicks": (
        (),
        f"""
        SELECT event_id AS e, ts, strftime(ts, '%Y%m%d') AS event_date,
          CASE event_type WHEN 'view' THEN 'view_item_list' WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_name,
          coalesce(CASE WHEN event_id % 59 <> 0 THEN CAST(user_id AS VARCHAR) END, CASE WHEN event_id % 118 <> 0 THEN 'device' || user_id END) AS user_id,
          CASE WHEN event_id % 41 = 0 THEN 'France' ELSE 'United Kingdom' END AS country,
          CASE WHEN event_id % 37 <> 0 THEN 'https://shop.example/' || CASE WHEN event_id % 31 = 0 THEN 'truck' WHEN event_id % 29 = 0 THEN 'seasonal' ELSE 'tyres' END
            || '?cam=' || {_pick(SEGMENTS, '(user_id // 25) % 5')} || '&p=1' END AS page,
          CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS txn,
          CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 47 = 0 THEN 'x99' ELSE CAST({ID_BASE} + k AS VARCHAR) END AS item_id,
          (155 + 10 * (k % 10)) || '-' || (35 + 5 * (k % 8)) || '-' || (14 + k % 7) AS list_id,
          CASE WHEN line = 2 THEN '2' WHEN event_id % 97 = 0 THEN '(not set)' WHEN event_id % 89 = 0 THEN '99' WHEN event_id % 83 = 0 THEN 'first'
            WHEN event_id % 6 = 5 THEN '200' ELSE CAST(event_id % 6 AS VARCHAR) END AS list_index,
          'model ' || (k % 9) AS category, 'brand ' || (k % 5) AS brand, 'v' || (k % 3) AS variant,
          CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 15 = 0 THEN ' No VRM Search'
            ELSE 'Nation_' || (user_id % 25) || ' ' || upper(substr({_pick(SEGMENTS, '(user_id // 25) % 5')}, 1, 1)) || lower(substr({_pick(SEGMENTS, '(user_id // 25) % 5')}, 2)) END AS vehicle,
          CASE WHEN event_id % 43 <> 0 THEN value END AS price, CASE WHEN event_id % 4 <> 3 THEN event_id % 4 END AS quantity,
          {_pick(CODES, f'event_id % {len(CODES)}')} AS code
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events), (VALUES (1), (2)) l(line)
        WHERE event_id % 101 <> 0 AND (line = 1 OR event_id % 7 = 0)""",
    ),
    "runs": (
        ("owners",),
        f"""
        SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'model-large' ELSE 'model-lite' END AS Model, o_orderkey % 3 = 0 AS Search_Enabled,
          CASE WHEN o_orderkey % 5 < 2 THEN 0 ELSE 2048 END AS Thinking_Budget, make || ' ' || model AS Vehicle,
          (155 + 10 * (o_orderkey % 3)) || '/55 R16' AS Size, o_orderkey AS Run_ID, o_orderstatus <> 'P' AS Success,
          140000 + o_orderkey % 1000 AS Input_Tokens, 190 + o_orderkey % 40 AS Output_Tokens, 140190 + o_orderkey % 1000 + o_orderkey % 40 AS Total_Tokens,
          [{", ".join(_run_token(i) for i in range(1, 21))}] AS tokens
        FROM orders JOIN owners ON o_custkey = c_custkey""",
    ),
    "answers": (
        ("owners",),
        f"""
        SELECT o_orderkey AS position,
          CASE o_orderkey % 8 WHEN 2 THEN make WHEN 3 THEN v || ' ' || s || 'R15' WHEN 5 THEN v || '90' WHEN 7 THEN '  ' || v || '  X ' ELSE v END AS Vehicle,
          CASE o_orderkey % 8 WHEN 0 THEN s || 'R16' WHEN 1 THEN s || 'ZR18' WHEN 2 THEN model || ' ' || s || ' R17' WHEN 3 THEN '' WHEN 4 THEN '31/10.50 R15'
            WHEN 5 THEN '7.50R16' WHEN 6 THEN '31x10.50R15' ELSE 'unknown' END AS Size,
          CASE WHEN o_orderkey % 31 = 0 THEN 'FormatError' ELSE {_result_sku(30)} END AS HB1, {_result_sku(31)} AS HB2, {_result_sku(32)} AS HB3, {_result_sku(33)} AS HB4,
          [{", ".join(_result_sku(i) for i in range(1, 23))}, '', ''] AS cells, o_orderkey % 31 <> 0 AS success
        FROM (SELECT o_orderkey, make, model, make || ' ' || model AS v, {_RESULT_SIZE} AS s FROM orders JOIN owners ON o_custkey = c_custkey)""",
    ),
    "raw": (
        ("wide",),
        f"""
        SELECT Vehicle, Size, CASE n % 11
            WHEN 0 THEN concat_ws(' ', Vehicle, Size, {_IDS})
            WHEN 1 THEN concat_ws(' ', replace(Vehicle, ' ', '_'), {_PACKED}, {_IDS})
            WHEN 2 THEN 'Here is the result:' || chr(10) || concat_ws(' ', lower(Vehicle), {_PACKED}, {_IDS})
            WHEN 3 THEN 'For ' || Vehicle || ' (' || Size || '): ' || replace({_IDS}, ' ', ', ')
            WHEN 4 THEN concat_ws(' ', Vehicle, {_PACKED}, HB1)
            WHEN 5 THEN 'sorry, nothing found for this request today'
            WHEN 6 THEN concat_ws(' ', Vehicle, {_PACKED}, HB1, HB1, HB2, HB3, HB3, SKU1)
            WHEN 7 THEN '' WHEN 8 THEN NULL
            WHEN 9 THEN concat_ws(' ', 'NoDataError', {_PACKED}, {_IDS})
            ELSE Vehicle || '  ' || {_PACKED} || chr(9) || {_IDS} || chr(10) END AS raw_text
        FROM (SELECT *, {_N} + {_MANUAL} AS n FROM wide)""",
    ),
    "asked": (
        ("owners",),
        """
        SELECT Vehicle, Size, min(Segment) AS Segment FROM (
          SELECT CASE WHEN o_orderkey % 7 = 3 THEN make || ' NEW' ELSE make || ' ' || model END AS Vehicle,
            (155 + 10 * (number % 10)) || '/' || (35 + 5 * (number % 8)) || ' R' || CASE WHEN number = 51 THEN 22 ELSE 14 + number % 7 END AS Size, model AS Segment
          FROM (SELECT *, o_orderkey % 51 + 1 AS number FROM orders JOIN owners ON o_custkey = c_custkey)) GROUP BY Vehicle, Size""",
    ),
    "runlist": (
        ("owners",),
        """
        SELECT o_orderkey AS position, CASE WHEN o_orderkey % 19 = 3 THEN 'nan' WHEN o_orderkey % 19 = 4 THEN NULL ELSE make || ' ' || model END AS Vehicle,
          CASE WHEN o_orderkey % 23 = 5 THEN 'None' ELSE (155 + 10 * (o_orderkey % 9)) || '/55 R16' END AS Size, CAST(o_orderkey % 1000 AS VARCHAR) AS PriorityRank
        FROM orders JOIN owners ON o_custkey = c_custkey""",
    ),
    "fits": (
        ("owners",),
        """
        SELECT * FROM (SELECT o_orderkey AS position,
          trim(CASE WHEN o_orderkey % 37 = 5 THEN '  ' ELSE CASE WHEN o_orderkey % 2 = 0 THEN lower(make) ELSE make END || ' ' || model END) AS Vehicle,
          CASE WHEN o_orderkey % 41 = 7 THEN '31/10.50 R15' ELSE (155 + 10 * (o_orderkey % 9)) || '/' || (5 + 5 * (o_orderkey % 12)) || ' R16' END AS Size,
          'POD' || (o_orderkey % 4) AS Pod, model AS Segment
        FROM orders JOIN owners ON o_custkey = c_custkey) WHERE Vehicle <> ''""",
    ),
    "log": (
        (),
        """
        SELECT CAST(user_id AS VARCHAR) AS run_id, ts, event_id AS line,
          CASE event_id % 5 WHEN 0 THEN 'Starting Stage ' || (event_id % 9 + 1) || ': load' WHEN 1 THEN NULL
            WHEN 2 THEN 'starting stage  ' || (event_id % 9 + 1) ELSE 'row ' || event_id END AS textPayload
        FROM events""",
    ),
}


def query(final: str, *reads: str, **steps: str) -> str:
    """``WITH`` the tables read (and what they read), then named steps, then ``final``."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in TABLES[name][0]:
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in reads:
        need(name)
    parts = [f"{name} AS MATERIALIZED ({TABLES[name][1]})" for name in wanted] + [f"{n} AS ({body})" for n, body in steps.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final

"""Likeness, influence and the mix of grades as DuckDB SQL over the scored table."""

from __future__ import annotations

from oracle.constants import INFLUENCE

VALID = "regexp_full_match(CAST(ProductId AS VARCHAR), '[0-9]{7,8}')"
LETTERS = "['A', 'B', 'C', 'D', 'E', 'F', 'G']"
FACTORS = [c for c in INFLUENCE if c.endswith("_pct")]
GRADES = (("Premium", "PremiumShare", 50), ("MidRange", "MidRangeShare", 25), ("Budget", "BudgetShare", 25))

ATTRIBUTES = f"""
      SELECT size_key, CAST(ProductId AS VARCHAR) AS id, min(lower(BRAND)) AS brand,
        min(CASE lower(GRADE) WHEN 'premium' THEN 0 WHEN 'midrange' THEN 1 WHEN 'budget' THEN 2 END) AS level,
        min(list_position({LETTERS}, upper(WET_GRIP)) - 1) AS wet, min(list_position({LETTERS}, upper(FUEL)) - 1) AS fuel,
        min(TRY_CAST(regexp_extract(NOISE_REDUCTION, '^([0-9]{{1,4}})', 1) AS INTEGER)) AS noise, min(lower(SEASONAL_PERFORMANCE)) AS season,
        min(PRICE) AS price, max(CAST(lower(AWARD_SCORE) = 'award' AS INTEGER)) AS award
      FROM keyed WHERE {VALID} GROUP BY 1, 2"""
BOUGHT = f"""
      SELECT size_key, vehicle_key, CAST(ProductId AS VARCHAR) AS id, max(Units) AS units, min(TyreScore) AS tier
      FROM keyed WHERE {VALID} AND Units > 0 GROUP BY 1, 2, 3"""

SIMILAR_STEPS = {
    "attributes": ATTRIBUTES,
    "bought": BOUGHT,
    "leads": "SELECT size_key, vehicle_key, id AS lead FROM bought QUALIFY row_number() OVER (PARTITION BY size_key, vehicle_key ORDER BY units DESC, tier, id) = 1",
    "gaps": """
      SELECT l.size_key, l.vehicle_key, b.id AS nearest, coalesce(abs(a.level - b.level) * 1000, 500) + coalesce(abs(a.wet - b.wet) * 250, 500)
        + coalesce(abs(a.fuel - b.fuel) * 250, 500) + coalesce(abs(a.noise - b.noise) * 100, 500)
        + CASE WHEN a.season IS NULL OR b.season IS NULL THEN 500 WHEN a.season = b.season THEN 0 ELSE 1000 END
        + coalesce(CASE WHEN a.price > 0 THEN CAST(floor(1000::DOUBLE * abs(a.price - b.price) / a.price) AS BIGINT) END, 500) AS distance
      FROM leads l JOIN attributes a ON a.size_key = l.size_key AND a.id = l.lead JOIN attributes b ON b.size_key = l.size_key AND b.brand = 'michelin'""",
}
SIMILAR = """
    SELECT l.size_key, l.vehicle_key, lead, nearest, CAST(distance AS BIGINT) AS distance FROM leads l
    LEFT JOIN (SELECT * FROM gaps QUALIFY row_number() OVER (PARTITION BY size_key, vehicle_key ORDER BY distance, nearest) = 1) g
      ON g.size_key = l.size_key AND g.vehicle_key = l.vehicle_key"""

COUSIN_STEPS = {
    "attributes": ATTRIBUTES,
    "bought": BOUGHT,
    "norms": "SELECT size_key, vehicle_key, sum(units * units) AS square, count(*) AS n FROM bought GROUP BY 1, 2",
    "dots": """
      SELECT a.size_key, a.vehicle_key, b.vehicle_key AS cousin, sum(a.units * b.units) AS dot
      FROM bought a JOIN bought b ON b.size_key = a.size_key AND b.id = a.id AND b.vehicle_key <> a.vehicle_key GROUP BY 1, 2, 3""",
    "cousins": """
      SELECT d.size_key, d.vehicle_key, row_number() OVER (PARTITION BY d.size_key, d.vehicle_key ORDER BY cosine DESC, cousin) AS place, cousin, cosine
      FROM (SELECT d.*, CAST(floor(1e6::DOUBLE * dot::DOUBLE / sqrt(x.square::DOUBLE * y.square::DOUBLE)) AS BIGINT) AS cosine, x.n
        FROM dots d JOIN norms x ON x.size_key = d.size_key AND x.vehicle_key = d.vehicle_key JOIN norms y ON y.size_key = d.size_key AND y.vehicle_key = d.cousin) d
      WHERE n < 24 QUALIFY place <= 5""",
    "offered": """
      SELECT c.size_key, c.vehicle_key, b.id, sum(c.cosine * b.units) AS weight FROM cousins c JOIN bought b ON b.size_key = c.size_key AND b.vehicle_key = c.cousin
      WHERE NOT EXISTS (SELECT 1 FROM bought o WHERE o.size_key = c.size_key AND o.vehicle_key = c.vehicle_key AND o.id = b.id) GROUP BY 1, 2, 3""",
    "told": """
      SELECT o.size_key, o.vehicle_key, o.id, CAST(o.weight AS BIGINT) AS weight, n.n,
        a.brand IN (SELECT p.brand FROM bought x JOIN attributes p ON p.size_key = x.size_key AND p.id = x.id WHERE x.size_key = o.size_key AND x.vehicle_key = o.vehicle_key) AS known_brand
      FROM offered o JOIN attributes a ON a.size_key = o.size_key AND a.id = o.id JOIN norms n ON n.size_key = o.size_key AND n.vehicle_key = o.vehicle_key""",
}
COUSINS = "SELECT * FROM cousins"
COUSIN_PRODUCTS = """
    SELECT size_key, vehicle_key, place, id, known_brand, weight
    FROM (SELECT *, row_number() OVER (PARTITION BY size_key, vehicle_key ORDER BY known_brand DESC, weight DESC, id) AS place FROM told) WHERE place + n <= 24"""


def influence(mean) -> tuple[str, dict[str, str]]:
    """The query and its steps; ``mean`` gives the exact average of a column."""
    ways = {"PRICE_pct": "price", "GRADE_pct": "level", "FUEL_pct": "fuel", "WET_GRIP_pct": "wet", "AWARD_SCORE_pct": "-award"}
    steps = {
        "attributes": ATTRIBUTES,
        "facts": "SELECT size_key, vehicle_key, min(Segment) FILTER (Segment <> 'NO SALES YET') AS Segment, "
        + ", ".join(f"max(TRY_CAST({c} AS DOUBLE)) AS {c}" for c in FACTORS) + " FROM keyed GROUP BY 1, 2",
        "means": f"SELECT Segment, {', '.join(f'{mean(c)} AS {c}' for c in FACTORS)} FROM facts WHERE Segment IS NOT NULL GROUP BY 1",
        "weights": "SELECT size_key, vehicle_key, "
        + " + ".join(f"CAST(f.{c} IS NOT NULL AS INTEGER)" for c in FACTORS) + " AS from_fit, "
        + ", ".join(f"CAST(floor(coalesce(f.{c}, m.{c}, 20) * 100 + 0.5::DOUBLE) AS BIGINT) AS {c}" for c in FACTORS)
        + " FROM facts f LEFT JOIN means m ON m.Segment = f.Segment",
        "places": "SELECT size_key, id, "
        + ", ".join(f"dense_rank() OVER (PARTITION BY size_key ORDER BY {ways[c]} NULLS LAST) AS {c}" for c in FACTORS) + " FROM attributes",
        "rated": "SELECT w.size_key, w.vehicle_key, o.id, from_fit, "
        + " + ".join(f"w.{c} * (1000000 // (60 + p.{c}))" for c in FACTORS)
        + f""" AS fused FROM (SELECT DISTINCT size_key, vehicle_key, CAST(ProductId AS VARCHAR) AS id FROM keyed WHERE {VALID}) o
        JOIN places p ON p.size_key = o.size_key AND p.id = o.id JOIN weights w ON w.size_key = o.size_key AND w.vehicle_key = o.vehicle_key""",
    }
    final = "SELECT size_key, vehicle_key, row_number() OVER (PARTITION BY size_key, vehicle_key ORDER BY fused DESC, id) AS place, id, fused, from_fit FROM rated QUALIFY place <= 10"
    return final, steps


def quotas(rows: str, mean, slots: int = 20) -> tuple[str, dict[str, str]]:
    """Seats by largest remainder, a row for each grade, in rounds; ``rows`` are the scored rows of valid products."""
    known = "coalesce(greatest(f.PremiumShare, f.MidRangeShare, f.BudgetShare) > 0, false)"
    steps = {
        "feat": rows,
        "fit": "SELECT size_key, vehicle_key, " + ", ".join(f"max({c}) AS {c}" for _, c, _ in GRADES)
        + ", " + ", ".join(f"count(DISTINCT id) FILTER (grade = '{g}') AS have_{g}" for g, _, _ in GRADES) + " FROM feat GROUP BY 1, 2",
        "seg": "SELECT Segment, " + ", ".join(f"{mean(c)} AS seg_{c}" for _, c, _ in GRADES)
        + " FROM (SELECT Segment, size_key, vehicle_key, " + ", ".join(f"max({c}) AS {c}" for _, c, _ in GRADES)
        + " FROM feat WHERE Segment <> 'NO SALES YET' AND greatest(PremiumShare, MidRangeShare, BudgetShare) > 0 GROUP BY ALL) GROUP BY 1",
    }
    each = " UNION ALL ".join(
        f"""SELECT w.size_key, w.vehicle_key, {known} AS known, {i} AS g, coalesce(f.have_{g}, 0) AS have,
          CAST(floor(CASE WHEN {known} THEN f.{c} ELSE coalesce(s.seg_{c}, {d}::DOUBLE) END * 100 + 0.5::DOUBLE) AS BIGINT) AS w
        FROM wanted w LEFT JOIN fit f ON f.size_key = w.size_key AND f.vehicle_key = w.vehicle_key LEFT JOIN seg s ON s.Segment = w.Segment"""
        for i, (g, c, d) in enumerate(GRADES)
    )
    steps["seats0"] = f"SELECT *, 0::BIGINT AS quota, 0::BIGINT AS taken FROM ({each})"
    fit = "PARTITION BY size_key, vehicle_key"

    def shared(at: int, column: str, room: str) -> None:
        steps[f"seats{at + 1}"] = f"""
      SELECT * EXCLUDE (open_, w_, all_, left_, part_, rem_, over_, first_)
        REPLACE (least({room}, {column} + part_ + CASE WHEN rem_ > 0 AND first_ <= over_ THEN 1 ELSE 0 END) AS {column}) FROM (
        SELECT *, left_ - sum(part_) OVER ({fit}) AS over_, row_number() OVER ({fit} ORDER BY rem_ DESC, g) AS first_ FROM (
          SELECT *, left_ * w_ // greatest(all_, 1) AS part_, left_ * w_ % greatest(all_, 1) AS rem_ FROM (
            SELECT *, sum(w_) OVER ({fit}) AS all_ FROM (
              SELECT *, CASE WHEN NOT open_ THEN 0 WHEN sum(CASE WHEN open_ THEN w ELSE 0 END) OVER ({fit}) > 0 THEN w ELSE 1 END AS w_ FROM (
                SELECT *, {column} < {room} AS open_, {slots} - sum({column}) OVER ({fit}) AS left_ FROM seats{at})))))"""

    for k in range(3):
        shared(k, "quota", str(slots))
    for k in range(3, 6):
        shared(k, "taken", "have")
    cells = ", ".join(f"CAST(max({x}) FILTER (g = {i}) AS BIGINT) AS {x}_{g}" for x in ("quota", "have", "taken") for i, (g, _, _) in enumerate(GRADES))
    return f"SELECT size_key, vehicle_key, bool_or(known) AS known, {cells} FROM seats6 GROUP BY 1, 2", steps


KEPT = [f"HB{i}" for i in range(1, 5)] + [f"SKU{i}" for i in range(1, 21)]


def damaged(told: str) -> str:
    """The answers of which five in six are spoiled."""
    new = {
        "HB1": "CASE kind WHEN 2 THEN '-' WHEN 3 THEN coalesce(cheap_id, HB1) WHEN 5 THEN HB4 ELSE HB1 END", "HB2": "CASE kind WHEN 1 THEN HB1 ELSE HB2 END",
        "HB4": "CASE kind WHEN 4 THEN '99999999' WHEN 5 THEN HB1 WHEN 2 THEN '-' ELSE HB4 END", "SKU1": "CASE WHEN kind IN (1, 4) THEN SKU2 ELSE SKU1 END",
    }
    return f"""
      SELECT Vehicle, Size, size_key, vehicle_key, {", ".join(f"{new.get(c, c)} AS {c}" for c in KEPT)}
      FROM (SELECT *, (length(Vehicle) + 2 * length(Size) + coalesce(TRY_CAST(substr(Size, 1, 3) AS INTEGER), 0) // 10) % 6 AS kind FROM ({told}))
        LEFT JOIN (SELECT size_key, min(id) AS cheap_id FROM feat WHERE grade = 'Budget' GROUP BY 1) USING (size_key)"""


def context(answers: str) -> dict[str, str]:
    """Steps that end in ``ctx``: answers with what is known of their boxes and fits."""
    return {
        "spoiled": answers,
        "boxed": """
      SELECT Vehicle, Size, list(struct_pack(pos := pos, id := t.id, there := f.id IS NOT NULL, grade := grade, a := a, b := b, runflat := runflat, m := m, brand := brand) ORDER BY pos) AS boxes
      FROM (SELECT Vehicle, Size, size_key, unnest([0, 1, 2, 3]) AS pos, unnest([HB1, HB2, HB3, HB4]) AS id FROM spoiled) t LEFT JOIN best_size f ON f.size_key = t.size_key AND f.id = t.id GROUP BY 1, 2""",
        "middle": f"""
      SELECT size_key, list(id ORDER BY price NULLS LAST, id) AS cheap FROM best_size JOIN (SELECT size_key, CAST(ProductId AS VARCHAR) AS id, min(PRICE) AS price FROM keyed WHERE {VALID} GROUP BY 1, 2) USING (size_key, id)
      WHERE a AND grade = 'MidRange' GROUP BY 1""",
        "ctx": f"""
      SELECT Vehicle, Size, boxes, [HB1, HB2, HB3, HB4] AS ids_, [{", ".join(KEPT[4:])}] AS more_, coalesce(pool, []) AS pool, coalesce(own_ids, []) AS own_ids, coalesce(pool_b, []) AS pool_b, coalesce(popular, []) AS popular, gate, wanted_flats, PremiumShare, coalesce(cheap, []) AS cheap
      FROM spoiled s JOIN boxed USING (Vehicle, Size) LEFT JOIN (SELECT size_key, vehicle_key, pool, own_ids, pool_b, popular, gate, wanted_flats, PremiumShare FROM lists) l
        ON l.size_key = s.size_key AND l.vehicle_key = s.vehicle_key LEFT JOIN middle c ON c.size_key = s.size_key""",
    }


def _some(items: str, test: str) -> str:
    return f"list_filter({items}, lambda x: {test})"


def _top(items: str, test: str) -> str:
    return f"({_some(items, test)}[1]).id"


def _any(items: str, test: str) -> str:
    return f"(len({_some(items, test)}) > 0)"


FREE = "NOT list_contains(ids_, x.id)"
BREAKS = {
    "other_size": _top("boxes", "x.id <> '-' AND NOT x.there"),
    "repeated": "nullif(array_to_string(list_filter(ids_, lambda x, i: x <> '-' AND list_contains(ids_[:i - 1], x) AND NOT list_contains(ids_[i + 1:], x)), ' '), '')",
    "repeated_more": "(SELECT string_agg(id, ' ' ORDER BY pos) FROM (SELECT id, min(pos) AS pos FROM (SELECT unnest(more_) AS id, unnest(range(20)) AS pos) WHERE id <> '-' GROUP BY id HAVING count(*) > 1))",
    "budget_too_high": _top("boxes", "x.pos < 3 AND x.grade = 'Budget'"),
    "not_in_set_a": _top("boxes", "x.pos < 3 AND x.there AND NOT x.a AND coalesce(x.grade <> 'Budget', true)"),
    "not_in_set_b": _top("boxes", "x.pos = 3 AND x.there AND NOT x.b"),
    "too_many_budget": f"CASE WHEN len({_some('boxes', 'x.grade = $$Budget$$')}) > 1 THEN array_to_string(list_transform({_some('boxes', 'x.grade = $$Budget$$')}, lambda x: x.id), ' ') END",
    "budget_behind_gate": f"CASE WHEN NOT gate THEN {_top('boxes', 'x.pos = 3 AND x.grade = $$Budget$$')} END",
    "gate_without_budget": f"CASE WHEN gate AND NOT {_any('boxes', 'x.grade = $$Budget$$')} THEN {_top('pool_b', f'x.grade = $$Budget$$ AND {FREE}')} END",
    "empty_high_box": f"CASE WHEN list_contains(ids_[:3], '-') THEN {_top('pool', f'x.a AND {FREE}')} END",
    "empty_box_four": f"CASE WHEN ids_[4] = '-' THEN {_top('pool_b', f'{FREE} AND (gate OR x.grade <> $$Budget$$)')} END",
    "top_seller_missing": "CASE WHEN NOT list_contains(list_concat(ids_, more_), (popular[1]).id) THEN (popular[1]).id END",
    "named_brand_missing": f"CASE WHEN PremiumShare >= 25 AND NOT {_any('boxes', 'x.brand = $$michelin$$')} THEN {_top('popular[:5]', 'x.brand = $$michelin$$ AND x.a')} END",
    "runflats_short": f"CASE WHEN len({_some('boxes', 'x.pos < 3 AND x.runflat')}) < wanted_flats AND "
    + _any("boxes", "x.pos < 3 AND NOT coalesce(x.runflat, false) AND NOT coalesce(x.id = (popular[1]).id, false) AND NOT coalesce(x.brand = $$michelin$$, false) AND NOT coalesce(x.m, false)")
    + f" THEN {_top('pool', f'x.a AND x.runflat AND {FREE}')} END",
    "enhancer_missing": f"CASE WHEN NOT {_any('boxes', 'x.m')} AND NOT {_any('pool', 'x.m AND list_contains(more_, x.id)')} THEN {_top('pool', 'x.m')} END",
    "other_vehicle": f"CASE WHEN {_any('pool', f'x.a AND list_contains(own_ids, x.id) AND {FREE}')} THEN "
    + _top("boxes", "x.pos < 3 AND x.there AND x.a AND NOT x.runflat AND NOT x.m AND NOT list_contains(own_ids, x.id)") + " END",
    "short_of_more": f"CASE WHEN list_contains(more_, '-') THEN {_top('pool', f'{FREE} AND NOT list_contains(more_, x.id)')} END",
}
FOUND = "SELECT Vehicle, Size, rule, evidence FROM (" + " UNION ALL ".join(f"SELECT Vehicle, Size, '{n}' AS rule, {e} AS evidence FROM ctx" for n, e in BREAKS.items()) + ") WHERE evidence IS NOT NULL"

NOT_HIGH = "NOT coalesce(list_contains(high, x.id), false)"
REPAIR_STEPS = {
    "r1": """
      SELECT *, list_transform(boxes, lambda x: CASE WHEN x.id = '-' THEN 'empty' WHEN NOT x.there THEN 'other_size' WHEN list_contains(ids_[:x.pos], x.id) THEN 'repeated'
        WHEN x.pos < 3 AND x.grade = 'Budget' THEN 'budget_too_high' WHEN x.pos < 3 AND NOT x.a THEN 'not_in_set_a' WHEN x.pos = 3 AND NOT x.b THEN 'not_in_set_b'
        WHEN x.pos = 3 AND x.grade = 'Budget' AND NOT gate THEN 'budget_behind_gate' END) AS bad FROM ctx""",
    "r2": f"""
      SELECT *, list_transform(boxes[:3], lambda x: CASE WHEN bad[x.pos + 1] IS NULL THEN x.id END) AS high, CASE WHEN bad[4] IS NULL THEN (boxes[4]).id END AS last_,
        bad[4] IS NULL AND coalesce((boxes[4]).grade = 'Budget', false) AS last_budget, {_some("boxes", "bad[x.pos + 1] = 'budget_too_high'")}[1] AS moved FROM r1""",
    "r3": f"SELECT *, {_some('pool_b', NOT_HIGH)} AS open_ FROM r2",
    "r4": f"""
      SELECT *, CASE WHEN last_budget THEN last_ WHEN gate AND coalesce(moved.b, false) THEN moved.id
        WHEN gate THEN coalesce({_top("open_", "x.grade = 'Budget'")}, last_) ELSE last_ END AS four FROM r3""",
    "r5": """
      SELECT *, CASE WHEN moved.id IS NOT NULL AND NOT coalesce(moved.id = four, false) THEN list_filter(cheap, lambda x: NOT coalesce(list_contains(high, x), false) AND NOT coalesce(x = four, false))[:1] ELSE [] END AS swap FROM r4""",
    "r6": f"SELECT *, list_concat(swap, list_filter(list_transform({_some('pool', f'x.a AND {NOT_HIGH} AND NOT coalesce(x.id = four, false)')}, lambda x: x.id), lambda y: NOT list_contains(swap, y))) AS spare FROM r5",
    "r7": "SELECT * REPLACE (list_transform(high, lambda x, i: coalesce(x, spare[1 + len(list_filter(high[:i - 1], lambda y: y IS NULL))])) AS high) FROM r6",
    "r7b": f"SELECT * REPLACE (coalesce(four, {_top('pool_b', f'x.grade <> $$Budget$$ AND {NOT_HIGH}')}) AS four) FROM r7",
    "r8": f"""
      SELECT *, {_any("pool", "x.m AND (coalesce(list_contains(high, x.id), false) OR coalesce(x.id = four, false))")} AS held,
        {_top("pool_b", f"x.m AND gate = (x.grade = 'Budget') AND {NOT_HIGH}")} AS wish_, {_top("pool", "x.m")} AS best_ FROM r7b""",
    "r9": """
      SELECT *, CASE WHEN NOT held AND wish_ IS NULL AND best_ IS NOT NULL THEN [best_] ELSE [] END AS front,
        list_transform(list_append(high, CASE WHEN NOT held AND wish_ IS NOT NULL THEN wish_ ELSE four END), lambda x: coalesce(x, '-')) AS now_ FROM r8""",
    "r10": """
      SELECT * REPLACE (CASE WHEN (popular[1]).id IS NULL OR list_contains(list_concat(now_, list_concat(more_, front)), (popular[1]).id) THEN front ELSE list_append(front, (popular[1]).id) END AS front),
        list_transform(list_filter(boxes, lambda x: x.there AND NOT list_contains(now_, x.id)), lambda x: x.id) AS lost FROM r9""",
    "r11": "SELECT *, list_filter(list_concat(list_concat(front, lost), list_concat(more_, list_transform(pool, lambda x: x.id))), lambda x: x <> '-' AND NOT list_contains(now_, x)) AS rest_ FROM r10",
    "r12": "SELECT *, list_concat(now_, list_concat(list_filter(rest_, lambda x, i: list_position(rest_, x) = i), list_transform(range(20), lambda x: '-'))) AS slots_ FROM r11",
}
REPAIRED = f"""
    SELECT Vehicle, Size, {", ".join(f"slots_[{i}] AS {c}" for i, c in enumerate(KEPT, 1))},
      array_to_string(list_concat(list_transform(list_filter(range(1, 5), lambda i: ids_[i] <> now_[i]), lambda i: 'HB' || i || ' ' || coalesce(bad[i], 'moved') || ': ' || ids_[i] || ' > ' || now_[i]),
        list_transform(list_filter(front, lambda x: more_[1] <> x), lambda x: 'SKU ' || x)), '; ') AS steps FROM r12"""

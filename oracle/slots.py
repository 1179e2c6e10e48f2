"""The slot rules as chained DuckDB steps over the lists of all products of a fit."""

from __future__ import annotations

from oracle.constants import BRANDS_A, BRANDS_B_ONLY

TRAITS = "id, grade, a, b, runflat, m, brand"
SHARES = (("Premium", "PremiumShare", 50.0), ("MidRange", "MidRangeShare", 25.0), ("Budget", "BudgetShare", 25.0))


def brands(names) -> str:
    return ", ".join(f"'{n.lower()}'" for n in names)


def rows(match: str) -> str:
    """Scored rows of valid products with what the rules ask; ``match``: the active enhancer's test."""
    active, good = "lower(SalesStatus) = 'active'", "lower(GRADE) IN ('premium', 'midrange')"
    return f"""
      SELECT size_key, vehicle_key, CAST(ProductId AS VARCHAR) AS id, lower(BRAND) AS brand, TyreScore AS tier, Units AS units,
        CASE lower(GRADE) WHEN 'premium' THEN 'Premium' WHEN 'midrange' THEN 'MidRange' WHEN 'budget' THEN 'Budget' ELSE GRADE END AS grade,
        CASE WHEN lower(OFFER) IN ('onoffer', '1', 'true') THEN 2 ELSE 0 END
          + CASE WHEN PRICE BETWEEN GoldilocksZone * (1 - 0.15::DOUBLE) AND GoldilocksZone * (1 + 0.15::DOUBLE) THEN 2 ELSE 0 END
          + CASE WHEN PRICEFLUCTUATION > 1.1::DOUBLE THEN -1 WHEN PRICEFLUCTUATION < 0.9::DOUBLE THEN 1 ELSE 0 END AS points,
        coalesce(lower(RunflatStatus) = 'runflat', false) AS runflat,
        coalesce({active} AND {good} AND lower(BRAND) IN ({brands(BRANDS_A)}), false) AS a,
        coalesce({active} AND ({good} OR lower(GRADE) = 'budget') AND lower(BRAND) IN ({brands(BRANDS_A + BRANDS_B_ONLY)}), false) AS b,
        coalesce({match}, false) AS m, Segment, PremiumShare, MidRangeShare, BudgetShare, RunflatShare
      FROM keyed WHERE regexp_full_match(CAST(ProductId AS VARCHAR), '[0-9]{{7,8}}')"""


def best(keys: str, source: str) -> str:
    order = "tier, points DESC, units DESC, grade NULLS FIRST, a, b, runflat, m, brand NULLS FIRST"
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys}, id ORDER BY {order}) = 1"


def lists(keys: str, source: str, name: str) -> str:
    item = f"struct_pack({', '.join(f'{t} := {t}' for t in TRAITS.split(', '))})"
    return (
        f"SELECT {keys}, list({item} ORDER BY tier, points DESC, units DESC, id) AS {name}_pool, "
        f"list({item} ORDER BY units DESC, tier, id) AS {name}_popular FROM {source} GROUP BY {keys}"
    )


def kept(items: str, test: str) -> str:
    return f"list_filter({items}, lambda x: {test})"


def first(items: str, test: str) -> str:
    return f"({kept(items, test)}[1]).id"


def answers(match: str, enhanced: bool, mean, makes=("bmw", "mercedes", "mini")) -> dict[str, str]:
    """Steps that end in ``slots`` (size_key, vehicle_key, slots); they read ``keyed`` and ``wanted``.

    ``mean`` gives the exact average of a column; ``makes`` want run-flats when the data say nothing.
    """
    steps = {
        "feat": rows(match),
        "best_own": best("size_key, vehicle_key", "feat"),
        "best_size": best("size_key", "best_own"),
        "own": lists("size_key, vehicle_key", "best_own", "own"),
        "whole": lists("size_key", "best_size", "size"),
        "fit": "SELECT size_key, vehicle_key, " + ", ".join(f"max({c}) AS {c}" for c in ("PremiumShare", "MidRangeShare", "BudgetShare", "RunflatShare")) + " FROM feat GROUP BY ALL",
        "seg": "SELECT Segment, " + ", ".join(f"{mean(c)} AS seg_{c}" for _, c, _ in SHARES)
        + " FROM (SELECT Segment, size_key, vehicle_key, " + ", ".join(f"max({c}) AS {c}" for _, c, _ in SHARES)
        + " FROM feat WHERE Segment <> 'NO SALES YET' AND greatest(PremiumShare, MidRangeShare, BudgetShare) > 0 GROUP BY ALL) GROUP BY 1",
    }
    known = "coalesce(greatest(f.PremiumShare, f.MidRangeShare, f.BudgetShare) > 0, false)"
    shares = ", ".join(f"CASE WHEN {known} THEN f.{c} ELSE coalesce(s.seg_{c}, {d}::DOUBLE) END AS {c}" for _, c, d in SHARES)
    steps["at0"] = f"""
      SELECT w.size_key, w.vehicle_key, coalesce(own_pool, size_pool) AS own_list, size_pool, coalesce(own_popular, size_popular) AS popular, {known} AS known,
        CASE WHEN {known} THEN RunflatShare ELSE 0 END AS runflat_share, {shares}
      FROM wanted w JOIN whole USING (size_key) LEFT JOIN own o ON o.size_key = w.size_key AND o.vehicle_key = w.vehicle_key
        LEFT JOIN fit f ON f.size_key = w.size_key AND f.vehicle_key = w.vehicle_key LEFT JOIN seg s ON s.Segment = w.Segment"""
    columns = {"size_key", "vehicle_key", "own_list", "size_pool", "popular", "known", "runflat_share", *(c for _, c, _ in SHARES)}
    count = 0

    def step(**new: str) -> None:
        nonlocal count
        old = ", ".join(f"{e} AS {n}" for n, e in new.items() if n in columns)
        more = "".join(f", {e} AS {n}" for n, e in new.items() if n not in columns)
        steps[f"at{count + 1}"] = f"SELECT *{f' REPLACE ({old})' if old else ''}{more} FROM at{count}"
        columns.update(new)
        count += 1

    def displace(new: str) -> None:
        free = kept("hot", "NOT list_contains(kept, x)")
        step(
            victim=f"CASE WHEN {new} IS NULL OR list_contains(hot, {new}) OR len(hot) < 3 THEN NULL ELSE {free}[-1] END",
            room=f"{new} IS NOT NULL AND (list_contains(hot, {new}) OR len(hot) < 3 OR len({free}) > 0)",
        )
        step(
            chosen=f"CASE WHEN room THEN list_append({kept('hot', 'victim IS NULL OR x <> victim')}, {new}) ELSE hot END",
            kept=f"CASE WHEN room THEN list_append(kept, {new}) ELSE kept END",
        )
        step(hot=kept("ids", "list_contains(chosen, x)"))

    step(own_ids="list_transform(own_list, lambda x: x.id)", lead="own_list[1]")
    step(cousins=kept("size_pool", "NOT list_contains(own_ids, x.id)"))
    alike = "x.grade IS NOT DISTINCT FROM lead.grade AND x.runflat = lead.runflat"
    step(pool=f"list_concat(own_list, list_concat({kept('cousins', alike)}, {kept('cousins', f'NOT ({alike})')}))")
    step(ids="list_transform(pool, lambda x: x.id)", gate="BudgetShare > 35", pool_b=kept("pool", "x.b"))
    step(hot=f"list_transform({kept('pool', 'x.a')}, lambda x: x.id)[1:3]", kept="CAST([] AS VARCHAR[])")
    step(open_b=kept("pool_b", "NOT list_contains(hot, x.id)"))
    wish = first("open_b", "x.m AND gate = (x.grade = 'Budget')") if enhanced else "CAST(NULL AS VARCHAR)"
    graded = lambda items: f"coalesce({first(items, 'gate = (x.grade = $$Budget$$)')}, {first(items, 'x.grade <> $$Budget$$')})"
    step(wish=wish, plain=graded("open_b"))
    step(box4="coalesce(wish, plain)", locked="wish IS NOT NULL", top="popular[1]")
    step(in_four="list_contains(hot, top.id) OR coalesce(top.id = box4, false)")
    step(
        star="CASE WHEN list_contains(hot, top.id) OR (NOT in_four AND top.a) THEN top.id END",
        star4="CASE WHEN NOT in_four AND top.b AND top.grade = 'Budget' AND gate AND NOT locked THEN top.id END",
    )
    displace("star")
    step(box4="coalesce(star4, box4)")
    step(
        has_brand=f"len({kept('pool', 'x.brand = $$michelin$$ AND (list_contains(hot, x.id) OR coalesce(x.id = box4, false))')}) > 0",
        seller=first("popular[1:5]", "x.brand = 'michelin' AND x.a"),
    )
    stays = first("pool", "x.brand = 'michelin' AND list_contains(hot, x.id)")
    step(named=f"CASE WHEN PremiumShare < 25 OR PremiumShare IS NULL OR seller IS NULL THEN NULL WHEN has_brand THEN {stays} ELSE seller END")
    displace("named")
    step(
        wanted_flats=f"CASE WHEN NOT known AND ({' OR '.join(f'starts_with(vehicle_key, $${m}$$)' for m in makes)}) THEN 3 WHEN NOT known THEN 0 WHEN runflat_share >= 85 THEN 3 WHEN runflat_share >= 55 THEN 2 WHEN runflat_share >= 20 THEN 1 ELSE 0 END",
        seller=first("popular", "x.runflat AND x.a"), runflats=f"list_transform({kept('pool', 'x.a AND x.runflat')}, lambda x: x.id)",
    )
    step(extra="CASE WHEN wanted_flats > 0 AND NOT coalesce(seller = box4, false) THEN seller END")
    displace("extra")
    for _ in range(3):
        have, spare = kept("hot", "list_contains(runflats, x)"), kept("runflats", "NOT list_contains(hot, x) AND NOT coalesce(x = box4, false)")
        step(extra=f"CASE WHEN len({have}) < wanted_flats THEN {spare}[1] END")
        displace("extra")
    step(still_b=kept("pool_b", "NOT list_contains(hot, x.id)"))
    step(box4=f"CASE WHEN list_contains(hot, box4) THEN {graded('still_b')} ELSE box4 END")
    step(boxes="list_append(list_concat(hot, [NULL, NULL, NULL])[1:3], box4)")
    step(rest=kept("pool", "NOT list_contains(boxes, x.id)"))
    step(rest_own=kept("rest", "list_contains(own_ids, x.id)"))
    part = lambda g, c: f"{kept('rest_own', f'x.grade = $${g}$$')}[1:CAST(floor({c} * 20 / 100 + 0.5) AS INTEGER)]"
    step(in_share=f"list_transform(list_concat({part(*SHARES[0][:2])}, list_concat({part(*SHARES[1][:2])}, {part(*SHARES[2][:2])})), lambda x: x.id)")
    forced = f"list_concat([top.id], CASE WHEN wish IS NULL THEN list_transform({kept('pool', 'x.m')}, lambda x: x.id)[1:1] ELSE [] END)" if enhanced else "[top.id]"
    step(
        forced=f"list_filter({forced}, lambda x: NOT list_contains(boxes, x))",
        sellers="list_filter(list_transform(popular, lambda x: x.id), lambda x: NOT list_contains(boxes, x))[1:5]",
        rest_ids="list_transform(rest, lambda x: x.id)",
    )
    step(more="list_concat(forced, list_concat(sellers, list_concat(list_filter(rest_ids, lambda x: list_contains(in_share, x)), rest_ids)))")
    step(more="list_filter(more, lambda x, i: list_position(more, x) = i)")
    dashes = "[" + ", ".join(["'-'"] * 20) + "]"
    step(slots=f"list_concat(list_transform(boxes, lambda x: coalesce(x, '-')), list_concat(more, {dashes})[1:20])")
    steps["lists"] = f"SELECT * FROM at{count}"
    steps["chosen_slots"] = f"SELECT size_key, vehicle_key, slots FROM at{count}"
    return steps

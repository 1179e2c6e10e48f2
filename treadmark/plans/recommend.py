"""Slot selection: four hotboxes and twenty further products per request.

The rules work on bounded lists.  Every fit (size and vehicle, or a size alone)
is reduced to its best products of every kind the rules tell apart, and the
steps after that are expressions over the lists of one row, so a step never
shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from treadmark.functions.lists import HOTBOXES, SKUS, as_columns, is_valid_id, padded
from treadmark.functions.numbers import clamped, exact_avg
from treadmark.functions.scoring import NO_SALES
from treadmark.operators.topk import best_n
from treadmark.session import durable
from treadmark.plans.candidates import NARROW, WIDE, keyed, keyed_requests

# Brands allowed in hotboxes 1-3, and those also allowed in hotbox 4.
BRANDS_A = (
    "Avon", "BFGoodrich", "Bridgestone", "Continental", "Cooper", "Dunlop", "Falken", "Firestone", "General", "Goodyear",
    "Hankook", "Kumho", "Lassa", "Maxxis", "Metzeler", "Michelin", "Nankang", "Nokian", "Pirelli", "Sumitomo", "Toyo",
    "Uniroyal", "Vredestein", "Yokohama",
)
BRANDS_B_ONLY = ("Accelera", "Dynamo", "Tomket", "Triangle", "Zeetex")
BUDGET_GATE = 35.0
# Run-flat share (percent) from which so many run-flats are wanted.
RUNFLAT_STEPS = ((20.0, 1), (55.0, 2), (85.0, 3))
DEFAULT_SHARES = {"Premium": 50.0, "MidRange": 25.0, "Budget": 25.0}
SHARES = {"Premium": "PremiumShare", "MidRange": "MidRangeShare", "Budget": "BudgetShare"}
HOT, MORE = 4, 20
# An answer uses at most 24 products.  When j of them are chosen, the next one of
# any kind is among the first j + 1 of that kind, so 24 of each kind are enough.
DEPTH = HOT + MORE
POPULAR = 5


@dataclass(frozen=True)
class Rules:
    zone_pct: float = 15
    fluctuation_upper: float = 1.1
    fluctuation_lower: float = 0.9
    brand: str | None = None
    model: str | None = None
    season: str | None = None
    named_brand: str = "michelin"
    named_share: float = 25.0
    # Fixed value: makes that want run-flats when the data say nothing.
    runflat_makes: tuple[str, ...] = ("BMW", "MERCEDES", "MINI")

    def checked(self) -> Rules:
        """Limits outside their bounds fall back to the defaults."""
        return Rules(
            clamped(self.zone_pct, 5, 50, 15), clamped(self.fluctuation_upper, 1.0, 2.0, 1.1),
            clamped(self.fluctuation_lower, 0.5, 1.0, 0.9), self.brand, self.model, self.season, self.named_brand,
            self.named_share, self.runflat_makes,
        )


def canonical_grade(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low == "midrange", "MidRange").when(low == "premium", "Premium").when(low == "budget", "Budget").otherwise(c)


def on_offer(c: Column) -> Column:
    return F.coalesce(F.lower(c).isin("onoffer", "1", "true"), F.lit(False))


def _enhanced(rules: Rules) -> Column:
    """Products that meet every active enhancer."""
    test = None
    for column, value in (("BRAND", rules.brand), ("Model", rules.model), ("SEASONAL_PERFORMANCE", rules.season)):
        if value:
            one = F.coalesce(F.lower(F.col(column)) == value.strip().lower(), F.lit(False))
            test = one if test is None else test & one
    return F.lit(False) if test is None else test


def features(scored: DataFrame, rules: Rules) -> DataFrame:
    """Scored rows with everything the rules ask of a product.

    ``points`` favours offers, prices in the zone and falling prices, and
    penalises risen ones.
    """
    rules = rules.checked()
    zone, pct = F.col("GoldilocksZone"), rules.zone_pct / 100.0
    in_zone = F.coalesce(F.col("PRICE").between(zone * (1 - pct), zone * (1 + pct)), F.lit(False))
    fluctuation = F.col("PRICEFLUCTUATION")
    points = (
        2 * on_offer(F.col("OFFER")).cast("int") + 2 * in_zone.cast("int")
        + F.when(fluctuation > rules.fluctuation_upper, -1).when(fluctuation < rules.fluctuation_lower, 1).otherwise(0)
    )
    brand = F.lower("BRAND")
    grade = canonical_grade(F.col("GRADE"))
    active = F.coalesce(F.lower("SalesStatus") == "active", F.lit(False))
    set_a = F.coalesce(brand.isin(*[b.lower() for b in BRANDS_A]), F.lit(False))
    set_b = set_a | F.coalesce(brand.isin(*[b.lower() for b in BRANDS_B_ONLY]), F.lit(False))
    good = grade.isin("Premium", "MidRange")
    runflat = F.coalesce(F.lower("RunflatStatus") == "runflat", F.lit(False))
    return keyed(scored).where(is_valid_id(F.col("ProductId").cast("string"))).select(
        *NARROW, F.col("ProductId").cast("string").alias("id"), grade.alias("grade"), brand.alias("brand"),
        F.col("TyreScore").alias("tier"), points.alias("points"), F.col("Units").alias("units"), runflat.alias("runflat"),
        F.coalesce(active & set_a & good, F.lit(False)).alias("a"),
        F.coalesce(active & set_b & (good | (grade == "Budget")), F.lit(False)).alias("b"),
        _enhanced(rules).alias("match"), "Segment", *SHARES.values(), "RunflatShare",
    )


def _rank_key() -> Column:
    """Relevance: tier, points, units, then id; smaller is better."""
    return F.struct("tier", (-F.col("points")).alias("p"), (-F.col("units")).alias("u"), "id")


TRAITS = ("grade", "a", "b", "runflat", "match", "brand")


def best_rows(rows: DataFrame, keys: list[str] = NARROW) -> DataFrame:
    """The most relevant row of every product in every key, as ``r``.

    Products of a fit seldom repeat, so rows move once, to their fits, and lie together there; those of a size are
    reduced before they move.
    """
    best = F.min(F.struct(_rank_key().alias("k"), *TRAITS, "units", "tier")).alias("r")
    if keys == NARROW:
        rows = rows.select(*keys, "id", "tier", "points", "units", *TRAITS).repartition(*keys)
    return rows.groupBy(*keys, "id").agg(best)


def short_lists(best: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: ``pool`` (products by relevance) and ``popular`` (products by units).

    ``best`` comes from ``best_rows`` of the same keys.  The pool holds the best DEPTH products of every combination of
    traits the rules filter on; every filtered list the rules take from it
    therefore starts as it would over all products of the key.
    """
    flat = best.select(*keys, "id", "r.k", *[f"r.{c}" for c in (*TRAITS, "units", "tier")])
    cell = ["grade", "a", "b", "runflat", "match"]
    pool = best_n(flat, [*keys, *cell], [F.asc("k")], DEPTH, "n")
    popular = best_n(flat, [*keys, "runflat", "a"], [F.desc("units"), F.asc("tier"), F.asc("id")], HOT + POPULAR, "n")

    def listed(df: DataFrame, order: Column, name: str) -> DataFrame:
        item = F.struct(order.alias("o"), F.struct("id", *TRAITS).alias("x"))
        items = F.sort_array(F.collect_list(item))
        return df.groupBy(*keys).agg(F.transform(items, lambda i: i["x"]).alias(name))

    by_units = F.struct((-F.col("units")).alias("u"), "tier", "id")
    # A popular product is in the pool too, however low its relevance.
    both = pool.unionByName(popular).dropDuplicates([*keys, "id"])
    return listed(both, F.col("k"), "pool").join(listed(popular, by_units, "popular"), keys)


def fit_shares(rows: DataFrame) -> DataFrame:
    """Grade and run-flat shares of every (size, vehicle); zero everywhere means unknown."""
    return rows.groupBy(*NARROW).agg(*[F.max(c).alias(c) for c in (*SHARES.values(), "RunflatShare")])


def segment_shares(rows: DataFrame) -> DataFrame:
    """Mean shares of the fits of a segment."""
    known = rows.where((F.col("Segment") != NO_SALES) & (F.greatest(*SHARES.values()) > 0))
    fits = known.groupBy("Segment", *NARROW).agg(*[F.max(c).alias(c) for c in SHARES.values()])
    return fits.groupBy("Segment").agg(*[exact_avg(F.col(c)).alias(f"seg_{c}") for c in SHARES.values()])


def settled_shares(df: DataFrame) -> DataFrame:
    """``known``: whether the fit has shares of its own; those that lack them take their segment's, else the defaults."""
    df = df.withColumn("known", F.coalesce(F.greatest(*SHARES.values()) > 0, F.lit(False)))
    return df.withColumns(
        {
            name: F.when(F.col("known"), F.col(name)).otherwise(F.coalesce(F.col(f"seg_{name}"), F.lit(DEFAULT_SHARES[grade])))
            for grade, name in SHARES.items()
        }
    )


def _with(df: DataFrame, **expressions: str) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def _displace(df: DataFrame, new: str) -> DataFrame:
    """Put the id in column ``new`` (if any) into hotboxes 1-3 and protect it.

    It takes a free box, else the place of the least relevant product that is
    not protected.  The boxes stay in order of relevance.
    """
    df = _with(
        df,
        victim=f"CASE WHEN {new} IS NULL OR array_contains(hot, {new}) OR size(hot) < 3 THEN NULL "
        "ELSE try_element_at(filter(hot, x -> NOT array_contains(kept, x)), -1) END",
        room=f"{new} IS NOT NULL AND (array_contains(hot, {new}) OR size(hot) < 3 "
        "OR exists(hot, x -> NOT array_contains(kept, x)))",
    )
    df = _with(
        df,
        chosen=f"CASE WHEN room THEN concat(filter(hot, x -> victim IS NULL OR x <> victim), array({new})) ELSE hot END",
        kept=f"CASE WHEN room THEN array_union(kept, array({new})) ELSE kept END",
    )
    return _with(df, hot="filter(ids, x -> array_contains(chosen, x))").drop("victim", "room", "chosen")


def scopes(requests: DataFrame, scored: DataFrame, rules: Rules) -> DataFrame:
    """Distinct requested fits with their lists and shares.

    A fit with rows of its own uses them first and the other products of its
    size after them; a fit without uses the size's.
    """
    wanted = durable(keyed_requests(requests).groupBy(*NARROW).agg(F.min("Segment").alias("Segment")), "wanted")
    # The steps cost time per row and little data, so the requests are spread
    # over all cores; sizing tasks by bytes would put them in a few.
    tasks = max(int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted.sparkSession.sparkContext.defaultParallelism)
    wanted = wanted.repartition(tasks, *NARROW)
    # Only rows of requested sizes are written; a segment's shares come from all
    # rows, but need a few columns and one aggregate.
    every = features(scored, rules)
    rows = durable(every.join(wanted.select(*WIDE).distinct(), WIDE, "left_semi"), "features")
    best = durable(best_rows(rows), "best-rows")
    asked = best.join(wanted.select(*NARROW), NARROW, "left_semi")
    own = short_lists(asked, NARROW).withColumnsRenamed({"pool": "own_pool", "popular": "own_popular"})
    size = short_lists(durable(best_rows(rows, WIDE), "best-of-size"), WIDE).withColumnsRenamed({"pool": "size_pool", "popular": "size_popular"})
    df = (
        wanted.join(own, NARROW, "left")
        .join(size, WIDE, "left")
        .join(fit_shares(rows), NARROW, "left")
        .join(segment_shares(every), "Segment", "left")
    )
    df = settled_shares(df)
    df = _with(
        df,
        own_list="coalesce(own_pool, size_pool)",
        popular="coalesce(own_popular, size_popular, array())",
        runflat_share="CASE WHEN known THEN RunflatShare ELSE 0.0 END",
    )
    # Cousins: other products of the size, those most like the fit's best one first.
    df = _with(df, own_ids="transform(own_list, x -> x.id)", lead="get(own_list, 0)")
    df = _with(
        df,
        cousins="filter(size_pool, x -> NOT array_contains(own_ids, x.id))",
    )
    df = _with(
        df,
        cousins="concat(filter(cousins, x -> x.grade <=> lead.grade AND x.runflat = lead.runflat), "
        "filter(cousins, x -> NOT (x.grade <=> lead.grade AND x.runflat = lead.runflat)))",
    )
    return _with(df, pool="concat(own_list, cousins)").select(
        *NARROW, "pool", "own_ids", "popular", "known", "runflat_share", *SHARES.values()
    )


def select_slots(fits: DataFrame, rules: Rules) -> DataFrame:
    """The rule steps over the lists of ``scopes``; adds ``slots`` (24 ids, '-' where none is left)."""
    enhanced = bool(rules.brand or rules.model or rules.season)
    model_only = bool(rules.model)
    df = _with(
        fits,
        ids="transform(pool, x -> x.id)",
        gate=f"BudgetShare > {BUDGET_GATE}",
        pool_a="transform(filter(pool, x -> x.a), x -> x.id)",
        pool_b="filter(pool, x -> x.b)",
    )
    # Hotboxes 1-3: the best of pool A.
    df = _with(df, hot="slice(pool_a, 1, 3)", kept="CAST(array() AS array<string>)")
    # A promoted model goes to hotbox 3 when pool A has it.
    promoted = "get(transform(filter(pool, x -> x.a AND x.match), x -> x.id), 0)" if model_only else "CAST(NULL AS string)"
    df = _displace(_with(df, promoted=promoted), "promoted")
    # Hotbox 4: the enhanced product, else the best of pool B; budget only behind the gate, and then first.
    match = "x.match" if enhanced else "false"
    df = _with(
        df,
        open_b="filter(pool_b, x -> NOT array_contains(hot, x.id))",
    )
    df = _with(
        df,
        wish=f"CASE WHEN promoted IS NULL THEN get(filter(open_b, x -> {match} AND (gate = (x.grade = 'Budget'))), 0).id END",
        plain="coalesce(get(filter(open_b, x -> gate = (x.grade = 'Budget')), 0).id, "
        "get(filter(open_b, x -> x.grade <> 'Budget'), 0).id)",
    )
    df = _with(df, box4="coalesce(wish, plain)", locked="wish IS NOT NULL", first="get(popular, 0)")
    # The most popular product: hotboxes 1-3, or hotbox 4 when it is a budget one behind the open gate.
    df = _with(
        df,
        in_four="first IS NOT NULL AND (array_contains(hot, first.id) OR coalesce(first.id = box4, false))",
    )
    df = _with(
        df,
        star="CASE WHEN array_contains(hot, first.id) OR (NOT in_four AND first.a) THEN first.id END",
        star4="CASE WHEN NOT in_four AND first.b AND first.grade = 'Budget' AND gate AND NOT locked THEN first.id END",
    )
    df = _displace(df, "star")
    df = _with(df, box4="coalesce(star4, box4)")
    # One product of the named brand when premium sells well and the brand is among the top sellers.
    brand = rules.named_brand.lower().replace("'", "''")
    df = _with(
        df,
        has_brand=f"exists(pool, x -> x.brand = '{brand}' AND (array_contains(hot, x.id) OR coalesce(x.id = box4, false)))",
        seller=f"get(filter(slice(popular, 1, {POPULAR}), x -> x.brand = '{brand}' AND x.a), 0).id",
    )
    df = _with(
        df,
        # one that has a box already keeps it: this rule comes before the run-flats
        named=f"CASE WHEN PremiumShare >= {rules.named_share} AND seller IS NOT NULL THEN CASE WHEN has_brand "
        f"THEN get(filter(pool, x -> x.brand = '{brand}' AND array_contains(hot, x.id)), 0).id ELSE seller END END",
    )
    df = _displace(df, "named")
    # Run-flats: so many as the share asks for, the top seller among them.
    makes = " OR ".join(f"startswith(vehicle_key, '{m.lower()}')" for m in rules.runflat_makes) or "false"
    most = max(count for _, count in RUNFLAT_STEPS)
    steps = " ".join(f"WHEN runflat_share >= {bound} THEN {count}" for bound, count in reversed(RUNFLAT_STEPS))
    df = _with(
        df,
        wanted=f"CASE WHEN NOT known AND ({makes}) THEN {most} WHEN NOT known THEN 0 {steps} ELSE 0 END",
        seller="get(filter(popular, x -> x.runflat AND x.a), 0).id",
        runflats="transform(filter(pool, x -> x.a AND x.runflat), x -> x.id)",
    )
    df = _displace(_with(df, extra="CASE WHEN wanted > 0 AND NOT coalesce(seller = box4, false) THEN seller END"), "extra")
    for _ in range(max(count for _, count in RUNFLAT_STEPS)):
        df = _with(
            df,
            extra="CASE WHEN size(array_intersect(hot, runflats)) < wanted THEN "
            "get(filter(runflats, x -> NOT array_contains(hot, x) AND NOT coalesce(x = box4, false)), 0) END",
        )
        df = _displace(df, "extra")
    # A product moved up from hotbox 4 leaves it to the next one.
    df = _with(
        df,
        box4="CASE WHEN array_contains(hot, box4) THEN coalesce("
        "get(filter(pool_b, x -> NOT array_contains(hot, x.id) AND gate = (x.grade = 'Budget')), 0).id, "
        "get(filter(pool_b, x -> NOT array_contains(hot, x.id) AND x.grade <> 'Budget'), 0).id) ELSE box4 END",
    )
    df = _with(
        df,
        three="CASE WHEN promoted IS NULL OR NOT array_contains(hot, promoted) THEN hot "
        "ELSE concat(array_remove(hot, promoted), array(promoted)) END",
    )
    df = _with(df, boxes="concat(slice(concat(three, array_repeat(CAST(NULL AS string), 3)), 1, 3), array(box4))")
    # The rest: what found no box, the top sellers, each grade's share, then whatever is left.
    quota = {grade: f"cast(floor({name} * {MORE} / 100 + 0.5) as int)" for grade, name in SHARES.items()}
    df = _with(
        df,
        rest="filter(pool, x -> NOT array_contains(boxes, x.id) OR array_contains(boxes, x.id) IS NULL)",
    )
    df = _with(df, rest_own="filter(rest, x -> array_contains(own_ids, x.id))")
    df = _with(
        df,
        in_share="concat("
        + ", ".join(
            f"transform(slice(filter(rest_own, x -> x.grade = '{g}'), 1, greatest({q}, 0)), x -> x.id)" for g, q in quota.items()
        )
        + ")",
        rest_ids="transform(rest, x -> x.id)",
        forced="concat(CASE WHEN first IS NULL THEN array() ELSE array(first.id) END, "
        + (
            "CASE WHEN promoted IS NULL AND wish IS NULL THEN slice(transform(filter(pool, x -> x.match), x -> x.id), 1, 1) "
            "ELSE array() END"
            if enhanced
            else "CAST(array() AS array<string>)"
        )
        + ")",
        sellers=f"slice(filter(transform(popular, x -> x.id), x -> NOT coalesce(array_contains(boxes, x), false)), 1, {POPULAR})",
    )
    return _with(
        df,
        more="array_distinct(concat(filter(forced, x -> NOT coalesce(array_contains(boxes, x), false)), sellers, "
        "filter(rest_ids, x -> array_contains(in_share, x)), rest_ids))",
    ).withColumn(
        "slots",
        F.concat(F.transform("boxes", lambda x: F.coalesce(x, F.lit("-"))), padded(F.col("more"), MORE, "-")),
    )


def recommend(requests: DataFrame, scored: DataFrame, rules: Rules = Rules(), fits: DataFrame | None = None) -> DataFrame:
    """One row of slots per request; requests of one fit share its selection.  ``fits``: their ``scopes``, if the caller has them."""
    chosen = select_slots(scopes(requests, scored, rules) if fits is None else fits, rules).select(*NARROW, "slots")
    none = F.array_repeat(F.lit("-"), HOT + MORE)
    rows = keyed_requests(requests).join(chosen, NARROW, "left").withColumn("slots", F.coalesce("slots", none))
    ok = F.forall(F.slice("slots", 1, HOT), is_valid_id)
    return rows.select("Vehicle", "Size", *as_columns(F.col("slots"), [*HOTBOXES, *SKUS]), ok.alias("success"))


def violations(answers: DataFrame, requests: DataFrame, scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts per broken rule over all answers; every count should be zero."""
    facts = features(scored, rules).groupBy("size_key", "id").agg(
        F.max("a").alias("a"), F.max("b").alias("b"), F.max(F.col("grade") == "Budget").alias("budget")
    )
    boxes = F.posexplode(F.array(*[F.col(c) for c in HOTBOXES])).alias("at", "id")
    long = keyed_requests(answers).select("Vehicle", *WIDE, boxes).where("id <> '-'")
    known = long.join(facts, ["size_key", "id"], "left")
    per_row = known.groupBy("Vehicle", *WIDE).agg(
        F.count_if(F.col("a").isNull()).alias("other_size"),
        F.count_if((F.col("at") < 3) & ~F.col("a")).alias("not_in_set_a"),
        F.count_if((F.col("at") == 3) & ~F.col("b")).alias("not_in_set_b"),
        F.count_if(F.col("budget") & (F.col("at") < 3)).alias("budget_too_high"),
        F.greatest(F.count_if("budget") - 1, F.lit(0)).alias("too_many_budget"),
        (F.count("*") - F.count_distinct("id")).alias("repeated"),
    )
    names = [c for c in per_row.columns if c not in ("Vehicle", *WIDE)]
    return per_row.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])

"""What weighs in the rest of an answer: influence factors, and the mix of grades."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from treadmark.functions.lists import is_valid_id
from treadmark.functions.numbers import exact_avg
from treadmark.functions.scoring import NO_SALES
from treadmark.operators.lookup import grown
from treadmark.operators.topk import best_n
from treadmark.plans import recommend
from treadmark.plans.candidates import NARROW, WIDE, keyed, keyed_requests
from treadmark.plans.likeness import attributes
from treadmark.session import durable

#: Influence columns and the order of a size's products in each: the best first.
FACTORS: Mapping[str, tuple[str, bool]] = {
    "PRICE_pct": ("price", True), "GRADE_pct": ("level", True), "FUEL_pct": ("fuel", True), "WET_GRIP_pct": ("wet", True), "AWARD_SCORE_pct": ("award", False),
}
#: Every factor's weight (percent) where neither the fit nor its segment has one.
DEFAULT_WEIGHT = 20.0
#: The usual constant of reciprocal rank fusion: a rank counts 1 / (FUSION + rank), here in millionths.
FUSION, MILLION = 60, 1_000_000
GRADES = tuple(recommend.SHARES)


def factor_weights(scored: DataFrame) -> DataFrame:
    """Per fit the weight of every factor, in hundredths of a percent, and ``from_fit``, how many are the fit's own.

    A factor that the fit lacks has the mean of its segment's fits, else DEFAULT_WEIGHT.
    """
    rows = keyed(scored).select(
        *NARROW, F.when(F.col("Segment") != NO_SALES, F.col("Segment")).alias("Segment"), *(F.col(c).try_cast("double").alias(c) for c in FACTORS)
    )
    fits = rows.groupBy(*NARROW).agg(F.min("Segment").alias("Segment"), *(F.max(c).alias(c) for c in FACTORS))
    means = fits.where("Segment IS NOT NULL").groupBy("Segment").agg(*(exact_avg(F.col(c)).alias(f"mean_{c}") for c in FACTORS))
    settled = fits.join(means, "Segment", "left")
    weights = [F.floor(F.coalesce(c, f"mean_{c}", F.lit(DEFAULT_WEIGHT)) * 100 + 0.5).alias(c) for c in FACTORS]
    own = sum((F.col(c).isNotNull().cast("int") for c in FACTORS), F.lit(0))
    return settled.select(*NARROW, own.alias("from_fit"), *weights)


def factor_ranks(scored: DataFrame) -> DataFrame:
    """Of every product its rank in each factor among the products of its size; equal ones share a rank."""
    products = attributes(scored)
    for name, (column, up) in FACTORS.items():
        order = F.col(column).asc_nulls_last() if up else F.col(column).desc_nulls_last()
        products = products.withColumn(f"rank_{name}", F.dense_rank().over(Window.partitionBy(*WIDE).orderBy(order)).cast("long"))
    return products.select(*WIDE, "id", *(f"rank_{c}" for c in FACTORS))


def fused(weights: Mapping[str, Column]) -> Column:
    """Reciprocal rank fusion in whole numbers: the sum of each factor's weight over FUSION plus the product's rank in it."""
    return sum((w * F.floor(MILLION / (FUSION + F.col(f"rank_{c}"))) for c, w in weights.items()), F.lit(0).cast("long"))


def influence_ranks(scored: DataFrame, n: int = 10) -> DataFrame:
    """Per fit its ``n`` products with the highest fused influence; ties go to the smaller id."""
    own = keyed(scored).where(is_valid_id(F.col("ProductId").cast("string"))).select(*NARROW, F.col("ProductId").cast("string").alias("id")).distinct()
    ranks, weights = durable(factor_ranks(scored), "factor-ranks"), durable(factor_weights(scored), "factor-weights")
    rows = grown(own).join(ranks, [*WIDE, "id"]).join(weights, NARROW)
    told = rows.select(*NARROW, "id", "from_fit", fused({c: F.col(c) for c in FACTORS}).alias("fused"))
    return best_n(told, NARROW, [F.desc("fused"), F.asc("id")], n, "place").select(*NARROW, "place", "id", "fused", "from_fit")


def apportioned(df: DataFrame, slots: int, weights: Mapping[str, str], room: Mapping[str, str], out: str) -> DataFrame:
    """``df`` with ``{out}_{name}``: ``slots`` shared by largest remainder, none getting more than its ``room``.

    Whole seats go by weight, those left to the largest remainders, ties in the order of ``weights``.  A name whose
    room is full gives what it cannot hold back, and that is shared again among the others; each round fills one name or
    ends, so there are as many rounds as names.  Names without weight share only what the others cannot hold.
    The parts add up to ``slots``, or to all room if that is less.
    """
    names = list(weights)
    df = df.withColumns({f"{out}_{g}": F.lit(0).cast("long") for g in names})
    for _ in range(len(names)):
        df = df.withColumns({f"_open_{g}": F.expr(f"CAST({out}_{g} < {room[g]} AS BIGINT)") for g in names})
        df = df.withColumn("_sum", F.expr(" + ".join(f"_open_{g} * {weights[g]}" for g in names)))
        df = df.withColumns({f"_w_{g}": F.expr(f"_open_{g} * CASE WHEN _sum > 0 THEN {weights[g]} ELSE 1 END") for g in names})
        df = df.withColumn("_sum", F.expr("greatest(" + " + ".join(f"_w_{g}" for g in names) + ", 1)"))
        df = df.withColumn("_left", F.expr(f"{slots} - (" + " + ".join(f"{out}_{g}" for g in names) + ")"))
        df = df.withColumns({f"_part_{g}": F.expr(f"_left * _w_{g} div _sum") for g in names} | {f"_rem_{g}": F.expr(f"_left * _w_{g} % _sum") for g in names})
        df = df.withColumn("_over", F.expr("_left - (" + " + ".join(f"_part_{g}" for g in names) + ")"))
        ahead = {
            g: " + ".join(f"CAST(_rem_{h} {'>=' if names.index(h) < names.index(g) else '>'} _rem_{g} AS INT)" for h in names if h != g) for g in names
        }
        df = df.withColumns(
            {f"{out}_{g}": F.expr(f"least({room[g]}, {out}_{g} + _part_{g} + CASE WHEN _rem_{g} > 0 AND {ahead[g]} < _over THEN 1 ELSE 0 END)") for g in names}
        )
    return df.drop("_sum", "_left", "_over", *(f"_{x}_{g}" for x in ("open", "w", "part", "rem") for g in names))


def grade_quotas(requests: DataFrame, scored: DataFrame, slots: int = recommend.MORE) -> DataFrame:
    """Per requested fit the seats of each grade among the further slots: ``quota`` by share, ``taken`` as far as there are
    products (``have``), what is missing being shared again."""
    wanted = keyed_requests(requests).groupBy(*NARROW).agg(F.min("Segment").alias("Segment"))
    rows = recommend.features(scored, recommend.Rules())
    # distinct products first: counting them distinct by grade would take each row once for every grade
    each = rows.where(F.col("grade").isin(*GRADES)).select(*NARROW, "grade", "id").repartition(*NARROW).distinct()
    have = each.groupBy(*NARROW).agg(*(F.count_if(F.col("grade") == g).alias(f"have_{g}") for g in GRADES))
    df = wanted.join(recommend.fit_shares(rows), NARROW, "left").join(recommend.segment_shares(rows), "Segment", "left").join(have, NARROW, "left")
    df = recommend.settled_shares(df)
    df = df.withColumns({f"have_{g}": F.coalesce(f"have_{g}", F.lit(0).cast("long")) for g in GRADES})
    df = df.withColumns({f"w_{g}": F.floor(F.col(c) * 100 + 0.5) for g, c in recommend.SHARES.items()})
    weights = {g: f"w_{g}" for g in GRADES}
    df = apportioned(df, slots, weights, dict.fromkeys(GRADES, f"{slots}L"), "quota")
    df = apportioned(df, slots, weights, {g: f"have_{g}" for g in GRADES}, "taken")
    return df.select(*NARROW, "known", *(f"{x}_{g}" for x in ("quota", "have", "taken") for g in GRADES))

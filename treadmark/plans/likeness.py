"""Products and vehicles that are alike: what to promote in a fit, and what to offer where it has little of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treadmark.functions.lists import is_valid_id
from treadmark.operators.lookup import grown
from treadmark.operators.topk import best_n
from treadmark.plans.candidates import NARROW, WIDE, keyed
from treadmark.session import durable

# Steps between grades and between classes, and what a step, a decibel and another season count.  Prices count by their
# difference in thousandths of the compared price; what is not known on one side counts UNKNOWN.
GRADE_LEVELS = ("premium", "midrange", "budget")
CLASSES = "ABCDEFG"
GRADE_STEP, CLASS_STEP, DECIBEL, OTHER_SEASON, UNKNOWN = 1000, 250, 100, 1000, 500
#: Fits with fewer products than an answer has slots need help from others.
ENOUGH, COUSINS = 24, 5


def level(grade: Column) -> Column:
    """0 for premium, 1 for mid-range, 2 for budget, else null."""
    return F.nullif(F.array_position(F.array(*map(F.lit, GRADE_LEVELS)), F.lower(grade)), F.lit(0).cast("bigint")) - 1


def class_of(letter: Column) -> Column:
    """0 for A, 1 for B and so on, else null."""
    return F.when(F.length(letter) == 1, F.nullif(F.instr(F.lit(CLASSES), F.upper(letter)), F.lit(0)) - 1)


def attributes(scored: DataFrame) -> DataFrame:
    """size_key, id and what products are compared by; of several offers of a product the least of each attribute."""
    rows = keyed(scored).where(is_valid_id(F.col("ProductId").cast("string")))
    return rows.groupBy(*WIDE, F.col("ProductId").cast("string").alias("id")).agg(
        F.min(F.lower("BRAND")).alias("brand"), F.min(level(F.col("GRADE"))).alias("level"), F.min(class_of(F.col("WET_GRIP"))).alias("wet"),
        F.min(class_of(F.col("FUEL"))).alias("fuel"), F.min(F.regexp_extract("NOISE_REDUCTION", r"^(\d{1,4})", 1).try_cast("int")).alias("noise"),
        F.min(F.lower("SEASONAL_PERFORMANCE")).alias("season"), F.min("PRICE").alias("price"),
        F.max((F.lower("AWARD_SCORE") == "award").cast("int")).alias("award"),
    )


def distance(a: str, b: str) -> Column:
    """How far product ``b`` is from product ``a``, in whole numbers; ``a`` and ``b`` are prefixes of their columns."""

    def steps(name: str, unit: int) -> Column:
        return F.coalesce(F.abs(F.col(a + name) - F.col(b + name)) * unit, F.lit(UNKNOWN)).cast("long")

    ours, its = F.col(a + "season"), F.col(b + "season")
    season = F.when(ours == its, 0).when(ours != its, OTHER_SEASON).otherwise(UNKNOWN)
    price = F.when(F.col(a + "price") > 0, F.floor(F.lit(1000.0) * F.abs(F.col(a + "price") - F.col(b + "price")) / F.col(a + "price")))
    return (
        steps("level", GRADE_STEP) + steps("wet", CLASS_STEP) + steps("fuel", CLASS_STEP) + steps("noise", DECIBEL)
        + season.cast("long") + F.coalesce(price, F.lit(UNKNOWN)).cast("long")
    )


def sold(scored: DataFrame) -> DataFrame:
    """size_key, vehicle_key, id, units and tier of every product that a fit has bought."""
    rows = keyed(scored).where(is_valid_id(F.col("ProductId").cast("string")) & (F.col("Units") > 0))
    return rows.groupBy(*NARROW, F.col("ProductId").cast("string").alias("id")).agg(F.max("Units").alias("units"), F.min("TyreScore").alias("tier"))


def similar_product(scored: DataFrame, brand: str) -> DataFrame:
    """Per fit with sales: ``lead``, its most popular product, and the product of ``brand`` in its size that is most like it.

    Fits share leads, so only the distinct leads of a size meet the brand's products of that size.  Ties go to the
    smaller id; without a product of the brand ``nearest`` and ``distance`` are null.
    """
    lead = F.min(F.struct((-F.col("units")).alias("u"), "tier", "id")).alias("first")
    leads = sold(scored).groupBy(*NARROW).agg(lead).select(*NARROW, F.col("first.id").alias("lead"))
    products = durable(attributes(scored), "products")
    mine = products.select(*WIDE, *(F.col(c).alias(f"a_{c}") for c in products.columns if c not in WIDE))
    theirs = products.where(F.col("brand") == brand.strip().lower()).select(*WIDE, *(F.col(c).alias(f"b_{c}") for c in products.columns if c not in WIDE))
    leads = durable(leads, "leads")
    asked = grown(leads.select(*WIDE, F.col("lead").alias("a_id")).distinct()).join(mine, [*WIDE, "a_id"])
    near = grown(asked).join(theirs, WIDE).groupBy(*WIDE, F.col("a_id").alias("lead")).agg(
        F.min(F.struct(distance("a_", "b_").alias("distance"), F.col("b_id").alias("nearest"))).alias("near")
    )
    return grown(leads).join(near, [*WIDE, "lead"], "left").select(*NARROW, "lead", "near.nearest", "near.distance")


def cousin_vehicles(scored: DataFrame, enough: int = ENOUGH, cousins: int = COUSINS) -> DataFrame:
    """Of every fit with fewer than ``enough`` products: the vehicles that buy most alike in its size.

    Vehicles are compared by the cosine of the units they bought of each product, in millionths.  Only fits that need
    help ask, each with fewer than ``enough`` products, so a size has at most that many pairs for a fit and a vehicle, and
    sums are made before the shuffle.
    """
    return _cousins(durable(sold(scored).select(*NARROW, "id", "units"), "bought"), enough, cousins)


def _cousins(bought: DataFrame, enough: int, cousins: int) -> DataFrame:
    fits = bought.groupBy(*NARROW).agg(F.sum(F.col("units") * F.col("units")).alias("square"), F.count("*").alias("n"))
    asking = grown(bought).join(fits.where(F.col("n") < enough).select(*NARROW), NARROW, "left_semi")
    other = bought.select(*WIDE, "id", F.col("vehicle_key").alias("cousin"), F.col("units").alias("their_units"))
    dots = grown(asking).join(other, [*WIDE, "id"]).where("vehicle_key <> cousin").groupBy(*NARROW, "cousin").agg(F.sum(F.col("units") * F.col("their_units")).alias("dot"))
    theirs = fits.select(*WIDE, F.col("vehicle_key").alias("cousin"), F.col("square").alias("their_square"))
    both = grown(grown(dots).join(fits.select(*NARROW, "square"), NARROW)).join(theirs, [*WIDE, "cousin"])
    cosine = F.floor(1e6 * F.col("dot").cast("double") / F.sqrt(F.col("square").cast("double") * F.col("their_square").cast("double")))
    ranked = best_n(both.withColumn("cosine", cosine), NARROW, [F.desc("cosine"), F.asc("cousin")], cousins, "place")
    return ranked.select(*NARROW, "place", "cousin", "cosine")


def cousin_products(scored: DataFrame, enough: int = ENOUGH, cousins: int = COUSINS) -> DataFrame:
    """What the similar vehicles of a fit buy in its size and it does not, to fill its answer up to ``enough`` products.

    Products of brands that the fit buys already come first, then those with most units, weighed by likeness.
    """
    bought = durable(sold(scored).select(*NARROW, "id", "units"), "bought")
    near = durable(_cousins(bought, enough, cousins), "cousins")
    brands = durable(attributes(scored).select(*WIDE, "id", "brand"), "brands")
    # Only what the fits that have cousins buy is held against their offers.
    mine = grown(bought).join(near.select(*NARROW).distinct(), NARROW, "left_semi")
    theirs = bought.select(*WIDE, F.col("vehicle_key").alias("cousin"), "id", "units")
    offered = grown(near).join(theirs, [*WIDE, "cousin"]).groupBy(*NARROW, "id").agg(F.sum(F.col("cosine") * F.col("units")).alias("weight"))
    new = grown(grown(offered).join(mine.select(*NARROW, "id"), [*NARROW, "id"], "left_anti")).join(brands, [*WIDE, "id"])
    own = grown(mine).join(brands, [*WIDE, "id"]).select(*NARROW, "brand").distinct().withColumn("known", F.lit(True))
    have = mine.groupBy(*NARROW).agg(F.count("*").alias("n"))
    known = grown(new).join(own, [*NARROW, "brand"], "left").withColumn("known_brand", F.coalesce("known", F.lit(False)))
    told = grown(known).join(have, NARROW)
    ranked = best_n(told, NARROW, [F.desc("known_brand"), F.desc("weight"), F.asc("id")], enough, "place")
    return ranked.where(F.col("place") + F.col("n") <= enough).select(*NARROW, "place", "id", "known_brand", "weight")

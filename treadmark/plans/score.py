"""Product scores: points, weights, percentile, tier."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treadmark.functions import scoring
from treadmark.functions.numbers import exact_avg, safe_ratio
from treadmark.functions.text import stripped_size
from treadmark.operators.lookup import grown
from treadmark.operators.position import ntile

# Input column, output column of the attributes that define one scored offer.
ATTRIBUTES = (
    ("ProductId", "ProductId"), ("Grade", "GRADE"), ("Size", "SIZE"), ("Manufacturer", "BRAND"), ("Model", "Model"),
    ("WetGrip", "WET_GRIP"), ("Fuel", "FUEL"), ("Noise", "NOISE_REDUCTION"), ("Season", "SEASONAL_PERFORMANCE"),
    ("Offer", "OFFER"), ("OE", "OE"), ("AwardScore", "AWARD_SCORE"),
)


def offers(products: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per distinct offer with its average price and price movement."""
    keyed = products.withColumn("SKU", F.col("ProductId").cast("string"))
    flagged = grown(keyed).join(catalogue.select("SKU", "run_flat"), "SKU", "left")
    keys = [F.col(a).alias(b) for a, b in ATTRIBUTES]
    past = (exact_avg(F.col("PrevPrice7")) + exact_avg(F.col("PrevPrice28"))) / F.lit(2.0)
    return flagged.groupBy(*keys, scoring.runflat_label(F.col("run_flat")).alias("RunflatStatus")).agg(
        exact_avg(F.col("Price")).alias("PRICE"),
        safe_ratio(exact_avg(F.col("Price")), past).alias("PRICEFLUCTUATION"),
    ).withColumn("StrippedSize", stripped_size(F.col("SIZE")))


def ranked(offer_rows: DataFrame) -> DataFrame:
    points = scoring.attribute_points(
        F.col("AWARD_SCORE"), F.col("FUEL"), F.col("NOISE_REDUCTION"), F.col("OE"), F.col("WET_GRIP")
    )
    return offer_rows.withColumn("TyreRank", scoring.weighted_total(points))


def tie_order() -> list:
    """Best rank first; equal ranks by product id, then by the rest of the offer key."""
    return [F.desc("TyreRank"), *[F.asc(b) for _, b in ATTRIBUTES], F.asc("RunflatStatus")]


def scored(products: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Offers with percentile (100 tiles over the whole table) and tier label."""
    tiled = ntile(ranked(offers(products, catalogue)), 100, tie_order(), "Percentile")
    return tiled.withColumn("TyreScore", scoring.tier_label(F.col("Percentile")))

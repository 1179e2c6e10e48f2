"""What sells: price zones, grade shares and run-flat share per vehicle and size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treadmark.functions.numbers import MONEY, round_away, safe_ratio, share_percent
from treadmark.functions.text import size_part
from treadmark.operators.lookup import grown

GRADES = (("Premium", "PremiumShare"), ("MidRange", "MidRangeShare"), ("Budget", "BudgetShare"))
FIT = ["Vehicle", "SizePart"]


def sold(sales: DataFrame, products: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Sales with units, joined once to the product attributes every share needs.

    ``sales`` as ``treadmark.sources.files.typed_sales``.  A product listed
    more than once counts once per listing.
    """
    listed = products.where(F.col("ProductId").isNotNull()).select(
        F.col("ProductId").cast("string").alias("ProductId"),
        F.col("Grade").alias("GRADE"),
        size_part(F.col("Size")).alias("SizePart"),
    )
    flags = catalogue.groupBy(F.col("SKU").alias("ProductId")).agg(
        F.count("*").alias("entries"), F.count_if(F.lower("run_flat") == "runflat").alias("runflat_entries")
    )
    attributes = grown(listed).join(flags, "ProductId", "left")
    return grown(sales.where(F.col("Units") > 0)).join(attributes, "ProductId")


def fit_totals(rows: DataFrame) -> DataFrame:
    """All sums per (vehicle, size part) in one pass; everything below is derived from it."""
    price = F.col("AvgPrice").cast(MONEY)
    units = F.col("Units")
    return rows.groupBy(*FIT).agg(
        F.sum(price).alias("price_sum"),
        F.count("AvgPrice").alias("price_count"),
        F.sum(units).alias("units"),
        F.sum(units * F.coalesce("runflat_entries", F.lit(0))).alias("runflat_units"),
        F.sum(units * F.coalesce("entries", F.lit(1))).alias("listed_units"),
        *[F.sum(F.when(F.col("GRADE") == grade, units)).alias(f"units_{grade}") for grade, _ in GRADES],
    )


def fit_average(totals: DataFrame) -> DataFrame:
    average = safe_ratio(F.col("price_sum"), F.col("price_count"))
    return totals.select(*FIT, average.alias("AvgPricePerUnit"))


def size_average(totals: DataFrame) -> DataFrame:
    """Average price per size part, from the finished fit sums."""
    sums = totals.groupBy("SizePart").agg(F.sum("price_sum").alias("s"), F.sum("price_count").alias("n"))
    return sums.select("SizePart", safe_ratio(F.col("s"), F.col("n")).alias("AvgPricePerUnit"))


def known_fits(totals: DataFrame) -> DataFrame:
    """Fits with both keys; the others can never be joined."""
    return totals.where(F.col("Vehicle").isNotNull() & F.col("SizePart").isNotNull())


def _share_columns() -> list[Column]:
    return [
        F.coalesce(share_percent(F.col(f"units_{grade}"), F.col("units")), F.lit(0.0)).alias(name)
        for grade, name in GRADES
    ]


def grade_shares(totals: DataFrame) -> DataFrame:
    """Premium, mid-range and budget share in percent; a grade without sales is 0."""
    return known_fits(totals).select(*FIT, *_share_columns())


def runflat_share(totals: DataFrame) -> DataFrame:
    return known_fits(totals).select(*FIT, share_percent(F.col("runflat_units"), F.col("listed_units")).alias("RunflatShare"))


def price_zone(totals: DataFrame) -> DataFrame:
    """Price zone per fit: its own average, or the size's when that is 0 or missing."""
    own, size = fit_average(known_fits(totals)).alias("f"), size_average(totals).alias("s")
    zone = zone_of(F.col("f.AvgPricePerUnit"), F.col("s.AvgPricePerUnit"))
    return own.join(size, F.col("f.SizePart") == F.col("s.SizePart"), "left").select(
        "f.Vehicle", "f.SizePart", zone.alias("GoldilocksZone")
    )


def zone_of(fit_price: Column, size_price: Column) -> Column:
    return F.coalesce(F.nullif(round_away(fit_price, 2), F.lit(0.0)), round_away(size_price, 2))


def market(totals: DataFrame) -> DataFrame:
    """Average price and all shares per fit, for one join."""
    average = safe_ratio(F.col("price_sum"), F.col("price_count")).alias("fit_price")
    runflat = share_percent(F.col("runflat_units"), F.col("listed_units")).alias("RunflatShare")
    return known_fits(totals).select(*FIT, average, *_share_columns(), runflat)

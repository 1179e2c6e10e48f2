"""The scored product table: one row per offer and vehicle, 33 columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from treadmark.functions import scoring
from treadmark.functions.numbers import round_away
from treadmark.functions.text import click_vehicle, list_id_size, size_part, spread_null
from treadmark.operators.lookup import grown
from treadmark.plans import market, score
from treadmark.session import durable, shuffle_partitions
from treadmark.sources.events import days, items_of
from treadmark.sources.files import typed_sales

INFLUENCE = ("Segment", "PRICE_pct", "GRADE_pct", "FUEL_pct", "WET_GRIP_pct", "AWARD_SCORE_pct")
COLUMNS = (
    "TyreScore", "ProductId", "GRADE", "BRAND", "Model", "WET_GRIP", "FUEL", "NOISE_REDUCTION", "SEASONAL_PERFORMANCE",
    "OE", "AWARD_SCORE", "RunflatStatus", *INFLUENCE, "Vehicle", "SIZE", "PRICE", "OFFER", "PRICEFLUCTUATION", "Orders",
    "Units", "GoldilocksZone", "PremiumShare", "MidRangeShare", "BudgetShare", "RunflatShare", "SalesStatus",
    "PRODUCTLISTVIEWS", "CLICKSTREAMRATE",
)


@dataclass(frozen=True)
class Inputs:
    products: DataFrame
    catalogue: DataFrame
    sales: DataFrame
    events: DataFrame
    influence: DataFrame


def clickstream(events: DataFrame) -> DataFrame:
    """Carts and list views per (product, size text, vehicle), for numeric product ids."""
    rows = items_of(events, "event_name").where(F.col("item.item_id").rlike(r"^\d+$"))
    return rows.groupBy(
        F.col("item.item_id").alias("SKU"),
        list_id_size(F.col("item.item_list_id")).alias("Size"),
        F.coalesce(click_vehicle(F.col("item.item_category5")), F.lit(scoring.NO_SALES)).alias("Vehicle"),
    ).agg(
        F.count_if(F.col("event_name") == "add_to_cart").alias("ADDTOCART"),
        F.count_if(F.col("event_name") == "view_item_list").alias("PRODUCTLISTVIEWS"),
    )


def click_window(events: DataFrame, run_date) -> DataFrame:
    """The three months up to the run date."""
    import datetime as dt

    month = run_date.month - 3
    year = run_date.year + (month - 1) // 12
    month = (month - 1) % 12 + 1
    last = (dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return days(events, dt.date(year, month, min(run_date.day, last)), run_date)


def build(inputs: Inputs) -> DataFrame:
    """Offers with sales, market shares, influence and click rate.

    All market figures of a fit come in one join; offers nobody bought have no
    vehicle, and their keys are spread so that they do not meet in one task.
    """
    sales = typed_sales(inputs.sales)
    offers = score.scored(inputs.products, inputs.catalogue).where(
        F.col("ProductId").isNotNull() & F.col("WET_GRIP").isNotNull()
    )
    # The fit sums feed the fit columns and the size average.
    totals = durable(market.fit_totals(market.sold(sales, inputs.products, inputs.catalogue)), "fit-totals")
    clicks = clickstream(inputs.events).select("SKU", F.col("Vehicle").alias("click_vehicle"), "PRODUCTLISTVIEWS")
    fits = market.market(totals).select(
        F.col("Vehicle").alias("fit_vehicle"), F.col("SizePart").alias("fit_size"), "fit_price", "PremiumShare",
        "MidRangeShare", "BudgetShare", "RunflatShare",
    )
    sizes = market.size_average(totals).select(
        F.col("SizePart").alias("any_size"), F.col("AvgPricePerUnit").alias("size_price")
    )
    # One row a vehicle, written so that Spark knows how few they are.
    influence = durable(inputs.influence.select(F.upper("Vehicle").alias("influence_vehicle"), *INFLUENCE), "influence")

    parts = shuffle_partitions(offers.sparkSession)
    sold = sales.where(F.col("ProductId").isNotNull()).select(F.col("ProductId").alias("SKU"), "Vehicle", "Orders", "Units")
    sold = sold.withColumn("vkey", spread_null(F.col("Vehicle"), F.col("SKU"), parts=parts))
    # Sales meet the clicks before the offers, so the wide rows of offers move once.
    seen = grown(sold).join(clicks.withColumnRenamed("click_vehicle", "vkey"), ["SKU", "vkey"], "left")
    rows = (
        grown(offers.withColumn("SKU", F.col("ProductId").cast("string")))
        .join(seen.drop("vkey"), "SKU", "left")
        .withColumn("part", size_part(F.col("SIZE")))
        .withColumn("vkey", spread_null(F.col("Vehicle"), F.col("SKU"), parts=parts))
        .withColumn("ikey", F.upper(F.regexp_replace(F.trim(F.col("vkey")), r"\s+", "")))
    )
    joined = (
        rows.join(fits, (F.col("vkey") == F.col("fit_vehicle")) & (F.col("part") == F.col("fit_size")), "left")
        .join(sizes, F.col("part") == F.col("any_size"), "left")
        .join(influence, F.col("ikey") == F.col("influence_vehicle"), "left")
    )
    orders = F.coalesce("Orders", F.lit(0).cast("bigint"))
    views = F.coalesce("PRODUCTLISTVIEWS", F.lit(0).cast("bigint"))
    zero = F.lit(0.0)
    return joined.select(
        "TyreScore", "ProductId", "GRADE", "BRAND", "Model", "WET_GRIP", "FUEL", "NOISE_REDUCTION",
        "SEASONAL_PERFORMANCE", "OE", "AWARD_SCORE", "RunflatStatus",
        *[scoring.or_no_sales(F.col(c)).alias(c) for c in INFLUENCE],
        scoring.or_no_sales(F.col("Vehicle")).alias("Vehicle"),
        "SIZE", "PRICE", "OFFER",
        round_away(F.coalesce("PRICEFLUCTUATION", F.lit(1.0)), 2).alias("PRICEFLUCTUATION"),
        orders.alias("Orders"),
        F.coalesce("Units", F.lit(0).cast("bigint")).alias("Units"),
        market.zone_of(F.col("fit_price"), F.col("size_price")).alias("GoldilocksZone"),
        *[F.coalesce(c, zero).alias(c) for c in ("PremiumShare", "MidRangeShare", "BudgetShare", "RunflatShare")],
        F.when(F.col("Vehicle").isNull(), "Potential").otherwise("Active").alias("SalesStatus"),
        views.alias("PRODUCTLISTVIEWS"),
        scoring.click_rate(orders, views).alias("CLICKSTREAMRATE"),
    )

"""Reports over the wide slot table: token fact, analysis and override rows.

Each report needs its slot rows twice, for the rows themselves and for the
distinct counts, so they are written to the shared folder once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from treadmark.functions.journey import token_bucket
from treadmark.functions.lists import HOTBOXES
from treadmark.functions.numbers import try_long
from treadmark.functions.text import (
    alnum_key, cam_key, cam_text, product_label, report_profile, report_rim, report_width, takeover_slug,
)
from treadmark.operators.counts import join_on, with_distinct_count
from treadmark.operators.position import with_position
from treadmark.operators.reshape import pivot_max, unpivot
from treadmark.session import durable

# The reports use the first 20 positions: four hotboxes and SKU1-SKU16.
TOKENS = (*HOTBOXES, *(f"SKU{i}" for i in range(1, 17)))
PIVOT_NAMES = ("SKU", *(f"SKU{i}" for i in range(2, 21)))
FIT = ["Make", "Model", "Width", "Profile", "Rim"]


@dataclass(frozen=True)
class Inputs:
    slots: DataFrame
    mapping: DataFrame
    catalogue: DataFrame
    manual: DataFrame


def enriched(inputs: Inputs, drop_zero: bool = False) -> DataFrame:
    """One row per filled slot with vehicle and product attributes.

    ``drop_zero`` leaves out rows whose first hotbox is '0' (or missing).
    """
    wide = inputs.slots.where(F.col("HB1") != "0") if drop_zero else inputs.slots
    keyed = wide.withColumn("vehicle_key", alnum_key(F.col("Vehicle")))
    long = unpivot(
        keyed, ["vehicle_key", "Vehicle", "Size"], [try_long(F.col(c)) for c in TOKENS], "token_position", "product_id"
    )
    mapping = inputs.mapping.select(
        alnum_key(F.col("vehicle")).alias("vehicle_key"), F.col("CarMake").alias("Make"),
        F.col("CarModel").alias("Model"), "Category", "Segment",
    )
    products = inputs.catalogue.select(
        try_long(F.col("Product_ID")).alias("product_id"), "Manufacturer", "Model_Name", "OE"
    ).where(F.col("product_id").isNotNull())
    return (
        long.join(mapping, "vehicle_key", "left")
        .join(products, "product_id", "left")
        .withColumn("Width", report_width(F.col("Size")))
        .withColumn("Profile", report_profile(F.col("Size")))
        .withColumn("Rim", report_rim(F.col("Size")))
    )


def fit_key(mode: str):
    return cam_key(*[F.col(c) for c in FIT], mode=mode)


def manual_list(manual: DataFrame, mode: str) -> DataFrame:
    return manual.select(cam_text(F.col("CAM"), mode).alias("CAM")).distinct().withColumn("_manual", F.lit(True))


def with_source(df: DataFrame, manual: DataFrame, mode: str, key: str = "CAM") -> DataFrame:
    """CAMSource: 'manual' for keys on the hand-kept list, else 'AIM'."""
    listed = manual_list(manual, mode).withColumnRenamed("CAM", key)
    return (
        join_on(df, listed, [key], match_null=False)
        .withColumn("CAMSource", F.when(F.col("_manual"), "manual").otherwise("AIM"))
        .drop("_manual")
    )


def token_fact(inputs: Inputs, run_date: dt.date, strict_compat: bool = False) -> DataFrame:
    """One row per filled slot for the fact table.

    ``strict_compat`` compares the manual list with a key whose capitals were
    dropped before upper-casing, as earlier reports did; it hardly ever matches.
    """
    rows = durable(enriched(inputs), "tokens")
    hot = F.col("token_position").between(1, 4)
    match = fit_key("capitals" if strict_compat else "alnum")
    out = rows.withColumn("CAM", fit_key("spaces")).withColumn("_match", match)
    out = with_source(out, inputs.manual, "alnum", "_match")
    out = with_distinct_count(out, FIT, "product_id", "distinct_sku_count", match_null=True)
    return out.select(
        F.lit(run_date).alias("snapshot_date"), "Manufacturer", "Make", "Model", "Vehicle", "Size", "Segment", "Category",
        "Model_Name", "OE",
        (F.col("OE").isNotNull() & (F.coalesce("OE", F.lit("")) != "")).alias("has_oe"),
        F.col("product_id").alias("sku"), "token_position",
        token_bucket(F.col("token_position")).alias("token_bucket"),
        hot.alias("is_hotbox"),
        F.when(hot, F.col("token_position")).alias("hotbox_n"),
        "CAM", "CAMSource", "distinct_sku_count",
    )


def analysis(inputs: Inputs, run_date: dt.date) -> DataFrame:
    """One row per fit with the product label of every slot."""
    label = product_label(F.col("Manufacturer"), F.col("Model_Name"), F.col("product_id"))
    rows = durable(enriched(inputs).withColumn("sku_label", label), "tokens")
    wide = rows.groupBy(*FIT, "Segment", "Category").agg(*pivot_max("token_position", "sku_label", PIVOT_NAMES))
    wide = wide.withColumn("Today", F.lit(run_date)).withColumn("CAM", fit_key("alnum"))
    wide = with_source(wide, inputs.manual, "spaces")
    counts = rows.groupBy(*FIT).agg(F.count_distinct("product_id").alias("distinct_sku_count"))
    return join_on(wide, counts, FIT, match_null=False).select(
        "Today", *FIT, *PIVOT_NAMES, "Segment", "Category", "CAM", "distinct_sku_count", "CAMSource"
    )


def override_rows(inputs: Inputs, run_date: dt.date) -> DataFrame:
    """One row per fit and source row with product ids, ribbons and constants."""
    slug = takeover_slug(*[F.col(c) for c in FIT])
    rows = durable(enriched(inputs, drop_zero=True).withColumn("TakeoverName", slug), "tokens")
    keys = [*FIT, "TakeoverName", "Segment", "Category", "Size", "Vehicle"]
    wide = rows.groupBy(*keys).agg(
        *pivot_max("token_position", "product_id", PIVOT_NAMES),
        F.min("Manufacturer").alias("Manufacturer"), F.min("Model_Name").alias("ModelName"), F.min("OE").alias("OE"),
    )
    ribbons = ("RibbonName", *(f"RibbonName{i}" for i in range(2, 21)))
    wide = wide.select(
        F.lit(run_date).alias("Today"), "*", *[F.lit("").alias(r) for r in ribbons],
        F.lit("UK").alias("Country"), F.lit("").alias("Year"), F.lit(4).cast("bigint").alias("CAMUSlot"),
        fit_key("alnum").alias("CAM"),
    )
    wide = with_source(wide, inputs.manual, "alnum")
    counts = rows.groupBy(*FIT).agg(F.count_distinct("product_id").alias("distinct_sku_count"))
    pairs = [c for pair in zip(PIVOT_NAMES, ribbons) for c in pair]
    return join_on(wide, counts, FIT, match_null=False).select(
        "Today", *FIT, "TakeoverName", *pairs, "Country", "Year", "CAMUSlot", "Manufacturer", "ModelName", "OE", "Segment",
        "Category", "Size", "Vehicle", "CAM", "distinct_sku_count", "CAMSource",
    )


def report_lines(df: DataFrame, then: list[str]) -> DataFrame:
    """Line numbers in the reading order of the reports: make, model, then rim, width, profile as numbers."""
    numbers = [F.col(c).cast("bigint").asc_nulls_first() for c in ("Rim", "Width", "Profile")]
    return with_position(df, [F.col("Make").asc_nulls_first(), F.col("Model").asc_nulls_first(), *numbers, *[F.col(c).asc_nulls_first() for c in then]], "line_no")

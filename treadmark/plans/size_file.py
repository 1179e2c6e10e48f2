"""Most frequent products per tyre size, laid out over 60 slots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from treadmark.operators.position import with_position
from treadmark.operators.reshape import unpivot
from treadmark.operators.topk import best_n
from treadmark.plans.slots import PIVOT_NAMES
from treadmark.sources.tables import latest_snapshot

SLOT_COUNT = 60
# Slots that repeat a product already placed, and its rank.
REPEATS = {9: 1, 13: 2, 17: 3, 21: 4}
LABEL = "AIM_Size"


def file_lines(slots: DataFrame) -> DataFrame:
    """Line numbers of the size file: by slot, then by size and product."""
    return with_position(slots, [F.asc("slot_number"), F.asc("Size"), F.asc("product_id")], "line_no")


def slot_layout() -> list[tuple[int, str]]:
    """(rank, slot number) for slots 1-60: each slot takes the next rank, except the repeats."""
    layout, rank = [], 0
    for slot in range(1, SLOT_COUNT + 1):
        if slot in REPEATS:
            layout.append((REPEATS[slot], f"{slot}.001"))
        else:
            rank += 1
            layout.append((rank, f"{slot}.001"))
    return layout


def layout_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(slot_layout(), "rnk bigint, slot string").select(
        "rnk", F.col("slot").cast("decimal(38,9)").alias("slot_number")
    )


def build(override: DataFrame, prices: DataFrame, run_date: dt.date) -> DataFrame:
    """Slots per size from the newest day of the override table."""
    size = ["Width", "Profile", "Rim"]
    latest = latest_snapshot(override, "Today")
    long = unpivot(latest, size, [F.col(c).cast("string") for c in PIVOT_NAMES], "token_position", "product_id")
    counts = long.where(F.length("product_id") >= 8).groupBy(*size, "product_id").agg(F.count("*").alias("cnt"))
    layout = slot_layout()
    ranked = best_n(counts, size, [F.desc("cnt"), F.asc("product_id")], max(r for r, _ in layout), "rnk")
    slotted = ranked.join(F.broadcast(layout_table(override.sparkSession)), "rnk")
    brands = prices.where(F.col("Brand").isNotNull()).select(F.col("SKU").cast("string").alias("product_id"), "Brand")
    return (
        slotted.join(brands, "product_id")
        .withColumn("Size", F.concat("Width", F.lit("/"), "Profile", F.lit(" R"), "Rim"))
        .where(F.col("Size").isNotNull())
        .select(
            "product_id", "slot_number", *[F.lit(LABEL).alias(c) for c in ("Rationale", "Initiative", "Notes")],
            F.lit(run_date).alias("Start_date"), F.date_add(F.lit(run_date), 30).alias("Review_date"), "Brand", "Size",
        )
    )

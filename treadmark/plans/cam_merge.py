"""Newest-wins merge of staged slot rows into the slot table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treadmark.functions.lists import HOTBOXES, SKUS, SLOTS
from treadmark.functions.text import STRICT_SIZE_RE, alnum_key, blank_to_null, squeeze, upsert_profile, upsert_rim, upsert_width
from treadmark.operators.compare import require_columns
from treadmark.operators.topk import best_one
from treadmark.operators.upsert import merge_newer

TARGET_SLOTS = tuple(f"SKU{i}" for i in range(1, 25))
KEYS = ("Make", "Model", "Width", "Profile", "Rim")


def staging(results: DataFrame, stamp) -> DataFrame:
    """Result rows as staging rows: names squeezed, blanks, '-' and FormatError as NULL."""
    require_columns(results, ["Vehicle", "Size", *SLOTS])
    return results.select(
        squeeze(F.col("Vehicle")).alias("Vehicle"),
        squeeze(F.col("Size")).alias("Size"),
        *[blank_to_null(F.col(c), "-", "FormatError").alias(c) for c in SLOTS],
        stamp.alias("last_modified"),
    )


def staged_rows(stage: DataFrame, mapping: DataFrame) -> DataFrame:
    """One staged row per make, model and size: the newest, ties by slot values."""
    known = mapping.where(F.col("CarMake").isNotNull() & F.col("CarModel").isNotNull()).select(
        alnum_key(F.col("vehicle")).alias("vehicle_key"), F.col("CarMake").alias("Make"), F.col("CarModel").alias("Model")
    )
    rows = stage.where(F.upper("Size").rlike(STRICT_SIZE_RE)).withColumn("vehicle_key", alnum_key(F.col("Vehicle")))
    slots = [blank_to_null(F.col(c)).alias(f"SKU{i}") for i, c in enumerate((*HOTBOXES, *SKUS), start=1)]
    parsed = rows.join(known, "vehicle_key").select(
        "Make", "Model", upsert_width(F.col("Size")).alias("Width"), upsert_profile(F.col("Size")).alias("Profile"),
        upsert_rim(F.col("Size")).alias("Rim"), *slots, "last_modified",
        F.upper(F.trim("Make")).alias("_make"), F.upper(F.trim("Model")).alias("_model"),
    )
    order = [F.desc_nulls_last("last_modified"), *[F.asc_nulls_first(c) for c in (*TARGET_SLOTS, "Make", "Model")]]
    newest = best_one(parsed, ["_make", "_model", "Width", "Profile", "Rim"], order)
    return newest.drop("_make", "_model")


def build(target: DataFrame, stage: DataFrame, mapping: DataFrame) -> DataFrame:
    """The slot table after the merge; write it with ``rewrite_table``."""
    staged = staged_rows(stage, mapping)

    def norm(df: DataFrame, c: str):
        return F.upper(F.trim(df[c])) if c in ("Make", "Model") else F.trim(df[c])

    keys = {c: (norm(target, c), norm(staged, c)) for c in KEYS}
    merged = merge_newer(
        target, staged, keys, replace=["Make", "Model"], patch=list(TARGET_SLOTS), keep=["Width", "Profile", "Rim"],
        stamp="last_modified", empty="-",
    )
    return merged.select(*KEYS, *TARGET_SLOTS, "last_modified")

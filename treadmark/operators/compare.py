"""Table comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def schema_drift(golden: DataFrame, current: DataFrame) -> dict[str, list[str]]:
    a, b = set(golden.columns), set(current.columns)
    return {"missing": sorted(a - b), "new": sorted(b - a)}


def row_drift(golden: DataFrame, current: DataFrame, ignored: list[str] | None = None) -> DataFrame:
    """Rows found on one side only, with the side; ``ignored`` columns do not count."""
    skip = set(ignored or [])
    columns = [c for c in golden.columns if c not in skip and c in current.columns]
    signed = golden.select(*columns, F.lit(1).alias("_sign")).unionByName(current.select(*columns, F.lit(-1).alias("_sign")))
    # One grouping counts both sides; equal rows cancel out and only what is left over is repeated.
    left = signed.groupBy(*columns).agg(F.sum("_sign").alias("_left")).where("_left <> 0")
    rows = left.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_left"))))
    return rows.select(*columns, F.when(F.col("_left") > 0, "golden").otherwise("current").alias("side"))


def cell_drift(golden: DataFrame, current: DataFrame, keys: list[str], volatile: list[str] | None = None) -> DataFrame:
    """What differs, by key: ``keys``, kind and ``cells``, a map from column to its old and new value as text.

    kind is changed (cells: the columns that differ), missing or new (cells: all columns of the row), and schema, one row for
    the table with the columns that only one side has.  Volatile columns do not count.  Rows that agree whole cancel out in
    one grouping; what is left is paired by key, rows that repeat a key in the order of their values.  Null keys pair
    like others, and nulls are values: a cell is changed if exactly one side is null.
    """
    skip = {*keys, *(volatile or [])}
    columns = [c for c in golden.columns if c not in skip and c in current.columns]
    row = F.struct(*columns) if columns else F.struct(F.lit(0).alias("_none"))
    signed = golden.select(*keys, row.alias("_row"), F.lit(1).alias("_sign")).unionByName(current.select(*keys, row.alias("_row"), F.lit(-1).alias("_sign")))
    left = signed.groupBy(*keys, "_row").agg(F.sum("_sign").alias("_left")).where("_left <> 0")
    sides = left.select(*keys, "_row", (F.col("_left") > 0).alias("_old"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_left"))).alias("_copy"))
    place = F.row_number().over(Window.partitionBy(*keys, "_old").orderBy("_row", "_copy"))
    pairs = sides.withColumn("_place", place).groupBy(*keys, "_place").agg(F.max(F.when(F.col("_old"), F.col("_row"))).alias("_a"), F.max(F.when(~F.col("_old"), F.col("_row"))).alias("_b"))
    kind = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "new").otherwise("changed")

    def cells(names: list[str], old, new) -> Column:
        items = [F.struct(F.lit(c).alias("key"), F.struct(old(c).cast("string").alias("old"), new(c).cast("string").alias("new")).alias("value")) for c in names]
        return F.map_from_entries(F.filter(F.array(*items), lambda e: ~e["value"]["old"].eqNullSafe(e["value"]["new"])))

    none = F.lit(None).cast("map<string,struct<old:string,new:string>>")
    changed = cells(columns, lambda c: F.col(f"_a.{c}"), lambda c: F.col(f"_b.{c}")) if columns else none
    rows = pairs.select(*keys, kind.alias("kind"), changed.alias("cells"))
    drift = schema_drift(golden, current)
    names = [c for c in [*drift["missing"], *drift["new"]] if c not in skip]
    if names:
        side = {c: "golden" if c in drift["missing"] else "current" for c in names}
        told = cells(names, lambda c: F.lit("present" if side[c] == "golden" else None), lambda c: F.lit("present" if side[c] == "current" else None))
        table = golden.sparkSession.range(1).select(*(F.lit(None).cast(dict(golden.dtypes)[k]).alias(k) for k in keys), F.lit("schema").alias("kind"), told.alias("cells"))
        rows = rows.unionByName(table)
    return rows


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df

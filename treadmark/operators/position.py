"""Row positions over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from treadmark.session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within a partition below this bit


def with_position(
    df: DataFrame, order: list[Column], name: str = "position", total: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Dense 1-based position of every row in ``order``; optionally the row count.

    The table is range-sorted once and written to the shared folder, so the
    partition layout is fixed.  Rows are then numbered inside their partition
    and shifted by the sizes of the partitions before it.  ``order`` should be
    total: equal sort values stay in one partition, distinct ones are split
    however many rows share a prefix.  ``keep``: the columns that are written, if what only orders the rows may go.
    """
    placed = durable(df.sort(*order).select(*(keep or df.columns), F.monotonically_increasing_id().alias("_mid"))).withColumn(
        "_part", F.shiftright("_mid", _ROW_BITS)
    )
    # One row per partition, so the window and the broadcast stay small.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifts = sizes.select(
        "_part",
        (F.sum("_rows").over(everything) - F.col("_rows")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(F.lit(1))).alias("_total"),
    )
    in_part = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    out = placed.join(F.broadcast(shifts), "_part").withColumn(name, F.col("_shift") + in_part + F.lit(1))
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop("_mid", "_part", "_shift", "_total")


def ntile(df: DataFrame, buckets: int, order: list[Column], name: str) -> DataFrame:
    """NTILE over the whole table: the first ``total % buckets`` tiles get one row more."""
    ranked = with_position(df, order, "_pos", "_n")
    return ranked.withColumn(name, tile_of(F.col("_pos"), F.col("_n"), buckets)).drop("_pos", "_n")


def tile_of(position: Column, total: Column, buckets: int) -> Column:
    small = F.floor(total / F.lit(buckets))
    wide = total % F.lit(buckets)
    edge = wide * (small + 1)
    in_wide = F.floor((position - 1) / (small + 1)) + 1
    in_small = wide + F.floor((position - edge - 1) / F.nullif(small, F.lit(0).cast("bigint"))) + 1
    return F.when(position <= edge, in_wide).otherwise(in_small).cast("bigint")


#: A page that ends before this row is cut by each task on its own and merged in one.
HEAD_ROWS = 10_000


def page(df: DataFrame, order: list[Column], offset: int, count: int) -> DataFrame:
    """Rows [offset, offset + count) of the ordered table; no task holds more than HEAD_ROWS or its share of them."""
    if offset + count <= HEAD_ROWS:
        return df.orderBy(*order).offset(offset).limit(count)
    placed = with_position(df, order, "_pos")
    return placed.where(F.col("_pos").between(offset + 1, offset + count)).drop("_pos")

"""Latest earlier event per key, without pairing events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def last_before(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, bucket: int
) -> DataFrame:
    """For every ``left`` row the greatest ``right_time`` <= ``left_time`` with equal keys.

    Rows without a match are dropped, as an inner join would.  Times are
    integers; ``bucket`` is a width in the same unit.  A key's timeline is cut
    into buckets: inside a bucket a window carries the last seen time forward,
    and what happened before the bucket comes from the per-bucket maxima.  So
    no task holds the whole timeline of a key, only one bucket of it, or one
    number per bucket.
    """
    present = None
    for k in keys:
        test = F.col(k).isNotNull()
        present = test if present is None else present & test
    slot = "_slot"
    lhs = left.where(present & F.col(left_time).isNotNull()).withColumn(
        slot, F.floor(F.col(left_time) / F.lit(bucket)).cast("bigint")
    )
    rhs = (
        right.where(present & F.col(right_time).isNotNull())
        .select(*keys, F.col(right_time).alias("_seen"))
        .withColumn(slot, F.floor(F.col("_seen") / F.lit(bucket)).cast("bigint"))
    )
    payload = [c for c in lhs.columns if c not in (*keys, slot)]

    # The greatest time seen in any earlier bucket, for each bucket with left rows.
    peaks = rhs.groupBy(*keys, slot).agg(F.max("_seen").alias("_peak"))
    asked = lhs.select(*keys, slot).distinct().withColumn("_asked", F.lit(True))
    timeline = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        peaks.join(asked, [*keys, slot], "full_outer")
        .withColumn("_carry", F.max("_peak").over(timeline))
        .where("_asked")
        .select(*keys, slot, "_carry")
    )

    # The greatest time inside the bucket: a right row sorts before a left row
    # of the same moment.
    events = lhs.select(
        *keys, slot, F.col(left_time).alias("_time"), F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_seen"),
        F.struct(*payload).alias("_row"),
    ).unionByName(
        rhs.select(*keys, slot, F.col("_seen").alias("_time"), F.lit(0).alias("_kind"), "_seen"),
        allowMissingColumns=True,
    )
    inside = Window.partitionBy(*keys, slot).orderBy("_time", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        events.withColumn("_near", F.max("_seen").over(inside))
        .where("_kind = 1")
        .join(carried, [*keys, slot], "left")
        .withColumn(right_time, F.coalesce("_near", "_carry"))
        .where(F.col(right_time).isNotNull())
    )
    return found.select(*keys, "_row.*", right_time)

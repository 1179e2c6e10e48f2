"""Distinct counts attached to detail rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from treadmark.session import shuffle_partitions


def with_distinct_count(df: DataFrame, keys: list[str], value: str, name: str, match_null: bool) -> DataFrame:
    """``count(distinct value)`` per key on every row of that key.

    Counted by a partial aggregate and joined back, so a hot key is never one
    window partition.  ``match_null`` tells whether NULL keys form a group (as
    in a window) or stay without a count (as in JOIN USING).
    """
    counts = df.groupBy(*keys).agg(F.count_distinct(value).alias(name))
    return join_on(df, counts, keys, match_null)


def join_on(df: DataFrame, other: DataFrame, keys: list[str], match_null: bool) -> DataFrame:
    """Left join to a keyed table, with or without matching NULL keys.

    Rows whose NULL key can match nothing are spread over the shuffle's partitions; where NULL is a key like others, the
    rows of one key can be split between tasks, as ``other`` has one row for it.
    """
    a, b = df, other.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    on = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_b_{k}")) if match_null else F.col(k) == F.col(f"_b_{k}")
        on = test if on is None else on & test
    if not match_null:
        missing = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
        spread = F.pmod(F.monotonically_increasing_id(), F.lit(shuffle_partitions(df.sparkSession))) + 1
        a = a.withColumn("_apart", F.when(missing, spread).otherwise(F.lit(0).cast("bigint")))
        on = on & (F.col("_apart") == F.col("_together"))
        b = b.withColumn("_together", F.lit(0).cast("bigint"))
    extra = [c for c in other.columns if c not in keys]
    return a.join(b, on, "left").select(*df.columns, *extra)

"""Best rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from treadmark.operators.position import with_position
from treadmark.session import durable


def best_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The ``n`` first rows of every key with their rank.

    The rank filter sits right on the window, so Spark keeps only ``n`` rows
    per key in every input task before the shuffle (window group limit): a
    hot key costs its one reducer at most ``n`` rows per task.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(rank, F.row_number().over(spec)).where(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("bigint"))
    )


def best_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return best_n(df, keys, order, 1, "_rank").drop("_rank")


def running_rank(df: DataFrame, keys: list[str], order: list[Column], name: str, keep: list[str] | None = None) -> DataFrame:
    """Rank of every row inside its key, for keys of any size.

    Rows are placed by one range sort on (keys, order), so a hot key is spread
    over many tasks; the rank is the distance to the key's first position.
    ``keep``: the columns that are written beside the keys, if not all.
    """
    placed = with_position(df, [*(F.col(k) for k in keys), *order], "_pos", keep=[*keys, *keep] if keep else None)
    # One row a key, written so that Spark knows how few they are: the sorted rows then stay where they are.
    firsts = durable(placed.groupBy(*keys).agg(F.min("_pos").alias("_first")), "firsts")
    same = None
    a, b = placed.alias("a"), firsts.alias("b")
    for k in keys:
        test = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        same = test if same is None else same & test
    joined = a.join(b, same).select("a.*", (F.col("a._pos") - F.col("b._first") + 1).alias(name))
    return joined.drop("_pos")

"""Wide slot rows to narrow rows and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unpivot(df: DataFrame, keep: Sequence[str], columns: Sequence[Column], position: str, value: str) -> DataFrame:
    """One row per non-NULL column, numbered from 1 in column order."""
    long = df.select(*keep, F.posexplode(F.array(*columns)).alias("_at", value))
    return long.where(F.col(value).isNotNull()).select(
        *keep, (F.col("_at") + 1).cast("bigint").alias(position), value
    )


def pivot_max(position: str, value: str, names: Sequence[str]) -> list[Column]:
    """Aggregates that put the greatest value of position i into the i-th name."""
    return [
        F.max(F.when(F.col(position) == i, F.col(value))).alias(name) for i, name in enumerate(names, start=1)
    ]

"""Lookups that fall back from a narrow key to a wider one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def grown(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never sent whole to the driver and every task.

    Spark judges a written table by its compressed files and a column's share of a row, so it broadcasts tables of
    many times its threshold.  What grows with the input is merged instead, at every size.
    """
    return df.hint("merge")


def scoped_requests(requests: DataFrame, sources: list[DataFrame], narrow: list[str], wide: list[str]) -> DataFrame:
    """Give every request the best scope that has rows, as (source, level).

    Tried in order for each source: equal ``narrow`` keys, then equal ``wide``
    keys.  Only distinct keys are joined, never candidate rows.  ``_source`` is
    the index of the source, ``_level`` is 'narrow' or 'wide'; requests that
    match nothing have NULL in both.
    """
    out = requests
    tiers: list[Column] = []
    for i, source in enumerate(sources):
        for level, keys in (("narrow", narrow), ("wide", wide)):
            flag = f"_has_{i}_{level}"
            out = out.join(source.select(*keys).distinct().withColumn(flag, F.lit(True)), keys, "left")
            tiers.append(F.when(F.col(flag), F.struct(F.lit(i).alias("source"), F.lit(level).alias("level"))))
    best = F.coalesce(*tiers)
    return (
        out.withColumn("_best", best)
        .withColumn("_source", F.col("_best.source"))
        .withColumn("_level", F.col("_best.level"))
        .drop("_best", *[c for c in out.columns if c.startswith("_has_")])
    )


def longest_prefix(names: DataFrame, name: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Longest entry of ``prefixes`` that each distinct name starts with.

    Every name offers its own beginnings as equi-join keys, so the work is the
    total length of the names and not names times prefixes.
    """
    beginnings = names.select(name).distinct().select(
        name, F.explode(F.sequence(F.lit(1), F.length(name))).alias("_len")
    ).where(F.length(name) > 0)
    keys = prefixes.select(F.col(prefix).alias("_prefix")).distinct()
    hits = beginnings.withColumn("_prefix", F.substring(F.col(name), F.lit(1), F.col("_len"))).join(keys, "_prefix")
    return hits.groupBy(name).agg(F.max_by("_prefix", "_len").alias(prefix))

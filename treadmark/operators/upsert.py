"""Keyed merge of a staging table into a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treadmark.session import shuffle_partitions


def _apart(df: DataFrame, prefix: str, keys: dict) -> Column:
    """0 for rows with all keys, else one of as many numbers as a shuffle has partitions."""
    known = [F.col(f"{prefix}{k}") for k in keys]
    missing = F.exists(F.array(*[k.isNull() for k in known]), lambda x: x)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(shuffle_partitions(df.sparkSession))) + 1
    return F.when(missing, spread).otherwise(F.lit(0).cast("bigint"))


def merge_newer(
    target: DataFrame,
    staged: DataFrame,
    keys: dict[str, tuple[Column, Column]],
    replace: list[str],
    patch: list[str],
    keep: list[str],
    stamp: str,
    empty: str,
) -> DataFrame:
    """The target after the merge.

    ``keys`` maps a name to its (target, staged) key expression; NULL keys never
    match.  A matched row whose staged stamp is not older takes the ``replace``
    columns and ``stamp`` from staging and each ``patch`` value that is neither
    NULL nor ``empty``.  An older row, or one with a missing stamp on either
    side, stays as it is.  Unmatched staged rows are inserted.  ``staged`` must
    hold one row per key.
    """
    t = target.select(*[target[c].alias(f"t_{c}") for c in target.columns], *[e[0].alias(f"tk_{k}") for k, e in keys.items()])
    s = staged.select(*[staged[c].alias(f"s_{c}") for c in staged.columns], *[e[1].alias(f"sk_{k}") for k, e in keys.items()])
    # Rows with a NULL key match nothing; a number that differs between the sides
    # keeps them from meeting in one task of the outer join.
    t = t.withColumn("t_row", F.lit(True)).withColumn("t_apart", _apart(t, "tk_", keys))
    s = s.withColumn("s_row", F.lit(True)).withColumn("s_apart", -_apart(s, "sk_", keys))
    on = F.col("t_apart") == F.col("s_apart")
    for k in keys:
        on = on & (F.col(f"tk_{k}") == F.col(f"sk_{k}"))
    both = t.join(s, on, "full_outer")
    is_new = F.col("t_row").isNull()
    is_update = F.coalesce(F.col("t_row") & F.col("s_row") & (F.col(f"s_{stamp}") >= F.col(f"t_{stamp}")), F.lit(False))

    def taken(c: str) -> Column:
        return F.when(is_new | is_update, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)

    def patched(c: str) -> Column:
        incoming = F.nullif(F.col(f"s_{c}"), F.lit(empty))
        return (
            F.when(is_new, incoming).when(is_update, F.coalesce(incoming, F.col(f"t_{c}"))).otherwise(F.col(f"t_{c}")).alias(c)
        )

    def kept(c: str) -> Column:
        return F.when(is_new, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)

    return both.select(*map(taken, replace), *map(kept, keep), *map(patched, patch), taken(stamp))

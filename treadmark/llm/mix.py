"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from treadmark.llm.common import WORD, free, only, table, text_of
from treadmark.session import durable

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
BINS = 1024
#: When no more documents than these are left, they are walked one by one.
FEW = 1024


def _uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the key alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``target`` of every source of ``sizes`` (source, source_size).

    Sources in code-point order, null last, take the weights in turn and share the total size by them.  A share
    stops at ``cap`` times the source's size; what is cut off is shared again among the others by weight, until no
    share is above its limit.  Every round needs two totals only, so no window runs over all sources.
    """
    spark = sizes.sparkSession
    by_rank = W.orderBy(F.col("source").asc_nulls_last())
    ranked = durable(sizes.withColumn("rank", F.row_number().over(by_rank) - 1), "sources")  # one row for each source
    picked = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", picked.cast("long")).drop("rank")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, above = 0.0, None
    while True:
        held = F.lit(False) if above is None else F.col("weight") * F.lit(share) > F.col("source_size") * cap
        free, cut, n = ranked.agg(
            F.sum(F.when(~held, F.col("weight"))), F.sum(F.when(held, F.col("source_size") * cap)), F.count(F.when(held, 1)),
        ).first()
        if n == above or not free:
            break
        above, share = n, float(total - (cut or 0)) / float(free)
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(share), (F.col("source_size") * cap).cast("double")))


def _expected(strata: DataFrame, cap: int) -> DataFrame:
    """Expected copies of the documents of each (source, appetite): min(cap, rate * appetite), the rate so chosen that
    the source's words meet its target.  A source has at most 64 appetites, so its window is small."""
    up = W.partitionBy("source").orderBy(F.desc("appetite"))
    above = up.rowsBetween(W.unboundedPreceding, -1)
    rest = up.rowsBetween(W.currentRow, W.unboundedFollowing)
    weighted = F.sum(F.col("words") * F.col("appetite")).over(rest).cast("double")
    rate = F.try_divide(F.col("target") - cap * F.coalesce(F.sum("words").over(above), F.lit(0)), weighted)  # null without words
    fits = F.when(F.col("rate") * F.col("appetite") <= cap, F.struct(F.col("appetite"), F.col("rate")))
    found = strata.withColumn("rate", rate).withColumn("rate", F.max(fits).over(W.partitionBy("source"))["rate"])
    copies = F.least(F.lit(float(cap)), F.coalesce(F.col("rate"), F.lit(float(cap))) * F.col("appetite"))
    out = found.withColumn("copies", F.when(F.col("words") > 0, copies).otherwise(0.0))
    out = out.withColumn("whole", F.floor(F.col("copies") + 1e-9)).withColumn(
        "part", F.greatest(F.lit(0.0), F.col("copies") - F.col("whole"))
    )
    need = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(W.partitionBy("source"))
    return out.select("source", "appetite", "whole", "part", need.alias("need"))


def _edge(rows: DataFrame, bin_: Column) -> DataFrame:
    """Per source: the bin in which the sample ends, and the words before it.  Bins are few, whatever the rows."""
    sums = rows.groupBy("source", bin_.alias("bin")).agg(F.sum("size").alias("words"), F.first("need").alias("need"), F.first("base").alias("base"))
    so_far = F.sum("words").over(W.partitionBy("source").orderBy("bin"))
    return (
        sums.withColumn("after", F.col("base") + so_far)
        .filter((F.col("after") - F.col("words") <= F.col("need")) & (F.col("need") < F.col("after")))
        .select("source", F.col("bin").alias("edge"), (F.col("after") - F.col("words")).alias("before"))
    )


def _cut(rows: DataFrame) -> DataFrame:
    """``rows`` with ``drawn``: those before the first, in the order of their places, that no longer fits into their
    source's ``need``.  Two counts over the bins find it, so only the last bin's rows are sorted."""
    first = F.floor(F.col("place") * BINS)
    second = F.floor((F.col("place") * BINS - first) * BINS)
    drawn = rows.filter("place IS NOT NULL")
    edge = durable(_edge(drawn, first), "edge").withColumnsRenamed({"source": "s1", "edge": "edge1", "before": "before1"})
    near = rows.join(edge, F.col("source").eqNullSafe(F.col("s1")), "left").drop("s1", "base")
    inner = near.filter(first == F.col("edge1")).withColumn("base", F.col("before1"))
    edge2 = durable(_edge(inner, second), "edge").withColumnsRenamed({"source": "s2", "edge": "edge2", "before": "before2"})
    near = near.join(edge2, F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2", "before1")
    at_edge = F.coalesce((first == F.col("edge1")) & (second == F.col("edge2")), F.lit(False))
    in_order = W.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = (
        near.filter(at_edge)
        .withColumn("so_far", F.col("before2") + F.sum("size").over(in_order))
        .withColumn("drawn", F.col("so_far") <= F.col("need"))
        .drop("so_far")
    )
    before = F.col("place").isNotNull() & (
        F.col("edge1").isNull() | (first < F.col("edge1")) | ((first == F.col("edge1")) & (F.col("edge2").isNull() | (second < F.col("edge2"))))
    )
    rest = near.filter(~at_edge).withColumn("drawn", F.coalesce(before, F.lit(False)))
    return durable(rest.unionByName(last).drop("edge1", "edge2", "before2"), "drawn")


def _stepped(rows: DataFrame) -> DataFrame:
    """``rows``, FEW at most, with ``drawn``: in the order of their places, those that fit into what their source still misses."""
    def step(done: Column, row: Column) -> Column:
        fits = F.coalesce(row["place"].isNotNull() & (done["filled"] + row["size"] <= row["need"]), F.lit(False))
        filled = done["filled"] + F.when(fits, row["size"]).otherwise(F.lit(0).cast("long"))
        return F.struct(filled.alias("filled"), F.concat(done["drawn"], F.array(fits)).alias("drawn"))

    order = ["place", "doc_id", "size"]
    one = F.struct(*order, *(c for c in rows.columns if c not in (*order, "base")))
    listed = rows.groupBy("source").agg(F.sort_array(F.collect_list(one)).alias("rows"))
    none = F.struct(F.lit(0).cast("long").alias("filled"), F.array().cast("array<boolean>").alias("drawn"))
    drawn = F.aggregate("rows", none, step, lambda done: done["drawn"])
    each = listed.select(F.explode(F.arrays_zip("rows", drawn.alias("drawn"))).alias("x"))
    return durable(each.select("x.rows.*", "x.drawn"), "drawn")


def _walk(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``drawn``, and the words that each source (``s``) still misses (``gap``).

    The order is walked to its end: a document larger than what is missing is stepped over.  What is missing never
    grows, so such a document cannot fit later: each round cuts the order of the documents that still fit, until none does
    or so few are left that one step walks them all.
    """
    parts, gap, n = [], None, rows.limit(FEW + 1).count()
    while True:
        cut = _cut(rows) if n > FEW else _stepped(rows)
        size_drawn = F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0))
        left = durable(cut.groupBy("source").agg((F.first("need") - size_drawn).alias("gap")), "gap").withColumnRenamed("source", "s")
        # a source without documents that fit is in no later round and keeps its gap
        gap = left if gap is None else durable(
            gap.join(left.withColumnsRenamed({"s": "t", "gap": "now"}), F.col("s").eqNullSafe(F.col("t")), "left").select("s", F.coalesce("now", "gap").alias("gap")), "gap"
        )
        free(rows.sparkSession)
        if n <= FEW:
            parts.append(cut)
            break
        found = cut.join(left, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        fits = F.col("place").isNotNull() & ~F.col("drawn") & (F.col("size") <= F.col("gap"))
        parts.append(found.filter(~fits).drop("gap"))
        rows = found.filter(fits).withColumn("need", F.col("gap")).withColumn("base", F.lit(0)).drop("gap", "drawn")
        n = rows.limit(FEW + 1).count()
        if not n:
            break
    picked = parts[0]
    for part in parts[1:]:
        picked = picked.unionByName(part)
    return durable(picked.drop("part", "need"), "picked"), gap


def pareto_mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, text: str = "text",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): how often the mix takes each document.

    Longer documents have a larger appetite (the bits of their size); a document expects min(cap, rate * appetite)
    copies.  Its whole copies are certain.  The parts below one are inclusion probabilities p, and a source's sample is
    drawn by Pareto order sampling: in the order of (u / (1-u)) / (p / (1-p)), each document that still fits into the
    words that are missing is taken, larger ones are stepped over; when none fits, the one document whose size is nearest
    to what remains closes the gap.  The order's places are found by counts over 1024 bins, twice, so that only about a
    millionth of a source's rows is ever sorted in one task.

    A null text has size 0 and is never repeated beyond its certain copies; a null source is a source, the last one.
    A null doc_id draws like the empty id.  Repeated rows draw alike and count each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    sized = durable(only(docs, "doc_id", "source", text).select("doc_id", "source", size.alias("size")), "sized")
    sized = sized.withColumn("appetite", F.length(F.bin("size")))
    strata = sized.groupBy("source", "appetite").agg(F.sum("size").alias("words"))
    strata = durable(strata, "strata")
    goal = targets(strata.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap).select(
        F.col("source").alias("of"), "source_size", "target"
    )
    strata = strata.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    plan = durable(_expected(strata, cap).join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "mix-plan")
    plan = plan.withColumnsRenamed({"source": "s", "appetite": "a"})
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("part") / (1 - F.col("part")))
    rows = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("appetite") == F.col("a")))
        .withColumn("u", _uniform(F.col("doc_id"), seed))
        .withColumn("odds", F.when((F.col("part") > 0) & (F.col("size") > 0), odds))
        .withColumn("place", F.col("odds") / (1 + F.col("odds")))
        .withColumn("base", F.lit(0))
        .drop("s", "a", "u", "odds")
    )
    picked, gap = _walk(rows)
    free = F.col("place").isNotNull() & ~F.col("drawn")
    off = F.abs(F.col("gap") - F.col("size"))
    closer = F.when(free & (off < F.col("gap")), F.struct(off.alias("off"), "place", "doc_id", "size"))
    filler = durable(
        picked.join(gap, F.col("source").eqNullSafe(F.col("s"))).groupBy("source").agg(F.min(closer).alias("f")).filter("f IS NOT NULL"), "filler"
    ).select(F.col("source").alias("s"), "f")
    fills = F.coalesce(free & (F.col("place") == F.col("f.place")) & F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("size") == F.col("f.size")), F.lit(False))
    copies = F.col("whole") + (F.col("drawn") | fills).cast("long")
    out = picked.join(filler, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("copies", copies)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; documents that it leaves out go."""
    taken = pareto_mix(docs, weights, cap, seed, text).filter("copies > 0")
    often = taken.groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    # The row travels as one value, so no column of it meets a name of ours.
    size = F.regexp_count(text_of(text), F.lit(WORD)).cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"), F.col("source").alias("own_source"), size.alias("own_size"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_size") == F.col("size"))
    again = rows.join(often, same).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return again.select("row.*")


def op1_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    return pareto_mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
 d AS (SELECT *, length(bin(size)) AS a,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM sized),
 s AS (SELECT source, sum(size)::BIGINT AS ss, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS w
       FROM d GROUP BY source),
 f AS (SELECT *, (sum(ss) OVER () - coalesce(sum(3 * ss) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lam
       FROM s WINDOW o AS (ORDER BY 3.0 * ss / w, source NULLS LAST)),
 l AS (SELECT coalesce(arg_min(lam, 3.0 * ss / w) FILTER (lam * w <= 3 * ss), 0) AS lam FROM f),
 t AS (SELECT source, ss, least(w * l.lam, (3 * ss)::DOUBLE) AS target FROM s, l),
 g AS (SELECT d.source, a, sum(size)::BIGINT AS words, any_value(ss) AS ss, any_value(target) AS target
       FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.source, a),
 r AS (SELECT *, (target - 3 * coalesce(sum(words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(words * a) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate
       FROM g WINDOW o AS (PARTITION BY source ORDER BY a DESC)),
 e AS (SELECT *, CASE WHEN words > 0 THEN least(3.0::DOUBLE,
           coalesce(arg_max(rate, a) FILTER (rate * a <= 3) OVER (PARTITION BY source), 3.0::DOUBLE) * a) ELSE 0.0::DOUBLE END AS copies FROM r),
 p AS (SELECT *, floor(copies + 1e-9::DOUBLE)::BIGINT AS whole, greatest(0.0::DOUBLE, copies - floor(copies + 1e-9::DOUBLE)) AS part FROM e),
 n AS (SELECT *, target - (sum(whole * words) OVER (PARTITION BY source))::DOUBLE AS need FROM p),
 q AS (SELECT d.*, n.ss, n.target, n.whole, n.need,
         CASE WHEN part > 0 AND size > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS odds
       FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source AND d.a = n.a),
 c AS MATERIALIZED (SELECT *, odds / (1 + odds) AS place, dense_rank() OVER (ORDER BY source NULLS LAST) AS sid,
         row_number() OVER (PARTITION BY source ORDER BY odds / (1 + odds) NULLS LAST, doc_id, size) AS step FROM q),
 w AS (SELECT DISTINCT sid, 0::BIGINT AS step, 0::BIGINT AS filled, false AS drawn FROM c
       UNION ALL SELECT c.sid, c.step, CASE WHEN filled + size <= need THEN filled + size ELSE filled END, filled + size <= need
       FROM w JOIN c ON c.sid = w.sid AND c.step = w.step + 1 WHERE odds IS NOT NULL),
 k AS (SELECT c.*, coalesce(w.drawn, false) AS drawn FROM c LEFT JOIN w ON w.sid = c.sid AND w.step = c.step),
 x AS (SELECT *, need - (sum(CASE WHEN drawn THEN size ELSE 0 END) OVER (PARTITION BY source))::DOUBLE AS gap FROM k),
 y AS (SELECT *, place IS NOT NULL AND NOT drawn AND abs(gap - size) < gap AS free FROM x),
 z AS (SELECT *, row_number() OVER (PARTITION BY source, free ORDER BY abs(gap - size), place, doc_id, size) = 1 AND free AS fills FROM y)
SELECT doc_id, size, ss AS source_size, target, size * (whole + CASE WHEN drawn OR fills THEN 1 ELSE 0 END) AS taken FROM z
"""

"""Quality rules: counts of every text, and a hashed n-gram likelihood ratio of trusted target to raw corpus.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treadmark.llm.common import only, table, text_of, words_of

BUCKETS = 8192
#: A document is kept when its mean log ratio for each n-gram is at least this.
THRESHOLD = -0.06
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once: a lambda in f would otherwise compute it again for each element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def n_repeat_words(words: Column) -> Column:
    """Words inside a three-word window that is found twice or more.

    The windows' hashes are sorted with their places, so equal windows become neighbours: n log n for a text, however
    often it repeats.
    """

    def windows(w: Column) -> Column:
        third = F.slice(w, 3, F.greatest(F.size(w), F.lit(1)))
        return F.transform(third, lambda x, i: F.xxhash64(F.get(w, i), F.get(w, i + 1), x))

    def covered(s: Column) -> Column:
        hit = F.filter(s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"]))
        at = F.transform(hit, lambda x: x["i"])
        return once(at, lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda i: i + 1), F.transform(p, lambda i: i + 2)))))

    def repeats(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(once(placed, covered))

    return once(once(words, windows), repeats).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, words and the base counts of every document; one pass over the texts, no shuffle."""
    t = only(docs, "doc_id", text).select("doc_id", text_of(text).alias("text")).withColumn("words", words_of(F.col("text")))
    out = t.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    few, repeats = F.col("n_words") < MIN_WORDS, 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return out.withColumn("base_failed", few | repeats)


def features(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of a text's words and of its pairs of neighbouring words."""

    def both(w: Column) -> Column:
        ones = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
        twos = F.transform(
            F.slice(w, 2, F.greatest(F.size(w), F.lit(1))),
            lambda x, i: F.pmod(F.xxhash64(F.get(w, i), x), F.lit(buckets)).cast("int"),
        )
        return F.concat(ones, twos)

    return once(words, both)


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, text: str = "text") -> list[float]:
    """log(p_trusted / p_raw) for each bucket, both with one added to every count.

    All documents count for the raw multinomial, and all whose doc_id is in ``trusted`` for the target.  Trusted ids grow
    with the corpus, so texts and ids are dealt by id and meet in tables of one task's ids; a text without id is
    never trusted and is dealt by its own hash.  The sums are as many as there are buckets, so a list of
    them can go to the driver whatever the corpus.  Without a trusted document every ratio is 0.
    """
    ids = trusted.select(F.col("doc_id").alias("of")).where("of IS NOT NULL").distinct().select("of", F.lit(0).cast("long").alias("at"), F.lit(1).alias("good"))
    rows = only(docs, "doc_id", text).select("doc_id", text_of(text).alias("text"))
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
    marked = rows.join(ids.hint("shuffle_hash"), (F.col("doc_id") == F.col("of")) & (F.col("spread") == F.col("at")), "left")
    found = marked.select(features(words_of(F.col("text")), buckets).alias("f"), "good")
    sums = found.select(F.explode("f").alias("b"), "good").groupBy("b").agg(F.count("*").alias("raw"), F.count("good").alias("good"))
    raw, good = [1.0] * buckets, [1.0] * buckets
    for b, r, g in sums.collect():
        raw[b] += r
        good[b] += g
    if sum(good) == buckets:
        return [0.0] * buckets
    a, z = math.log(sum(good)), math.log(sum(raw))
    return [math.log(g) - a - math.log(r) + z for g, r in zip(good, raw, strict=True)]


def quality_rules(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """doc_id, the base counts, base_failed, llr and kept of every document.

    ``llr`` is the mean log ratio for each hashed word and word pair; a document is kept when it passes the base rules
    and its llr is at least ``threshold``.  A null or empty text has no words, fails the base and has llr 0.  Rows are
    judged alone: repeated rows and null ids get the same verdict each; an empty table gives no rows.
    """
    ratios = log_ratios(docs, trusted, buckets, text)
    weights = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded into one constant
    judged = counts(docs, text).withColumn("f", features(F.col("words"), buckets))
    total = F.aggregate(F.col("f"), F.lit(0.0), lambda acc, b: acc + F.get(weights, b))
    llr = F.when(F.size("f") > 0, total / F.size("f")).otherwise(0.0)
    out = judged.withColumn("llr", llr).drop("f", "words")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return quality_rules(table(spark, folder, "documents"), trusted)

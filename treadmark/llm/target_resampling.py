"""Importance resampling towards a target distribution, over hashed n-gram features.

A feature's bucket is the CRC-32 of its bytes.  A CRC goes on from its state, so the state after a word serves every
n-gram that begins with it.  Frequent words are the head of the vocabulary: their states are broadcast, and the
buckets of frequent pairs of them; whatever is not in the head takes its CRC directly.  Both ways give the same buckets, so
the bucket totals are exact, wherever the head ends.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treadmark.llm.common import LOWER, UPPER, only, ship, table
from treadmark.operators.position import with_position
from treadmark.session import durable

#: Words are runs of anything but these ASCII characters; A-Z are lower-cased first.
APART = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_PLAIN = bytes.maketrans(APART + UPPER.encode(), b" " * len(APART) + LOWER.encode())

LONGEST, BUCKETS = 1, 10_000
SEED, LEAST_WORDS, PERCENT = "2024", 20, 10
#: A word is frequent if at least one in HEAD is that word, so there are at most HEAD; likewise for pairs.  Longer words than
#: HEAD_BYTES are never in the head, which bounds what is broadcast.
HEAD, HEAD_BYTES = 65_536, 64
#: A task's counts are sent on when they hold so many words.
HELD = 200_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


@dataclass
class Head:
    """CRC states of frequent words and buckets of frequent pairs."""

    buckets: int = BUCKETS
    states: dict[bytes, int] = field(default_factory=dict)
    pairs: dict[tuple[bytes, bytes], int] = field(default_factory=dict)

    @classmethod
    def of(cls, words: Iterable[bytes], pairs: Iterable[tuple[bytes, bytes]] = (), buckets: int = BUCKETS) -> Head:
        states = {w: zlib.crc32(w) for w in words}
        return cls(buckets, states, {(a, b): zlib.crc32(b" " + b, states[a]) % buckets for a, b in pairs})

    def features(self, words: list[bytes], longest: int) -> np.ndarray:
        """Buckets of all runs of 1 to ``longest`` words, shorter ones first."""
        get, crc = self.states.get, zlib.crc32
        states = [get(w) if w in self.states else crc(w) for w in words]
        out = [np.array(states, np.int64) % self.buckets]
        for n in range(2, longest + 1):
            ends = words[n - 1 :]
            if n == 2:
                known = self.pairs
                found = [known.get((a, b)) for a, b in zip(words, ends, strict=False)]
                states = [crc(b" " + b, s) for s, b in zip(states, ends, strict=False)] if longest > 2 else [
                    None if f is not None else crc(b" " + b, s) for f, s, b in zip(found, states, ends, strict=False)
                ]
                out.append(np.array([s % self.buckets if f is None else f for f, s in zip(found, states, strict=True)], np.int64))
            else:
                states = [crc(b" " + b, s) for s, b in zip(states, ends, strict=False)]
                out.append(np.array(states, np.int64) % self.buckets)
        return np.concatenate(out)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return only(docs, text).select(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def _frequent(rows: DataFrame, count, columns: int) -> list:
    """The words, or pairs, that make up at least a HEAD-th of what ``count`` counts; ``count`` gives a text's words or pairs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            keys = list(held)
            parts = [keys] if columns == 1 else list(zip(*keys, strict=True))
            names = [*(f"w{k}" for k in range(columns)), "n"]
            return pa.record_batch([*(pa.array(p, pa.binary()) for p in parts), pa.array(list(held.values()), pa.int64())], names=names)

        for batch in batches:
            for t in batch.column(0):
                held.update(count(t.as_py()))
                if len(held) > HELD:
                    yield sent()
                    held.clear()
        if held:
            yield sent()

    keys = [f"w{k}" for k in range(columns)]
    counts = rows.mapInArrow(counted, ", ".join([*(f"{k} binary" for k in keys), "n long"])).groupBy(*keys).agg(F.sum("n").alias("n"))
    counts = durable(counts, "feature-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.filter(F.col("n") * HEAD >= total).select(*keys).collect()  # at most HEAD rows of HEAD_BYTES each
    return sorted(bytes(r[0]) if columns == 1 else tuple(map(bytes, r)) for r in found)


def vocabulary_head(texts: list[DataFrame], longest: int = LONGEST, buckets: int = BUCKETS) -> Head:
    """The head of the vocabulary of all texts (column ``text``, binary) together, counted over every one of them."""
    rows = texts[0]
    for more in texts[1:]:
        rows = rows.union(more)
    short = lambda t: [w for w in words_of(t) if len(w) <= HEAD_BYTES]
    words = _frequent(rows, short, 1)
    if longest < 2 or not words:
        return Head.of(words, buckets=buckets)
    known = rows.sparkSession.sparkContext.broadcast(frozenset(words))

    def of_pairs(t: bytes) -> list[tuple[bytes, bytes]]:
        own, w = known.value, words_of(t)
        return [(a, b) for a, b in zip(w, w[1:], strict=False) if a in own and b in own]

    return Head.of(words, _frequent(rows, of_pairs, 2), buckets)


def features(docs: DataFrame, head: Head, longest: int = LONGEST, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_words, n_features and buckets (packed little-endian) of every whole text."""
    kind = dict(docs.dtypes)[key]
    shared = docs.sparkSession.sparkContext.broadcast(head)
    width = _width(head.buckets)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n_words, packed = [], []
                for t in part.column(1):
                    words = words_of(t.as_py())
                    n_words.append(len(words))
                    packed.append(own.features(words, longest).astype(width).tobytes())
                size = np.dtype(width).itemsize
                columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array([len(p) // size for p in packed], pa.int64()), pa.array(packed, pa.binary())]
                yield pa.record_batch(columns, names=[key, "n_words", "n_features", "buckets"])

    rows = only(docs, key, text).select(key, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(hashed, f"`{key}` {kind}, n_words long, n_features long, buckets binary")


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds; each task adds up its own first."""
    width = _width(buckets)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                n += np.bincount(np.frombuffer(packed.as_buffer(), width), minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(n[some])], names=["bucket", "n"])

    rows = found.select("buckets").mapInArrow(totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:  # one for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share of the target over its share of the raw, both smoothed by one."""
    s, t, buckets = raw.astype(float), target.astype(float), float(len(raw))
    total_s, total_t = float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (total_s + buckets) / ((a + 1) * (total_t + buckets)))) for a, b in zip(s, t, strict=True)], np.int64)


def _noise(key: Column, seed: str) -> Column:
    """Thousandths of a Gumbel variable from the key alone; the highest sums of weight and noise are a sample without
    replacement in proportion to the weights' exponentials."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    seed: str = SEED, text: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; those drawn towards the texts of ``target`` have a rank.

    A null text has no words, weighs 0 and is not drawn.  A null doc_id has the noise of the empty id and comes last among
    ties.  Every row is a document of its own; repeated rows have equal scores and differing ranks.  Without documents there
    are no rows; without target texts all buckets of a size gain alike.
    """
    spark = docs.sparkSession
    ship(spark)
    head = vocabulary_head([_texts(docs, text), _texts(target, text)], longest, buckets)
    found = durable(features(docs, head, longest, text), "features")
    goal = features(target.select(F.lit(0).alias("doc_id"), text), head, longest, text)
    gain = spark.sparkContext.broadcast(gains(bucket_totals(found, buckets), bucket_totals(goal, buckets)))
    kind, width = dict(docs.dtypes)["doc_id"], _width(buckets)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = gain.value
        for batch in batches:
            weights = [int(own[np.frombuffer(packed.as_buffer(), width)].sum()) for packed in batch.column(3)]
            yield pa.record_batch([*batch.columns[:3], pa.array(weights, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    scored = found.mapInArrow(weighed, f"doc_id {kind}, n_words long, n_features long, weight long")
    scored = durable(scored.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id()), "scored")
    able = F.col("n_words") >= least_words
    draw = scored.filter(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    placed = with_position(scored.filter(able), order, "place")
    rank = F.when(F.col("place") <= draw, F.col("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, rank.alias("rank")).union(scored.filter(~able).select(*columns, F.lit(None).cast("long")))


def op12_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


# CRC-32 over distinct words only, byte by byte.
ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
 t AS (SELECT 'd' AS side, row_number() OVER () AS row, doc_id, text FROM documents
       UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
 l AS (SELECT side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM t),
 w AS (SELECT side, row, unnest(words) AS word FROM l),
 v AS (SELECT DISTINCT word, hex(encode(word)) AS bytes FROM w),
 b AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(bytes) // 2), lambda i: ('0x' || bytes[2 * i + 1 : 2 * i + 2])::BIGINT)),
         lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295) % 10000 AS bucket FROM v, crc),
 f AS (SELECT side, row, bucket FROM w JOIN b USING (word)),
 n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM f GROUP BY bucket),
 a AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM n),
 g AS (SELECT bucket, floor(1000::DOUBLE * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain FROM n, a),
 x AS (SELECT row, sum(gain)::BIGINT AS weight FROM f JOIN g USING (bucket) WHERE side = 'd' GROUP BY row),
 h AS (SELECT doc_id, len(words)::BIGINT AS n, coalesce(weight, 0) AS weight,
         (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE AS u
       FROM l LEFT JOIN x USING (row) WHERE side = 'd'),
 s AS (SELECT *, weight + floor(-1000::DOUBLE * ln(-ln(u)))::BIGINT AS score FROM h),
 r AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST, n) AS place, count(*) FILTER (n >= 20) OVER () AS able FROM s)
SELECT doc_id, n AS n_features, weight, score, CASE WHEN n >= 20 AND place <= 10 * able // 100 THEN place END AS rank FROM r
"""

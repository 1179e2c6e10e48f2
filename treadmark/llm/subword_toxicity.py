"""Toxicity: a bag of subword vectors, averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself, each found by a hash; a text is the mean of
its words; a linear softmax makes two probabilities of it.  Vectors and softmax are trained together.  A misspelled or
inflected word that training never met still shares most n-grams with one that it met.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from treadmark.llm.common import fold, only, ship, table

#: Lengths of the n-grams of a word between its end marks, the number of vectors, and their length.
SHORTEST, LONGEST, BUCKETS, WIDTH = 3, 6, 1 << 18, 4
#: What the mean is multiplied by: a few words among hundreds must move the softmax.
GAIN = 200.0
#: The model learns from the whole texts of at most so many labelled documents of the classes 0 and 1, those with the smallest
#: hashes of their ids.  A text comes to the driver as weights of at most BUCKETS vectors.
TRAIN_ROWS = (3000, 1500)
#: Vectors that fewer of these documents use are not trained; calling a clean document toxic costs so many times what missing a
#: toxic one does.
LEAST_DOCS, CLEAN_WEIGHT = 4, 1.5
EPOCHS, BATCH, RATE, DECAY = 10, 32, 0.05, 0.03
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.5
#: Words whose scores a task remembers.
MEMORY = 300_000
#: Texts that are scored, and words that are hashed, at a time.
SOME, NEW = 64, 20_000
#: Marks that may stand around a word.
MARKS = ".,;:!?()[]{}<>\"'`*_~…“”‘’«»„¡¿|/\\-"


_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return ((h ^ (h >> np.uint64(29))) * _STEP >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each subword of the words (themselves and their n-grams) the word's place and the subword's bucket.

    The hashes of all words' n-grams are made side by side: one multiplication for each further character.
    """
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    of = np.repeat(np.arange(len(words)), sizes)
    left = ends[of] - np.arange(len(codes))
    powers = np.cumprod(np.full(int(sizes.max()), _STEP, np.uint64))
    whole = np.add.reduceat(codes * powers[np.arange(len(codes)) - starts[of]], starts)
    places, found = [np.arange(len(words))], [_bucket(whole)]
    h = codes.copy()
    for n in range(2, LONGEST + 1):
        if n > len(codes):
            break
        h = h[:-1] * _STEP + codes[n - 1 :]
        if n >= SHORTEST:
            fits = np.flatnonzero((left[: len(h)] >= n) & (sizes[of[: len(h)]] > n))
            places.append(of[fits])
            found.append(_bucket(h[fits] ^ np.uint64(n)))
    return np.concatenate(places), np.concatenate(found)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors that a whole text uses, and their weights, which add up to one."""
    counts = Counter(w.strip(MARKS) for w in words_of(text))
    if not counts:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    of, buckets = subwords(list(counts))
    each = np.fromiter(counts.values(), float, len(counts)) / np.bincount(of) / sum(counts.values())
    total = np.bincount(buckets, each[of], BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used].astype(np.float32)


@dataclass
class Model:
    """``vectors`` of the subwords and the softmax's weights of the two classes."""

    vectors: np.ndarray
    out: np.ndarray
    shift: np.ndarray

    def gap(self) -> np.ndarray:
        """What each subword adds to the toxic class's logit over the other's; averages of vectors are averages of this."""
        return GAIN * (self.vectors @ (self.out[:, 1] - self.out[:, 0]))


class Scorer:
    """Probabilities of texts; words are remembered by what they add."""

    def __init__(self, model: Model):
        self.gap, self.base, self.known = model.gap(), float(model.shift[1] - model.shift[0]), {}

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), NEW):
            some = words[at : at + NEW]
            of, buckets = subwords([w.strip(MARKS) for w in some])
            self.known.update(zip(some, (np.bincount(of, self.gap[buckets]) / np.bincount(of)).tolist(), strict=True))

    def __call__(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > MEMORY:
            self.known.clear()
        known, split = self.known, [words_of(t) for t in texts]
        new = set().union(*split) - known.keys()
        self._learn(sorted(new))
        means = np.array([sum(map(known.__getitem__, words)) / len(words) if words else 0.0 for words in split])
        return 1 / (1 + np.exp(-np.clip(self.base + means, -40, 40)))


def untrained(prior: float = 0.5) -> Model:
    return Model(np.zeros((BUCKETS, WIDTH), np.float32), np.zeros((WIDTH, 2)), np.array([0.0, np.log(prior / (1 - prior))]))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 1) -> Model:
    """A model trained by AdaGrad with weight decay on the bags; the classes weigh CLEAN_WEIGHT to one, however many rows each has."""
    share = float(np.mean(labels)) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return untrained(0.95 if share else 0.05)
    rng = np.random.default_rng(seed)
    often = np.zeros(BUCKETS, np.int64)
    for used, _ in bags:
        often[used] += 1
    bags = [(used[keep], value[keep]) for used, value, keep in ((u, v, often[u] >= LEAST_DOCS) for u, v in bags)]
    model = untrained()
    model.out = rng.normal(0, 0.5, (WIDTH, 2))  # the vectors start at nothing, so subwords that are never met add nothing
    weight = np.where(labels == 1, 1 / share, CLEAN_WEIGHT / (1 - share)) / (1 + CLEAN_WEIGHT)
    seen, seen_out, seen_shift = np.full((BUCKETS, 1), 1e-6), np.full((WIDTH, 2), 1e-6), np.full(2, 1e-6)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            used = np.concatenate([bags[d][0] for d in docs])
            value = np.concatenate([bags[d][1] for d in docs]) * np.float32(GAIN)
            sizes = np.array([len(bags[d][0]) for d in docs])
            of = np.repeat(np.arange(len(docs)), sizes)
            mean = np.stack([np.bincount(of, value * model.vectors[used, k], len(docs)) for k in range(WIDTH)], axis=1)
            logits = mean @ model.out + model.shift
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(docs)), labels[docs].astype(int)] -= 1
            p *= weight[docs, None] / len(docs)
            back = (p @ model.out.T).astype(np.float32)
            some, place = np.unique(used, return_inverse=True)
            slope = np.stack([np.bincount(place, value * back[of, k], len(some)) for k in range(WIDTH)], axis=1)
            seen[some, 0] += (slope**2).mean(axis=1)
            model.vectors[some] = (1 - rate * DECAY) * model.vectors[some] - (rate * slope / np.sqrt(seen[some])).astype(np.float32)
            for param, g, total in ((model.out, mean.T @ p, seen_out), (model.shift, p.sum(axis=0), seen_shift)):
                total += g**2
                param -= rate * g / np.sqrt(total)
    return model


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """A model from a bounded sample of the labelled documents outside the held-out fold, their texts whole."""
    ship(docs.sparkSession)
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    of = lambda v: known.filter(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS[v])
    some = of(0).union(of(1)).withColumnRenamed("doc_id", "of")

    def bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for doc_id, value, toxic in zip(*batch.columns, strict=True):
                used, weights = bag(value.as_py() or "")
                row = [pa.array([doc_id.as_py()], pa.int64()), pa.array([pack(used.astype("<u4").tobytes())]), pa.array([pack(weights.astype("<f2").tobytes())]), pa.array([toxic.as_py()], pa.int32())]
                yield pa.record_batch(row, names=["doc_id", "used", "weights", "toxic"])

    picked = only(docs, "doc_id", text).join(F.broadcast(some), F.col("doc_id") == F.col("of")).selectExpr("CAST(doc_id AS BIGINT)", f"CAST(`{text}` AS STRING)", "CAST(toxic AS INT)")
    rows = picked.mapInArrow(bagged, "doc_id bigint, used binary, weights binary, toxic int").collect()  # bounded by TRAIN_ROWS and BUCKETS
    rows = sorted({r["doc_id"]: r for r in rows}.values(), key=lambda r: r["doc_id"])
    unpack = zstandard.ZstdDecompressor().decompress
    bags = [(np.frombuffer(unpack(bytes(r["used"])), "<u4").astype(np.int32), np.frombuffer(unpack(bytes(r["weights"])), "<f2").astype(np.float32)) for r in rows]
    return fit(bags, np.array([r["toxic"] for r in rows], float))


def toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text; one pass, no shuffle.

    Only the text makes the score.  A null text counts as empty, and an empty one has the score of no evidence.  Repeated
    rows and null ids are scored each; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [own(texts[at : at + SOME]) for at in range(0, len(texts), SOME)]
            p = np.concatenate(found) if found else np.empty(0)
            yield pa.record_batch([batch.column(0), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = only(docs, "doc_id", text).selectExpr("doc_id", f"CAST(`{text}` AS STRING) AS text")
    out = rows.mapInArrow(score, f"doc_id {kind}, score double, predicted int")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")


def op11_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity(docs, train(docs, table(spark, folder, "labels")))

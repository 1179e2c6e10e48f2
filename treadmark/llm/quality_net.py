"""Quality classifier: a byte-level convolutional network in numpy.

Filters read eight bytes at every fourth byte.  Their outputs are max-pooled over chunks of 1,024 bytes, each overlapping
the next by half, so that chunks cover the whole document; the maxima of a document's chunks are combined by
their maximum and their mean, and one logistic unit makes a probability of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from treadmark.llm.common import fold, free, give_back, only, ship, table

WIDTH, STRIDE, FILTERS = 8, 4, 16
#: Bytes of half a chunk.
BLOCK = 512
#: Bytes whose outputs are in memory at a time.
SEGMENT = 1 << 18
#: The network learns from the whole texts of at most so many labelled documents of each class, those with the smallest hashes
#: of their ids, and of at most so many bytes; a document that would go beyond them is stepped over.
TRAIN_ROWS, TRAIN_BYTES = 1500, 12_000_000
#: Chunks whose outputs are in memory at a time when it learns.
LEARN = 512
EPOCHS, BATCH, RATE, DECAY = 14, 64, 0.01, 1e-4
#: Rejecting a good document costs so many times what keeping a bad one does.
GOOD_WEIGHT = 3.0
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3


@dataclass
class Net:
    """``taps[k, byte]`` is what a byte adds to the filters at place k; the zero byte pads and adds nothing."""

    taps: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float

    def outputs(self, data: np.ndarray) -> np.ndarray:
        """Filter outputs at every fourth byte of ``data``, which is WIDTH - STRIDE bytes longer than a multiple of it."""
        n = (len(data) - WIDTH + STRIDE) // STRIDE
        total = np.repeat(self.bias[None, :], n, axis=0)
        for k in range(WIDTH):
            total += np.take(self.taps[k], data[k : k + n * STRIDE : STRIDE], axis=0)
        return total

    def blocks(self, data: np.ndarray) -> np.ndarray:
        """Filter maxima of each block of padded bytes."""
        tail = np.zeros(WIDTH - STRIDE, np.uint8)
        found = []
        for at in range(0, len(data), SEGMENT):
            piece = data[at : at + SEGMENT + WIDTH - STRIDE]
            if at + SEGMENT >= len(data):
                piece = np.concatenate((piece, tail))
            found.append(self.outputs(piece).reshape(-1, BLOCK // STRIDE, FILTERS).max(axis=1))
        return np.concatenate(found)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """A probability for each text."""
        sizes = [max(1, -(-len(t) // BLOCK)) for t in texts]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        data = np.zeros(int(starts[-1]) * BLOCK, np.uint8)
        for t, at in zip(texts, starts, strict=False):
            data[at * BLOCK : at * BLOCK + len(t)] = np.frombuffer(t, np.uint8)
        # A block's last outputs also read the first bytes of the next block, which may be another document's.
        block = np.maximum(self._apart(data, starts), 0)
        chunk = block.copy()
        chunk[:-1] = np.maximum(block[:-1], block[1:])
        last = starts[1:] - 1
        chunk[last] = block[last]
        alone = np.array(sizes) == 1
        keep = np.ones(len(block), bool)
        keep[last[~alone]] = False  # of n > 1 blocks there are n - 1 chunks
        first = np.concatenate(([0], np.cumsum(np.where(alone, 1, np.array(sizes) - 1))))[:-1]
        chunk = chunk[keep]
        counts = np.diff(np.append(first, len(chunk)))
        top = np.maximum.reduceat(chunk, first, axis=0)
        mean = np.add.reduceat(chunk, first, axis=0) / counts[:, None]
        return 1 / (1 + np.exp(-np.clip(np.concatenate((top, mean), axis=1) @ self.out + self.shift, -40, 40)))

    def _apart(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """As ``blocks``, but no output reads across the end of a document."""
        block = self.blocks(data)
        ends = starts[1:-1]  # the block before each of these ended a document
        if len(ends):
            n = BLOCK // STRIDE
            for group in np.array_split(ends, -(-len(ends) // 256)):
                piece = np.zeros((len(group), BLOCK + WIDTH - STRIDE), np.uint8)
                piece[:, :BLOCK] = data.reshape(-1, BLOCK)[group - 1]
                at = np.arange(n) * STRIDE
                total = np.repeat(self.bias[None, :], len(group) * n, axis=0).reshape(len(group), n, FILTERS)
                for k in range(WIDTH):
                    total += self.taps[k][piece[:, at + k]]
                block[group - 1] = total.max(axis=1)
        return block


def untrained(prior: float = 0.5) -> Net:
    odds = np.log(prior / (1 - prior))
    return Net(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS), float(odds))


def _window(chunks: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A short stretch of a document as an example of its own: short texts are rare, and their maxima are low."""
    row = chunks[rng.integers(len(chunks))]
    full = max(1, int(np.count_nonzero(row)))
    n = int(rng.integers(20, 250))
    at = int(rng.integers(0, max(1, full - n)))
    out = np.zeros((1, len(row)), np.uint8)
    piece = row[at : min(at + n, full)]
    out[0, : len(piece)] = piece
    return out


def _highest(net: Net, padded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each chunk's highest output of every filter, and its place; chunks of a long text come piece by piece."""
    raw, place = np.empty((len(padded), FILTERS), np.float32), np.empty((len(padded), FILTERS), np.int64)
    for k in range(0, len(padded), LEARN):
        piece = padded[k : k + LEARN]
        total = np.zeros((len(piece), len(at), FILTERS), np.float32) + net.bias
        for j in range(WIDTH):
            total += net.taps[j][piece[:, at + j]]
        place[k : k + LEARN] = total.argmax(axis=1)
        raw[k : k + LEARN] = np.take_along_axis(total, place[k : k + LEARN, None, :], axis=1)[:, 0]
    return raw, place


def fit(chunks: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Net:
    """A network fitted by Adam on the chunks (rows of 2 * BLOCK bytes) of each document; the classes
    weigh GOOD_WEIGHT to one, however many rows each has."""
    good = float(np.mean(labels)) if len(labels) else 0.5
    if not len(labels) or good in (0.0, 1.0):
        return untrained(min(max(good, 0.05), 0.95))
    rng = np.random.default_rng(seed)
    chunks, labels = [*chunks, *(_window(c, rng) for c in chunks)], np.concatenate((labels, labels))
    net = untrained(0.5)
    net.taps += rng.normal(0, 0.3, net.taps.shape).astype(np.float32)
    net.taps[:, 0] = 0
    net.out = rng.normal(0, 0.1, 2 * FILTERS)
    weight = np.where(labels == 1, GOOD_WEIGHT / good, 1 / (1 - good)) / (1 + GOOD_WEIGHT)
    params = [net.taps, net.bias, net.out, np.zeros(1)]
    first, second, step = [np.zeros(p.shape) for p in params], [np.zeros(p.shape) for p in params], 0
    at = np.arange(0, 2 * BLOCK, STRIDE)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), BATCH):
            docs = order[k : k + BATCH]
            data = np.concatenate([chunks[d] for d in docs])
            n = np.array([len(chunks[d]) for d in docs])
            start = np.concatenate(([0], np.cumsum(n)))[:-1]
            padded = np.pad(data, ((0, 0), (0, WIDTH - STRIDE)))
            raw, place = _highest(net, padded, at)
            m = np.maximum(raw, 0)
            top = np.maximum.reduceat(m, start, axis=0)
            mean = np.add.reduceat(m, start, axis=0) / n[:, None]
            both = np.concatenate((top, mean), axis=1)
            p = 1 / (1 + np.exp(-np.clip(both @ net.out + params[3][0], -40, 40)))
            slope = (p - labels[docs]) * weight[docs] / len(docs)
            of = np.repeat(np.arange(len(docs)), n)
            back = slope[of, None] * (net.out[:FILTERS] * (m == top[of]) + net.out[FILTERS:] / n[of, None]) * (raw > 0)
            g_taps = np.zeros(net.taps.shape)
            row = np.arange(len(data))[:, None]
            lane = np.arange(FILTERS)[None, :]
            for j in range(WIDTH):
                np.add.at(g_taps[j], (padded[row, place * STRIDE + j], lane), back)
            g_taps[:, 0] = 0
            grads = [g_taps, back.sum(axis=0), both.T @ slope + DECAY * net.out, np.array([slope.sum()])]
            step += 1
            for value, g, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                value -= (RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(value.dtype)
    net.shift = float(params[3][0])
    return net


def chunks_of(text: bytes) -> np.ndarray:
    """All chunks of a text, the last padded with zeros."""
    n = max(1, -(-len(text) // BLOCK) - 1)
    data = np.frombuffer(text.ljust((n + 1) * BLOCK, b"\0"), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, 2 * BLOCK)[::BLOCK]


def within(sizes: list[int], limit: int) -> list[int]:
    """Places of those sizes that fit below the limit, one after the other; what does not fit is stepped over."""
    out = []
    for place, size in enumerate(sizes):
        if size <= limit:
            limit -= size
            out.append(place)
    return out


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> Net:
    """A network from a bounded sample of the labelled documents outside the held-out fold."""
    ship(docs.sparkSession)
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    of = lambda q: known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    some = of(0).union(of(1)).withColumnRenamed("doc_id", "of")
    whole = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    picked = only(docs, "doc_id", text).join(F.broadcast(some), F.col("doc_id") == F.col("of")).select("of", whole.alias("text"), "quality")
    one = picked.groupBy("of").agg(F.min("text").alias("text"), F.max("quality").alias("quality"))  # repeated rows count once
    order = Window.partitionBy("quality").orderBy(F.xxhash64("of"), "of")  # at most TRAIN_ROWS rows each
    sizes = one.select("of", "quality", F.octet_length("text").alias("size"), F.row_number().over(order).alias("place"))
    ranked = sorted(sizes.collect(), key=lambda r: r["place"])
    chosen = [group[k]["of"] for q in (0, 1) for group in [[r for r in ranked if r["quality"] == q]] for k in within([r["size"] for r in group], TRAIN_BYTES)]
    rows = picked.filter(F.col("of").isin(chosen)).groupBy("of").agg(F.min("text").alias("text"), F.max("quality").alias("quality")).collect()
    rows = sorted(rows, key=lambda r: r["of"])  # bounded by TRAIN_ROWS and TRAIN_BYTES
    net = fit([chunks_of(bytes(r["text"])) for r in rows], np.array([r["quality"] for r in rows], float))
    del rows, ranked
    free(docs.sparkSession)
    give_back()
    return net


def quality_scores(docs: DataFrame, net: Net, text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text; one pass, no shuffle.

    Only the text's bytes make the score.  A null text counts as empty, and an empty one has the score of a chunk
    without bytes.  Repeated rows and null ids are scored each; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            found = [own.scores(texts[i : i + 64]) for i in range(0, len(texts), 64)]
            p = np.concatenate(found) if found else np.empty(0)
            columns = [batch.column(0), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]
            yield pa.record_batch(columns, names=["doc_id", "score", "predicted"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = only(docs, "doc_id", text).selectExpr("doc_id", f"CAST(`{text}` AS STRING) AS text")
    out = rows.mapInArrow(score, f"doc_id {kind}, score double, predicted int")
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")


def kept(docs: DataFrame, net: Net, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the network does not reject, with all their columns; one pass, no shuffle."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(place).to_pylist()]
            for i in range(0, len(texts), 64):
                good = own.scores(texts[i : i + 64]) >= THRESHOLD
                yield batch.slice(i, 64).filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def op9_quality_net(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_scores(docs, train(docs, table(spark, folder, "labels")))

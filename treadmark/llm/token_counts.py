"""Token counts: greedy word pieces by a linear longest-match automaton.

The vocabulary's trie gets a failure link at every node, and with it the number of pieces that are finished when the
link is followed.  A word is then read once, character by character, and only that number is added up: no piece is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from treadmark.llm.common import SPACES, fresh, only, ship, table
from treadmark.llm.pieces import MODEL, NORMAL, SPACE, read_pieces

#: Words whose count a worker remembers; the memory is emptied when full.
MEMORY = 300_000


class PieceCounter:
    """Counts of greedy longest-match pieces of single words.

    ``first`` are the pieces that can begin a word, ``rest`` those that can continue one.  A word that cannot be cut
    into pieces counts as one unknown piece.
    """

    def __init__(self, first: list[str], rest: list[str]):
        # Node 0 is where a word begins, node 1 where a piece has ended inside a word.
        self.step: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                at = root
                for c in piece:
                    if c not in self.step[at]:
                        self.step[at][c] = len(self.step)
                        self.step.append({})
                        ends.append(False)
                    at = self.step[at][c]
                ends[at] = ends[at] or at > 1
        n = len(self.step)
        self.fail: list[int] = [-1] * n
        self.popped = [0] * n
        queue = [0, 1]
        for at in queue:  # breadth first: a parent's link is known before its children's
            for c, child in self.step[at].items():
                if ends[child]:
                    self.fail[child], self.popped[child] = 1, 1
                else:
                    z, count = self.fail[at], self.popped[at]
                    while z >= 0 and c not in self.step[z]:
                        count += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[child], self.popped[child] = self.step[z][c], count
                queue.append(child)
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        step, fail, popped = self.step, self.fail, self.popped
        at = total = 0
        for c in word:
            while (to := step[at].get(c, -1)) < 0:
                if fail[at] < 0:
                    return 1
                total += popped[at]
                at = fail[at]
            at = to
        while at != 1:
            if fail[at] < 0:
                return 1 if word else 0
            total += popped[at]
            at = fail[at]
        return total

    def __call__(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[word] = self.count(word)
        return found


def vocabulary(path: str = MODEL) -> tuple[list[str], list[str]]:
    """Beginning and continuing pieces of a SentencePiece file: the space sign marks a word's begin."""
    pieces = read_pieces(path)
    normal = [t for t, k in zip(pieces.text, pieces.kind, strict=True) if k == NORMAL and SPACE not in t[1:]]
    return [t for t in normal if t.startswith(SPACE)], [t for t in normal if not t.startswith(SPACE)]


_COUNTERS: dict[str, PieceCounter] = {}


def _counter(key: str, shared: Broadcast) -> PieceCounter:
    """The worker's counter for one call; tasks of the same call share it."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PieceCounter(*shared.value)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, path: str = MODEL, text: str = "text") -> DataFrame:
    """doc_id, n_words and n_tokens (both long) of every whole text; one pass, no shuffle.

    Words are runs of anything but ASCII white space, and each is read with the space sign before it.  A null
    or empty text has no words and no tokens.  Repeated rows and null ids are counted each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(path))  # bounded: the vocabulary of one file
    ship(docs.sparkSession)
    key, table_ = fresh(path), bytes.maketrans(SPACES, b" " * len(SPACES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(key, shared)
        for batch in batches:
            n_words, n_tokens = [], []
            for value in batch.column(1).to_pylist():
                words = (value or "").encode().translate(table_).decode().split(" ")
                words = [SPACE + w for w in words if w]
                n_words.append(len(words))
                n_tokens.append(sum(map(counter, words)))
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = only(docs, "doc_id", text).selectExpr("doc_id", f"CAST(`{text}` AS STRING) AS text")
    return rows.mapInArrow(count, f"doc_id {kind}, n_words bigint, n_tokens bigint")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"))

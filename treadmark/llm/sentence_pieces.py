"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from treadmark.llm.common import fresh, only, ship, table
from treadmark.llm.pieces import BYTE, MODEL, NORMAL, SPACE, Pieces, read_pieces

#: Stretches whose pieces a worker remembers; the memory is emptied when full.
MEMORY = 200_000
#: What one unknown character costs below the lowest score of a piece.
UNKNOWN_PENALTY = 10.0


class PieceCoder:
    """Best-scoring pieces of whole texts, and texts from pieces.

    The score of a cut is the sum of its pieces' scores.  At each position the automaton's output links give all
    pieces that end there, longest first, and each relaxes the best score of that position; on equal scores the longer
    last piece stays.  A character that no piece covers becomes the pieces of its bytes, or the unknown piece.

    No piece holds the space sign behind another character, so a best path has a cut before each space sign that
    follows something else, and around each character that no piece holds.  Texts are taken apart at these places
    first: the best path of the whole is the best paths of the stretches in a row.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        normal = [i for i, k in enumerate(pieces.kind) if k == NORMAL]
        self.lowest = min(pieces.score[i] for i in normal) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(pieces.text[i], (len(pieces.text[i]), pieces.score[i], i))
        self.automaton.make_automaton()
        by_byte = {int(pieces.text[i][3:5], 16): i for i, k in enumerate(pieces.kind) if k == BYTE}
        self.by_byte = [by_byte[b] for b in range(256)] if len(by_byte) == 256 else None
        self.single = {pieces.text[i] for i in normal if len(pieces.text[i]) == 1}
        letters = set().union(*(pieces.text[i] for i in normal))
        self.whole = any(SPACE in pieces.text[i].lstrip(SPACE) for i in normal)  # then texts cannot be taken apart
        alone = "\n" if "\n" not in letters else ""
        self.stretch = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|{alone or '(?!)'}", re.DOTALL)
        self.known: dict[str, bytes] = {}
        texts = [b""] * len(pieces.text)
        for i, (t, k) in enumerate(zip(pieces.text, pieces.kind, strict=True)):
            if k == NORMAL:
                texts[i] = t.replace(SPACE, " ").encode()
            elif k == BYTE:
                texts[i] = bytes([int(t[3:5], 16)])
        self.bytes_of = texts

    def best(self, s: str) -> list[int]:
        """The pieces of the best path through a stretch."""
        n = len(s)
        score = [0.0] + [-np.inf] * n
        last: list[tuple[int, int]] = [(0, -1)] * (n + 1)  # length and id of the last piece; id -1: an unknown character
        hits = self.automaton.iter(s)
        end, found = next(hits, (n, None))
        for i, c in enumerate(s):
            to, top, how = i + 1, -np.inf, (1, -1)
            while end == i:
                length, value, piece = found
                if (x := score[to - length] + value) > top:
                    top, how = x, (length, piece)
                end, found = next(hits, (n, None))
            if c not in self.single and (x := score[i] + self.lowest) > top:
                top, how = x, (1, -1)
            score[to], last[to] = top, how
        out: list[int] = []
        while n:
            length, piece = last[n]
            if piece >= 0:
                out.append(piece)
            elif self.by_byte:
                out.extend(self.by_byte[b] for b in reversed(s[n - 1].encode()))
            else:
                out.append(self.pieces.unknown)
            n -= length
        return out[::-1]

    def _coded(self, s: str) -> bytes:
        found = self.known.get(s)
        if found is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = np.array(self.best(s), np.int32).tobytes()
            if len(s) <= 64:
                self.known[s] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        s = ((" " if self.pieces.dummy_prefix else "") + text).replace(" ", SPACE)
        parts = [s] if self.whole else self.stretch.findall(s)
        return np.frombuffer(b"".join(map(self._coded, parts)), np.int32)

    def decode(self, ids: list[int]) -> str:
        of = self.bytes_of
        text = b"".join([of[i] for i in ids]).decode(errors="replace")
        return text[1:] if self.pieces.dummy_prefix and text.startswith(" ") else text


_CODERS: dict[str, PieceCoder] = {}


def _coder(key: str, shared: Broadcast) -> PieceCoder:
    """The worker's coder for one call; tasks of the same call share it."""
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = PieceCoder(shared.value)
    return _CODERS[key]


def encoded(docs: DataFrame, path: str = MODEL, text: str = "text") -> DataFrame:
    """doc_id, ids (array of int), n_pieces (long) and round_trip of every whole text; one pass, no shuffle.

    ``round_trip`` says whether decoding gives the text again: it does, unless the text holds the space sign itself or,
    without byte pieces, a character that no piece covers.  A null or empty text has no pieces.  Repeated rows
    and null ids are coded each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_pieces(path))  # bounded: the vocabulary of one file

    ship(docs.sparkSession)
    key = fresh(path)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared)
        for batch in batches:
            # few rows at a time: a batch of very long texts would be large in memory
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [coder.encode(t) for t in texts]
                same = [coder.decode(i.tolist()) == t for i, t in zip(ids, texts, strict=True)]
                sizes = np.array([len(i) for i in ids], np.int64)
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                columns = [part.column(0), pa.ListArray.from_arrays(offsets, flat), pa.array(sizes), pa.array(same)]
                yield pa.record_batch(columns, names=["doc_id", "ids", "n_pieces", "round_trip"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = only(docs, "doc_id", text).selectExpr("doc_id", f"CAST(`{text}` AS STRING) AS text")
    return rows.mapInArrow(code, f"doc_id {kind}, ids array<int>, n_pieces bigint, round_trip boolean")


def decoded(coded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and text from the ids of ``encoded``; null ids give a null text."""
    shared = coded.sparkSession.sparkContext.broadcast(read_pieces(path))

    ship(coded.sparkSession)
    key = fresh(path)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared)
        for batch in batches:
            texts = [None if i is None else coder.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = dict(coded.dtypes)["doc_id"]
    return only(coded, "doc_id", "ids").mapInArrow(back, f"doc_id {kind}, text string")


def op5_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"))

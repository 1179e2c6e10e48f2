"""The prefix trie against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from treadmark.llm import prefix_trie
from treadmark.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, c long, depth long, last long, ends string"


def trie(rows):
    """The nodes as the operator returns them, with prefixes as tuples of their turns."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(ts, key=lambda t: t[:4])] for c, ts in own.items()}
    root = {"members": [], "ends": [], "kids": {}, "size": 0}
    for c in turns:
        h, family = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        at = root
        at["members"].append(c)
        for turn in turns.get(family, [])[:h] + turns[c][h:]:
            at = at["kids"].setdefault(turn, {"members": [], "ends": [], "kids": {}, "size": len(turn[1])})
            at["members"].append(c)
        at["ends"].append(c)
    order, stack = [], [(root, 0, None)] if turns else []
    while stack:
        node, depth, parent = stack.pop()
        order.append((node, depth, parent))
        stack.extend((kid, depth + 1, min(node["members"])) for kid in node["kids"].values())
    out = []
    for node, depth, parent in reversed(order):
        node["leaves"] = sum(k["leaves"] for k in node["kids"].values()) or 1
        node["saved"] = (len(node["members"]) - 1) * node["size"] + sum(k["saved"] for k in node["kids"].values())
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        out.append((min(node["members"]), depth, parent, len(node["members"]), len(node["kids"]), node["leaves"], node["saved"], ends))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)


def some_rows(seed):
    """Few texts, so that conversations share beginnings; nulls in every column, ties, repeated rows, ids below zero."""
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    rows = []
    for c in [*rng.sample(range(-250, 450), 120), 10**15, None]:
        for k in range(rng.randrange(1, 9)):
            rows.append((c, pick(k, k, k, k, 2, None), pick("user", "assistant", None), pick("", None, "a", "bb", "é🎉", "ccc ccc")))
    return rows + rows[:20]


@pytest.mark.parametrize("seed", range(3))
def test_nodes_like_a_walk(spark, seed):
    rows = some_rows(seed)
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == trie(rows)


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    rows = some_rows(7)
    monkeypatch.setattr(prefix_trie, "cells_for", lambda n: 64)
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == trie(rows)


def test_what_is_proven_alone_is_alone(spark):
    rows = [(i, 10 * i % 977, i * i) for i in range(4000)] + [(i, 10 * i % 977, i * i) for i in range(0, 4000, 3)]
    df = spark.createDataFrame(rows, "depth long, p1 long, p2 long")
    for cells in (1 << 10, 1 << 15):
        got = prefix_trie.alone(df, cells).groupBy("depth").agg(F.count("*").alias("n"), F.max("alone").alias("alone")).collect()
        assert all(r["n"] == 1 for r in got if r["alone"])
    assert sum(r["alone"] for r in got) > 2000


def test_long_and_common_conversations(spark, monkeypatch):
    """A conversation over several blocks, its copy, one that leaves it late, and a node at which very many end."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    monkeypatch.setattr(prefix_trie, "IDS", 16)
    long = [(i, "user", f"turn {i % 50}") for i in range(300)]
    rows = [(100, *t) for t in long] + [(200, *t) for t in long] + [(300, *t) for t in long[:250]] + [(300, 250, "user", "other")] + [(300, 251 + i, "user", f"{i}") for i in range(200)]
    rows += [(1000 + 100 * i, 0, "user", "hello") for i in range(150)] + [(1000 + 100 * i, 1, "user", f"{i % 5}") for i in range(0, 150, 3)]
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == trie(rows)


def test_none_one_and_turnless(spark):
    assert prefix_trie.prefix_trie(frame(spark, [(None, 0, "user", "x")])).count() == 0
    assert found(prefix_trie.prefix_trie(frame(spark, [(None, 0, "user", "x")]).limit(0))) == []
    turnless = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0)
    for rows in ([(0, 0, "user", "x")], [(turnless, 0, "user", "x")], [(0, 0, "u", "x"), (turnless, 0, "user", "x"), (700, 0, None, None)]):
        assert found(prefix_trie.prefix_trie(frame(spark, rows))) == trie(rows)


def test_very_long_texts_are_whole(spark):
    a, b = "x" * 300_000 + "a", "x" * 300_000 + "b"
    rows = [(100 * i, 0, "user", t) for i, t in enumerate((a, a, b, "y"))]
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == trie(rows)


def test_sql_says_the_same(spark, small):
    rows = some_rows(11)
    con = duckdb.connect()
    con.register("conversations", frame(spark, rows).toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    cursor = con.execute(prefix_trie.ORACLE)
    names = [d[0] for d in cursor.description]
    got = sorted((tuple(r) for r in cursor.fetchall()), key=repr)
    assert names == prefix_trie.prefix_trie(table(spark, small, "conversations")).columns
    assert got == trie(rows)

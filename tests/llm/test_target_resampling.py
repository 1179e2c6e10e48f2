"""Importance resampling against plain Python, and its SQL on awkward tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from plain_readings import LONG, awkward

from treadmark.llm import target_resampling as tr
from treadmark.llm.common import LOWER, UPPER, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest):
    words = WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))
    return len(words), [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def plain(docs, target, longest, buckets, percent=10, least=20):
    """The rows as the operator returns them; repeated rows in any order."""
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    found = [(i, *grams(t, longest)) for i, t in docs]
    s = collections.Counter(bucket(g) for _, _, f in found for g in f)
    t = collections.Counter(bucket(g) for x in target for g in grams(x, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(g)) for g in f)
        rows.append((n, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    cut = percent * len(able) // 100
    out = [(*r[1:], k + 1 if k < cut else None) for k, r in enumerate(able)] + [(*r[1:], None) for r in rows if r[0] < least]
    return collections.Counter(out)


def test_a_head_changes_no_bucket():
    words = [w.encode() for w in "the cat and the dog and the cat é漢 x".split()]
    heads = [tr.Head(977), tr.Head.of([b"the", b"cat"], buckets=977), tr.Head.of(set(words), [(b"the", b"cat"), (b"and", b"the")], 977)]
    for longest in (1, 2, 3, 4):
        want = [zlib.crc32(b" ".join(words[k : k + n])) % 977 for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
        for head in heads:
            assert head.features(words, longest).tolist() == want
            assert head.features([], longest).tolist() == [] and len(head.features(words[:1], longest)) == 1


def test_words_are_those_of_the_pattern():
    text = "".join(map(chr, range(1, 600))) + " Ünï_cødé-x 漢字🎉9a\x00b " + LONG[:2000]
    assert [w.decode() for w in tr.words_of(text.encode())] == WORD.findall(text.translate(str.maketrans(UPPER, LOWER)))


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (2, 500), (3, 70_000)])
def test_rows_like_plain_python(spark, small, longest, buckets):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, small, "documents").collect()]
    docs += [(r["doc_id"], r["text"]) for r in awkward(spark).collect()] + [(None, "many words " * 15), (None, "many words " * 15), (77, docs[3][1])]
    target = [r["text"] for r in table(spark, small, "benchmark").collect()] + [None, ""]
    df = spark.createDataFrame([(i, t, 1, 2, b"x", 3) for i, t in docs], "doc_id long, text string, score long, rank long, buckets binary, row long")
    goal = spark.createDataFrame([(t, 5) for t in target], "text string, doc_id long")
    got = collections.Counter(map(tuple, tr.resampled(df, goal, longest, buckets).collect()))
    assert got == plain(docs, target, longest, buckets)


def test_head_is_bounded_and_frequent(spark):
    rows = [("the " * 50 + f"rare{i}",) for i in range(200)] + [("z" * 500 + " ",)] * 50
    df = spark.createDataFrame(rows, "text string").selectExpr("CAST(text AS BINARY) AS text")
    head = tr.vocabulary_head([df], 2)
    assert b"the" in head.states and (b"the", b"the") in head.pairs and not any(len(w) > tr.HEAD_BYTES for w in head.states)
    old, tr.HEAD = tr.HEAD, 100
    try:
        assert set(tr.vocabulary_head([df], 2).states) == {b"the"}
    finally:
        tr.HEAD = old


def test_empty_tables(spark, small):
    docs, goal = table(spark, small, "documents"), table(spark, small, "benchmark")
    assert tr.resampled(docs.limit(0), goal).count() == 0
    assert tr.resampled(docs, goal.limit(0)).count() == docs.count()
    assert (tr.gains(np.zeros(5, np.int64), np.zeros(5, np.int64)) == 0).all()


def test_sql_says_the_same(spark, small):
    docs = awkward(spark).select("doc_id", "text").union(table(spark, small, "documents").select("doc_id", "text"))
    goal = table(spark, small, "benchmark")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", goal.toPandas())
    cursor = con.execute(tr.ORACLE)
    found = tr.resampled(docs, goal)
    assert [d[0] for d in cursor.description] == found.columns
    assert collections.Counter(cursor.fetchall()) == collections.Counter(map(tuple, found.collect()))

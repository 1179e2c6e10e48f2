import random

import pytest
from pyspark.sql import functions as F

from treadmark.operators import asof, compare, counts, lookup, position, reshape, topk, upsert


@pytest.mark.parametrize("n", [1, 37, 100, 250])
def test_ntile_is_the_sql_one(spark, n):
    rows = [(i % 7, i) for i in range(n)]
    random.Random(n).shuffle(rows)
    df = spark.createDataFrame(rows, "score int, id int").repartition(5)
    got = {r.id: r.tile for r in position.ntile(df, 100, [F.desc("score"), F.asc("id")], "tile").collect()}
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    small, wide = divmod(n, 100)
    expect, at = {}, 0
    for tile in range(1, 101):
        for _ in range(small + (tile <= wide)):
            expect[order[at][1]] = tile
            at += 1
    assert got == expect


def test_positions_split_a_hot_key(spark):
    """A third of all rows share the first sort key and still spread over partitions."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id").repartition(6)
    out = position.with_position(df, [F.asc("k"), F.asc("id")], "pos", "n")
    rows = out.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 9001)) and rows[0].n == 9000
    assert [(r.k, r.id) for r in rows] == sorted((r.k, r.id) for r in rows)


def test_running_rank_with_null_key(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 5), (None, 2), ("b", 9)], "k string, v int")
    got = {(r.k, r.v): r["rank"] for r in topk.running_rank(df, ["k"], [F.asc("v")], "rank").collect()}
    assert got == {("a", 1): 1, ("a", 3): 2, (None, 2): 1, (None, 5): 2, ("b", 9): 1}


@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_asof_against_pairs(spark, bucket):
    rng = random.Random(bucket)
    views = [(rng.choice("ab"), rng.choice("xy"), rng.randint(0, 60)) for _ in range(60)]
    views = [(u, s if rng.random() > 0.1 else None, t) for u, s, t in views]
    buys = [(rng.choice("abc"), rng.choice("xy"), rng.randint(0, 60), i) for i in range(80)]
    left = spark.createDataFrame(buys, "u string, s string, t long, id int")
    right = spark.createDataFrame(views, "u string, s string, seen long")
    got = {r.id: r.seen for r in asof.last_before(left, right, ["u", "s"], "t", "seen", bucket).collect()}
    expect = {}
    for u, s, t, i in buys:
        times = [vt for vu, vs, vt in views if (vu, vs) == (u, s) and vt <= t]
        if times:
            expect[i] = max(times)
    assert got == expect


def test_merge_cases(spark):
    target = spark.createDataFrame(
        [("a", "1", "x", 5), ("b", "1", "x", 5), ("c", "1", "x", 5), ("d", "1", "x", None), ("keep", "1", "x", 1)],
        "k string, v string, w string, t long",
    )
    staged = spark.createDataFrame(
        [("A", "2", "-", 6), ("B", "2", None, 5), ("C", "2", "y", 4), ("D", "2", "y", 9), ("NEW", "2", "-", None), (None, "2", "y", 1)],
        "k string, v string, w string, t long",
    )
    keys = {"k": (F.upper(target["k"]), staged["k"])}
    got = {r.k: (r.v, r.w, r.t) for r in upsert.merge_newer(target, staged, keys, ["k"], ["v", "w"], [], "t", "-").collect()}
    assert got == {
        "A": ("2", "x", 6), "B": ("2", "x", 5), "c": ("1", "x", 5), "d": ("1", "x", None), "keep": ("1", "x", 1),
        "NEW": ("2", None, None), None: ("2", "y", 1),
    }


def test_longest_prefix(spark):
    names = spark.createDataFrame([("ALFA ROMEO GIULIA",), ("ALFA 4",), ("ZIL",), ("",)], "n string")
    makes = spark.createDataFrame([("ALFA",), ("ALFA ROMEO",), ("Z",)], "m string")
    got = {r.n: r.m for r in lookup.longest_prefix(names, "n", makes, "m").collect()}
    assert got == {"ALFA ROMEO GIULIA": "ALFA ROMEO", "ALFA 4": "ALFA", "ZIL": "Z"}


def test_scoped_requests(spark):
    requests = spark.createDataFrame([("s1", "v1"), ("s1", "v9"), ("s2", "v1"), ("s3", "v1")], "s string, v string")
    main = spark.createDataFrame([("s1", "v1")] * 3, "s string, v string")
    other = spark.createDataFrame([("s2", "v1"), ("s1", "v9")], "s string, v string")
    out = lookup.scoped_requests(requests, [main, other], ["s", "v"], ["s"]).collect()
    assert {(r.s, r.v): (r._source, r._level) for r in out} == {
        ("s1", "v1"): (0, "narrow"), ("s1", "v9"): (0, "wide"), ("s2", "v1"): (1, "narrow"), ("s3", "v1"): (None, None),
    }


def test_distinct_count_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, p int")
    windowed = {(r.k, r.p): r.n for r in counts.with_distinct_count(df, ["k"], "p", "n", True).collect()}
    assert windowed == {("a", 1): 2, ("a", 2): 2, (None, 3): 2, (None, 4): 2}
    joined = {(r.k, r.p): r.n for r in counts.with_distinct_count(df, ["k"], "p", "n", False).collect()}
    assert joined == {("a", 1): 2, ("a", 2): 2, (None, 3): None, (None, 4): None}


def test_unpivot_drops_nulls_and_keeps_positions(spark):
    df = spark.createDataFrame([("r", 7, None, 9)], "k string, a long, b long, c long")
    out = reshape.unpivot(df, ["k"], [F.col("a"), F.col("b"), F.col("c")], "pos", "v").collect()
    assert [(r.pos, r.v) for r in out] == [(1, 7), (3, 9)]


def test_compare(spark):
    a = spark.createDataFrame([(1, "x", "t1"), (1, "x", "t1"), (2, "y", "t1")], "i int, c string, ts string")
    b = spark.createDataFrame([(1, "x", "t2"), (3, "y", "t2")], "i int, c string, ts string")
    got = sorted((r.i, r.side) for r in compare.row_drift(a, b, ["ts"]).collect())
    assert got == [(1, "golden"), (2, "golden"), (3, "current")]
    assert compare.schema_drift(a, b.drop("ts")) == {"missing": ["ts"], "new": []}
    with pytest.raises(ValueError, match="zz"):
        compare.require_columns(a, ["i", "zz"])

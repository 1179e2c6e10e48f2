"""Tables replaced in one step, cell drift, checked loads and times across a clock change."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from treadmark.operators.compare import cell_drift
from treadmark.sources import events, files, versions

DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]


@pytest.fixture
def table(spark, tmp_path):
    t = versions.DayTable(spark, str(tmp_path / "t"), (("v", "string"),), "Date")
    t.replace(rows(spark, *((d, "old") for d in DAYS)), DAYS[0], DAYS[-1])
    return t


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "Date date, v string")


def held(table, version=None):
    return sorted((r.Date, r.v) for r in table.read(version).collect())


OLD = [(d, "old") for d in DAYS]
NEW = [(DAYS[0], "old"), (DAYS[1], "new"), (DAYS[3], "old"), (DAYS[4], "old")]


def test_window_is_replaced_in_one_step(spark, table):
    base = table.current()
    load = table.stage(rows(spark, (DAYS[1], "new"), (DAYS[4], "outside")), DAYS[1], DAYS[2])
    assert held(table) == OLD  # a run that dies here has changed nothing
    now = table.commit(base, load, DAYS[1], DAYS[2])
    assert held(table) == NEW and now.number == 2  # the silent day went with the others
    assert held(table, base) == OLD  # who still reads the old version reads it whole


@pytest.mark.parametrize("step", ["write", "create", "rename"])
def test_a_run_that_dies_leaves_old_or_new(spark, table, monkeypatch, step):
    class Dead(Exception):
        pass

    def dies(*_):
        raise Dead

    if step == "write":
        monkeypatch.setattr(table, "_names", dies)
        with pytest.raises(Dead):
            table.replace(rows(spark, (DAYS[1], "new")), DAYS[1], DAYS[2])
        monkeypatch.undo()
    else:
        real = table._fs

        class Broken:
            def __getattr__(self, name):
                return dies if name == step else getattr(real, name)

        monkeypatch.setattr(table, "_fs", Broken())
        with pytest.raises(Dead):
            table.replace(rows(spark, (DAYS[1], "new")), DAYS[1], DAYS[2])
        monkeypatch.undo()
    again = versions.DayTable(spark, table.path, table.fields, "Date")
    assert held(again) == OLD
    again.replace(rows(spark, (DAYS[1], "new")), DAYS[1], DAYS[2])
    assert held(again) == NEW
    assert again.sweep() >= (step != "write") and held(again) == NEW


def test_the_second_of_two_writers_is_refused(spark, table):
    base = table.current()
    mine, theirs = (table.stage(rows(spark, (DAYS[0], v)), DAYS[0], DAYS[0]) for v in ("mine", "theirs"))
    table.commit(base, theirs, DAYS[0], DAYS[0])
    with pytest.raises(versions.StaleVersion):
        table.commit(base, mine, DAYS[0], DAYS[0])
    assert held(table)[0] == (DAYS[0], "theirs")


def test_replacing_from_itself_and_pruning(spark, table):
    table.replace(table.read().withColumn("v", F.concat("v", F.lit("!"))), DAYS[0], DAYS[1])
    assert [v for _, v in held(table)] == ["old!", "old!", "old", "old", "old"]
    plan = table.read().where(F.col("Date") == F.lit(DAYS[0]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Date" in plan
    empty = versions.DayTable(spark, table.path + "-none", table.fields, "Date")
    assert empty.read().count() == 0 and empty.current().number == 0
    empty.replace(rows(spark, (DAYS[0], "x")).limit(0), DAYS[0], DAYS[4])
    assert empty.read().count() == 0 and empty.current().number == 1


def test_cells_by_key(spark):
    a = spark.createDataFrame([(1, "x", 1.0, "t1"), (2, "y", None, "t1"), (3, "z", 3.0, "t1"), (None, "n", 1.0, "t1"), (5, "r", 1.0, "t1"), (5, "r", 2.0, "t1")], "k int, s string, d double, ts string")
    b = spark.createDataFrame([(1, "x", 1.0, "t2", 0), (2, None, 5.0, "t2", 0), (4, "w", None, "t2", 0), (None, "m", 1.0, "t2", 0), (5, "r", 1.0, "t2", 0), (5, "q", 2.0, "t2", 0)], "k int, s string, d double, ts string, e int")
    found = {(r.k, r.kind): {c: (v.old, v.new) for c, v in r.cells.items()} for r in cell_drift(a, b, ["k"], ["ts"]).collect()}
    assert found == {
        (2, "changed"): {"s": ("y", None), "d": (None, "5.0")}, (3, "missing"): {"s": ("z", None), "d": ("3.0", None)}, (4, "new"): {"s": (None, "w")},
        (None, "changed"): {"s": ("n", "m")}, (5, "changed"): {"s": ("r", "q")}, (None, "schema"): {"e": (None, "present")},
    }
    assert cell_drift(a, a, ["k"]).count() == 0 and cell_drift(a.limit(0), a.limit(0), ["k"]).count() == 0


def test_checked_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Name,N,At\nx,1,2024-01-31 08:00:00\n"y, z",,\nw,two,2024-01-31\nv,3,never\nu,4\nt,5,2024-02-01,more\n')
    (tmp_path / "b.csv").write_text("Name,M,At\nx,1,2024-01-31\n")
    (tmp_path / "c.csv").write_text("Name,N,At,Z\nx,1,2024-01-31,0\n")
    (tmp_path / "d.csv").write_text("")
    fields = (("Name", "string"), ("N", "int"), ("At", "timestamp_ntz"))
    good, bad = files.load_checked(spark, str(tmp_path), fields)
    assert good.dtypes == [("Name", "string"), ("N", "int"), ("At", "timestamp_ntz")]
    assert sorted(map(tuple, good.collect()), key=str) == [("x", 1, dt.datetime(2024, 1, 31, 8)), ("y, z", None, None)]
    found = sorted((os.path.basename(r.file), r.line_no, r.reason) for r in bad.collect())
    assert found == [("a.csv", 4, "N is no int"), ("a.csv", 5, "At is no timestamp_ntz"), ("a.csv", 6, "number of fields"), ("a.csv", 7, "number of fields"), ("b.csv", 2, "header"), ("c.csv", 2, "header")]


def test_line_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "big.csv").write_text("Name,N\n" + "".join(f"n{i},{'x' if i % 1000 == 7 else i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        good, bad = files.load_checked(spark, str(tmp_path), (("Name", "string"), ("N", "int")))
        assert good.count() == 19_980 and sorted(r.line_no for r in bad.collect()) == [i + 2 for i in range(20_000) if i % 1000 == 7]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_london_clocks(spark):
    utc = [dt.datetime(2024, 3, 30, 23, 59, 59, 999999), dt.datetime(2024, 3, 31, 0, 59, 59), dt.datetime(2024, 3, 31, 1, 0), dt.datetime(2024, 3, 31, 23, 0), dt.datetime(2024, 10, 27, 0, 59), dt.datetime(2024, 10, 27, 1, 0)]
    micros = [int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) for t in utc]
    df = spark.createDataFrame([(m,) for m in micros], "m long")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            there = events.local_time(events.utc_time(F.col("m")), "Europe/London")
            got = df.select(events.utc_time(F.col("m")).alias("u"), there.alias("t"), F.to_date(there).alias("d"), events.day_length(F.to_date(there), "Europe/London").alias("h")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [r.u for r in got] == utc
        assert [r.t.hour for r in got] == [23, 0, 2, 0, 1, 1] and [r.h for r in got] == [24, 23, 23, 24, 25, 25]
        assert got[3].d == dt.date(2024, 4, 1)  # 23:00 in UTC is the next day in London

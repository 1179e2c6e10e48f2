import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from treadmark import schemas
from treadmark.plans import audit, cam_merge
from treadmark.sources import files, tables


def test_csv_by_suffix_headers_and_bad_lines(spark, tmp_path):
    (tmp_path / "day").mkdir()
    good = "10000001,VW,Golf,205,55,16,3,9,80.5\n"
    (tmp_path / "day" / "x-CarMakeModelSales.csv").write_text(good + "10000002,VW\n")
    (tmp_path / "other.csv").write_text("junk\n")
    df = files.read_csv(spark, str(tmp_path), schemas.SALES, header=False, suffix="CarMakeModelSales.csv", audit=True)
    rows = {r.ProductId: r for r in df.collect()}
    assert rows["10000001"]._corrupt_record is None and rows["10000002"]._corrupt_record == "10000002,VW"
    assert files.read_csv_or_none(spark, str(tmp_path), schemas.SALES, False, "TyreScore.csv") is None
    typed = files.typed_sales(df).where("ProductId = '10000001'").first()
    assert (typed.Vehicle, typed.Orders, typed.Units, typed.AvgPrice) == ("VWGOLF", 3, 9, 80.5)
    assert files.clean_header(" Wet Grip.x-y ") == "Wet_Grip_x_y"


def test_file_order_follows_the_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Vehicle,Size,Rank\n" + "".join(f"v{i},205/55 R16,{100 - i}\n" for i in range(50)) + "nan,x,1\n,y,2\n")
    raw = files.with_file_order(spark.read.option("header", True).schema("Vehicle string, Size string, Rank string").csv(str(tmp_path / "r.csv")))
    usable = files.runlist(raw)
    # the blank cell is read as NULL and, like in the run list rules, kept
    assert usable.count() == 51
    assert [r.Vehicle for r in audit.run_list_head(usable, 3, position=files.FILE_ORDER).collect()] == ["v0", "v1", "v2"]
    assert [r.PriorityRank for r in audit.run_list_head(usable, 2, by_rank=True, position=files.FILE_ORDER).collect()] == ["2", "51"]
    with pytest.raises(ValueError):
        files.runlist(spark.createDataFrame([("a",)], "Vehicle string"))


def test_manifest(spark, tmp_path):
    (tmp_path / "a.sql").write_bytes(b"SELECT 1")
    row = files.manifest(spark, str(tmp_path), "*.sql").first()
    assert (row.file, row.size, row.sha256) == ("a.sql", 8, hashlib.sha256(b"SELECT 1").hexdigest())


def test_window_replace_removes_silent_days(spark, tmp_path):
    path = str(tmp_path / "t")
    day = [dt.date(2024, 1, d) for d in range(1, 6)]
    tables.replace_table(spark.createDataFrame([(d, "old") for d in day], "Date date, v string"), path, ["Date"])
    new = spark.createDataFrame([(day[1], "new"), (day[4], "outside")], "Date date, v string")
    tables.replace_window(new, path, "Date", day[1], day[2])
    got = {r.Date: r.v for r in spark.read.schema("v string, Date date").parquet(path).collect()}
    assert got == {day[0]: "old", day[1]: "new", day[3]: "old", day[4]: "old"}


def test_append_by_name_and_rewrite(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(spark.createDataFrame([(1, "a")], "i int, s string"), path)
    tables.append_rows(spark.createDataFrame([("b", 2)], "s string, i int"), path)
    with pytest.raises(ValueError):
        tables.append_rows(spark.createDataFrame([(1,)], "i int"), path)
    tables.rewrite_table(spark.read.parquet(path).withColumn("i", F.col("i") * 10), path)
    spark.catalog.refreshByPath(path)
    assert sorted((r.i, r.s) for r in spark.read.parquet(path).collect()) == [(10, "a"), (20, "b")]


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)], "d string, v int")
    assert sorted(r.v for r in tables.latest_snapshot(df, "d").collect()) == [2, 3]


def test_staging_blanks(spark):
    row = {c: "10000001" for c in schemas.names(schemas.RESULTS)} | {"Vehicle": " VW   Golf ", "HB1": "-", "HB2": " ", "SKU3": "FormatError"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    out = cam_merge.staging(df, F.lit(dt.datetime(2024, 1, 1))).first()
    assert out.Vehicle == "VW Golf" and out.HB1 is None and out.HB2 is None and out.SKU3 is None and out.HB3 == "10000001"
    with pytest.raises(ValueError, match="SKU20"):
        cam_merge.staging(df.drop("SKU20"), F.lit(None))


def test_log_lines(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"run_id":"r","timestamp":"2024-01-01T00:00:00","textPayload":"Starting Stage 3"}\n{"run_id":"r"}\n')
    assert [r.textPayload for r in files.read_log(spark, str(tmp_path)).collect()] == ["Starting Stage 3"]


def test_pages_to_rows(spark):
    from treadmark.plans import clean

    item = ("VW", "205/55R16", "1", "2", "3", "4", ["10000001", "10000001", "-"], True)
    schema = (
        "page int, Segment string, items array<struct<Vehicle: string, Size: string, HB1: string, HB2: string, HB3: string, "
        "HB4: string, SKUs: array<string>, success: boolean>>"
    )
    pages = spark.createDataFrame([(2, "S", [item]), (1, "S", [item, ("VW", "205/55 R16", *"5678", None, None)])], schema)
    rows = clean.flattened(pages)
    assert rows.count() == 3 and rows.where("success").count() == 2
    kept = clean.wide_results(rows).collect()
    assert [(r.Size, r.HB1, r.SKU1, r.SKU2, r.SKU3, r.SKU24, r.repeats) for r in kept] == [
        ("205/55 R16", "1", "10000001", "-", "-", "", 1)
    ]


def test_contract_and_failure_codes(spark):
    from treadmark.plans import clean

    df = spark.createDataFrame([(["x"] * 20, True), (["x"] * 16, True), (["x"] * 20, None)], "SKUs array<string>, success boolean")
    assert audit.contract(df).count() == 2
    errors = spark.createDataFrame([("Timeout 504",), ("api quota",), ("boom",)], "e string")
    assert [r[0] for r in errors.select(clean.failure_code(F.col("e"))).collect()] == ["TIMEOUT", "UPSTREAM_ERROR", "INTERNAL_ERROR"]


def test_cost_report_sink_and_filters(spark, tmp_path):
    runs = spark.createDataFrame([("m", True, 1_000_000, 500_000, 1_500_000)], "Model string, Success boolean, Input_Tokens long, Output_Tokens long, Total_Tokens long")
    tables.export_json(audit.job_cost(runs, "r1", "GLOBAL"), str(tmp_path / "cost"))
    row = spark.read.json(str(tmp_path / "cost")).first()
    assert row.estimated_cost_gbp == 0.21752 and row.cams_succeeded == 1
    fits = spark.createDataFrame([("POD1", "City"), ("POD2", "City")], "Pod string, Segment string")
    assert audit.filtered_fits(fits, "pod1", "CITY").count() == 1 and audit.filtered_fits(fits).count() == 2
    assert audit.allowed_segments(fits, ["Sport"]).count() == 0 and audit.allowed_segments(fits, []).count() == 2


def test_single_lookup_matches_inside_the_size(spark):
    from treadmark.plans import candidates

    rows = [("2.BETTER", 5, 1, "VW Golf", "205/55 R16"), ("1.BEST", 1, 2, "VW Golf", "205/55 R16 91V"), ("1.BEST", 9, 3, "Audi", "205/55 ZR16")]
    df = spark.createDataFrame(rows, "TyreScore string, Units long, ProductId long, Vehicle string, SIZE string").selectExpr(
        "*", "string(null) OFFER", "1.0D PRICE", "'' Segment", "0L PRODUCTLISTVIEWS"
    )
    assert [r.ProductId for r in candidates.single_lookup(df, "205/55 R16").collect()] == [2, 1]
    assert [r.ProductId for r in candidates.single_lookup(df, "205/55", "vw-golf", 1).collect()] == [2]


def test_a_second_upload_does_not_count_twice(spark, tmp_path):
    for day, product in (("b", "10000002"), ("a", "10000001")):
        (tmp_path / day).mkdir()
        (tmp_path / day / "x Sales.csv").write_text(f"{product},VW,Golf,205,55,16,3,9,80.5\n")
    got = files.read_csv(spark, str(tmp_path), schemas.SALES, header=False, suffix="Sales.csv").collect()
    assert [r.ProductId for r in got] == ["10000001"]
    assert files.read_csv(spark, str(tmp_path), schemas.SALES, header=False, suffix="None.csv").count() == 0


def test_pages_by_position_are_those_by_limit(spark, monkeypatch):
    from treadmark.operators import position

    df = spark.range(500).withColumn("k", F.col("id") % 7)
    order = [F.asc("k"), F.asc("id")]
    want = [r.id for r in position.page(df, order, 40, 25).collect()]
    monkeypatch.setattr(position, "HEAD_ROWS", 0)
    assert sorted(r.id for r in position.page(df, order, 40, 25).collect()) == sorted(want)


def test_row_drift_counts_repeats(spark):
    from treadmark.operators.compare import row_drift

    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "i int, s string")
    assert sorted(map(tuple, row_drift(a, b).collect())) == [(1, "x", "golden"), (3, "y", "current")]

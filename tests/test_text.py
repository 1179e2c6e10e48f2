from pyspark.sql import functions as F

from treadmark.functions import journey, lists, numbers, scoring, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column).first()[0]


def column(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_size_parts_backtrack_and_miss(spark):
    got = column(spark, text.size_part, ["205/55 R16 91V", "225/40 ZR18", "no size", None])
    assert got == ["205/55 R16", "225/40", None, None]
    assert column(spark, text.stripped_size, ["205/55 R16 91V", "225/40 ZR18"]) == ["205/55 R16", None]


def test_list_id_repeats_the_rim(spark):
    assert column(spark, text.list_id_size, ["205-55-16", "x"]) == ["205/55/16 R16", None]


def test_repair_moves_text_between_fields(spark):
    rows = [
        ("GOLF", "205/70R15", "GOLF", "205/70 R15"),
        ("GOLF", "225/40ZR18", "GOLF", "225/40 ZR18"),
        # the slash form wants three digits after it, so the decimal form matches
        ("GOLF", "31/10.50 R15", "GOLF 31/", "10.50 R15"),
        ("GOLF", "31/1050R15", "GOLF", "31/1050 R15"),
        ("GOLF", "7.50 R16", "GOLF", "7.50 R16"),
        ("GOLF", "31x10.50 R15", "GOLF", "31x10.50 R15"),
        ("VW", "GOLF 205/55 R16", "VW GOLF", "205/55 R16"),
        ("VW GOLF 205/55R16 GTI", "", "VW GOLF GTI", "205/55 R16"),
        ("ROVER90", "unknown", "ROVER 90", "unknown"),
        (None, None, "", ""),
    ]
    df = spark.createDataFrame(rows, "v string, s string, v2 string, s2 string")
    name = text.repaired_vehicle_size(F.col("v"), F.col("s"))
    for r in df.select(name.alias("n"), "v2", "s2").collect():
        assert (r.n.Vehicle, r.n.Size) == (r.v2, r.s2)


def test_keys(spark):
    assert column(spark, text.alnum_key, [" VW-Golf 7 "]) == ["vwgolf7"]
    assert column(spark, text.vehicle_key, ["Citroën C-3"]) == ["citroënc3"]
    assert column(spark, text.upper_stripped, ["a b/c-d", None]) == ["ABCD", ""]
    assert column(spark, text.page_token, ["u?cam=X1&y=2", "u?cam=", "none"]) == ["X1", "", None]
    assert column(spark, text.title_words, ["vauxhall  GRANDLAND x-LINE"]) == ["Vauxhall Grandland X-line"]
    parts = [F.lit(x) for x in ("VW", "Golf Plus", "205", "55", "16")]
    assert one(spark, text.cam_key(*parts, mode="alnum"), x="") == "VWGOLFPLUS2055516"
    assert one(spark, text.cam_key(*parts, mode="capitals"), x="") == "OLFLUS2055516"


def test_loose_and_safe_numbers(spark):
    assert column(spark, lambda c: text.loose_size(c, 3), ["225/55R18", "225\\55 zr 18", "x"]) == ["18", "18", None]
    assert column(spark, numbers.try_long, ["12", "-", " 7", "99999999999999999999", None]) == [12, None, 7, None, None]


def test_rounding_half_away_from_zero(spark):
    got = column(spark, lambda c: numbers.round_away(c.cast("double"), 0), ["2.5", "-2.5", "2.4", "0"])
    assert got == [3.0, -3.0, 2.0, 0.0]


def test_click_rate_cap(spark):
    df = spark.createDataFrame([(0, 10), (1, 10), (1, 1000), (5, 0)], "o long, v long")
    assert [r[0] for r in df.select(scoring.click_rate(F.col("o"), F.col("v"))).collect()] == [0.0, 0.14, 0.1, 0.0]


def test_journey_order_and_shadowed_rules(spark):
    codes = ["PSCMM-AIM1", "psucmm-aim", "XSUCMM-NONCAM", "XUCMM-NONCAM", "NONCAM", None]
    df = spark.createDataFrame([(c, "golf") for c in codes], "c string, v string")
    got = [r[0] for r in df.select(journey.journey_label(F.col("c"), F.col("v"))).collect()]
    assert got == ["AIM", "AIM U - SWITCH", "CAM WAVES U", "CAM U", "NON MERCH VRM", "NON MERCH VRM"]
    by_size = spark.createDataFrame([(None, " no vrm search")], "c string, v string")
    assert by_size.select(journey.journey_label(F.col("c"), F.col("v"))).first()[0] == "SIZE"


def test_slots_from_list_index(spark):
    values = ["1", "4", "200", "99", "(not set)", "first", "7"]
    assert column(spark, journey.slot_position, values) == [1, 4, 4, 99, None, None, 7]
    assert column(spark, journey.placement_label, values) == [
        "Hotbox 1", "Hotbox 4", "Hotbox 4", "BrandSelector", "Waves", "Waves", "Waves"
    ]


def test_unknown_pages_and_null_page_are_not_counted(spark):
    df = spark.createDataFrame([("a/truck",), ("a/tyres",), (None,)], "u string")
    assert [r[0] for r in df.where(journey.counted_page(F.col("u"))).collect()] == ["a/tyres"]


def test_strict_id(spark):
    values = ["10000001", "10000001.0", "1234567", "-", "nan", " 10000001 ", None]
    assert column(spark, lists.strict_id, values) == ["10000001", "10000001", None, None, None, "10000001", None]


def test_spread_null_keeps_values_and_separates_nulls(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, "k").alias("k"), "id")
    keys = [r[0] for r in df.select(text.spread_null(F.col("k"), F.col("id"), parts=256)).distinct().collect()]
    assert "k" in keys and len(keys) > 100 and all(k == "k" or k.startswith("\0") for k in keys)

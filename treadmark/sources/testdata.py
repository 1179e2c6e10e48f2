"""The job's input tables, derived from the generic test tables.

Each function takes (spark, folder) and returns a table in the shape of
``treadmark.schemas``.  All are plain transformations of the whole tables, with
odd values (missing keys, bad text, repeated rows) spread through them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treadmark.functions.lists import HOTBOXES, SKUS
from treadmark.operators.lookup import grown
from treadmark.operators.topk import best_n

RUN_DATE = dt.date(2024, 1, 31)
ID_BASE = 10_000_000
# Brand#1 .. Brand#25 stand for these names; the last two are in no brand set.
BRANDS = (
    "Avon", "Bridgestone", "Continental", "Cooper", "Dunlop", "Falken", "Firestone", "Goodyear", "Hankook", "Kumho",
    "Maxxis", "Michelin", "Nankang", "Nokian", "Pirelli", "Toyo", "Uniroyal", "Vredestein", "Yokohama", "Accelera",
    "Dynamo", "Triangle", "Zeetex", "Nobrand", "Otherbrand",
)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CODES = (
    "PSUCMM-AIM1", "SUCMM-AIM1", "pxsucmm-aim", "XSUCMM-AIM", "CMM-AIM7", "PSCMM-AIM", "SUCMM-MAN1", "XSUCMM-NONCAM",
    "PSUCMM-NONCAM", "PXSUCMM", "XUCMM-NONCAM", "PXUCMM-NONCAM", "UCMM", "PUCMM", "SCMM", "pscmm", "CMM", "PCMM",
    "NONCAM", "OTHER", None, None,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def product_id(partkey: Column) -> Column:
    return partkey + F.lit(ID_BASE)


def size_text() -> Column:
    p = F.col("p_partkey")
    width = (F.lit(155) + 10 * (F.col("p_size") % 10)).cast("string")
    profile = (F.lit(35) + 5 * (F.col("p_size") % 8)).cast("string")
    rim = (F.lit(14) + F.col("p_size") % 7).cast("string")
    letter = F.when(p % 13 == 5, "ZR").otherwise("R")
    tail = F.when(p % 11 == 7, " 91V").otherwise("")
    return F.concat(width, F.lit("/"), profile, F.lit(" "), letter, rim, tail)


def brand_name() -> Column:
    return _pick(BRANDS, F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int") - 1)


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Product offers.  Some products have two price rows, some two offers, a few no id."""
    p = F.col("p_partkey")
    letters = F.lit("ABCDEF")
    copies = F.when((p % 10).isin(0, 5), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    raised = F.when((F.col("copy") == 1) & (p % 10 == 0), 1.1).otherwise(1.0)
    part = table(spark, folder, "part").withColumn("copy", F.explode(copies))
    offer = F.when(F.col("copy") == 1, F.when(p % 10 == 5, "ONOFFER")).otherwise(None)
    base_offer = F.when(p % 4 == 0, "ONOFFER").when(p % 4 == 1, "OnOffer").otherwise("NOTOFFER")
    price = F.col("p_retailprice") * raised
    return part.select(
        F.when(p % 997 != 996, product_id(p)).alias("ProductId"),
        F.when(F.col("p_type").isin("STANDARD", "LARGE"), "Premium")
        .when(F.col("p_type").isin("MEDIUM", "PROMO"), "MidRange")
        .otherwise("Budget")
        .alias("Grade"),
        size_text().alias("Size"),
        brand_name().alias("Manufacturer"),
        F.col("p_name").alias("Model"),
        F.nullif(F.substring(letters, (p % 7 + 1).cast("int"), F.lit(1)), F.lit("")).alias("WetGrip"),
        F.nullif(F.substring(letters, (p % 5 + 1).cast("int"), F.lit(1)), F.lit("")).alias("Fuel"),
        F.concat((68 + p % 8).cast("string"), _pick(("-A", "-B", "-C", "-D"), p % 4)).alias("Noise"),
        price.alias("Price"),
        (price * (1 + (p % 5) * 0.02)).alias("PrevPrice7"),
        (price * (1 - (p % 3) * 0.03)).alias("PrevPrice28"),
        _pick(("Summer", "Winter", "AllSeason"), p % 3).alias("Season"),
        F.coalesce(offer, base_offer).alias("Offer"),
        F.when(p % 6 == 0, "Yes").otherwise("No").alias("OE"),
        F.when(p % 9 == 0, "Award").otherwise("No").alias("AwardScore"),
    )


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("p_partkey")
    flags = _pick(("Runflat", "RUNFLAT", None, "Standard", "Standard", "Standard", "", "Standard"), p % 8)
    return (
        table(spark, folder, "part")
        .where(p % 17 != 3)
        .select(product_id(p).cast("string").alias("SKU"), flags.alias("run_flat"))
    )


def catalogue_with_price(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("p_partkey")
    return (
        table(spark, folder, "part")
        .where(p % 29 != 1)
        .select(product_id(p).cast("string").alias("SKU"), F.when(p % 19 != 0, brand_name()).alias("Brand"))
    )


def report_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("p_partkey")
    return (
        table(spark, folder, "part")
        .where(p % 23 != 5)
        .select(
            F.when(p % 31 == 2, F.concat(F.lit("x"), p.cast("string")))
            .otherwise(product_id(p).cast("string"))
            .alias("Product_ID"),
            F.when(p % 14 != 3, brand_name()).alias("Manufacturer"),
            F.col("p_name").alias("Model_Name"),
            _pick(("", None, "Yes", "No", "No"), p % 5).alias("OE"),
        )
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per product and vehicle, every column as text, as the sales file has it."""
    # Orders get their vehicles before they meet the lines, so that lines move once to their orders, as whole hundredths.
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("decimal(18,2)").alias("q"), F.col("l_extendedprice").cast("decimal(18,2)").alias("m")
    )
    bought = _orders_of_vehicles(spark, folder).select("o_orderkey", "make", "model")
    quantity, money = F.sum("q"), F.sum("m")
    grouped = (
        grown(lines).join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        # one row per order first: the distinct order count is then a plain count
        .groupBy("l_partkey", "make", "model", "l_orderkey")
        .agg(quantity.alias("q"), money.alias("m"))
        .groupBy("l_partkey", "make", "model")
        .agg(F.count("*").alias("orders"), F.sum("q").alias("q"), F.sum("m").alias("m"))
    )
    average = F.floor(F.col("m").cast("double") / F.col("q").cast("double") * 100 + 0.5) / 100
    units = F.when(F.col("l_partkey") % 37 == 4, F.lit(0)).otherwise(F.col("q").cast("bigint"))
    return grouped.select(
        product_id(F.col("l_partkey")).cast("string").alias("ProductId"),
        F.col("make").alias("CarMake"),
        F.col("model").alias("CarModel"),
        F.lit(None).cast("string").alias("Width"),
        F.lit(None).cast("string").alias("Profile"),
        F.lit(None).cast("string").alias("Rim"),
        F.col("orders").cast("string").alias("Orders"),
        units.cast("string").alias("Units"),
        average.cast("string").alias("AvgPrice"),
    )


def _vehicles_of_customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey", "n_nationkey", "n_regionkey", F.col("n_name").alias("make"), F.col("c_mktsegment").alias("model")
        )
    )


def _orders_of_vehicles(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the vehicles of their customers, dealt over all tasks: files may be few, and what follows costs time a row."""
    customers = _vehicles_of_customers(spark, folder)
    return grown(table(spark, folder, "orders")).join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _vehicles(spark: SparkSession, folder: str) -> DataFrame:
    return _vehicles_of_customers(spark, folder).select("n_nationkey", "n_regionkey", "make", "model").distinct()


def vehicle_mapping(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("n_nationkey")
    return _vehicles(spark, folder).where(k % 13 != 12).select(
        F.when(k % 2 == 0, F.lower(F.concat_ws(" ", "make", "model")))
        .otherwise(F.concat_ws("-", "make", "model"))
        .alias("vehicle"),
        F.col("make").alias("CarMake"),
        F.col("model").alias("CarModel"),
        F.concat(F.lit("POD"), F.col("n_regionkey").cast("string")).alias("Pod"),
        _pick(("City", "Family", "Sport", None), k % 4).alias("Category"),
        F.col("model").alias("Segment"),
    )


def influence(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("n_nationkey")
    return _vehicles(spark, folder).where(k % 5 != 4).select(
        F.concat("make", "model").alias("Vehicle"),
        F.when(k % 7 != 6, F.col("model")).alias("Segment"),
        (10 + k * 0.5).alias("PRICE_pct"),
        F.when(k % 3 != 1, 20 + k * 0.5).alias("GRADE_pct"),
        (30 + k * 0.25).alias("FUEL_pct"),
        (40 + k * 0.5).alias("WET_GRIP_pct"),
        F.when(k % 2 == 0, 5 + k * 0.5).alias("AWARD_SCORE_pct"),
    )


def best_sellers(spark: SparkSession, folder: str, n: int = 24, sold: DataFrame | None = None) -> DataFrame:
    """The ``n`` best selling products of every (vehicle, size), ranked.

    ``sold`` is the sales table when the caller already has it.
    """
    sold = (sold or sales(spark, folder)).select(
        "ProductId", F.concat_ws(" ", "CarMake", "CarModel").alias("Vehicle"), F.col("Units").cast("bigint").alias("Units")
    )
    part = table(spark, folder, "part").select(
        product_id(F.col("p_partkey")).cast("string").alias("ProductId"), size_text().alias("Size")
    )
    return best_n(
        grown(sold).join(part, "ProductId"), ["Vehicle", "Size"], [F.desc("Units"), F.asc("ProductId")], n, "slot"
    )


def wide_slots(spark: SparkSession, folder: str, sold: DataFrame | None = None) -> DataFrame:
    """One row per (vehicle, size): HB1-HB4, SKU1-SKU20; '-' where there is no product.

    Some rows have HB1 = '0', some a word where an id should be.
    """
    slots = [
        F.max(F.when(F.col("slot") == i, F.col("ProductId"))).alias(c) for i, c in enumerate((*HOTBOXES, *SKUS), 1)
    ]
    wide = best_sellers(spark, folder, sold=sold).groupBy("Vehicle", "Size").agg(*slots)
    digits = F.length(F.col("Vehicle")) + F.length(F.col("Size"))
    filled = wide.select(
        "Vehicle", "Size", *[F.coalesce(F.col(c), F.lit("-")).alias(c) for c in (*HOTBOXES, *SKUS)]
    )
    return filled.withColumn("HB1", F.when(digits % 11 == 3, "0").otherwise(F.col("HB1"))).withColumn(
        "SKU2", F.when(F.col("SKU2") == "-", "none").otherwise(F.col("SKU2"))
    )


def manual_keys(spark: SparkSession, folder: str, sold: DataFrame | None = None) -> DataFrame:
    """Hand-kept keys, written in two ways: with blanks, or with punctuation."""
    seen = best_sellers(spark, folder, 1, sold).select("Vehicle", "Size")
    make = F.regexp_replace(F.split("Vehicle", " ")[0], "_", "")
    model = F.split("Vehicle", " ")[1]
    width, profile, rim = (F.regexp_extract("Size", r"^(\d+)/(\d+) Z?R(\d+)", i) for i in (1, 2, 3))
    number = F.regexp_extract("Vehicle", r"_(\d+)", 1).cast("int")
    picked = (width.cast("int") + profile.cast("int") + number) % 7 == 0
    return seen.where(picked).select(
        F.when(number % 2 == 0, F.concat_ws(" ", make, model, width, profile, rim))
        .otherwise(F.concat(make, F.lit("-"), F.lower(model), F.lit(" "), width, F.lit("/"), profile, F.lit(" R"), rim))
        .alias("CAM")
    )


def cam_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Staged slots: the wide rows with blanks in places, and a change time."""
    n = F.length("Vehicle") + F.regexp_extract("Size", r"^(\d+)", 1).cast("int")
    wide = wide_slots(spark, folder)
    rows = wide.withColumn("SKU5", F.when(n % 5 == 0, "  ").otherwise(F.col("SKU5"))).withColumn("n", n)
    # Some vehicles are staged twice, in two spellings of one key.
    copies = F.when(n % 6 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    twice = rows.withColumn("copy", F.explode(copies))
    changed = F.lit(dt.datetime(2024, 1, 20)) + F.make_dt_interval(F.col("n") % 9, F.col("copy"))
    return twice.select(
        F.when(F.col("copy") == 1, F.lower("Vehicle")).otherwise(F.col("Vehicle")).alias("Vehicle"),
        "Size",
        F.when(F.col("copy") == 1, F.col("HB2")).otherwise(F.col("HB1")).alias("HB1"),
        *[c for c in (*HOTBOXES, *SKUS) if c != "HB1"],
        F.when(F.col("n") % 14 != 13, changed.cast("timestamp_ntz")).alias("last_modified"),
    )


def cam_target(spark: SparkSession, folder: str) -> DataFrame:
    """An older target: other products in the slots; times older, equal, newer or missing."""
    n = F.length("Vehicle") + F.regexp_extract("Size", r"^(\d+)", 1).cast("int")
    wide = wide_slots(spark, folder).withColumn("n", n).where("n % 3 <> 0")
    make = F.split("Vehicle", " ")[0]
    model = F.split("Vehicle", " ")[1]
    old = [F.when(F.col(c).rlike("^[0-9]+$"), F.concat(F.lit("2"), F.substring(c, 2, 7))).alias(f"SKU{i}")
           for i, c in enumerate((*HOTBOXES, *SKUS), 1)]
    stamp = F.lit(dt.datetime(2024, 1, 20)) + F.make_dt_interval(
        F.col("n") % 9 + F.when(F.col("n") % 4 == 1, 1).when(F.col("n") % 4 == 2, -1).otherwise(0)
    )
    return wide.select(
        F.lower(make).alias("Make"),
        F.concat(F.lit(" "), model).alias("Model"),
        F.regexp_extract("Size", r"^(\d+)", 1).alias("Width"),
        F.concat(F.regexp_extract("Size", r"/(\d+)", 1), F.lit(" ")).alias("Profile"),
        F.regexp_extract("Size", r"R(\d+)", 1).alias("Rim"),
        *old,
        F.when(F.col("n") % 10 != 7, stamp.cast("timestamp_ntz")).alias("last_modified"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Nested clickstream events."""
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    raw = table(spark, folder, "events").withColumn("k", k)
    nation = F.col("user_id") % 25
    segment = _pick(SEGMENTS, F.floor(F.col("user_id") / 25) % 5)
    vehicle = F.concat(F.lit("Nation_"), nation.cast("string"), F.lit(" "), F.initcap(segment))
    name = (
        F.when(F.col("event_type") == "view", "view_item_list")
        .when(F.col("event_type") == "click", "add_to_cart")
        .otherwise(F.col("event_type"))
    )
    size = F.concat_ws(
        "-",
        (155 + 10 * (F.col("k") % 10)).cast("string"),
        (35 + 5 * (F.col("k") % 8)).cast("string"),
        (14 + F.col("k") % 7).cast("string"),
    )
    index = (
        F.when(e % 97 == 0, "(not set)").when(e % 89 == 0, "99").when(e % 83 == 0, "first")
        .when(e % 6 == 5, "200").otherwise((e % 6).cast("string"))
    )

    def param(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), F.struct(value.cast("string").alias("string_value")).alias("value"))

    def item(list_index: Column) -> Column:
        return F.struct(
            F.when(e % 53 == 0, None).when(e % 47 == 0, "x99").otherwise(product_id(F.col("k")).cast("string")).alias("item_id"),
            size.alias("item_list_id"),
            list_index.alias("item_list_index"),
            F.concat(F.lit("model "), (F.col("k") % 9).cast("string")).alias("item_category"),
            F.when(e % 61 == 0, None).when(e % 15 == 0, " No VRM Search").otherwise(vehicle).alias("item_category5"),
            F.concat(F.lit("brand "), (F.col("k") % 5).cast("string")).alias("item_brand"),
            F.concat(F.lit("v"), (F.col("k") % 3).cast("string")).alias("item_variant"),
            F.when(e % 43 != 0, F.col("value")).alias("price"),
            F.when(e % 4 != 3, e % 4).alias("quantity"),
            F.array(param("item_category7", F.lit("x")), param("item_category8", _pick(CODES, e % len(CODES)))).alias("item_params"),
        )

    items = F.when(e % 7 == 0, F.array(item(index), item(F.lit("2")))).otherwise(F.array(item(index)))
    page = F.when(
        e % 37 != 0,
        F.concat(
            F.lit("https://shop.example/"),
            F.when(e % 31 == 0, "truck").when(e % 29 == 0, "seasonal").otherwise("tyres"),
            F.lit("?cam="), segment, F.lit("&p=1"),
        ),
    )
    user = F.col("user_id").cast("string")
    return raw.select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        F.timestamp_diff("MICROSECOND", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"), F.col("ts")).alias("event_timestamp"),
        F.when(e % 118 != 0, F.concat(F.lit("device"), user)).alias("user_pseudo_id"),
        F.when(e % 59 != 0, user).alias("user_id"),
        name.alias("event_name"),
        F.struct(F.when(e % 41 == 0, "France").otherwise("United Kingdom").alias("country")).alias("geo"),
        F.array(
            param("page_location", page), param("transaction_id", F.when(name == "purchase", e.cast("string")))
        ).alias("event_params"),
        F.when(e % 101 != 0, items).otherwise(F.filter(items, lambda x: F.lit(False))).alias("items"),
    )


def raw_outputs(spark: SparkSession, folder: str, sold: DataFrame | None = None) -> DataFrame:
    """Text answers to slot requests, well formed and not."""
    wide = wide_slots(spark, folder, sold)
    n = F.length("Vehicle") + F.regexp_extract("Size", r"^(\d+)", 1).cast("int") + F.regexp_extract("Vehicle", r"_(\d+)", 1).cast("int")
    ids = F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("none")) for c in (*HOTBOXES, *SKUS)])
    packed_size = F.regexp_replace("Size", "[/ ]", "")
    text = (
        F.when(n % 11 == 0, F.concat_ws(" ", "Vehicle", "Size", ids))
        .when(n % 11 == 1, F.concat_ws(" ", F.regexp_replace("Vehicle", " ", "_"), packed_size, ids))
        .when(n % 11 == 2, F.concat(F.lit("Here is the result:\n"), F.concat_ws(" ", F.lower("Vehicle"), packed_size, ids)))
        .when(n % 11 == 3, F.concat(F.lit("For "), F.col("Vehicle"), F.lit(" ("), F.col("Size"), F.lit("): "), F.regexp_replace(ids, " ", ", ")))
        .when(n % 11 == 4, F.concat_ws(" ", "Vehicle", packed_size, "HB1"))
        .when(n % 11 == 5, F.lit("sorry, nothing found for this request today"))
        .when(n % 11 == 6, F.concat_ws(" ", "Vehicle", packed_size, "HB1", "HB1", "HB2", "HB3", "HB3", "SKU1"))
        .when(n % 11 == 7, F.lit(""))
        .when(n % 11 == 8, F.lit(None))
        .when(n % 11 == 9, F.concat_ws(" ", F.lit("NoDataError"), packed_size, ids))
        .otherwise(F.concat(F.col("Vehicle"), F.lit("  "), packed_size, F.lit("\t"), ids, F.lit("\n")))
    )
    return wide.select("Vehicle", "Size", text.alias("raw_text"))


def bench_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One recorded run per order; its answer is a line of up to 20 product ids."""
    o = F.col("o_orderkey")
    variant = "(o_orderkey div 8 % 4)"
    tokens = F.expr(
        f"array_join(transform(sequence(1, 20), i -> CASE WHEN ({variant} + i) % 9 = 4 THEN '-' "
        f"ELSE string({ID_BASE} + ({variant} * 11 + i * 3 + o_custkey % 5) % 60) END), ' ')"
    )
    vehicle = F.concat_ws(" ", "make", "model")
    size = F.concat((155 + 10 * (o % 3)).cast("string"), F.lit("/55 R16"))
    return _orders_of_vehicles(spark, folder).select(
        F.when(o % 2 == 0, "model-large").otherwise("model-lite").alias("Model"),
        (o % 3 == 0).alias("Search_Enabled"),
        F.when(o % 5 < 2, 0).otherwise(2048).alias("Thinking_Budget"),
        vehicle.alias("Vehicle"),
        size.alias("Size"),
        o.alias("Run_ID"),
        (F.col("o_orderstatus") != "P").alias("Success"),
        (1000 + o % 900).alias("Model_Latency_ms"),
        (1100 + o % 900).alias("E2E_Latency_ms"),
        (140000 + o % 1000).alias("Input_Tokens"),
        (190 + o % 40).alias("Output_Tokens"),
        (140190 + o % 1000 + o % 40).alias("Total_Tokens"),
        F.lit(None).cast("double").alias("Cost_USD"),
        F.when(F.col("o_orderstatus") == "P", "FormatError").alias("Error_Type"),
        F.concat_ws(
            " ", F.regexp_replace(vehicle, " ", "_"), F.regexp_replace(size, "[/ ]", ""), tokens
        ).alias("Generated_SKUs"),
        F.lit(None).cast("string").alias("Raw_Output"),
    )


def run_results(spark: SparkSession, folder: str) -> DataFrame:
    """Service answers in request order, some broken, some repeated."""
    o = F.col("o_orderkey")
    base = _orders_of_vehicles(spark, folder)
    vehicle = F.concat_ws(" ", "make", "model")
    size = F.concat((155 + 10 * (o % 9)).cast("string"), F.lit("/"), (35 + 5 * (o % 6)).cast("string"))
    forms = (
        (vehicle, F.concat(size, F.lit("R16"))),
        (vehicle, F.concat(size, F.lit("ZR18"))),
        (F.col("make"), F.concat_ws(" ", "model", F.concat(size, F.lit(" R17")))),
        (F.concat_ws(" ", vehicle, F.concat(size, F.lit("R15"))), F.lit("")),
        (vehicle, F.lit("31/10.50 R15")),
        (F.concat(vehicle, F.lit("90")), F.lit("7.50R16")),
        (vehicle, F.lit("31x10.50R15")),
        (F.concat(F.lit("  "), vehicle, F.lit("  X ")), F.lit("unknown")),
    )

    def form(field: int) -> Column:
        return F.get(F.array(*[f[field] for f in forms]), (o % len(forms)).cast("int"))

    def sku(i: str) -> str:
        number = f"{ID_BASE} + (o_orderkey * 7 + {i} * (o_orderkey % 3 + 1)) % 40"
        return (
            f"CASE WHEN (o_orderkey + {i}) % 17 = 0 THEN '-' WHEN (o_orderkey + {i}) % 23 = 0 THEN '1234567' "
            f"WHEN (o_orderkey + {i}) % 29 = 0 THEN concat({ID_BASE // 100} + o_orderkey % 9, '.0') ELSE string({number}) END"
        )

    skus = F.expr(f"array_join(transform(sequence(1, 22), i -> {sku('i')}), ' ')")
    boxes = [F.expr(sku(str(i))) for i in range(30, 34)]
    return base.select(
        o.alias("position"),
        form(0).alias("Vehicle"),
        form(1).alias("Size"),
        F.when(o % 31 == 0, "FormatError").otherwise(boxes[0]).alias("HB1"),
        *[box.alias(name) for box, name in zip(boxes[1:], HOTBOXES[1:])],
        skus.alias("SKUs"),
        (o % 31 != 0).alias("success"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct vehicles and sizes asked for; some vehicles or sizes have no sales."""
    o = F.col("o_orderkey")
    base = _orders_of_vehicles(spark, folder)
    number = o % 51 + 1
    size = F.concat(
        (155 + 10 * (number % 10)).cast("string"), F.lit("/"), (35 + 5 * (number % 8)).cast("string"), F.lit(" R"),
        F.when(number == 51, F.lit("22")).otherwise((14 + number % 7).cast("string")),
    )
    vehicle = F.when(o % 7 == 3, F.concat(F.col("make"), F.lit(" NEW"))).otherwise(F.concat_ws(" ", "make", "model"))
    return base.select(vehicle.alias("Vehicle"), size.alias("Size"), F.col("model").alias("Segment")).groupBy(
        "Vehicle", "Size"
    ).agg(F.min("Segment").alias("Segment"))


def runlist(spark: SparkSession, folder: str) -> DataFrame:
    """Priority list in file order, headers in mixed case, some rows unusable."""
    o = F.col("o_orderkey")
    base = _orders_of_vehicles(spark, folder)
    return base.select(
        o.alias("position"),
        F.when(o % 19 == 3, "nan").when(o % 19 == 4, None).otherwise(F.concat_ws(" ", "make", "model")).alias("VEHICLE"),
        F.when(o % 23 == 5, "None").otherwise(F.concat((155 + 10 * (o % 9)).cast("string"), F.lit("/55 R16"))).alias("size"),
        (o % 1000).cast("string").alias(" Rank "),
    )


def segment_list(spark: SparkSession, folder: str) -> DataFrame:
    """Vehicle/size list in file order with stray blanks and repeats."""
    o = F.col("o_orderkey")
    base = _orders_of_vehicles(spark, folder)
    return base.select(
        o.alias("position"),
        F.when(o % 37 == 5, "  ").otherwise(
            F.concat(F.lit(" "), F.when(o % 2 == 0, F.lower("make")).otherwise(F.col("make")), F.lit(" "), F.col("model"))
        ).alias("Vehicle"),
        F.when(o % 41 == 7, "31/10.50 R15").otherwise(
            F.concat((155 + 10 * (o % 9)).cast("string"), F.lit("/"), (5 + 5 * (o % 12)).cast("string"), F.lit(" R16"))
        ).alias("Size"),
        F.concat(F.lit("POD"), (o % 4).cast("string")).alias("Pod"),
        F.concat(F.col("model"), F.lit(" ")).alias("Segment"),
    )


def log_entries(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    text = (
        F.when(e % 5 == 0, F.concat(F.lit("Starting Stage "), (e % 9 + 1).cast("string"), F.lit(": load")))
        .when(e % 5 == 1, None)
        .when(e % 5 == 2, F.concat(F.lit("starting stage  "), (e % 9 + 1).cast("string")))
        .otherwise(F.concat(F.lit("row "), e.cast("string")))
    )
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("ts").alias("timestamp"), e.alias("line"), text.alias("textPayload")
    )

"""CSV, JSON and binary inputs."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from treadmark import schemas
from treadmark.functions.numbers import try_long
from treadmark.functions.text import is_named

CORRUPT = "_corrupt_record"
# Order of rows as written: file, place of the split in the file, row in the split.
FILE_ORDER = "file_order"


def with_file_order(df: DataFrame) -> DataFrame:
    """Adds a sortable column that follows the order of lines in the files."""
    return df.withColumn(
        FILE_ORDER,
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_csv(
    spark: SparkSession, path: str, fields: schemas.Fields, header: bool, suffix: str | None = None, audit: bool = False
) -> DataFrame:
    """CSV with a fixed schema.

    With ``suffix`` the first file in path order whose name ends with it, at any
    depth, is read, and none gives no rows: a second upload does not count twice.  With
    ``audit`` malformed lines stay in the result with their text in
    ``_corrupt_record`` instead of failing the load.
    """
    text = schemas.ddl(fields) + (f", {CORRUPT} string" if audit else "")
    reader = spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
    reader = reader.option("enforceSchema", True)
    if audit:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True)
        found = sorted(reader.csv(path).inputFiles())
        if not found:
            return spark.createDataFrame([], text)
        path = unquote(found[0])
        reader = reader.option("pathGlobFilter", "*").option("recursiveFileLookup", False)
    return reader.csv(path)


def read_csv_or_none(spark: SparkSession, path: str, fields: schemas.Fields, header: bool, suffix: str) -> DataFrame | None:
    """As ``read_csv``; None when no file ends with ``suffix``."""
    df = read_csv(spark, path, fields, header, suffix)
    return df if df.inputFiles() else None


def clean_header(name: str) -> str:
    out = name.strip()
    for mark in " .-":
        out = out.replace(mark, "_")
    return out


def with_clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def read_named_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose header gives the columns, all read as text; headers cleaned."""
    return with_clean_headers(spark.read.option("header", True).csv(path))


# Accepted run-list headers in lower case.
RUNLIST_HEADERS = {"vehicle": "Vehicle", "size": "Size", "priorityrank": "PriorityRank", "rank": "PriorityRank"}


def runlist(df: DataFrame) -> DataFrame:
    """Run list with canonical headers; rows without a usable name dropped."""
    out = df
    for c in df.columns:
        out = out.withColumnRenamed(c, RUNLIST_HEADERS.get(c.strip().lower(), c.strip()))
    missing = [c for c in ("Vehicle", "Size") if c not in out.columns]
    if missing:
        raise ValueError(f"run list lacks {missing}; found {out.columns}")
    return out.where(is_named(F.col("Vehicle")) & is_named(F.col("Size")))


def segment_list(df: DataFrame) -> DataFrame:
    """Vehicle/size list, stripped, rows with a blank vehicle or size dropped."""
    out = df.select(
        *[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in schemas.names(schemas.SEGMENT_LIST)],
        *[c for c in df.columns if c not in schemas.names(schemas.SEGMENT_LIST)],
    )
    return out.where((F.col("Vehicle") != "") & (F.col("Size") != ""))


def log_lines(df: DataFrame) -> DataFrame:
    """Log records that carry text."""
    return df.where(F.col("textPayload").isNotNull() & (F.col("textPayload") != ""))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return log_lines(spark.read.schema(schemas.ddl(schemas.LOG_ENTRIES)).json(path))


def manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, size and sha256 of each job input (SQL text, small CSV).

    Each file is read whole by one task, so this is for inputs far below 2 GB.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
        F.col("length").alias("size"),
        F.sha2("content", 256).alias("sha256"),
    )


def typed_sales(sales: DataFrame) -> DataFrame:
    """Sales file columns as the jobs use them."""
    from treadmark.functions.text import sales_vehicle

    return sales.select(
        F.col("ProductId").cast("string").alias("ProductId"),
        sales_vehicle(F.col("CarMake"), F.col("CarModel")).alias("Vehicle"),
        try_long(F.col("Orders")).alias("Orders"),
        try_long(F.col("Units")).alias("Units"),
        F.col("AvgPrice").try_cast("double").alias("AvgPrice"),
    )


def distinct_makes(sales: DataFrame) -> DataFrame:
    return sales.where(F.col("CarMake").isNotNull()).select(F.upper(F.trim("CarMake")).alias("Make")).distinct()


def load_checked(spark: SparkSession, path: str, fields: schemas.Fields) -> tuple[DataFrame, DataFrame]:
    """CSV files with a header line as typed rows, and what could not be loaded: file, line_no, reason, line.

    A file whose header is not that of ``fields`` is set apart whole; a line goes apart if it has another number of fields, or
    a value that is not of its column's type (the reason names the first such column).  Empty values are null.  Lines
    are numbered from 1, the header's, by counting the lines of each split and adding up those before, so no
    file is numbered in one task.  A quoted value must not hold a line break.
    """
    names = schemas.names(fields)
    source = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("id")
    )
    splits = source.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    lines = source.join(splits, ["file", "block"]).select("file", "value", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line_no"))
    heads = lines.where("line_no = 1").select("file", F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(names) + 1))).alias("head"))
    told = F.array(*(F.trim(F.col(f"head.c{i}")) for i in range(len(names) + 1)))
    right = F.array(*map(F.lit, names), F.lit(None).cast("string"))
    heads = heads.select("file", told.eqNullSafe(right).alias("known"))
    cut = lines.join(heads, "file").where("line_no > 1")
    text = ", ".join([*(f"c{i} string" for i in range(len(names))), f"{CORRUPT} string"])
    cut = cut.withColumn("row", F.from_csv("value", text, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}))
    cell = lambda i: F.nullif(F.col(f"row.c{i}"), F.lit(""))
    wrong = F.when(~F.col("known"), "header").when(F.col(f"row.{CORRUPT}").isNotNull(), "number of fields")
    for i, (name, kind) in enumerate(fields):
        if kind != "string":
            wrong = wrong.when(cell(i).isNotNull() & cell(i).try_cast(kind).isNull(), f"{name} is no {kind}")
    checked = cut.withColumn("reason", wrong)
    good = checked.where("reason IS NULL").select(*(cell(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)))
    return good, checked.where("reason IS NOT NULL").select("file", F.col("line_no").cast("long"), "reason", F.col("value").alias("line"))

"""Table sinks on Parquet, CSV and JSON."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from treadmark import schemas
from treadmark.session import durable


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Truncate and load.  ``df`` must not read from ``path``; see ``rewrite_table``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def rewrite_table(df: DataFrame, path: str) -> None:
    """Replace a table by something computed from itself.

    The result is finished in a new folder, then the folders are exchanged; a
    job that dies half way leaves the old table in place.
    """
    spark = df.sparkSession
    fresh, old = f"{path}.next-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    fs, to_path = _file_system(spark, path)
    if fs.exists(to_path(path)) and not fs.rename(to_path(path), to_path(old)):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(to_path(fresh), to_path(path)):
        raise OSError(f"cannot move the new table to {path}")
    fs.delete(to_path(old), True)


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append, columns matched by name with the table already there."""
    spark = df.sparkSession
    fs, to_path = _file_system(spark, path)
    if fs.exists(to_path(path)):
        wanted = spark.read.parquet(path).columns
        if set(wanted) != set(df.columns):
            raise ValueError(f"columns differ from {path}: {sorted(set(wanted) ^ set(df.columns))}")
        df = df.select(*wanted)
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_window(df: DataFrame, path: str, date_column: str, start: dt.date, end: dt.date) -> None:
    """Replace the days [start, end] of a date-partitioned table.

    Days with new rows are overwritten; days of the window without any are
    removed.  The window is a few weeks of days, so the list of days is short.
    Each day is replaced as a whole, the days not in one step: who reads
    meanwhile may see new days beside old ones, and a run that dies is repeated.
    A table that needs the window in one step must be in a table format with
    transactions.
    """
    spark = df.sparkSession
    rows = durable(df.where(F.col(date_column).between(F.lit(start), F.lit(end))), "window")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_column).parquet(path)
    written = {r[0] for r in rows.select(date_column).distinct().collect()}
    fs, to_path = _file_system(spark, path)
    day = start
    while day <= end:
        folder = to_path(f"{path}/{date_column}={day.isoformat()}")
        if day not in written and fs.exists(folder):
            fs.delete(folder, True)
        day += dt.timedelta(days=1)
    spark.catalog.refreshByPath(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def load_csv(spark: SparkSession, path: str, fields: schemas.Fields) -> DataFrame:
    return spark.read.schema(schemas.ddl(fields)).option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def latest_snapshot(df: DataFrame, date_column: str) -> DataFrame:
    """Rows of the newest day.  The newest day is one value, read from the partition list or a tiny aggregate."""
    newest = df.agg(F.max(date_column).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(date_column) == F.col("_newest"), "left_semi")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    return fs, jvm.org.apache.hadoop.fs.Path

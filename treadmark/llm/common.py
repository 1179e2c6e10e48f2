"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import os
import pickle
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space as bytes: what ``bytes.split`` would split at, and nothing more.
SPACES = b" \t\n\x0b\x0c\r"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def fold(key: Column, parts: int = 5) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns of the input cannot clash with the operator's own."""
    return df.select(*names)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def free(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written: it does so when nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return a task's freed memory to the machine: the worker outlives the task, and C's allocator keeps what it was given."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def pack(value: object) -> bytes:
    """A compressed message from one of the package's tasks to another."""
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(value, 5))


def unpack(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches, one batch's Python objects at a time."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def ship(spark: SparkSession) -> None:
    """Give Spark the package's own source once for each context, so that executors can import what its tasks call."""
    sc = spark.sparkContext
    if getattr(sc, "_treadmark_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="treadmark-source-"), "treadmark_source.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                out.write(os.path.join(folder, name), os.path.join("treadmark", os.path.relpath(os.path.join(folder, name), package)))
    sc.addPyFile(path)
    sc._treadmark_shipped = True

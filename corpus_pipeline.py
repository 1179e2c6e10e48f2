"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Quality first (documents that the network rejects go), then one document of each group of near copies stays, then secrets
are masked in the texts, then sources are mixed to their target weights (documents are repeated or left out), and the
mix is coded as pieces.  The network, the groups and the seatings of the sample have no SQL; the stages are tested
against plain Python in ``tests/llm/test_pipeline.py``.

Nulls, empty texts and repeated rows are as the stages' operators say; columns beyond those of ``documents`` are kept as
they are, whatever their names, up to the last stage.  Without documents there are no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from treadmark.llm import jaccard_join, mix, quality_net, secret_scan, sentence_pieces
from treadmark.llm.common import fresh
from treadmark.session import durable


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, fitted on the labels of ``sf_dir``, does not reject."""
    return quality_net.kept(docs, quality_net.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingle sets link."""
    return jaccard_join.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    spans = fresh("secrets")
    found = secret_scan.secrets(docs, to=spans)
    hit = F.size(F.col(f"`{spans}`")) > 0
    text = F.when(hit, secret_scan.masked(F.col("text"), F.col(f"`{spans}`"))).otherwise(F.col("text"))
    out = found.withColumn("text", text).withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mix.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as piece ids."""
    return sentence_pieces.encoded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

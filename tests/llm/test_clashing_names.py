"""Columns of the input may have any name, also those that the operators use inside; their values come back unchanged."""

from __future__ import annotations

import os

import pytest
from plain_readings import awkward
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from treadmark import session
from treadmark.llm import jaccard_join, mix, quality_net, secret_scan, seating_lm

NAMES = (
    "_id _source _of _copies _size _again _key _blob _spans _secrets _first _place own_id own_source own_size copies blob id place spans text_ rep c n first found "
    "key rank h taken target part whole need drawn gap base s a bin words"
).split()


def clashing(spark):
    rows = awkward(spark).withColumn("row", F.monotonically_increasing_id())
    return rows.select("*", *(F.concat(F.lit(f"{n} "), F.col("row").cast("string")).alias(n) for n in NAMES))


OPERATORS = {
    "mixed": mix.mixed,
    "secrets": lambda d: secret_scan.secrets(d, to="spans"),
    "first": jaccard_join.one_of_each,
    "net": lambda d: quality_net.kept(d, quality_net.untrained(0.9)),
    "masked": lambda d: pipeline.secrets(d.sparkSession, d, ""),
    "mixture": lambda d: pipeline.mixture(d.sparkSession, d, ""),
    "near": lambda d: pipeline.near_copies(d.sparkSession, d, ""),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_come_back(spark, name):
    docs = clashing(spark)
    got = OPERATORS[name](docs)
    assert sorted(got.columns) == sorted(docs.columns)
    for r in got.collect():
        for n in NAMES:
            assert name == "secrets" and n == "spans" or r[n] == f"{n} {r['row']}"


def test_nothing_is_left_in_the_shared_folder(spark):
    docs = awkward(spark)
    secret_scan.secrets(docs).collect()
    seating_lm.scored(docs).collect()
    session.clear_staged()
    folder = session.shared_dir(spark).removeprefix("file:")
    assert not [n for n in os.listdir(folder) if n.startswith(("unseen", "blob-ledger", "numbered", "buckets", "shingles"))]

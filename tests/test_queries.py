"""Plans of the registered queries, and some of them against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
import check

PLANNED = (
    "tyre_score", "grade_share_pivot", "clickstream", "best_placement", "top_skus", "consistency", "parse_output", "dedup_rows",
    "top100_candidates", "hotbox_slots", "cam_merge", "merch_report",
)
COMPARED = ("size_parts", "tyre_score", "price_zone", "merch_report", "cam_merge", "parse_output", "make_model", "outcome_counts", "fit_page")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_workers_and_no_single_task_over_rows(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # Windows over everything may only see per-partition or per-block sums.
    for i, line in enumerate(text.splitlines()):
        if "Exchange SinglePartition" in line:
            below = "\n".join(text.splitlines()[i : i + 4])
            assert "HashAggregate" in below, below


@pytest.mark.parametrize("name", ("tyre_score", "score_output", "tiered_candidates", "hotbox_slots", "backfill", "quality", "token_fact"))
def test_staged_steps_use_no_python_and_no_cross_join(spark, small, name, monkeypatch):
    from treadmark import session

    plans = []
    monkeypatch.setattr(session, "plan_listener", plans.append)
    entry.queries()[name](spark, small)
    assert plans
    for text in plans:
        assert "Python" not in text and "Pandas" not in text
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, small):
    from treadmark.plans import attribution
    from treadmark.queries import _base

    text = plan(attribution.purchases(_base(spark, small)))
    assert "EqualTo(event_name,purchase)" in text
    schema = text[text.index("ReadSchema") :]
    assert "item_list_id" not in schema and "item_id" in schema


def test_day_partitions_are_pruned(spark, small, tmp_path):
    import datetime as dt

    from treadmark.sources import events, testdata

    path = str(tmp_path / "events")
    testdata.events(spark, small).write.partitionBy("event_date").parquet(path)
    stored = spark.read.schema(testdata.events(spark, small).schema).parquet(path)
    text = plan(events.days(stored, dt.date(2024, 1, 2), dt.date(2024, 1, 3)).select("event_name"))
    assert "PartitionFilters: [isnotnull(event_date" in text and "20240102" in text


def test_group_limit_cuts_before_the_shuffle(spark, small):
    text = plan(entry.queries()["top_skus"](spark, small))
    assert text.index("Final") < text.index("Partial") and "WindowGroupLimit" in text


@pytest.mark.parametrize("name", COMPARED)
def test_against_duckdb(spark, small, name):
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    verdict, _ = check.compare(spark, con, small, name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    from treadmark.queries import QUERIES

    assert not set(QUERIES) - set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())

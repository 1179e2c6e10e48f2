"""Plans of jobs over tables that grow: what is broadcast, what is shuffled, and that the rows stay right."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from treadmark import queries as q, session
from treadmark.functions import lists
from treadmark.plans import audit, candidates, likeness, recommend, weighting
from treadmark.sources import testdata as td


@pytest.fixture
def plans():
    """Plans of the tables that are written along the way."""
    seen: list[str] = []
    session.plan_listener = seen.append
    yield seen
    session.plan_listener = None


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def scored(spark, small):
    return session.durable(q.scored_table(spark, small), "scored")


@pytest.mark.parametrize("job", [likeness.cousin_products, likeness.cousin_vehicles, lambda s: likeness.similar_product(s, "Michelin")])
def test_what_was_bought_is_never_sent_whole_to_the_driver(scored, plans, job):
    out = job(scored)
    assert not any("BroadcastExchange" in p for p in [*plans, plan(out)])


def test_lines_move_once_to_their_orders_and_once_to_their_products(spark, small):
    text = plan(td.sales(spark, small))
    assert text.count("SortMergeJoin") == 2
    # orders and customers by customer, orders and lines by order, sums by product: the joined lines are not dealt by customer
    assert "hashpartitioning(l_orderkey" in text and text.count("hashpartitioning(o_custkey") == 1
    assert text.index("l_orderkey") < text.index("hashpartitioning(o_custkey")


def test_sales_are_merged_with_products_and_offers(spark, small, plans):
    out = plan(q.scored_table(spark, small))
    totals = next(p for p in plans if "price_sum" in p or "SizePart" in p)
    assert totals.count("SortMergeJoin") == 2 and "BroadcastExchange" not in totals
    assert out.count("SortMergeJoin") == 2


def test_orders_are_dealt_over_tasks_before_their_answers_are_made(spark, small):
    for make in (td.run_results, td.requests, td.bench_runs, td.runlist, td.segment_list):
        assert "SortMergeJoin" in plan(make(spark, small))


def test_a_block_moves_its_lines_and_their_order_alone(scored, plans):
    rows = candidates.text_block(scored, ["size_key"])
    written = next(p for p in plans if "rangepartitioning" in p)
    assert "GoldilocksZone" not in written.split("rangepartitioning")[0]
    sorted_rows = rows.where("line_no > 0").orderBy("size_key", "line_no").limit(40).collect()
    want = candidates.top_candidates(scored, ["size_key"], 40).withColumn("want", candidates.block_line())
    want = {(r["size_key"], r["rank"]): r["want"] for r in want.collect()}
    assert sorted_rows and all(want[r["size_key"], r["line_no"]] == r["line"] for r in sorted_rows if r["line_no"] <= 40)


def test_products_of_a_fit_are_not_taken_once_for_every_grade(spark, small, scored):
    assert "Expand" not in plan(weighting.grade_quotas(td.requests(spark, small), scored))


def test_a_fits_products_move_once(scored):
    rows = recommend.features(scored, recommend.Rules())
    text = plan(recommend.best_rows(rows))
    assert text.count("Exchange") == 1 and "REPARTITION_BY_COL" in text
    a = recommend.best_rows(rows).groupBy("size_key", "id").agg(F.min("r").alias("r"))
    b = recommend.best_rows(rows, candidates.WIDE)
    assert not a.exceptAll(b.select(a.columns)).count() and a.count() == b.count()


def test_answered_products_are_looked_up_alone(spark, scored):
    runs = spark.createDataFrame([(True, "10000001 77777777 10000001"), (False, "88888888"), (True, None)], "Success boolean, Generated_SKUs string")
    out = audit.unmatched_skus(scored, runs)
    assert "LeftSemi" in plan(out)
    assert [r["sku"] for r in out.collect()] == ["77777777"]


def test_places_are_found_once_an_item(spark):
    rows = [(["a", "b", "a", "c"], ["c", "a", None, "b", "z", "a"]), ([], ["a"]), (None, ["a"]), (["a", None], [None, "a"]), (["a", "b"], None)]
    df = spark.createDataFrame(rows, "ref array<string>, got array<string>")
    out = df.select(lists.out_of_order(F.col("ref"), F.col("got")).alias("m"))
    assert [r["m"] for r in out.collect()] == [["a", "b"], [], [], [], None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 1


def test_every_trusted_document_counts(spark):
    """More trusted documents than the 20,000 that the target was once fitted on, and ids that are null or repeat."""
    import math

    from treadmark.llm import quality_rules

    docs = spark.range(30_000).selectExpr("id AS doc_id", "IF(id < 25000, 'good', 'bad') AS text")
    docs = docs.union(spark.createDataFrame([(None, "bad"), (7, "bad"), (8, None)], "doc_id bigint, text string"))
    trusted = spark.range(25_000).selectExpr("id AS doc_id").union(spark.createDataFrame([(None,), (3,)], "doc_id bigint"))
    ratios = quality_rules.log_ratios(docs, trusted, 64)
    good, bad = (spark.sql(f"SELECT pmod(xxhash64('{w}'), 64)").first()[0] for w in ("good", "bad"))
    assert good != bad
    trusted_sum, raw_sum = 25_001 + 64, 30_002 + 64
    assert ratios[good] == pytest.approx(math.log(25_001 / trusted_sum) - math.log(25_001 / raw_sum))
    assert ratios[bad] == pytest.approx(math.log(2 / trusted_sum) - math.log(5_003 / raw_sum))


def test_a_task_gives_back_what_it_freed():
    """Small objects between live ones: the allocator alone would keep their pages."""
    from treadmark.llm.common import give_back

    def resident() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    held = [bytes(2000) for _ in range(100_000)]
    held = held[::50]
    before = resident()
    give_back()
    assert before - resident() > 50_000_000 and len(held) == 2_000

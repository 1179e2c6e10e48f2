"""Rule breaks and repairs on hand-written rows, and over whole answers."""

from __future__ import annotations

import pytest


from treadmark import queries as q
from treadmark.functions.lists import HOTBOXES, SKUS
from treadmark.plans import recommend, repair
from treadmark.session import durable

ITEM = "struct<id:string,grade:string,a:boolean,b:boolean,runflat:boolean,match:boolean,brand:string>"
SCHEMA = (
    "Vehicle string, Size string, size_key string, vehicle_key string, boxes array<struct<at:int,id:string,there:boolean,grade:string,a:boolean,b:boolean,"
    f"runflat:boolean,match:boolean,brand:string>>, box_ids array<string>, more array<string>, pool array<{ITEM}>, own_ids array<string>, popular array<{ITEM}>, "
    f"PremiumShare double, cheap array<string>, pool_b array<{ITEM}>, gate boolean, named_brand string, named_share double, wanted int"
)
# id: grade, in set A, in set B, run-flat, meets the enhancer, brand; by relevance
PRODUCTS = {
    "p1": ("Premium", True, True, False, False, "avon"), "m1": ("MidRange", True, True, False, False, "toyo"), "p2": ("Premium", True, True, True, False, "michelin"),
    "b1": ("Budget", False, True, False, False, "zeetex"), "m2": ("MidRange", True, True, False, True, "kumho"), "b2": ("Budget", False, True, False, True, "zeetex"),
    "x1": ("Premium", False, False, False, False, "odd"),
}


def row(boxes, more=(), gate=False, wanted=0, cheap=("m2", "m1"), **other):
    pool = [(i, *t) for i, t in PRODUCTS.items()]
    known = [(k, i, i in PRODUCTS, *PRODUCTS.get(i, (None,) * 6)) for k, i in enumerate(boxes)]
    more = [*more, *["-"] * (20 - len(more))]
    return ("V", "S", "s", "v", known, list(boxes), more, pool, list(PRODUCTS), pool[:3], other.get("share", 10.0), list(cheap), [p for p in pool if p[3]], gate, "michelin", 25.0, wanted)


def found(spark, *args, **kwargs):
    df = spark.createDataFrame([row(*args, **kwargs)], SCHEMA)
    return {r["rule"]: r["evidence"] for r in repair.breaks(df).collect()}


REST = ["x1", "b1", "b2"]


@pytest.mark.parametrize(
    "boxes,more,options,rule,evidence",
    [
        (["p1", "m1", "p2", "zz"], [*REST, "m2"], {}, "other_size", "zz"),
        (["p1", "m1", "p1", "m2"], [*REST, "p2"], {}, "repeated", "p1"),
        (["p1", "m1", "p2", "m2"], [*REST, "x1"], {}, "repeated_more", "x1"),
        (["p1", "b1", "p2", "m2"], ["x1", "b2", "m1"], {}, "budget_too_high", "b1"),
        (["p1", "x1", "p2", "m2"], ["m1", "b1", "b2"], {}, "not_in_set_a", "x1"),
        (["p1", "m1", "p2", "x1"], ["m2", "b1", "b2"], {}, "not_in_set_b", "x1"),
        (["p1", "b1", "p2", "b2"], ["x1", "m1", "m2"], {"gate": True}, "too_many_budget", "b1 b2"),
        (["p1", "m1", "p2", "b1"], ["x1", "m2", "b2"], {}, "budget_behind_gate", "b1"),
        (["p1", "m1", "p2", "m2"], REST, {"gate": True}, "gate_without_budget", "b1"),
        (["p1", "m1", "-", "m2"], [*REST, "p2"], {}, "empty_high_box", "p2"),
        (["p1", "m1", "p2", "-"], [*REST, "m2"], {}, "empty_box_four", "m2"),
        (["m2", "m1", "p2", "-"], REST, {}, "top_seller_missing", "p1"),
        (["p1", "m1", "m2", "-"], [*REST, "p2"], {"share": 25.0}, "named_brand_missing", "p2"),
        (["p1", "m1", "m2", "-"], [*REST, "p2"], {"wanted": 1}, "runflats_short", "p2"),
        (["p1", "m1", "p2", "-"], ["x1"], {}, "enhancer_missing", "m2"),
        (["p1", "m1", "p2", "m2"], ["x1"], {}, "short_of_more", "b1"),
    ],
)
def test_each_rule_by_hand(spark, boxes, more, options, rule, evidence):
    assert found(spark, boxes, more, **options)[rule] == evidence


def test_a_good_answer_breaks_nothing(spark):
    assert found(spark, ["p1", "m1", "p2", "m2"], [*REST], share=50.0, wanted=1) == {}


def mended(spark, *args, rules=None, **kwargs):
    df = spark.createDataFrame([row(*args, **kwargs)], SCHEMA)
    r = repair.repaired(df, rules or recommend.Rules()).first()
    return [r[c] for c in HOTBOXES], [r[c] for c in SKUS if r[c] != "-"], r["steps"]


def test_repairs_by_hand(spark):
    boxes, more, steps = mended(spark, ["p1", "b1", "p2", "m1"], ["m2"], gate=True)
    assert boxes == ["p1", "m1", "p2", "b1"] and more[0] == "m2"  # the budget tyre moves down, the box goes to the best that is free
    assert steps == "HB2 budget_too_high: b1 > m1; HB4 moved: m1 > b1"
    boxes, _, _ = mended(spark, ["p1", "b1", "p2", "b2"], gate=True)
    assert boxes == ["p1", "m2", "p2", "b2"]  # a second budget tyre is swapped for the cheapest mid-range one, not the best
    assert mended(spark, ["p1", "b1", "p2", "m1"])[0] == ["p1", "m2", "p2", "m1"]  # closed gate: no budget tyre at all
    assert mended(spark, ["zz", "m1", "m1", "b1"])[0] == ["p1", "m1", "p2", "m2"]
    assert mended(spark, ["p1", "m1", "p2", "m2"], REST) == (["p1", "m1", "p2", "m2"], REST, "")


def test_enhancers_and_top_sellers(spark):
    rules = recommend.Rules(brand="kumho")
    assert mended(spark, ["p1", "m1", "p2", "-"], rules=rules)[0][3] == "m2"
    boxes, more, _ = mended(spark, ["p1", "m1", "m2", "b1"], rules=rules, gate=True)
    assert boxes[3] == "b1" and more[0] == "p2"  # a hotbox meets it already
    boxes, more, steps = mended(spark, ["m2", "m1", "p2", "-"], ["x1"])
    assert "p1" in [*boxes, *more]


@pytest.fixture(scope="module")
def whole(spark, small):
    rules = recommend.Rules(brand="Michelin")
    scored, asked = q._scored(spark, small), q._requests(spark, small)
    first = durable(repair.repaired(repair.in_context(q._damaged(spark, small, asked, scored, rules), asked, scored, rules), rules), "first")
    return first, durable(repair.in_context(first.drop("steps"), asked, scored, rules), "again"), rules


def test_mended_answers_break_no_rule_that_is_mended(whole):
    left = {r["rule"] for r in repair.breaks(whole[1]).collect()}
    assert not left - {"named_brand_missing", "runflats_short", "other_vehicle"}


def test_mending_twice_changes_nothing(whole):
    first, again, rules = whole
    second = repair.repaired(again, rules)
    assert first.where("steps <> ''").count() > 500 and second.where("steps <> ''").count() == 0
    assert second.drop("steps").exceptAll(first.drop("steps")).count() == 0
    assert first.count() == second.count() == first.select("Vehicle", "Size").distinct().count()


def test_repairs_run_without_python(spark, small, whole):
    text = repair.repaired(whole[1], whole[2])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


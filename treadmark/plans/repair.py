"""Answers held against every rule, and mended: both work on the lists of one row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from treadmark.functions.lists import HOTBOXES, SKUS, as_columns, is_valid_id, padded
from treadmark.operators.lookup import grown
from treadmark.operators.topk import best_n
from treadmark.plans import recommend
from treadmark.plans.candidates import NARROW, WIDE, keyed, keyed_requests
from treadmark.plans.recommend import HOT, MORE, POPULAR, RUNFLAT_STEPS, TRAITS, Rules
from treadmark.session import durable

ROW = ["Vehicle", "Size"]
#: An answer has four hotboxes, so the fifth cheapest product of a size is never needed.
CHEAP = HOT + 1


@dataclass(frozen=True)
class Invariant:
    """``evidence`` is an expression over the columns of ``in_context``: what breaks the rule in a row, or null."""

    name: str
    evidence: str


def _first(items: str, test: str) -> str:
    return f"get(filter({items}, x -> {test}), 0).id"


def _joined(ids: str) -> str:
    return f"nullif(array_join({ids}, ' '), '')"


#: Fixed rules of an answer, as data; ``boxes`` are the hotboxes with what is known of their products.
INVARIANTS = (
    Invariant("other_size", _first("boxes", "x.id <> '-' AND NOT x.there")),
    Invariant("repeated", _joined("array_distinct(filter(box_ids, (x, i) -> x <> '-' AND array_position(box_ids, x) <= i))")),
    Invariant("repeated_more", _joined("array_distinct(filter(more, (x, i) -> x <> '-' AND array_position(more, x) <= i))")),
    Invariant("budget_too_high", _first("boxes", "x.at < 3 AND x.grade = 'Budget'")),
    Invariant("not_in_set_a", _first("boxes", "x.at < 3 AND x.there AND NOT x.a AND coalesce(x.grade <> 'Budget', true)")),
    Invariant("not_in_set_b", _first("boxes", "x.at = 3 AND x.there AND NOT x.b")),
    Invariant("too_many_budget", "CASE WHEN size(filter(boxes, x -> x.grade = 'Budget')) > 1 THEN array_join(transform(filter(boxes, x -> x.grade = 'Budget'), x -> x.id), ' ') END"),
    Invariant("budget_behind_gate", f"CASE WHEN NOT gate THEN {_first('boxes', 'x.at = 3 AND x.grade = $Budget$')} END".replace("$", "'")),
    Invariant(
        "gate_without_budget",
        f"CASE WHEN gate AND NOT coalesce(exists(boxes, x -> x.grade = 'Budget'), false) THEN {_first('pool_b', 'x.grade = $Budget$ AND NOT array_contains(box_ids, x.id)')} END".replace("$", "'"),
    ),
    Invariant("empty_high_box", f"CASE WHEN array_contains(slice(box_ids, 1, 3), '-') THEN {_first('pool', 'x.a AND NOT array_contains(box_ids, x.id)')} END"),
    Invariant(
        "empty_box_four",
        f"CASE WHEN box_ids[3] = '-' THEN {_first('pool_b', 'NOT array_contains(box_ids, x.id) AND (gate OR x.grade <> $Budget$)')} END".replace("$", "'"),
    ),
    Invariant("top_seller_missing", "CASE WHEN NOT array_contains(concat(box_ids, more), get(popular, 0).id) THEN get(popular, 0).id END"),
    Invariant("named_brand_missing", "CASE WHEN PremiumShare >= named_share AND NOT coalesce(exists(boxes, x -> x.brand = named_brand), false) THEN "
              f"get(filter(slice(popular, 1, {POPULAR}), x -> x.brand = named_brand AND x.a), 0).id END"),
    Invariant(
        "runflats_short",
        "CASE WHEN size(filter(boxes, x -> x.at < 3 AND x.runflat)) < wanted AND exists(boxes, x -> x.at < 3 AND NOT coalesce(x.runflat, false) AND "
        "NOT coalesce(x.id = get(popular, 0).id, false) AND NOT coalesce(x.brand = named_brand, false) AND NOT coalesce(x.match, false)) "
        f"THEN {_first('pool', 'x.a AND x.runflat AND NOT array_contains(box_ids, x.id)')} END",
    ),
    Invariant("enhancer_missing", f"CASE WHEN NOT coalesce(exists(boxes, x -> x.match), false) AND NOT exists(pool, x -> x.match AND array_contains(more, x.id)) THEN {_first('pool', 'x.match')} END"),
    Invariant(
        "other_vehicle",
        "CASE WHEN exists(pool, x -> x.a AND array_contains(own_ids, x.id) AND NOT array_contains(box_ids, x.id)) THEN "
        f"{_first('boxes', 'x.at < 3 AND x.there AND x.a AND NOT x.runflat AND NOT x.match AND NOT array_contains(own_ids, x.id)')} END",
    ),
    Invariant("short_of_more", "CASE WHEN array_contains(more, '-') THEN get(filter(pool, x -> NOT array_contains(box_ids, x.id) AND NOT array_contains(more, x.id)), 0).id END"),
)


def in_context(answers: DataFrame, requests: DataFrame, scored: DataFrame, rules: Rules = Rules(), fits: DataFrame | None = None) -> DataFrame:
    """Answers with the lists and shares of their fits, and ``boxes``: place (0 to 3), id and traits of each hotbox.

    A hotbox whose product its size does not have is not ``there``.  An answer's row is joined to its fit once; the
    hotboxes are looked up by (size, id), four rows for each answer.  ``fits``: the ``scopes`` of the requests, if the caller has them.
    """
    fits = recommend.scopes(requests, scored, rules) if fits is None else fits
    facts = durable(recommend.best_rows(recommend.features(scored, rules), WIDE), "size-facts")
    prices = keyed(scored).where(is_valid_id(F.col("ProductId").cast("string"))).groupBy(*WIDE, F.col("ProductId").cast("string").alias("id")).agg(F.min("PRICE").alias("price"))
    middle = facts.where("r.a AND r.grade = 'MidRange'").select(*WIDE, "id")
    middle = grown(middle).join(prices, [*WIDE, "id"])
    cheap = best_n(middle, WIDE, [F.asc_nulls_last("price"), F.asc("id")], CHEAP, "n")
    cheap = cheap.groupBy(*WIDE).agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "id"))), lambda x: x["id"]).alias("cheap"))
    rows = keyed_requests(answers)
    long = rows.select(*ROW, *WIDE, F.posexplode(F.array(*HOTBOXES)).alias("at", "id"))
    long = grown(long).join(facts, [*WIDE, "id"], "left")
    item = F.struct("at", "id", F.col("r").isNotNull().alias("there"), *(F.col(f"r.{t}").alias(t) for t in TRAITS))
    boxes = long.groupBy(*ROW).agg(F.sort_array(F.collect_list(item)).alias("boxes"))
    df = rows.join(boxes, ROW).join(fits, NARROW).join(cheap, WIDE, "left")
    nothing = F.array().cast(df.schema["pool"].dataType)
    df = df.withColumns({"pool": F.coalesce("pool", nothing), "own_ids": F.coalesce("own_ids", F.array().cast("array<string>"))})
    makes = " OR ".join(f"startswith(vehicle_key, '{m.lower()}')" for m in rules.runflat_makes) or "false"
    steps = " ".join(f"WHEN runflat_share >= {bound} THEN {count}" for bound, count in reversed(RUNFLAT_STEPS))
    return df.select(
        *ROW, *NARROW, "boxes", F.array(*HOTBOXES).alias("box_ids"), F.array(*SKUS).alias("more"), "pool", "own_ids", "popular", "PremiumShare",
        F.expr("coalesce(cheap, CAST(array() AS array<string>))").alias("cheap"), F.expr("filter(pool, x -> x.b)").alias("pool_b"),
        F.expr(f"BudgetShare > {recommend.BUDGET_GATE}").alias("gate"), F.lit(rules.named_brand.lower()).alias("named_brand"), F.lit(rules.named_share).alias("named_share"),
        F.expr(f"CASE WHEN NOT known THEN CASE WHEN {makes} THEN {max(n for _, n in RUNFLAT_STEPS)} ELSE 0 END {steps} ELSE 0 END").alias("wanted"),
    )


def breaks(context: DataFrame, invariants: tuple[Invariant, ...] = INVARIANTS) -> DataFrame:
    """Vehicle, Size, rule and evidence of every rule that a row of ``in_context`` breaks; one pass, no shuffle."""
    found = F.array(*(F.struct(F.lit(i.name).alias("rule"), F.expr(i.evidence).alias("evidence")) for i in invariants))
    rows = context.select(*ROW, F.explode(F.filter(found, lambda x: x["evidence"].isNotNull())).alias("x"))
    return rows.select(*ROW, "x.rule", "x.evidence")


def _with(df: DataFrame, **expressions: str) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def repaired(context: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Answers with their breaks mended where the rules say how, and ``steps``, what was changed.

    In the order of the rules' priority: products of other sizes, repeats and products that their box may not hold leave
    the hotboxes; a budget tyre from a high box moves to hotbox 4 if that holds none and the gate is open, else the cheapest
    mid-range tyre takes its place; open boxes are filled with the best that may stand there; the best product that meets an enhancer takes
    hotbox 4 if the budget rules allow it, else the first further slot; the top seller and the products that lost
    their boxes follow.  A mended answer stays as it is when it is mended again.
    """
    enhanced = bool(rules.brand or rules.model or rules.season)
    df = _with(
        context,
        bad="transform(boxes, x -> CASE WHEN x.id = '-' THEN 'empty' WHEN NOT x.there THEN 'other_size' WHEN array_position(box_ids, x.id) <= x.at THEN 'repeated' "
        "WHEN x.at < 3 AND x.grade = 'Budget' THEN 'budget_too_high' WHEN x.at < 3 AND NOT x.a THEN 'not_in_set_a' WHEN x.at = 3 AND NOT x.b THEN 'not_in_set_b' "
        "WHEN x.at = 3 AND x.grade = 'Budget' AND NOT gate THEN 'budget_behind_gate' END)",
    )
    df = _with(
        df,
        high="transform(slice(boxes, 1, 3), x -> CASE WHEN bad[x.at] IS NULL THEN x.id END)",
        last="CASE WHEN bad[3] IS NULL THEN boxes[3].id END",
        last_budget="bad[3] IS NULL AND coalesce(boxes[3].grade = 'Budget', false)",
        moved="get(filter(boxes, x -> bad[x.at] = 'budget_too_high'), 0)",
    )
    # Hotbox 4: what it has, unless the gate asks for a budget tyre.
    df = _with(df, open_b="filter(pool_b, x -> NOT coalesce(array_contains(high, x.id), false))")
    df = _with(
        df,
        four="CASE WHEN last_budget THEN last WHEN gate AND coalesce(moved.b, false) THEN moved.id "
        "WHEN gate THEN coalesce(get(filter(open_b, x -> x.grade = 'Budget'), 0).id, last) ELSE last END",
    )
    # Hotboxes 1 to 3: a budget tyre that finds no box is swapped for the cheapest mid-range one.
    df = _with(
        df,
        swap="CASE WHEN moved IS NOT NULL AND NOT coalesce(moved.id = four, false) THEN slice(filter(cheap, x -> NOT coalesce(array_contains(high, x), false) "
        "AND NOT coalesce(x = four, false)), 1, 1) ELSE CAST(array() AS array<string>) END",
    )
    df = _with(
        df,
        spare="array_distinct(concat(swap, transform(filter(pool, x -> x.a AND NOT coalesce(array_contains(high, x.id), false) AND NOT coalesce(x.id = four, false)), x -> x.id)))",
    )
    df = _with(df, high="transform(high, (x, i) -> coalesce(x, get(spare, size(filter(slice(high, 1, i), y -> y IS NULL)))))")
    df = _with(df, four="coalesce(four, get(filter(pool_b, x -> x.grade <> 'Budget' AND NOT coalesce(array_contains(high, x.id), false)), 0).id)")
    # The enhancer.
    if enhanced:
        df = _with(
            df,
            held="exists(pool, x -> x.match AND (coalesce(array_contains(high, x.id), false) OR coalesce(x.id = four, false)))",
            wish="get(filter(pool_b, x -> x.match AND gate = (x.grade = 'Budget') AND NOT coalesce(array_contains(high, x.id), false)), 0).id",
            best="get(filter(pool, x -> x.match), 0).id",
        )
        df = _with(df, front="CASE WHEN NOT held AND wish IS NULL AND best IS NOT NULL THEN array(best) ELSE CAST(array() AS array<string>) END",
                   four="CASE WHEN NOT held AND wish IS NOT NULL THEN wish ELSE four END")
    else:
        df = _with(df, front="CAST(array() AS array<string>)")
    df = _with(df, now="transform(concat(high, array(four)), x -> coalesce(x, '-'))")
    # The rest: the top seller if no slot has it, then what lost its box, the answer's own, and the pool.
    df = _with(
        df,
        front="CASE WHEN array_contains(concat(now, more, front), get(popular, 0).id) OR get(popular, 0) IS NULL THEN front ELSE concat(front, array(get(popular, 0).id)) END",
        lost="transform(filter(boxes, x -> x.there AND NOT array_contains(now, x.id)), x -> x.id)",
    )
    df = _with(
        df,
        rest="array_distinct(filter(concat(front, lost, more, transform(pool, x -> x.id)), x -> x <> '-' AND NOT array_contains(now, x)))",
        steps="concat(transform(filter(sequence(0, 3), i -> box_ids[i] <> now[i]), i -> concat('HB', CAST(i + 1 AS STRING), ' ', coalesce(bad[i], 'moved'), ': ', box_ids[i], ' > ', now[i])), "
        "transform(filter(front, x -> get(more, 0) <> x), x -> concat('SKU ', x)))",
    )
    slots = F.concat("now", padded(F.col("rest"), MORE, "-"))
    return df.select(*ROW, *as_columns(slots, [*HOTBOXES, *SKUS]), F.array_join("steps", "; ").alias("steps"))

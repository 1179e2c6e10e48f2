"""Expressions over the bounded slot list of one row (4 hotboxes and up to 24 more)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from treadmark.functions.text import BLANK

VALID_ID = "^[0-9]{7,8}$"
HOTBOXES = tuple(f"HB{i}" for i in range(1, 5))
SKUS = tuple(f"SKU{i}" for i in range(1, 21))
SLOTS = HOTBOXES + SKUS


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once: lambdas would compute it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Tokens between blanks; no empty tokens."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), lambda t: t != "")


def padded(items: Column, width: int, filler: str) -> Column:
    """Exactly ``width`` items: cut, or filled up on the right."""
    return F.slice(F.concat(items, F.array_repeat(F.lit(filler), width)), 1, width)


def as_columns(items: Column, names: Sequence[str]) -> list[Column]:
    return [F.get(items, F.lit(i)).alias(name) for i, name in enumerate(names)]


def is_valid_id(c: Column) -> Column:
    return F.coalesce(c.rlike(VALID_ID), F.lit(False))


def _trimmed(items: Column) -> Column:
    return F.transform(items, lambda x: F.trim(x))


def blank_repeats(items: Column) -> Column:
    """Later repeats of an id become '-'; blanks and dashes are left alone."""

    def keep(trimmed: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            t = F.trim(x)
            first = F.array_position(trimmed, t) == (i + 1).cast("bigint")
            return F.when(x.isNull() | t.isin("", "-") | first, x).otherwise(F.lit("-"))

        return F.transform(items, one)

    return let(_trimmed(items), keep)


def repeat_count(items: Column) -> Column:
    ids = F.filter(F.transform(items, lambda x: F.trim(x)), lambda t: ~t.isin("", "-"))
    return (F.size(ids) - F.size(F.array_distinct(ids))).cast("bigint")


def kept_ids(slots: Column) -> Column:
    """Valid ids at their first place; every other slot NULL."""

    def keep(trimmed: Column) -> Column:
        return F.transform(
            trimmed,
            lambda x, i: F.when(is_valid_id(x) & (F.array_position(trimmed, x) == (i + 1).cast("bigint")), x),
        )

    return let(_trimmed(slots), keep)


def backfilled(slots: Column, candidates: Column) -> Column:
    """Holes take the next unused candidate in order, then '-'."""

    def fill(both: Column) -> Column:
        kept, unused = both["kept"], both["unused"]

        def one(x: Column, i: Column) -> Column:
            hole = F.size(F.filter(F.slice(kept, F.lit(1), i + 1), lambda y: y.isNull()))
            return F.coalesce(x, F.get(unused, hole - 1), F.lit("-"))

        return F.transform(kept, one)

    def unused(kept: Column) -> Column:
        left = F.array_except(F.filter(candidates, is_valid_id), F.filter(kept, lambda x: x.isNotNull()))
        return F.struct(kept.alias("kept"), left.alias("unused"))

    return let(let(kept_ids(slots), unused), fill)


def strict_id(c: Column) -> Column:
    """Eight characters after dropping a trailing '.0', else NULL."""
    text = F.when(F.coalesce(c, F.lit("")).isin("-") | (F.lower(c) == "nan"), F.lit("")).otherwise(c)
    text = F.trim(F.regexp_replace(text, r"\.0$", ""))
    return F.when(F.length(text) == 8, text)


def digit_tokens(text: Column) -> Column:
    return F.filter(words(text), lambda t: t.rlike("^[0-9]+$"))


def digit_or_dash_tokens(text: Column) -> Column:
    return F.filter(words(text), lambda t: t.rlike("^([0-9]+|-)$"))


def missing_from(reference: Column, got: Column) -> Column:
    """Items of ``reference`` not in ``got``: order and repeats are kept."""
    return F.filter(reference, lambda x: ~F.array_contains(got, x))


def out_of_order(reference: Column, got: Column) -> Column:
    """Common items that come before their left neighbour in ``reference``.

    A repeated reference item counts at its last place.
    """
    def places(both: Column) -> Column:
        # each common item with its place counted from the end, found once
        return F.transform(both["common"], lambda x: F.struct(x.alias("x"), F.array_position(both["backwards"], x).alias("p")))

    def moved(placed: Column) -> Column:
        later = F.filter(placed, lambda e, i: (i > 0) & (e["p"] > F.get(placed, i - 1)["p"]))
        return F.transform(later, lambda e: e["x"])

    common = F.filter(got, lambda x: F.array_contains(reference, x))
    return let(let(F.struct(common.alias("common"), F.reverse(reference).alias("backwards")), places), moved)


def missing_slots(slots: Column) -> Column:
    bad = F.filter(
        F.transform(slots, lambda x: F.trim(F.coalesce(x, F.lit("nan")))), lambda t: t.isin("-", "", "nan")
    )
    return F.size(bad).cast("bigint")


def numeric_ids(slots: Column) -> Column:
    return F.filter(F.transform(slots, lambda x: F.trim(x)), lambda t: t.rlike("^[0-9]+$"))


def all_distinct(items: Column) -> Column:
    return F.size(items) == F.size(F.array_distinct(items))

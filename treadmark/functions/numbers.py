"""Rounding, safe casts and order-independent averages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(20,6)"


def round_away(c: Column, places: int) -> Column:
    """Half away from zero, by floor, so that engines agree on near-ties."""
    factor = float(10**places)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(factor) + F.lit(0.5)) / F.lit(factor)


def exact_sum(c: Column) -> Column:
    """Sum through decimals: the result does not depend on task order."""
    return F.sum(c.cast(MONEY)).cast("double")


def exact_avg(c: Column) -> Column:
    return exact_sum(c) / F.nullif(F.count(c), F.lit(0)).cast("double")


def try_long(c: Column) -> Column:
    """Whole number in the text, else NULL.

    The pattern comes first because a failing cast costs an exception per row.
    """
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c.try_cast("bigint"))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` in doubles, NULL for a zero or NULL divisor."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def share_percent(part: Column, total: Column) -> Column:
    return round_away(safe_ratio(part, total) * F.lit(100.0), 2)


def clamped(value: float, low: float, high: float, default: float) -> float:
    """A job argument outside its bounds falls back to the default."""
    return value if low <= value <= high else default

"""Attribute points, weights and percentile tiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Points per label letter, weights, tier bounds.
LETTER_POINTS = (("A", 10.0), ("B", 9.0), ("C", 5.0), ("D", 2.5), ("E", 1.0))
NOISE_POINTS = (("-A", 10.0), ("-B", 5.0), ("-C", 1.0))
WEIGHTS = (("award", 1.00), ("fuel", 1.00), ("noise", 0.10), ("oe", 1.00), ("review", 0.50), ("wet_grip", 0.50))
TIERS = (
    (25, "1.BEST TYRE SCORE"),
    (50, "2.BETTER TYRE SCORE"),
    (75, "3.GOOD TYRE SCORE"),
    (90, "4.FAIR TYRE SCORE"),
)
LAST_TIER = "Unclassified"
NO_SALES = "NO SALES YET"


def _first_match(cases: list[tuple[Column, object]], default: object) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out.otherwise(F.lit(default))


def letter_points(c: Column) -> Column:
    return _first_match([(c == letter, points) for letter, points in LETTER_POINTS], 0.0)


def noise_points(c: Column) -> Column:
    return _first_match([(c.endswith(suffix), points) for suffix, points in NOISE_POINTS], 0.0)


def flag_points(c: Column, value: str) -> Column:
    return F.when(c == value, F.lit(10.0)).otherwise(F.lit(0.0))


def attribute_points(award: Column, fuel: Column, noise: Column, oe: Column, wet_grip: Column) -> dict[str, Column]:
    return {
        "award": flag_points(award, "Award"),
        "fuel": letter_points(fuel),
        "noise": noise_points(noise),
        "oe": flag_points(oe, "Yes"),
        "review": F.lit(0.0),
        "wet_grip": letter_points(wet_grip),
    }


def weighted_total(points: dict[str, Column]) -> Column:
    """Sum of weighted points, always added in the same order."""
    total = None
    for name, weight in WEIGHTS:
        term = points[name] * F.lit(weight)
        total = term if total is None else total + term
    return total


def tier_label(percentile: Column) -> Column:
    return _first_match([(percentile <= bound, label) for bound, label in TIERS], LAST_TIER)


def runflat_label(run_flat: Column) -> Column:
    return F.when(F.lower(run_flat) == "runflat", F.lit("Runflat")).otherwise(F.lit("Non-Runflat"))


def or_no_sales(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NO_SALES))


def click_rate(orders: Column, views: Column) -> Column:
    """Orders per list view in percent; 1 or more is replaced by 0.14."""
    from treadmark.functions.numbers import round_away, safe_ratio

    percent = safe_ratio(orders, views) * F.lit(100.0)
    return round_away(
        F.when(percent.isNull(), F.lit(0.0)).when(percent >= 1, F.lit(0.14)).otherwise(percent), 3
    )

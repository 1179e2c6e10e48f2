"""Labels read from one clickstream item."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from treadmark.functions.numbers import try_long

# Code prefixes (% = anything) and their journey label, tried in
# this order.  Some later entries are shadowed by earlier ones; the order is
# part of the result.
JOURNEY_RULES = (
    ("PSUCMM-AIM%", "AIM U - SWITCH"),
    ("SUCMM-AIM%", "AIM U"),
    ("PXSUCMM-AIM%", "AIM U - SWITCH"),
    ("XSUCMM-AIM%", "AIM U"),
    ("%-AIM%", "AIM"),
    ("PSCMM-AIM%", "AIM - SWITCH"),
    ("SUCMM%", "CAM WAVES U"),
    ("SUCMM-MAN%", "CAM WAVES U"),
    ("XSUCMM%", "CAM WAVES U"),
    ("SUCMM-NONCAM%", "CAM WAVES U"),
    ("PSUCMM%", "CAM WAVES U - SWITCH"),
    ("PSUCMM-MAN%", "CAM WAVES U - SWITCH"),
    ("PXSUCMM%", "CAM WAVES U - SWITCH"),
    ("PSUCMM-NONCAM%", "CAM WAVES U - SWITCH"),
    ("XSUCMM-NONCAM%", "CAM U"),
    ("SUCMM-NONCAM%", "CAM U"),
    ("XUCMM-NONCAM%", "CAM U"),
    ("PXSUCMM-NONCAM%", "CAM U - SWITCH"),
    ("PSUCMM-NONCAM%", "CAM U - SWITCH"),
    ("PXUCMM-NONCAM%", "CAM U - SWITCH"),
    ("UCMM%", "CAM U"),
    ("XUCMM%", "CAM U"),
    ("UCMM-NONCAM%", "CAM U"),
    ("PUCMM%", "CAM U - SWITCH"),
    ("PXUCMM%", "CAM U - SWITCH"),
    ("PUCMM-NONCAM%", "CAM U - SWITCH"),
    ("SCMM%", "CAM WAVES"),
    ("PSCMM%", "CAM WAVES - SWITCH"),
    ("CMM%", "CAM"),
    ("PCMM%", "CAM - SWITCH"),
)
NO_REGISTRATION = "NO VRM SEARCH"
SIZE_JOURNEY = "SIZE"
DEFAULT_JOURNEY = "NON MERCH VRM"
# Page tokens whose views are not counted.
EXCLUDED_PAGES = (
    "fitfast", "truck", "manufacturer", "seasonal", "runflat", "reinforced", "loadratings", "carmanufacturer",
    "speedratings", "staging", "inforgen",
)


def journey_label(code: Column, vehicle_text: Column) -> Column:
    upper = F.upper(code)
    out = None
    for pattern, label in JOURNEY_RULES:
        test = upper.like(pattern)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.when(F.upper(F.trim(vehicle_text)) == NO_REGISTRATION, SIZE_JOURNEY).otherwise(DEFAULT_JOURNEY)


def slot_position(index: Column) -> Column:
    """List index as a slot: 200 is slot 4, text that is no number is NULL."""
    number = try_long(index)
    return F.when(number == 200, F.lit(4).cast("bigint")).otherwise(number)


def placement_label(index: Column) -> Column:
    number = try_long(index)
    return (
        F.when(number.between(1, 3), F.concat(F.lit("Hotbox "), number.cast("string")))
        .when(number.isin(4, 200), F.lit("Hotbox 4"))
        .when(number == 99, F.lit("BrandSelector"))
        .otherwise(F.lit("Waves"))
    )


def placement_rank(label: Column) -> Column:
    """Smaller is better: hotbox number, then BrandSelector, then the rest."""
    number = try_long(F.nullif(F.regexp_extract(label, r"Hotbox (\d+)", 1), F.lit("")))
    return F.coalesce(number, F.when(label == "BrandSelector", F.lit(99)).otherwise(F.lit(100)).cast("bigint"))


def counted_page(url: Column) -> Column:
    """True unless the URL names an excluded page; a NULL URL is not counted."""
    return ~url.rlike("|".join(EXCLUDED_PAGES))


def param(params: Column, key: str) -> Column:
    """String value of ``key`` in a repeated key/value field, NULL when absent."""
    return F.get(F.filter(params, lambda p: p["key"] == key), F.lit(0))["value"]["string_value"]


def token_bucket(position: Column) -> Column:
    return F.when(
        position.between(1, 4), F.concat(F.lit("Hotbox "), position.cast("string"))
    ).otherwise(F.lit("Waves"))

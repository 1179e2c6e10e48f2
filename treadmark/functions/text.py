"""Column expressions for keys, sizes and labels.

Every function takes and returns a Column and stays inside generated JVM code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode blanks, as a character class for Java patterns.
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"
SIZE_PART_RE = r"^\d+/\d+\s*[A-Z]?\d+"
STRIPPED_SIZE_RE = r"^(\d+/\d+\s*R\d+)"
# The four written forms of a tyre size.
SIZE_FORMS = (
    r"\d{3}/\d{2}\s*[A-Z]{0,2}R\d{2}",
    r"\d{2}/\d{3,4}(?:\.\d{2})?\s*[A-Z]{0,2}R\d{2}",
    r"\d{1,2}\.\d{2}\s*[A-Z]{0,2}R\d{2}",
    r"\d{1,2}x\d{2}\.\d{2}\s*[A-Z]{0,2}R\d{2}",
)
STRICT_SIZE_RE = r"^\s*\d{3}\s*/\s*\d{2}\s*[A-Z]*\s*R\s*\d{2}\s*$"


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``, NULL (not '') when there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def blank_to_null(c: Column, *also: str) -> Column:
    """Trimmed text with '' and each value of ``also`` turned into NULL."""
    out = F.nullif(F.trim(c), F.lit(""))
    for value in also:
        out = F.nullif(out, F.lit(value))
    return out


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BLANK + "+", " "))


def alnum_key(c: Column) -> Column:
    """Join key: lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]", "")


def compare_key(c: Column) -> Column:
    """Key used when matching free text; NULL compares as ''."""
    return F.coalesce(F.regexp_replace(F.lower(c), "[^a-z0-9]", ""), F.lit(""))


def upper_stripped(c: Column) -> Column:
    """Upper case without blanks, slashes and dashes; NULL becomes ''."""
    return F.coalesce(F.upper(F.regexp_replace(c, r"[\s/-]+", "")), F.lit(""))


def size_key(c: Column) -> Column:
    """Lower case, no spaces; the key candidates are looked up by."""
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit(""))


def vehicle_key(c: Column) -> Column:
    """Lower case, letters and digits of any script."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def sales_vehicle(make: Column, model: Column) -> Column:
    """Vehicle label of the sales file: make and model run together, upper case."""
    return F.trim(F.upper(F.concat(make, model)))


def click_vehicle(c: Column) -> Column:
    """Vehicle label of the clickstream: upper case, no spaces."""
    return F.upper(F.replace(c, F.lit(" "), F.lit("")))


def size_part(size: Column) -> Column:
    return extract(size, SIZE_PART_RE, 0)


def stripped_size(size: Column) -> Column:
    return extract(size, STRIPPED_SIZE_RE)


def list_id_size(list_id: Column) -> Column:
    """``205-55-16`` -> ``205/55/16 R16`` (the rim is repeated on purpose)."""
    return F.concat(F.replace(list_id, F.lit("-"), F.lit("/")), F.lit(" R"), extract(list_id, r"(\d+)$"))


def report_width(size: Column) -> Column:
    return extract(size, r"^(\d+)")


def report_profile(size: Column) -> Column:
    return extract(size, r"/(\d+)\s")


def report_rim(size: Column) -> Column:
    return extract(size, r"R(\d+)$")


def upsert_width(size: Column) -> Column:
    return extract(F.upper(size), r"^\s*(\d{3})")


def upsert_profile(size: Column) -> Column:
    return extract(F.upper(size), r"^\s*\d{3}\s*/\s*(\d{2})")


def upsert_rim(size: Column) -> Column:
    return extract(F.upper(size), r"R\s*(\d{2})\s*$")


LOOSE_SIZE_RE = r"(\d{2,3})[/\\](\d{2,3}(?:\.\d+)?)\s*[A-Z]*\s*(\d{2})"


def loose_size(size: Column, part: int) -> Column:
    """Width (1), profile (2) or rim (3) of a size written either way round."""
    return extract(F.upper(size), LOOSE_SIZE_RE, part)


def cam_key(make: Column, model: Column, width: Column, profile: Column, rim: Column, mode: str = "alnum") -> Column:
    """Make/model/size key; NULL when any part is NULL.

    mode ``alnum`` keeps letters and digits; ``spaces`` only drops blanks;
    ``capitals`` drops everything but lower-case letters and digits before
    upper-casing, a historic variant that almost never matches.
    """
    return cam_text(F.concat(make, model, width, profile, rim), mode)


def cam_text(text: Column, mode: str = "alnum") -> Column:
    if mode == "alnum":
        return F.upper(alnum_key(text))
    if mode == "spaces":
        return F.upper(F.regexp_replace(F.trim(text), r"\s+", ""))
    if mode == "capitals":
        return F.upper(F.regexp_replace(F.trim(text), "[^a-z0-9]", ""))
    raise ValueError(f"unknown key mode {mode!r}")


def takeover_slug(make: Column, model: Column, width: Column, profile: Column, rim: Column) -> Column:
    dash = F.lit("-")

    def packed(c: Column) -> Column:
        return F.regexp_replace(c, r"\s+", "")

    return F.lower(F.concat(F.lit("aim-"), packed(make), dash, packed(model), dash, width, dash, profile, dash, rim))


def product_label(maker: Column, model: Column, product_id: Column) -> Column:
    return F.concat(
        F.coalesce(maker, F.lit("")), F.lit("-"), F.coalesce(model, F.lit("")), F.lit("-"), product_id.cast("string")
    )


def page_token(url: Column) -> Column:
    """Text after the first '=' up to '&' or '?'; NULL when there is no '='."""
    return F.when(F.contains(url, F.lit("=")), F.regexp_extract(url, "=([^&?]*)", 1))


def title_words(c: Column) -> Column:
    return F.initcap(squeeze(c))


def token_estimate(c: Column) -> Column:
    return F.floor(F.length(c) / 4).cast("bigint")


def spaced_size(c: Column) -> Column:
    """A blank before the construction letters: ``225/40ZR18`` -> ``225/40 ZR18``."""
    return squeeze(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)(?<=\d)([A-Z]{0,2})R(?=\d)", " $1R"))


_CORE_RE = r"(?is)^(.*?)\b(" + "|".join(SIZE_FORMS) + r")\b(.*)$"


def repaired_vehicle_size(vehicle: Column, size: Column) -> Column:
    """struct(Vehicle, Size) with a size found in the wrong field moved home.

    Text before the size in the Size field belongs to the vehicle; when the
    Size field has no size at all, one is looked for in the vehicle name.
    """
    v = F.trim(F.coalesce(vehicle, F.lit("")))
    s = F.trim(F.coalesce(size, F.lit("")))
    in_size, in_vehicle = s.rlike(_CORE_RE), v.rlike(_CORE_RE)
    lead = F.trim(F.regexp_extract(s, _CORE_RE, 1))
    new_size = (
        F.when(in_size, F.regexp_extract(s, _CORE_RE, 2))
        .when(in_vehicle, F.regexp_extract(v, _CORE_RE, 2))
        .otherwise(s)
    )
    new_vehicle = (
        F.when(in_size, F.concat_ws(" ", v, F.nullif(lead, F.lit(""))))
        .when(in_vehicle, F.concat_ws(" ", F.regexp_extract(v, _CORE_RE, 1), F.regexp_extract(v, _CORE_RE, 3)))
        .otherwise(v)
    )
    spaced = squeeze(F.regexp_replace(new_vehicle, r"(?<=[A-Za-z])(?=\d)", " "))
    return F.struct(spaced.alias("Vehicle"), spaced_size(new_size).alias("Size"))


def is_named(c: Column) -> Column:
    """False for names that stand for nothing: nan, none, blank.  NULL is kept."""
    return ~F.coalesce(F.lower(c).isin("nan", "", "none"), F.lit(False))


def spread_null(key: Column, *identity: Column, parts: int) -> Column:
    """Join key whose NULLs are spread over ``parts`` values that match nothing.

    A left join sends all NULL keys to one task; this keeps them apart.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*identity), F.lit(parts)).cast("string")))

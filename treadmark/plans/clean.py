"""Answers to slot requests: reading, repairing, de-duplicating, reconciling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treadmark.functions import lists, parsing
from treadmark.functions.lists import HOTBOXES, SKUS
from treadmark.functions.text import loose_size, repaired_vehicle_size, title_words
from treadmark.operators.lookup import longest_prefix
from treadmark.operators.topk import best_one

SKUS_24 = tuple(f"SKU{i}" for i in range(1, 25))


def parse_outputs(raw: DataFrame) -> DataFrame:
    """``ids`` and the names read from each answer, trying the strict reading first.

    ``tier`` tells which reading gave the line: strict, loose, or plain.
    """
    text, vehicle, size = F.col("raw_text"), F.col("Vehicle"), F.col("Size")
    tried = raw.withColumn("strict", parsing.strict_line(text, vehicle, size)).withColumn(
        "loose", F.when(F.col("strict").isNull(), parsing.loose_line(text, vehicle, size))
    )
    read = tried.withColumn("line", F.coalesce("strict", "loose", "raw_text")).withColumn(
        "parsed", parsing.lenient_line(F.col("line"))
    )
    tier = F.when(F.col("strict").isNotNull(), "strict").when(F.col("loose").isNotNull(), "loose").otherwise("plain")
    return read.select(
        *raw.columns, tier.alias("tier"), "line", F.col("parsed.vehicle").alias("parsed_vehicle"),
        F.col("parsed.size").alias("parsed_size"), F.col("parsed.ids").alias("ids"),
    )


def hotbox_success(ids: Column) -> Column:
    return F.forall(F.slice(ids, 1, 4), lists.is_valid_id) & (F.size(ids) >= 4)


def backfill(parsed: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Holes of every answer filled from ``candidates`` (keys, ranked ids as an array).

    The answer keeps the requested names.  ``error_code`` says why there is no
    full set of hotboxes; ``success`` needs four valid hotbox ids.
    """
    rows = parsed.join(candidates, keys, "left").withColumn(
        "slots", lists.backfilled(F.col("ids"), F.coalesce("candidate_ids", F.array().cast("array<string>")))
    )
    missing = F.coalesce(F.contains("line", F.lit("NoDataError")), F.lit(False))
    # A row without a name is no request at all.
    invalid = F.coalesce(F.lower("Vehicle"), F.lit("")).isin("", "nan") | F.coalesce(F.lower("Size"), F.lit("")).isin("", "nan")
    ok = hotbox_success(F.col("slots")) & ~missing & ~invalid
    filled = lists.padded(F.col("slots"), parsing.PRODUCTS, "-")
    boxes = F.concat(F.array_repeat(F.lit("Error"), 4), F.array_repeat(F.lit("-"), 20))
    code = (
        F.when(invalid, "INVALID_INPUT").when(missing, "NO_RESULTS").when(~ok, "UPSTREAM_ERROR")
    )
    final = rows.withColumn("slots", F.when(missing | invalid, boxes).otherwise(filled))
    return final.select(
        *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("Unknown")).alias(c) for c in ("Vehicle", "Size")],
        *lists.as_columns(F.col("slots"), [*HOTBOXES, *SKUS]), ok.alias("success"), code.alias("error_code")
    )


def failure_code(message: Column) -> Column:
    """Outcome code of a failed request from its error text."""
    upper = F.upper(message)
    return (
        F.when(F.contains(upper, F.lit("TIMEOUT")), "TIMEOUT")
        .when(F.contains(upper, F.lit("API")), "UPSTREAM_ERROR")
        .otherwise("INTERNAL_ERROR")
    )


def batch_outcomes(batched: DataFrame, failed: Column) -> DataFrame:
    """Outcome of every request of a run in batches: all requests of a batch that ``failed`` after its retries fail with it."""
    return batched.withColumn("success", ~failed).withColumn("error_code", F.when(failed, "BATCH_FAILED"))


def flattened(pages: DataFrame) -> DataFrame:
    """Pages of answers (page number and an array of records) as one row per record, in order."""
    rows = pages.select("page", "Segment", F.posexplode("items").alias("at", "item"))
    return rows.select(
        F.struct("page", "at").alias("position"), "Segment", *[f"item.{c}" for c in ("Vehicle", "Size", *HOTBOXES)],
        F.array_join("item.SKUs", " ").alias("SKUs"), F.coalesce("item.success", F.lit(False)).alias("success"),
    )


def wide_results(results: DataFrame) -> DataFrame:
    """Answer records to 24 product columns, names repaired, repeats blanked.

    Rows with FormatError in any field are dropped, and of each (Vehicle, Size)
    the first by ``position`` is kept.  ``repeats`` counts the blanked cells.
    """
    # The bad rows go first: a filter after the columns were laid out would be
    # pushed through them and repeat their expressions for every column.
    cells = lists.padded(lists.words(F.col("SKUs")), len(SKUS_24), "")
    rows = results.withColumn("_cells", cells).withColumn(
        "_name", repaired_vehicle_size(F.col("Vehicle"), F.col("Size"))
    )
    every = F.concat(F.array("_name.Vehicle", "_name.Size", *HOTBOXES), F.col("_cells"))
    bad = F.exists(every, lambda c: F.coalesce(F.contains(c, F.lit(parsing.FORMAT_ERROR)), F.lit(False)))
    first = best_one(
        rows.where(~bad).select("position", "_name.Vehicle", "_name.Size", *HOTBOXES, "_cells"),
        ["Vehicle", "Size"], [F.asc("position")],
    )
    unique = first.withColumn("_unique", lists.blank_repeats(F.col("_cells")))
    return unique.select(
        "position", "Vehicle", "Size", *HOTBOXES, *lists.as_columns(F.col("_unique"), SKUS_24),
        lists.repeat_count(F.col("_cells")).alias("repeats"),
    )


def make_and_model(names: DataFrame, makes: DataFrame) -> DataFrame:
    """Each distinct Vehicle split into make and model by the longest known make."""
    distinct = names.select("Vehicle").distinct().withColumn("_upper", F.upper("Vehicle"))
    found = longest_prefix(distinct, "_upper", makes, "Make").withColumnRenamed("Make", "_make")
    rest = F.trim(F.substring(F.col("Vehicle"), F.length("_make") + 1, F.length("Vehicle") + 1))
    return distinct.join(found, "_upper", "left").select(
        "Vehicle",
        title_words(F.coalesce("_make", F.lit("Unknown"))).alias("Make"),
        title_words(F.when(F.col("_make").isNull(), F.col("Vehicle")).otherwise(rest)).alias("Model"),
    )


def cam_rows(wide: DataFrame, makes: DataFrame) -> DataFrame:
    """Rows keyed by make, model, width, profile and rim with 24 eight-character ids."""
    split = make_and_model(wide, makes)
    return wide.join(split, "Vehicle").select(
        "Vehicle", "Size", "Make", "Model",
        *[loose_size(F.col("Size"), i).alias(n) for i, n in enumerate(("Width", "Profile", "Rim"), start=1)],
        *[lists.strict_id(F.col(c)).alias(c) for c in SKUS_24],
    )


def reconciled(first: DataFrame, retry: DataFrame, key: str = "position") -> DataFrame:
    """First answers, each failed one replaced by its retry when that succeeded."""
    a, b = first.alias("a"), retry.alias("b")
    use = ~F.coalesce("a.success", F.lit(False)) & F.coalesce("b.success", F.lit(False))
    columns = [
        F.when(use, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in first.columns if c != key
    ]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "left").select(F.col(f"a.{key}").alias(key), *columns)

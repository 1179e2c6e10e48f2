"""Checks and analyses of answers, runs and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from treadmark.functions import lists
from treadmark.functions.numbers import round_away, safe_ratio
from treadmark.functions.lists import HOTBOXES, SKUS, SLOTS
from treadmark.operators.counts import join_on
from treadmark.operators.position import page, with_position
from treadmark.operators.topk import best_n, best_one, running_rank
from treadmark.session import durable

CONFIG = ["Model", "Search_Enabled", "Thinking_Budget"]
# List prices in USD per million tokens (in, out), and GBP for the job report.
RUN_PRICES = (("gemini-2.5-flash", 0.30, 2.50), ("gemini-2.5-flash-lite", 0.10, 0.40))
JOB_PRICE = (0.072505, 0.29002)
TARGET_SLOTS = 20


def successful(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("Success"))


def consistency(runs: DataFrame) -> DataFrame:
    """Share of the most frequent answer among the successful runs of each setting."""
    keys = [*CONFIG, "Vehicle", "Size"]
    answer = F.array_join(lists.digit_or_dash_tokens(F.col("Generated_SKUs")), " ")
    counted = successful(runs).groupBy(*keys, answer.alias("answer")).agg(F.count("*").alias("n"))
    return counted.groupBy(*keys).agg(
        F.sum("n").alias("runs"),
        F.count("*").alias("answers"),
        (safe_ratio(F.max("n"), F.sum("n")) * 100.0).alias("share"),
    ).withColumn("consistency_pct", round_away(F.col("share"), 2)).drop("share")


def _sku_counts(runs: DataFrame, keys: list[str]) -> DataFrame:
    rows = successful(runs).select(*keys, F.explode(lists.digit_tokens(F.col("Generated_SKUs"))).alias("sku"))
    return rows.groupBy(*keys, "sku").agg(F.count("*").alias("n"))


def top_skus(runs: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` most frequent products of every key; ties by product."""
    return best_n(_sku_counts(runs, keys), keys, [F.desc("n"), F.asc("sku")], n)


def sku_universe(runs: DataFrame) -> DataFrame:
    return (
        successful(runs).select(F.explode(lists.digit_tokens(F.col("Generated_SKUs"))).alias("sku")).distinct()
    )


def sku_metadata(scored: DataFrame, universe: DataFrame) -> DataFrame:
    """One metadata row per answered product: the vehicle row with most units."""
    columns = ["TyreScore", "GRADE", "BRAND", "Model", "PRICE", "SalesStatus", "Units"]
    rows = scored.select(F.col("ProductId").cast("string").alias("sku"), *columns)
    used = rows.join(universe, "sku", "left_semi")
    return best_one(used, ["sku"], [F.desc("Units"), *[F.asc_nulls_first(c) for c in columns if c != "Units"]])


def unmatched_skus(scored: DataFrame, runs: DataFrame) -> DataFrame:
    universe = durable(sku_universe(runs), "universe")  # read twice
    # the scored rows are cut to the answered products before they are held against them
    known = scored.select(F.col("ProductId").cast("string").alias("sku")).join(universe, "sku", "left_semi").distinct()
    return universe.join(known, "sku", "left_anti")


def quality(runs: DataFrame, scored: DataFrame) -> DataFrame:
    """Mean number and percentage of best-tier products per setting, over successful runs."""
    # Counted per setting and product before the join, so a product answered in
    # a third of all runs is one row per setting.
    counts = durable(_sku_counts(runs, CONFIG), "sku-counts")  # the runs' products are taken apart once
    grades = sku_metadata(scored, durable(counts.select("sku").distinct(), "universe")).select("sku", F.col("TyreScore").alias("grade"))
    graded = counts.join(grades, "sku", "left").withColumn("grade", F.coalesce("grade", F.lit("Unknown")))
    best = graded.groupBy(*CONFIG).agg(
        F.sum(F.when(F.contains(F.upper("grade"), F.lit("BEST")), F.col("n")).otherwise(0)).alias("best")
    )
    totals = successful(runs).groupBy(*CONFIG).agg(F.count("*").alias("runs"))
    mean = F.coalesce(F.col("best"), F.lit(0)).cast("double") / F.col("runs").cast("double")
    return join_on(totals, best, CONFIG, match_null=True).select(
        *CONFIG, round_away(mean, 4).alias("best_count"),
        round_away(mean / F.lit(float(TARGET_SLOTS)) * 100.0, 4).alias("best_pct"), "runs",
    )


def richness(runs: DataFrame) -> DataFrame:
    return _sku_counts(runs, CONFIG).groupBy(*CONFIG).agg(F.count("*").alias("unique_skus"))


def price_table(spark: SparkSession, prices=RUN_PRICES) -> DataFrame:
    return spark.createDataFrame(list(prices), "Model string, price_in double, price_out double")


def run_cost(runs: DataFrame, prices: DataFrame) -> DataFrame:
    """Tokens and cost per model; a model without a list price costs nothing."""
    usage = runs.groupBy("Model").agg(
        F.count("*").alias("runs"), F.sum("Input_Tokens").alias("tokens_in"), F.sum("Output_Tokens").alias("tokens_out")
    )
    cost = F.col("tokens_in") / 1e6 * F.coalesce("price_in", F.lit(0.0)) + F.col("tokens_out") / 1e6 * F.coalesce(
        "price_out", F.lit(0.0)
    )
    return usage.join(prices, "Model", "left").select(
        "Model", "runs", "tokens_in", "tokens_out", round_away(cost, 5).alias("cost")
    )


def job_cost(runs: DataFrame, run_id: str, mode: str) -> DataFrame:
    """The one-row cost report of a job."""
    tokens_in, tokens_out = F.sum("Input_Tokens"), F.sum("Output_Tokens")
    cost = tokens_in * (JOB_PRICE[0] / 1e6) + tokens_out * (JOB_PRICE[1] / 1e6)
    return runs.agg(
        F.lit(run_id).alias("run_id"), F.lit(mode).alias("mode"), F.count("*").alias("cams_attempted"),
        F.count_if("Success").alias("cams_succeeded"), tokens_in.alias("prompt_token_count"),
        tokens_out.alias("candidates_token_count"), F.sum("Total_Tokens").alias("total_token_count"),
        round_away(cost, 5).alias("estimated_cost_gbp"),
    )


def outcome_counts(results: DataFrame, batch_size: int, position: str = "position") -> DataFrame:
    """Attempted, succeeded and failed per batch, with the running totals.

    ``position`` is 0-based.  The running totals go over one row per batch,
    added up in two levels: blocks of batches first, so that the only window
    over everything has one row per block.
    """
    block = 10_000
    batches = results.groupBy(F.floor(F.col(position) / batch_size).cast("bigint").alias("batch")).agg(
        F.count("*").alias("attempted"),
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.coalesce(F.col("success"), F.lit(False))).alias("failed"),
    ).withColumn("block", F.floor(F.col("batch") / block))
    measures = ("attempted", "succeeded", "failed")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = batches.groupBy("block").agg(*[F.sum(m).alias(m) for m in measures]).select(
        "block", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"before_{m}") for m in measures]
    )
    inside = Window.partitionBy("block").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return batches.join(blocks, "block").select(
        "batch", *measures, *[(F.sum(m).over(inside) + F.col(f"before_{m}")).alias(f"total_{m}") for m in measures]
    )


def list_diff(df: DataFrame, reference: Column, got: Column, keys: list[str]) -> DataFrame:
    """What an answer misses, adds, and has out of order against a reference list."""
    rows = df.select(*keys, reference.alias("_ref"), got.alias("_got"))
    ref, res, moved = F.col("_ref"), F.col("_got"), F.col("_moved")
    rows = rows.withColumn("_moved", lists.out_of_order(ref, res))
    return rows.select(
        *keys,
        F.concat_ws(" ", lists.missing_from(ref, res)).alias("missing"),
        F.concat_ws(" ", lists.missing_from(res, ref)).alias("added"),
        F.concat_ws(" ", moved).alias("out_of_order"),
        (F.size(moved) == 0).alias("is_sorted"),
        F.size(ref).cast("bigint").alias("count_ref"),
        F.size(res).cast("bigint").alias("count_res"),
    )


def slot_checks(wide: DataFrame) -> DataFrame:
    """Missing, repeated and too few products per row, and the answer contract."""
    slots = F.array(*[F.col(c) for c in SLOTS])
    ids = lists.numeric_ids(slots)
    boxes = lists.numeric_ids(F.array(*[F.col(c) for c in HOTBOXES]))
    skus = lists.numeric_ids(F.array(*[F.col(c) for c in SKUS]))
    return wide.select(
        "Vehicle", "Size", lists.missing_slots(slots).alias("missing"),
        (~lists.all_distinct(ids)).alias("has_repeats"),
        (F.size(ids) < TARGET_SLOTS).alias("too_few"),
        F.forall(slots, lists.is_valid_id).alias("all_numeric"),
        lists.all_distinct(boxes).alias("hotboxes_distinct"),
        lists.all_distinct(skus).alias("skus_distinct"),
        F.forall(F.array(*[F.col(c) for c in HOTBOXES]), lists.is_valid_id).alias("success"),
    )


def contract(results: DataFrame) -> DataFrame:
    """Rows that break the answer contract: exactly 20 SKUs and success."""
    return results.where((F.size("SKUs") != len(SKUS)) | ~F.coalesce(F.col("success"), F.lit(False)))


def sizes_by_vehicle(segment_list: DataFrame) -> DataFrame:
    """Distinct sizes of every vehicle in natural number order."""
    numbers = F.transform(F.regexp_extract_all("Size", F.lit(r"(\d+)"), 1), lambda x: x.try_cast("decimal(38,0)"))
    key = F.when(F.size(numbers) > 0, numbers).otherwise(F.array(F.lit(0).cast("decimal(38,0)")))
    rows = segment_list.select(F.upper("Vehicle").alias("Vehicle"), "Size").distinct().withColumn("_key", key)
    return running_rank(rows, ["Vehicle"], [F.asc("_key"), F.asc("Size")], "ordinal").drop("_key")


def vehicle_names(segment_list: DataFrame) -> DataFrame:
    """Distinct vehicles, ordered without regard to case."""
    return segment_list.select("Vehicle").distinct().orderBy(F.upper("Vehicle"), "Vehicle")


def fit_map(segment_list: DataFrame, position: str = "position") -> DataFrame:
    """Pod and segment per (vehicle, size); the last row wins."""
    last = F.max_by(F.struct("Pod", "Segment"), position).alias("m")
    rows = segment_list.groupBy(F.upper("Vehicle").alias("Vehicle"), "Size").agg(last, F.min(position).alias("position"))
    return rows.select("Vehicle", "Size", "m.Pod", "m.Segment", "position")


def filtered_fits(fits: DataFrame, pod: str | None = None, segment: str | None = None) -> DataFrame:
    """Fits of one pod and/or segment, whatever the case."""
    out = fits
    for column, value in (("Pod", pod), ("Segment", segment)):
        if value:
            out = out.where(F.lower(column) == value.lower())
    return out


def allowed_segments(df: DataFrame, segments: list[str]) -> DataFrame:
    return df.where(F.col("Segment").isin(segments)) if segments else df


def latest_stage(log: DataFrame) -> DataFrame:
    """Stage each run announced last, else unknown."""
    stage = F.regexp_extract("textPayload", r"(?i)Starting Stage\s+(\d+)", 1)
    seen = log.withColumn("stage", F.when(stage != "", F.concat(F.lit("stage"), stage)))
    last = F.max_by("stage", F.when(F.col("stage").isNotNull(), F.struct("timestamp", "line")))
    return seen.groupBy("run_id").agg(F.coalesce(last, F.lit("unknown")).alias("stage"), F.count("*").alias("entries"))


def recent_entries(log: DataFrame, since, count: int = 50) -> DataFrame:
    """The newest entries after ``since``."""
    rows = log.where(F.col("timestamp") > since)
    return page(rows, [F.desc("timestamp"), F.desc("line")], 0, count)


def run_list_head(runlist: DataFrame, count: int, by_rank: bool = False, position: str = "position") -> DataFrame:
    """The first rows in file order, or by priority rank on request."""
    order = [F.col(position).asc()]
    if by_rank:
        order.insert(0, F.col("PriorityRank").try_cast("double").asc_nulls_last())
    return page(runlist, order, 0, count)


def batched(rows: DataFrame, batch_size: int, position: str = "position") -> DataFrame:
    """Batch number by dense position."""
    placed = with_position(rows, [F.col(position).asc()], "_pos")
    return placed.withColumn("batch", F.floor((F.col("_pos") - 1) / batch_size).cast("bigint")).drop("_pos")

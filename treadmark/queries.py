"""Every job over the test tables, one entry per query: name -> f(spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from treadmark import schemas
from treadmark.functions import lists, parsing, text
from treadmark.operators.compare import cell_drift, row_drift
from treadmark.operators.position import page
from treadmark.plans import attribution, audit, cam_merge, candidates, clean, likeness, market, recommend, repair, score, score_output, size_file, slots, weighting
from treadmark.session import durable, scratch_path, staged_path
from treadmark.sources import events as event_times, files, tables, testdata as td, versions
from treadmark.sources.events import base_events

RUN_DATE = td.RUN_DATE
WINDOW = attribution.Window.ending_before(RUN_DATE, dt.date(2024, 1, 15), dt.date(2024, 1, 18))


def _results(spark: SparkSession, folder: str) -> DataFrame:
    return durable(td.run_results(spark, folder), "results")


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return durable(td.raw_outputs(spark, folder), "raw")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return durable(scored_table(spark, folder), "scored")


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return durable(td.requests(spark, folder), "requests")


def size_parts(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("Size")
    return td.products(spark, folder).select("Size").distinct().select(
        "Size", text.size_part(size).alias("size_part"), text.stripped_size(size).alias("stripped"),
        text.report_width(size).alias("width"), text.report_profile(size).alias("profile"), text.report_rim(size).alias("rim"),
        text.upsert_width(size).alias("up_width"), text.upsert_profile(size).alias("up_profile"), text.upsert_rim(size).alias("up_rim"),
        *[text.loose_size(size, i).alias(f"loose_{i}") for i in (1, 2, 3)],
        text.size_key(size).alias("size_key"), text.spaced_size(size).alias("spaced"),
        F.upper(size).rlike(text.STRICT_SIZE_RE).alias("strict"),
    )


def vehicle_keys(spark: SparkSession, folder: str) -> DataFrame:
    v = F.col("vehicle")
    return td.vehicle_mapping(spark, folder).select(
        "vehicle", text.sales_vehicle(F.col("CarMake"), F.col("CarModel")).alias("sales"), text.click_vehicle(v).alias("click"),
        text.alnum_key(v).alias("alnum"), text.vehicle_key(v).alias("letters"), text.upper_stripped(v).alias("stripped"),
        text.title_words(v).alias("title"), text.token_estimate(v).alias("tokens"),
        text.page_token(F.concat(F.lit("x?v="), v, F.lit("&y=2"))).alias("page_token"),
    )


def cam_keys(spark: SparkSession, folder: str) -> DataFrame:
    parts = [F.col(c) for c in cam_merge.KEYS]
    return td.cam_target(spark, folder).select(
        *cam_merge.KEYS, *[text.cam_key(*parts, mode=m).alias(m) for m in ("alnum", "spaces", "capitals")],
        text.takeover_slug(*parts).alias("slug"),
    )


def tyre_score(spark: SparkSession, folder: str) -> DataFrame:
    return score.scored(td.products(spark, folder), td.catalogue(spark, folder)).select(
        "ProductId", "GRADE", "SIZE", "StrippedSize", "BRAND", "Model", "WET_GRIP", "FUEL", "NOISE_REDUCTION", "PRICE", "OFFER",
        "PRICEFLUCTUATION", "RunflatStatus", "TyreRank", "Percentile", "TyreScore",
    )


def _totals(spark: SparkSession, folder: str) -> DataFrame:
    sold = market.sold(files.typed_sales(td.sales(spark, folder)), td.products(spark, folder), td.catalogue(spark, folder))
    return market.fit_totals(sold)


def price_zone(spark: SparkSession, folder: str) -> DataFrame:
    return market.price_zone(durable(_totals(spark, folder), "fit-totals"))


def grade_share_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return market.grade_shares(_totals(spark, folder))


def runflat_share(spark: SparkSession, folder: str) -> DataFrame:
    return market.runflat_share(_totals(spark, folder))


def clickstream(spark: SparkSession, folder: str) -> DataFrame:
    return score_output.clickstream(score_output.click_window(td.events(spark, folder), RUN_DATE))


def _sold(spark: SparkSession, folder: str) -> DataFrame:
    return durable(td.sales(spark, folder), "sales")


def scored_table(spark: SparkSession, folder: str, sold: DataFrame | None = None) -> DataFrame:
    events = score_output.click_window(td.events(spark, folder), RUN_DATE)
    sold = _sold(spark, folder) if sold is None else sold
    return score_output.build(
        score_output.Inputs(td.products(spark, folder), td.catalogue(spark, folder), sold, events, td.influence(spark, folder))
    )


def _slot_inputs(spark: SparkSession, folder: str) -> slots.Inputs:
    sold = durable(td.sales(spark, folder), "sales")
    return slots.Inputs(
        td.wide_slots(spark, folder, sold), td.vehicle_mapping(spark, folder), td.report_catalogue(spark, folder),
        td.manual_keys(spark, folder, sold),
    )


def token_fact(spark: SparkSession, folder: str) -> DataFrame:
    return slots.token_fact(_slot_inputs(spark, folder), RUN_DATE)


def token_fact_strict(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table with the manual list read as earlier reports did."""
    return slots.token_fact(_slot_inputs(spark, folder), RUN_DATE, strict_compat=True)


def analysis_wide(spark: SparkSession, folder: str) -> DataFrame:
    return slots.analysis(_slot_inputs(spark, folder), RUN_DATE)


def dashboard_wide(spark: SparkSession, folder: str) -> DataFrame:
    return slots.override_rows(_slot_inputs(spark, folder), RUN_DATE)


def _override_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two days of override rows; the older day has other slots."""
    wide = durable(td.wide_slots(spark, folder), "wide")
    day = wide.select(
        F.lit(RUN_DATE).alias("Today"), text.report_width(F.col("Size")).alias("Width"),
        text.report_profile(F.col("Size")).alias("Profile"), text.report_rim(F.col("Size")).alias("Rim"),
        *[F.when(F.col(c).rlike("^[0-9]+$"), F.col(c).try_cast("bigint")).alias(n) for c, n in zip(slots.TOKENS, slots.PIVOT_NAMES)],
    )
    older = day.withColumn("Today", F.date_sub(F.lit(RUN_DATE), 7)).withColumn("SKU", F.col("SKU") + 1)
    return day.unionByName(older)


def size_slots(spark: SparkSession, folder: str) -> DataFrame:
    out = size_file.build(_override_history(spark, folder), td.catalogue_with_price(spark, folder), RUN_DATE)
    return out.withColumn("slot_number", F.col("slot_number").cast("double"))


def cam_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return cam_merge.build(td.cam_target(spark, folder), td.cam_staging(spark, folder), td.vehicle_mapping(spark, folder))


def _base(spark: SparkSession, folder: str) -> DataFrame:
    return durable(base_events(td.events(spark, folder), WINDOW.scan, WINDOW.end), "base-events")


def journey(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.visibility(_base(spark, folder)).groupBy(
        "journey_category", "MerchandisingPosition", "SlotPosition", "page_location_cam"
    ).agg(F.count("*").alias("views"), F.count_distinct("user_id").alias("users"))


def best_placement(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.best_placement(attribution.visibility(_base(spark, folder)))


def asof_purchase(spark: SparkSession, folder: str) -> DataFrame:
    base = _base(spark, folder)
    best = attribution.best_placement(attribution.visibility(base))
    return attribution.attributed(attribution.purchases(base), best)


def merch_report(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.report(td.events(spark, folder), td.vehicle_mapping(spark, folder), WINDOW)


def rolling_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the report table after an old table had its window replaced."""
    events = durable(td.events(spark, folder).select(F.to_date("event_date", "yyyyMMdd").alias("Date"), "event_name"), "days")
    old = events.groupBy("Date").agg(F.count("*").alias("n")).withColumn("origin", F.lit("old"))
    new = events.where((F.col("event_name") == "purchase") & (F.dayofmonth("Date") % 5 != 2)).groupBy("Date").agg(
        F.count("*").alias("n")
    ).withColumn("origin", F.lit("new"))
    path = scratch_path(spark, "report")
    tables.replace_table(old, path, ["Date"])
    tables.replace_window(new, path, "Date", WINDOW.start, WINDOW.end)
    return spark.read.schema("n bigint, origin string, Date date").parquet(path)


def top100_candidates(spark: SparkSession, folder: str) -> DataFrame:
    top = candidates.top_candidates(scored_table(spark, folder), ["size_key"])
    return top.select("size_key", "rank", "ProductId", "Vehicle", "TyreScore", "Units", "OFFER")


def bulk_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate of the requested sizes with its rank in the size."""
    scored = scored_table(spark, folder)
    # only what orders the candidates and what is shown of them is sorted
    needed = ["SIZE", "TyreScore", "Units", "ProductId", "Vehicle", "OFFER", "PRICE", "Segment", "PRODUCTLISTVIEWS"]
    rows = candidates.fetch_many(_requests(spark, folder), scored.select(*needed)).drop("size_key", "vehicle_key")
    top = candidates.top_candidates(rows, ["size_key"], None)
    return top.select("size_key", "rank", "ProductId", "Vehicle", "TyreScore", "Units", "OFFER")


def tiered_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """The first source lacks the 165 sizes, so those come from the second one."""
    scored = _scored(spark, folder)
    main = scored.where(~F.col("SIZE").startswith("165"))
    asked = td.requests(spark, folder)
    return candidates.tiered(asked, [main, scored])


def text_block(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every size's block."""
    return candidates.text_block(scored_table(spark, folder), ["size_key"]).select("size_key", "line_no", "line")


def request_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """How long the block of each request is, with the fall-back from vehicle to size."""
    return candidates.request_blocks(td.requests(spark, folder), _scored(spark, folder))


def hotbox_slots(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(spark, folder)
    return recommend.recommend(_requests(spark, folder), scored)


def hotbox_slots_promoted(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(spark, folder)
    return recommend.recommend(_requests(spark, folder), scored, recommend.Rules(brand="Michelin"))


def hotbox_runflat_makes(spark: SparkSession, folder: str) -> DataFrame:
    """The slots when the makes of two nations want run-flats, whatever the data lack."""
    scored = _scored(spark, folder)
    return recommend.recommend(_requests(spark, folder), scored, recommend.Rules(runflat_makes=("NATION1", "NATION2")))


def hotbox_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Rule breaks over all answers, which must all be zero."""
    scored, asked = _scored(spark, folder), _requests(spark, folder)
    rules = recommend.Rules(season="Winter")
    answers = durable(recommend.recommend(asked, scored, rules), "answers")
    return recommend.violations(answers, asked, scored, rules)


def best_of_pool(spark: SparkSession, folder: str) -> DataFrame:
    """The first rule step alone: the three most relevant pool A products of every fit."""
    scored = _scored(spark, folder)
    best = durable(recommend.best_rows(recommend.features(scored, recommend.Rules())), "best-rows")
    lists_ = recommend.short_lists(best, candidates.NARROW)
    picked = F.expr("transform(filter(pool, x -> x.a), x -> x.id)")
    return lists_.select(*candidates.NARROW, *[F.get(picked, F.lit(i)).alias(f"HB{i + 1}") for i in range(3)])


def _damaged(
    spark: SparkSession, folder: str, asked: DataFrame, scored: DataFrame, rules: recommend.Rules, fits: DataFrame | None = None
) -> DataFrame:
    """Answers of which five in six are spoiled, each kind in its own way."""
    told = recommend.recommend(asked, scored, rules, fits)
    budget = recommend.features(scored, rules).where("grade = 'Budget'").groupBy("size_key").agg(F.min("id").alias("cheap_id"))
    rows = candidates.keyed_requests(told).join(budget, "size_key", "left")
    kind = (F.length("Vehicle") + 2 * F.length("Size") + F.floor(F.coalesce(F.substring("Size", 1, 3).try_cast("int"), F.lit(0)) / 10)) % 6
    new = {
        "HB1": F.when(kind == 2, "-").when(kind == 3, F.coalesce("cheap_id", "HB1")).when(kind == 5, F.col("HB4")).otherwise(F.col("HB1")),
        "HB2": F.when(kind == 1, F.col("HB1")).otherwise(F.col("HB2")),
        "HB4": F.when(kind == 4, "99999999").when(kind == 5, F.col("HB1")).when(kind == 2, "-").otherwise(F.col("HB4")),
        "SKU1": F.when(kind.isin(1, 4), F.col("SKU2")).otherwise(F.col("SKU1")),
    }
    return durable(rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in told.columns)), "damaged")


def _context(spark: SparkSession, folder: str, rules: recommend.Rules) -> DataFrame:
    scored, asked = _scored(spark, folder), _requests(spark, folder)
    fits = durable(recommend.scopes(asked, scored, rules), "fits")  # the answers and their context read it
    return repair.in_context(_damaged(spark, folder, asked, scored, rules, fits), asked, scored, rules, fits)


def slot_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Every broken rule of spoiled answers, with its evidence."""
    return repair.breaks(_context(spark, folder, recommend.Rules(brand="Michelin")))


def own_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of the answers as they are chosen: none."""
    scored, asked = _scored(spark, folder), _requests(spark, folder)
    fits = durable(recommend.scopes(asked, scored, recommend.Rules()), "fits")
    answers = durable(recommend.recommend(asked, scored, fits=fits), "answers")
    return repair.breaks(repair.in_context(answers, asked, scored, fits=fits)).groupBy("rule").count()


def slot_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Spoiled answers, mended, with the steps taken."""
    rules = recommend.Rules(brand="Michelin")
    return repair.repaired(_context(spark, folder, rules), rules)


def enhancer_similar(spark: SparkSession, folder: str) -> DataFrame:
    return likeness.similar_product(_scored(spark, folder), "Michelin")


def cousin_vehicles(spark: SparkSession, folder: str) -> DataFrame:
    return likeness.cousin_vehicles(_scored(spark, folder))


def cousin_products(spark: SparkSession, folder: str) -> DataFrame:
    return likeness.cousin_products(_scored(spark, folder))


def influence_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return weighting.influence_ranks(_scored(spark, folder))


def grade_quotas(spark: SparkSession, folder: str) -> DataFrame:
    return weighting.grade_quotas(_requests(spark, folder), _scored(spark, folder))


def parse_output(spark: SparkSession, folder: str) -> DataFrame:
    parsed = clean.parse_outputs(_raw(spark, folder))
    return parsed.select("Vehicle", "Size", "tier", "parsed_vehicle", "parsed_size", F.array_join("ids", " ").alias("ids"))


def backfill(spark: SparkSession, folder: str) -> DataFrame:
    sold = _sold(spark, folder)  # the answers and the scored table come of the same sales
    raw = durable(td.raw_outputs(spark, folder, sold), "raw")
    ids = candidates.scoped_ids(raw, durable(scored_table(spark, folder, sold), "scored"))
    return clean.backfill(candidates.keyed_requests(clean.parse_outputs(raw)), ids, candidates.NARROW)


def repair_size(spark: SparkSession, folder: str) -> DataFrame:
    name = text.repaired_vehicle_size(F.col("Vehicle"), F.col("Size"))
    rows = _results(spark, folder).withColumn("name", name)
    return rows.select("position", F.col("name.Vehicle").alias("Vehicle"), F.col("name.Size").alias("Size"))


def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    return clean.wide_results(_results(spark, folder))


def make_model(spark: SparkSession, folder: str) -> DataFrame:
    makes = files.distinct_makes(td.sales(spark, folder))
    return clean.cam_rows(durable(clean.wide_results(_results(spark, folder)), "wide-results"), makes)


def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """First pass against a retry whose outcome follows another pattern."""
    first = _results(spark, folder).select("position", "Vehicle", "HB1", F.col("success") & (F.col("position") % 3 != 0))
    first = first.toDF("position", "Vehicle", "HB1", "success")
    retry = first.where(~F.col("success")).select(
        "position", "Vehicle", F.concat(F.lit("r"), "HB1").alias("HB1"), (F.col("position") % 2 == 0).alias("success")
    )
    return clean.reconciled(first, retry)


def outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.outcome_counts(td.run_results(spark, folder), 100)


def consistency(spark: SparkSession, folder: str) -> DataFrame:
    return audit.consistency(td.bench_runs(spark, folder))


def top_skus(spark: SparkSession, folder: str) -> DataFrame:
    return audit.top_skus(td.bench_runs(spark, folder), [*audit.CONFIG, "Vehicle", "Size"], 3)


def top_skus_by_vehicle(spark: SparkSession, folder: str) -> DataFrame:
    return audit.top_skus(td.bench_runs(spark, folder), ["Vehicle", "Size"], 5)


def richness(spark: SparkSession, folder: str) -> DataFrame:
    return audit.richness(td.bench_runs(spark, folder))


def quality(spark: SparkSession, folder: str) -> DataFrame:
    return audit.quality(td.bench_runs(spark, folder), _scored(spark, folder))


def unmatched_skus(spark: SparkSession, folder: str) -> DataFrame:
    return audit.unmatched_skus(_scored(spark, folder), td.bench_runs(spark, folder))


def cost(spark: SparkSession, folder: str) -> DataFrame:
    prices = audit.price_table(spark, [("model-large", 0.30, 2.50), ("model-other", 0.10, 0.40)])
    return audit.run_cost(td.bench_runs(spark, folder), prices)


def job_cost(spark: SparkSession, folder: str) -> DataFrame:
    return audit.job_cost(td.bench_runs(spark, folder), "run-1", "GLOBAL")


def list_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole answer against a changed one: turned round, its fifth product replaced, its repeats left out."""
    ids = lists.words(F.col("SKUs"))
    changed = F.transform(F.reverse(ids), lambda x, i: F.when(i == 4, F.lit("99999999")).otherwise(x))
    return audit.list_diff(td.run_results(spark, folder), F.array_distinct(changed), ids, ["position"])


def slot_checks(spark: SparkSession, folder: str) -> DataFrame:
    return audit.slot_checks(td.wide_slots(spark, folder))


def vehicle_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return audit.sizes_by_vehicle(files.segment_list(td.segment_list(spark, folder)))


def vehicle_list(spark: SparkSession, folder: str) -> DataFrame:
    return audit.vehicle_names(files.segment_list(td.segment_list(spark, folder)))


def fit_page(spark: SparkSession, folder: str) -> DataFrame:
    """Second page of the fits of one pod, in list order."""
    fits = audit.fit_map(files.segment_list(td.segment_list(spark, folder)))
    return page(audit.filtered_fits(fits, pod="pod1"), [F.asc("position")], 20, 20)


def runlist_batches(spark: SparkSession, folder: str) -> DataFrame:
    usable = files.runlist(td.runlist(spark, folder))
    return audit.batched(usable, 64)


def runlist_head(spark: SparkSession, folder: str) -> DataFrame:
    """The 100 first rows by priority."""
    return audit.run_list_head(files.runlist(td.runlist(spark, folder)), 100, by_rank=True)


def distinct_makes(spark: SparkSession, folder: str) -> DataFrame:
    return files.distinct_makes(td.sales(spark, folder))


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Slot rows exported to CSV and loaded back with the fixed schema."""
    path = scratch_path(spark, "results-csv")
    tables.export_csv(td.wide_slots(spark, folder), path)
    return tables.load_csv(spark, path, schemas.RESULTS)


def golden_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that differ between a reference table and a changed one, leaving out a volatile column."""
    golden = td.runlist(spark, folder).toDF("position", "Vehicle", "Size", "PriorityRank")
    current = golden.withColumn("Vehicle", F.when(F.col("position") % 50 == 7, "other").otherwise(F.col("Vehicle"))).withColumn(
        "PriorityRank", F.lit("x")
    )
    return row_drift(golden, current, ["PriorityRank"])


def golden_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The cells that differ between a reference table and one with changed, lost and added rows and another column."""
    golden = td.runlist(spark, folder).toDF("position", "Vehicle", "Size", "PriorityRank")
    at = F.col("position")
    changed = golden.where(at % 60 != 3).withColumn("Vehicle", F.when(at % 50 == 7, "other").otherwise(F.col("Vehicle"))).withColumn("PriorityRank", F.lit("x"))
    current = changed.union(golden.where(at % 70 == 5).withColumn("position", -at)).withColumn("note", F.lit("x"))
    found = cell_drift(golden, current, ["position"], ["PriorityRank"])
    return found.select("position", "kind", F.explode("cells").alias("cell", "v")).select("position", "kind", "cell", "v.old", "v.new")


def atomic_window(spark: SparkSession, folder: str) -> DataFrame:
    """As ``rolling_replace``, in one step, after a run that died before its commit."""
    days = durable(td.events(spark, folder).select(F.to_date("event_date", "yyyyMMdd").alias("Date"), "event_name"), "days")
    old = days.groupBy("Date").agg(F.count("*").alias("n")).withColumn("origin", F.lit("old"))
    new = days.where((F.col("event_name") == "purchase") & (F.dayofmonth("Date") % 5 != 2)).groupBy("Date").agg(F.count("*").alias("n")).withColumn("origin", F.lit("new"))
    table = versions.DayTable(spark, staged_path(spark, "day-table"), (("n", "bigint"), ("origin", "string")), "Date")
    table.replace(old, dt.date(2000, 1, 1), dt.date(2099, 12, 31))
    table.stage(new.withColumn("origin", F.lit("lost")), WINDOW.start, WINDOW.end)
    table.replace(new, WINDOW.start, WINDOW.end)
    return table.read()


def _staging(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Staging rows written as CSV, some with a time that is none, some in files with another header, and loaded."""
    kind = (7 * F.length("Vehicle") + F.length("Size")) % 5
    rows = durable(td.wide_slots(spark, folder).select(*schemas.names(schemas.RESULTS)), "staging")
    rows = rows.withColumn("last_modified", F.when(kind == 2, "yesterday").otherwise("2024-01-31 08:00:00"))
    path = staged_path(spark, "staging-csv")
    tables.export_csv(rows.where(kind != 3), f"{path}/right")
    tables.export_csv(rows.where(kind == 3).withColumnRenamed("Size", "Sise"), f"{path}/wrong")
    fields = tuple((n, "timestamp_ntz" if k == "timestamp" else k) for n, k in schemas.STAGING)
    return files.load_checked(spark, f"{path}/*", fields)


def staging_good(spark: SparkSession, folder: str) -> DataFrame:
    return _staging(spark, folder)[0].select("Vehicle", "Size", "HB1", "SKU20", "last_modified")


def staging_bad(spark: SparkSession, folder: str) -> DataFrame:
    part = F.split("line", ",")
    return _staging(spark, folder)[1].select("reason", F.get(part, F.lit(0)).alias("Vehicle"), F.get(part, F.lit(1)).alias("Size"))


def london_days(spark: SparkSession, folder: str) -> DataFrame:
    """Events 61 days later, by the day in London: the last one is the night of the clock change, an hour short."""
    utc = event_times.utc_time(F.col("event_timestamp")) + F.expr("INTERVAL 61 DAY")
    there = td.events(spark, folder).select(event_times.local_time(utc, "Europe/London").alias("at"))
    days = there.groupBy(F.to_date("at").alias("day")).agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count("*").alias("n"))
    hours = event_times.day_length(F.col("day"), "Europe/London")
    return days.select("day", "first_at", "last_at", "n", hours.alias("hours"), F.floor(F.col("n") * 100 / hours).cast("decimal(18,0)").alias("per_100_hours"))


def latest_stage(spark: SparkSession, folder: str) -> DataFrame:
    return audit.latest_stage(td.log_entries(spark, folder))


def recent_log(spark: SparkSession, folder: str) -> DataFrame:
    since = F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz")
    return audit.recent_entries(files.log_lines(td.log_entries(spark, folder)), since).select("run_id", "line", "textPayload")


def snapshot_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots appended to a table by days, the newer one read back."""
    path = scratch_path(spark, "snapshots")
    rows = durable(token_fact(spark, folder), "snapshot")
    tables.replace_table(rows, path, ["snapshot_date"])
    tables.append_rows(rows.where("is_hotbox").withColumn("snapshot_date", F.date_add("snapshot_date", 1)), path, ["snapshot_date"])
    return tables.latest_snapshot(spark.read.parquet(path), "snapshot_date").select(rows.columns)


def json_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log exported as JSON lines and read back with its schema."""
    path = scratch_path(spark, "log-json")
    tables.export_json(td.log_entries(spark, folder), path)
    return files.read_log(spark, path).groupBy("run_id").agg(F.count("*").alias("entries"), F.max("textPayload").alias("last"), F.min("timestamp").alias("since"))


def clean_headers(spark: SparkSession, folder: str) -> DataFrame:
    """A file whose headers need cleaning, all columns read as text."""
    path = scratch_path(spark, "headers-csv")
    mapping = td.vehicle_mapping(spark, folder).select(F.col("vehicle").alias(" vehicle"), F.col("CarMake").alias("Car.Make"), F.col("Segment").alias("seg-ment"))
    tables.export_csv(mapping, path)
    return files.read_named_csv(spark, path)


def report_lines(spark: SparkSession, folder: str) -> DataFrame:
    wide = slots.analysis(_slot_inputs(spark, folder), RUN_DATE)
    return slots.report_lines(wide, ["Segment", "Category", "SKU"]).select("line_no", "Make", "Model", "Width", "Profile", "Rim", "Segment", "Category", "SKU")


def size_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    return size_file.file_lines(size_slots(spark, folder)).select("line_no", "slot_number", "Size", "product_id")


def runlist_first(spark: SparkSession, folder: str) -> DataFrame:
    """The 100 first rows in file order."""
    return audit.run_list_head(files.runlist(td.runlist(spark, folder)), 100)


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """Answers packed into pages of fifty and taken out again."""
    fields = F.struct("Vehicle", "Size", *lists.HOTBOXES, lists.words(F.col("SKUs")).alias("SKUs"), "success")
    page_of = F.floor(F.col("position") / 50).alias("page")
    rows = td.run_results(spark, folder).select(page_of, F.col("position").alias("_p"), fields.alias("item"))
    packed = rows.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("_p", "item"))).alias("items"))  # at most fifty orders
    pages = packed.select("page", F.lit("all").alias("Segment"), F.col("items.item").alias("items"))
    return clean.flattened(pages).select("position.page", "position.at", "Segment", "Vehicle", "Size", "HB1", "HB4", "SKUs", "success")


def contract_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Answers without exactly twenty products, or without success."""
    few = F.slice(lists.words(F.col("SKUs")), F.lit(1), (F.lit(20) - F.col("position") % 2).cast("int"))
    return audit.contract(td.run_results(spark, folder).withColumn("SKUs", few)).select("position", F.size("SKUs").cast("bigint").alias("n"), "success")


def error_lines(spark: SparkSession, folder: str) -> DataFrame:
    asked = td.requests(spark, folder)
    return asked.select("Vehicle", "Size", parsing.error_line(F.col("Vehicle"), F.col("Size"), "NoContent").alias("line"))


def failure_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of failed requests, and of all requests of a failed batch."""
    batched = audit.batched(files.runlist(td.runlist(spark, folder)), 64)
    message = F.concat(F.element_at(F.array(*map(F.lit, ("read timeout ", "api limit ", "broken "))), (F.col("position") % 3 + 1).cast("int")), F.col("position").cast("string"))
    out = clean.batch_outcomes(batched, F.col("batch") % 7 == 3)
    return out.select("position", "batch", "success", F.coalesce("error_code", clean.failure_code(message)).alias("error_code"))


def segment_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of two segments."""
    fits = files.segment_list(td.segment_list(spark, folder))
    return audit.allowed_segments(fits, ["BUILDING", "MACHINERY"]).select("position", "Vehicle", "Size", "Segment")


def size_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup's first rows for one size, found anywhere in the size text."""
    found = candidates.single_lookup(scored_table(spark, folder), "175/")
    return found.select("size_key", "vehicle_key", "ProductId", "TyreScore", "Units", "OFFER")


def as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that any reader shows the same value."""
    shown = {
        name: F.date_format(name, "yyyy-MM-dd" if kind == "date" else "yyyy-MM-dd HH:mm:ss")
        for name, kind in df.dtypes
        if kind == "date" or kind.startswith("timestamp")
    }
    return df.withColumns(shown) if shown else df


_JOBS = {
    "size_parts": size_parts, "vehicle_keys": vehicle_keys, "cam_keys": cam_keys, "tyre_score": tyre_score,
    "price_zone": price_zone, "grade_share_pivot": grade_share_pivot, "runflat_share": runflat_share,
    "clickstream": clickstream, "score_output": scored_table, "token_fact": token_fact,
    "token_fact_strict": token_fact_strict, "analysis_wide": analysis_wide, "dashboard_wide": dashboard_wide,
    "size_file": size_slots, "cam_merge": cam_upsert, "journey": journey, "best_placement": best_placement,
    "asof_purchase": asof_purchase, "merch_report": merch_report, "rolling_replace": rolling_replace,
    "top100_candidates": top100_candidates, "bulk_candidates": bulk_candidates, "tiered_candidates": tiered_candidates,
    "text_block": text_block, "request_blocks": request_blocks, "hotbox_slots": hotbox_slots, "hotbox_slots_promoted": hotbox_slots_promoted,
    "hotbox_runflat_makes": hotbox_runflat_makes,
    "hotbox_violations": hotbox_violations, "best_of_pool": best_of_pool, "parse_output": parse_output,
    "backfill": backfill, "repair_size": repair_size, "dedup_rows": dedup_rows, "make_model": make_model,
    "reconcile": reconcile, "outcome_counts": outcome_counts, "consistency": consistency, "top_skus": top_skus,
    "top_skus_by_vehicle": top_skus_by_vehicle, "richness": richness, "quality": quality,
    "unmatched_skus": unmatched_skus, "cost": cost, "job_cost": job_cost, "list_diff": list_diff,
    "slot_checks": slot_checks, "vehicle_sizes": vehicle_sizes, "vehicle_list": vehicle_list, "fit_page": fit_page,
    "runlist_batches": runlist_batches, "runlist_head": runlist_head, "distinct_makes": distinct_makes,
    "csv_round_trip": csv_round_trip, "golden_diff": golden_diff, "latest_stage": latest_stage, "recent_log": recent_log,
    "snapshot_latest": snapshot_latest, "json_log": json_log, "clean_headers": clean_headers, "report_lines": report_lines,
    "size_file_lines": size_file_lines, "runlist_first": runlist_first, "page_records": page_records, "contract_breaks": contract_breaks,
    "enhancer_similar": enhancer_similar, "cousin_vehicles": cousin_vehicles, "cousin_products": cousin_products,
    "influence_ranks": influence_ranks, "grade_quotas": grade_quotas, "slot_breaks": slot_breaks, "own_breaks": own_breaks, "slot_repair": slot_repair,
    "golden_cells": golden_cells, "atomic_window": atomic_window, "staging_bad": staging_bad,
    "error_lines": error_lines, "failure_codes": failure_codes, "segment_rows": segment_rows, "size_lookup": size_lookup,
}


def _shown(job):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return as_text(job(spark, folder))

    run.__name__, run.__doc__ = job.__name__, job.__doc__
    return run


# These show their values as they are: dates, times and decimals.
_TYPED = {"staging_good": staging_good, "london_days": london_days}
QUERIES = {name: _shown(job) for name, job in _JOBS.items()} | _TYPED

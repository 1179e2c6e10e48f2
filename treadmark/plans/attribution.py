"""Views, purchases and which view a purchase belongs to."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from treadmark.functions import journey
from treadmark.functions.numbers import MONEY
from treadmark.functions.text import alnum_key
from treadmark.operators.asof import last_before
from treadmark.operators.counts import join_on
from treadmark.operators.topk import best_one
from treadmark.session import durable
from treadmark.sources.events import base_events

VISIT = ["user_id", "SKU", "visit_ts"]
HOUR = 3_600_000_000  # microseconds
OUTPUT_DAYS = 21
HISTORY_DAYS = 90
METRICS = ("TotalUsers", "Orders", "Purchasers", "PurchasedUnits", "PurchasedRevenue", "UsersUniqueDayJourney")


@dataclass(frozen=True)
class Window:
    """Days written, days read, and the days whose metrics are masked."""

    start: dt.date
    end: dt.date
    scan: dt.date
    bad_start: dt.date
    bad_end: dt.date

    @staticmethod
    def ending_before(run_date: dt.date, bad_start: dt.date, bad_end: dt.date) -> Window:
        start = run_date - dt.timedelta(days=OUTPUT_DAYS)
        return Window(
            start, run_date - dt.timedelta(days=1), start - dt.timedelta(days=HISTORY_DAYS), bad_start, bad_end
        )


def visibility(base: DataFrame) -> DataFrame:
    """Every counted view with its journey, slot and placement."""
    rows = base.where((F.col("event_name") == "view_item_list") & journey.counted_page(F.col("page_location")))
    return rows.select(
        F.col("event_date").alias("snapshot_date"), F.col("ts").alias("visit_ts"), "user_id", "page_location_cam",
        journey.journey_label(F.col("item_category8"), F.col("item_category5")).alias("journey_category"),
        alnum_key(F.col("item_category5")).alias("vehicle"),
        journey.slot_position(F.col("item_list_index")).alias("SlotPosition"),
        F.col("item_list_id").alias("Size"), F.col("item_brand").alias("Manufacturer"),
        F.col("item_category").alias("ModelName"), F.col("item_variant").alias("Variant"), F.col("item_id").alias("SKU"),
        journey.placement_label(F.col("item_list_index")).alias("MerchandisingPosition"),
    )


def best_placement(views: DataFrame) -> DataFrame:
    """One view per (user, product, moment): the most prominent placement."""
    order = [
        journey.placement_rank(F.col("MerchandisingPosition")).asc(),
        F.asc_nulls_first("SlotPosition"),
        *[
            F.asc_nulls_first(c)
            for c in ("journey_category", "vehicle", "Size", "Manufacturer", "ModelName", "Variant", "page_location_cam")
        ],
    ]
    return best_one(views, VISIT, order)


def _first_touch(best: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """The first view of every key, as its own (user, product, moment) with a flag.

    Found by a minimum, so a busy user's day is never one window partition, and
    joined back on the unique view key, which has no skew.
    """
    first = best.groupBy(*keys).agg(
        F.min(F.struct("visit_ts", F.coalesce("SKU", F.lit("")).alias("SKU"), F.col("SKU").isNull().alias("none"))).alias("f")
    )
    return first.where("NOT f.none").select(
        "user_id", F.col("f.SKU").alias("SKU"), F.col("f.visit_ts").alias("visit_ts"), F.lit(1).cast("bigint").alias(flag)
    )


def with_first_touch(best: DataFrame) -> DataFrame:
    """Flags for the first view per day and per day and journey; views without product are dropped.

    Views without a product take part in finding the first one and only then
    leave, so a day may have no flagged view.
    """
    day = _first_touch(best, ["snapshot_date", "user_id"], "UsersUniqueDay")
    per_journey = _first_touch(best, ["snapshot_date", "user_id", "journey_category"], "UsersUniqueDayJourney")
    zero = F.lit(0).cast("bigint")
    return (
        best.where(F.col("SKU").isNotNull())
        .join(day, VISIT, "left")
        .join(per_journey, VISIT, "left")
        .withColumn("UsersUniqueDay", F.coalesce("UsersUniqueDay", zero))
        .withColumn("UsersUniqueDayJourney", F.coalesce("UsersUniqueDayJourney", zero))
    )


def purchases(base: DataFrame) -> DataFrame:
    units = F.coalesce("quantity", F.lit(1).cast("bigint"))
    return base.where(F.col("event_name") == "purchase").select(
        "user_id", F.col("item_id").alias("SKU"), F.col("ts").alias("purchase_ts"), "transaction_id", units.alias("Units"),
        (F.coalesce("price", F.lit(0.0)) * units).alias("ItemRevenue"),
    )


def attributed(bought: DataFrame, best: DataFrame, bucket: int = HOUR) -> DataFrame:
    """Each bought (transaction, user, product) with the last view at or before it."""
    matched = last_before(bought, best, ["user_id", "SKU"], "purchase_ts", "visit_ts", bucket)
    # Several lines of one product in one transaction count once: the latest one.
    latest = F.max(F.struct("visit_ts", "purchase_ts", "Units", "ItemRevenue")).alias("line")
    return (
        matched.groupBy("transaction_id", "user_id", "SKU")
        .agg(latest)
        .select("transaction_id", "user_id", "SKU", "line.visit_ts", "line.Units", "line.ItemRevenue")
    )


def per_visit(attributions: DataFrame) -> DataFrame:
    return attributions.groupBy(*VISIT).agg(
        F.count_distinct("transaction_id").alias("Orders"),
        F.lit(1).cast("bigint").alias("Purchasers"),  # a visit has one user
        F.sum("Units").alias("PurchasedUnits"),
        F.sum(F.col("ItemRevenue").cast(MONEY)).cast("double").alias("PurchasedRevenue"),
    )


def vehicle_dimension(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy(alnum_key(F.col("vehicle")).alias("vehicle")).agg(
        F.min("Segment").alias("Segment"), F.min("Pod").alias("Pod"), F.min("Category").alias("Category")
    )


def report(events: DataFrame, mapping: DataFrame, window: Window) -> DataFrame:
    """The merchandising report rows of the output window.

    The raw events are read once: the flat rows both branches need are written
    to the shared folder, and so are the deduplicated views, which are used by
    the attribution, the first-touch flags and the report itself.
    """
    base = durable(base_events(events, window.scan, window.end), "base-events")
    best = durable(best_placement(visibility(base)), "views")
    visits = per_visit(attributed(purchases(base), best))
    flagged = with_first_touch(best).where(F.col("snapshot_date").between(F.lit(window.start), F.lit(window.end)))
    joined = join_on(flagged.join(visits, VISIT, "left"), vehicle_dimension(mapping), ["vehicle"], match_null=False)
    masked = F.col("snapshot_date").between(F.lit(window.bad_start), F.lit(window.bad_end))
    sources = dict(zip(METRICS, ("UsersUniqueDay", *METRICS[1:])))
    zero = {"PurchasedRevenue": F.lit(0.0)}

    def metric(name: str):
        value = F.coalesce(F.col(sources[name]), zero.get(name, F.lit(0).cast("bigint")))
        return F.when(~masked, value).alias(name)

    return joined.select(
        F.col("snapshot_date").alias("Date"), "journey_category", F.col("vehicle").alias("Vehicle"), "Size",
        "SlotPosition", "MerchandisingPosition", "Manufacturer", "ModelName", "Variant", "SKU", metric("TotalUsers"),
        "Segment", "Pod", "Category", *[metric(m) for m in METRICS[1:]],
    )

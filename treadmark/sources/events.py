"""Clickstream events: nested rows to flat item rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from treadmark.functions import journey
from treadmark.functions.text import page_token

COUNTRY = "United Kingdom"


def days(events: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Events of [start, end]; on a table partitioned by event_date only those days are read."""
    return events.where(F.col("event_date").between(start.strftime("%Y%m%d"), end.strftime("%Y%m%d")))


def items_of(events: DataFrame, *keep: str) -> DataFrame:
    """One row per item; events without items are dropped."""
    return events.select(*keep, F.explode("items").alias("item"))


def base_events(events: DataFrame, start: dt.date, end: dt.date, country: str = COUNTRY) -> DataFrame:
    """Views and purchases of known users, one row per item, fields pulled out once.

    Event time stays in microseconds; the user is the signed-in id, else the
    device id.
    """
    wanted = days(events, start, end).where(
        F.col("event_name").isin("view_item_list", "purchase") & (F.col("geo.country") == country)
    )
    flat = wanted.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.col("event_timestamp").alias("ts"),
        F.coalesce("user_id", "user_pseudo_id").alias("user_id"),
        "event_name",
        journey.param(F.col("event_params"), "page_location").alias("page_location"),
        journey.param(F.col("event_params"), "transaction_id").alias("transaction_id"),
        "items",
    ).where(F.col("user_id").isNotNull())
    rows = items_of(flat, "event_date", "ts", "user_id", "event_name", "page_location", "transaction_id")
    return rows.select(
        "event_date", "ts", "user_id", "event_name", "page_location", "transaction_id",
        page_token(F.col("page_location")).alias("page_location_cam"),
        journey.param(F.col("item.item_params"), "item_category8").alias("item_category8"),
        *[
            F.col(f"item.{c}").alias(c)
            for c in (
                "item_list_id", "item_list_index", "item_category5", "item_brand", "item_category", "item_variant",
                "item_id", "price", "quantity",
            )
        ],
    )


def utc_time(micros: Column) -> Column:
    """The time of an event as TIMESTAMP without zone, in UTC, whatever the session's zone."""
    seconds = (micros.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def local_time(utc: Column, zone: str) -> Column:
    """The time on the clocks of ``zone``, with its summer time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def day_length(day: Column, zone: str) -> Column:
    """Hours of a calendar day in ``zone``: 23 or 25 when the clocks change."""
    starts = [F.convert_timezone(F.lit(zone), F.lit("UTC"), F.date_add(day, n).cast("timestamp_ntz")) for n in (0, 1)]
    return F.timestamp_diff("HOUR", *starts).cast("int")

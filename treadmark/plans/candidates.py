"""Ranked candidates per tyre size and vehicle, with fallbacks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from treadmark.functions.lists import VALID_ID
from treadmark.functions.text import size_key, vehicle_key
from treadmark.operators.lookup import scoped_requests
from treadmark.operators.topk import best_n, running_rank
from treadmark.plans.score_output import COLUMNS
from treadmark.session import durable

LOOKUP_LIMIT = 100
NARROW, WIDE = ["size_key", "vehicle_key"], ["size_key"]
# Headers of the text block, in field order.
BLOCK_HEADERS = (
    "TyreScore", "ProdID", "WetGrade", "Brand", "Model", "WetVal", "FuelVal", "NoiseVal", "Season", "IsOE", "AwardScore",
    "IsRunflat", "Segment", "PriceScore", "WetScore", "FuelScore", "WetScorePct", "AwardScorePct", "Vehicle", "Size",
    "PriceGBP", "IsOffer", "PriceFluct", "Orders", "Units", "Goldilocks", "PremShare", "MidShare", "BudShare", "RFShare",
    "Status", "Views", "ClickRate",
)
# An answer has 24 slots.  With h holes, 24 - h ids are taken, so the h next ones
# are among the first 24 candidates.
FILL_DEPTH = 24


def keyed(scored: DataFrame) -> DataFrame:
    return scored.withColumn("size_key", size_key(F.col("SIZE"))).withColumn("vehicle_key", vehicle_key(F.col("Vehicle")))


def keyed_requests(requests: DataFrame) -> DataFrame:
    return requests.withColumn("size_key", size_key(F.col("Size"))).withColumn("vehicle_key", vehicle_key(F.col("Vehicle")))


def candidate_order() -> list[Column]:
    """Best tier first, then units; product and vehicle break ties."""
    return [F.asc("TyreScore"), F.desc("Units"), F.asc("ProductId"), F.asc("Vehicle"), F.asc_nulls_first("OFFER"),
            F.asc_nulls_first("PRICE"), F.asc_nulls_first("Segment"), F.asc_nulls_first("PRODUCTLISTVIEWS")]


def top_candidates(scored: DataFrame, keys: list[str], limit: int | None = LOOKUP_LIMIT) -> DataFrame:
    """Ordered candidates of every key; all of them when ``limit`` is None."""
    rows = keyed(scored)
    if limit is None:
        return running_rank(rows, keys, candidate_order(), "rank")
    return best_n(rows, keys, candidate_order(), limit, "rank")


def single_lookup(scored: DataFrame, size: str, vehicle: str | None = None, limit: int = LOOKUP_LIMIT) -> DataFrame:
    """Candidates of one size (matched anywhere in the size text) and, if given, one vehicle."""
    rows = keyed(scored).where(F.contains("size_key", F.lit(size.strip().lower().replace(" ", ""))))
    if vehicle:
        rows = rows.where(F.col("vehicle_key") == re.sub(r"[\W_]", "", vehicle).lower())
    return rows.orderBy(*candidate_order()).limit(limit)


def scopes(requests: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """size_key, vehicle_key, tier of every request: the best source and level that has any candidate.

    Tier 2 * i is source i at the request's size and vehicle, 2 * i + 1 source i at its size.
    """
    asked = durable(keyed_requests(requests).select(*NARROW).distinct(), "asked")  # every source and level reads it
    found = scoped_requests(asked, sources, NARROW, WIDE).where("_source IS NOT NULL")
    tier = F.col("_source") * 2 + F.when(F.col("_level") == "wide", 1).otherwise(0)
    return durable(found.select(*NARROW, tier.cast("bigint").alias("tier")), "scopes")


def scope_rows(asked: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """All candidates of every scope in ``asked``, each scope once, whatever the number of its requests.

    Rows of a size's scope carry NULL as ``scope_vehicle``.
    """
    parts = []
    for i, source in enumerate(sources):
        for wide, keys in enumerate((NARROW, WIDE)):
            tier = 2 * i + wide
            mine = asked.where(F.col("tier") == tier).select(*keys).distinct()
            vehicle = F.lit(None).cast("string") if wide else F.col("vehicle_key")
            rows = source.join(mine, keys, "left_semi")
            parts.append(rows.withColumn("scope_vehicle", vehicle).withColumn("tier", F.lit(tier).cast("bigint")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def of_requests(asked: DataFrame, figures: DataFrame) -> DataFrame:
    """Figures of scopes (size_key, scope_vehicle, tier) at every request of the scope."""
    vehicle = F.when(F.col("tier") % 2 == 0, F.col("vehicle_key"))
    a, b = asked.withColumn("scope_vehicle", vehicle), figures
    on = ["size_key", "tier", "scope_vehicle"]
    narrow = a.where("scope_vehicle IS NOT NULL").join(b.where("scope_vehicle IS NOT NULL"), on)
    wide = a.where("scope_vehicle IS NULL").drop("scope_vehicle").join(b.where("scope_vehicle IS NULL").drop("scope_vehicle"), on[:2])
    return narrow.drop("scope_vehicle").unionByName(wide)


def tiered(requests: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """Number and figures of the candidates of every request from the best source and level that has any.

    Candidates are summed up once for each scope; requests then only meet the sums.
    """
    tables = [keyed(s) for s in sources]
    asked = scopes(requests, tables)
    figures = scope_rows(asked, tables).groupBy("size_key", "scope_vehicle", "tier").agg(
        F.count("*").alias("n"), F.count_distinct("ProductId").alias("products"),
        F.min("TyreScore").alias("best"), F.sum("Units").alias("units"),
    )
    return of_requests(asked, figures).select(*NARROW, "tier", "n", "products", "best", "units")


def fetch_many(requests: DataFrame, scored: DataFrame) -> DataFrame:
    """All candidates of the requested sizes."""
    sizes = keyed_requests(requests).select("size_key").where("size_key <> ''").distinct()
    return keyed(scored).join(sizes, "size_key", "left_semi")


def ranked_ids(scored: DataFrame, keys: list[str], depth: int = FILL_DEPTH) -> DataFrame:
    """The first ``depth`` distinct valid product ids of every key, in candidate order.

    ``depth`` covers every slot an answer can have, taken or empty, so nothing
    an answer could use is missing.
    """
    rows = keyed(scored).where(F.col("ProductId").cast("string").rlike(VALID_ID))
    if keys == NARROW:  # products of a fit seldom repeat, so rows move once, to their fits
        rows = rows.select(*keys, "ProductId", "TyreScore", "Units").repartition(*keys)
    order = F.struct(F.col("TyreScore"), (-F.col("Units")).alias("u"), F.col("ProductId"))
    firsts = rows.groupBy(*keys, "ProductId").agg(F.min(order).alias("o"))
    top = best_n(firsts, keys, [F.asc("o")], depth, "rank")
    ordered = F.sort_array(F.collect_list(F.struct("rank", F.col("ProductId").cast("string").alias("id"))))
    return top.groupBy(*keys).agg(F.transform(ordered, lambda x: x["id"]).alias("candidate_ids"))


def scoped_ids(requests: DataFrame, scored: DataFrame) -> DataFrame:
    """Ranked ids for every requested (size, vehicle): the vehicle's own, else the size's."""
    wanted = durable(keyed_requests(requests).select(*NARROW).distinct(), "wanted")
    rows = keyed(scored).join(wanted.select("size_key").distinct(), "size_key", "left_semi")
    scored = durable(rows.select("Vehicle", "SIZE", "ProductId", "TyreScore", "Units"), "requested")  # three branches read it
    seen = keyed(scored).select(*NARROW).distinct().withColumn("seen", F.lit(True))
    own = ranked_ids(scored, NARROW).withColumnRenamed("candidate_ids", "own")
    size = ranked_ids(scored, WIDE).withColumnRenamed("candidate_ids", "any")
    joined = wanted.join(seen, NARROW, "left").join(own, NARROW, "left").join(size, WIDE, "left")
    none = F.array().cast("array<string>")
    return joined.select(*NARROW, F.when(F.col("seen"), F.coalesce("own", none)).otherwise(F.col("any")).alias("candidate_ids"))


def block_line() -> Column:
    """One candidate as a text line: NULL is written None, '|' becomes '/'."""
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("None")), F.lit("|"), F.lit("/")) for c in COLUMNS]
    return F.concat_ws("|", *cells)


def block_lines(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Text block of every key as numbered lines; line 0 is the header."""
    return _with_head(ranked.select(*keys, F.col("rank").alias("line_no"), block_line().alias("line")), keys)


def _with_head(lines: DataFrame, keys: list[str]) -> DataFrame:
    head = lines.select(*keys).distinct().select(*keys, F.lit(0).cast("bigint").alias("line_no"), F.lit("|".join(BLOCK_HEADERS)).alias("line"))
    return head.unionByName(lines)


def text_block(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Text block of every key, all candidates, one row for each numbered line; no key's lines meet in one value."""
    rows = keyed(scored).withColumn("line", block_line())
    # the line and what orders it: no other column moves with them
    needed = ["TyreScore", "Units", "ProductId", "Vehicle", "OFFER", "PRICE", "Segment", "PRODUCTLISTVIEWS"]
    ranked = running_rank(rows.select(*keys, *needed, "line"), keys, candidate_order(), "rank", ["line"])
    return _with_head(ranked.select(*keys, F.col("rank").alias("line_no"), "line"), keys)


def request_blocks(requests: DataFrame, scored: DataFrame) -> DataFrame:
    """Lines, characters and tokens of every request's text block: its vehicle's candidates, else its size's."""
    rows = keyed(scored)
    asked = scopes(requests, [rows])
    lines = scope_rows(asked, [rows]).select("size_key", "scope_vehicle", "tier", F.length(block_line()).alias("chars"))
    sums = lines.groupBy("size_key", "scope_vehicle", "tier").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    head = len("|".join(BLOCK_HEADERS))
    # the header, the candidates, and a line break before each of them
    sums = sums.withColumn("lines", F.col("n") + 1).withColumn("chars", F.col("chars") + F.col("n") + F.lit(head)).drop("n")
    out = of_requests(asked, sums)
    return out.select(*NARROW, "tier", "lines", "chars", F.floor(F.col("chars") / 4).cast("bigint").alias("tokens"))

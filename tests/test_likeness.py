"""Likeness, influence weights and the mix of grades against plain Python and written-out cases."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from treadmark.plans import likeness, recommend, weighting
from treadmark.queries import scored_table

ROW = {
    "TyreScore": "1.BEST TYRE SCORE", "ProductId": 10000001, "GRADE": "Premium", "BRAND": "Avon", "Model": "M", "WET_GRIP": "B", "FUEL": "C", "NOISE_REDUCTION": "70-B",
    "SEASONAL_PERFORMANCE": "Summer", "OE": "", "AWARD_SCORE": "No", "RunflatStatus": "", "Segment": "S", "PRICE_pct": "20", "GRADE_pct": "20", "FUEL_pct": "20",
    "WET_GRIP_pct": "20", "AWARD_SCORE_pct": "20", "Vehicle": "V1", "SIZE": "205/55 R16", "PRICE": 100.0, "OFFER": "", "PRICEFLUCTUATION": 1.0, "Orders": 1, "Units": 5,
    "GoldilocksZone": 100.0, "PremiumShare": 50.0, "MidRangeShare": 30.0, "BudgetShare": 20.0, "RunflatShare": 0.0, "SalesStatus": "Active", "PRODUCTLISTVIEWS": 0, "CLICKSTREAMRATE": 0.0,
}


@pytest.fixture(scope="module")
def schema(spark, small):
    return scored_table(spark, small).schema


def scored(spark, schema, *rows):
    whole = [{**ROW, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in whole], schema)


def test_the_nearest_of_the_brand_by_hand(spark, schema):
    mine = {"BRAND": "Toyo", "Units": 0, "Vehicle": "NO SALES YET"}
    df = scored(
        spark, schema, {"Units": 9}, {"ProductId": 10000002, "Units": 3, "WET_GRIP": "A"},
        {**mine, "ProductId": 20000001, "WET_GRIP": "D"},  # two classes: 500
        {**mine, "ProductId": 20000002, "PRICE": 130.0, "NOISE_REDUCTION": "71-A"},  # 300 + 100
        {**mine, "ProductId": 20000003, "SEASONAL_PERFORMANCE": None},  # 500
        {**mine, "ProductId": 20000004, "GRADE": "MidRange"},  # 1000
        {**mine, "ProductId": 20000005, "SIZE": "195/55 R16"},  # another size
        {"Vehicle": "V2", "SIZE": "175/55 R16"},
    )
    found = {(r["size_key"], r["vehicle_key"]): (r["lead"], r["nearest"], r["distance"]) for r in likeness.similar_product(df, " TOYO ").collect()}
    assert found == {("205/55r16", "v1"): ("10000001", "20000002", 400), ("175/55r16", "v2"): ("10000001", None, None)}


def test_cousins_by_hand(spark, schema):
    units = {"V1": {1: 10, 2: 5}, "V2": {1: 20, 2: 10, 3: 4}, "V3": {2: 7, 4: 9}, "V4": {5: 3}, "V5": {}}
    df = scored(spark, schema, *({"Vehicle": v, "ProductId": 10000000 + p, "Units": u, "BRAND": "Avon" if p < 4 else "Toyo"} for v, own in units.items() for p, u in own.items()))
    rows = likeness.cousin_vehicles(df).collect()

    def cosine(a, b):
        dot = sum(u * units[b].get(p, 0) for p, u in units[a].items())
        return math.floor(1e6 * dot / math.sqrt(float(sum(u * u for u in units[a].values())) * float(sum(u * u for u in units[b].values())))) if dot else 0

    want = {(a.lower(), b.lower(), cosine(a, b)) for a in units for b in units if a != b and cosine(a, b)}
    assert {(r["vehicle_key"], r["cousin"], r["cosine"]) for r in rows} == want
    assert [r["cousin"] for r in sorted(rows, key=lambda r: r["place"]) if r["vehicle_key"] == "v1"] == ["v2", "v3"]
    offers = [(r["id"], r["known_brand"]) for r in likeness.cousin_products(df).orderBy("place").collect() if r["vehicle_key"] == "v1"]
    assert offers == [("10000003", True), ("10000004", False)]  # the brand it buys already, though fewer units
    assert likeness.cousin_vehicles(df, enough=2).count() == 0  # only fits with few products ask; v4 has no cousin
    assert likeness.cousin_products(df, enough=3).where("vehicle_key = 'v1'").count() == 1


def test_one_weight_changes_the_order(spark, schema):
    a, b = {"ProductId": 10000001, "PRICE": 90.0, "FUEL": "E"}, {"ProductId": 10000002, "PRICE": 120.0, "FUEL": "A"}

    def order(**weights):
        return [r["id"] for r in weighting.influence_ranks(scored(spark, schema, {**a, **weights}, {**b, **weights})).orderBy("place").collect()]

    assert order(PRICE_pct="40", FUEL_pct="20") == ["10000001", "10000002"]
    assert order(PRICE_pct="40", FUEL_pct="60") == ["10000002", "10000001"]


def test_weights_fall_back_to_segment_and_default(spark, schema):
    none = dict.fromkeys(weighting.FACTORS, "NO SALES YET")
    df = scored(spark, schema, {"PRICE_pct": "30"}, {"Vehicle": "V2", "PRICE_pct": "50"}, {"Vehicle": "V3", **none}, {"Vehicle": "V4", **none, "Segment": "NO SALES YET"})
    found = {r["vehicle_key"]: (r["PRICE_pct"], r["GRADE_pct"], r["from_fit"]) for r in weighting.factor_weights(df).collect()}
    assert found == {"v1": (3000, 2000, 5), "v2": (5000, 2000, 5), "v3": (4000, 2000, 0), "v4": (2000, 2000, 0)}


def seats(slots, weights, room):
    """Largest remainder with full names taken out, one seat table at a time."""
    got = [0] * len(weights)
    while True:
        free = [k for k in range(len(weights)) if got[k] < room[k]]
        left = slots - sum(got)
        if not left or not free:
            return got
        w = {k: weights[k] for k in free} if any(weights[k] for k in free) else dict.fromkeys(free, 1)
        total = sum(w.values())
        part = {k: left * w[k] // total for k in free}
        over = left - sum(part.values())
        for k in sorted(free, key=lambda k: (-(left * w[k] % total), k))[:over]:
            part[k] += 1
        for k in free:
            got[k] = min(room[k], got[k] + part[k])


def test_seats_like_plain_python(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(25), *(rng.choice([0, 0, 1, 3333, 5000, rng.randrange(10000)]) for _ in range(3)), *(rng.choice([0, 2, 7, 30]) for _ in range(3))) for _ in range(600)]
    df = spark.createDataFrame(rows, "n long, w0 long, w1 long, w2 long, r0 long, r1 long, r2 long")
    names = {"a": "0", "b": "1", "c": "2"}
    for slots in (20, 7):
        out = weighting.apportioned(df, slots, {g: f"w{i}" for g, i in names.items()}, {g: f"r{i}" for g, i in names.items()}, "x")
        assert out.columns == [*df.columns, "x_a", "x_b", "x_c"]
        for r in out.collect():
            want = seats(slots, r[1:4], r[4:7])
            assert list(r[7:]) == want and sum(want) == min(slots, sum(r[4:7]))


def test_quotas_add_up(spark, small):
    df = scored_table(spark, small)
    requests = df.select(F.col("Vehicle"), F.col("SIZE").alias("Size"), "Segment").distinct()
    for r in weighting.grade_quotas(requests, df).collect():
        assert sum(r[f"quota_{g}"] for g in weighting.GRADES) == recommend.MORE
        assert sum(r[f"taken_{g}"] for g in weighting.GRADES) == min(recommend.MORE, sum(r[f"have_{g}"] for g in weighting.GRADES))

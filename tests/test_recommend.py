"""Slot selection against a plain re-statement of the rules over all rows of a fit."""

import random

import pytest
from pyspark.sql import functions as F

from treadmark.functions.lists import SLOTS
from treadmark.plans import recommend
from treadmark.plans.recommend import BRANDS_A, BRANDS_B_ONLY, Rules

SCHEMA = (
    "ProductId long, GRADE string, BRAND string, Model string, SEASONAL_PERFORMANCE string, OFFER string, PRICE double, "
    "PRICEFLUCTUATION double, GoldilocksZone double, TyreScore string, Units long, RunflatStatus string, SalesStatus string, "
    "Vehicle string, SIZE string, Segment string, PremiumShare double, MidRangeShare double, BudgetShare double, RunflatShare double"
)
TIERS = ("1.BEST TYRE SCORE", "2.BETTER TYRE SCORE", "3.GOOD TYRE SCORE", "Unclassified")


def fixture(seed):
    """A few fits: rich, poor, budget-heavy, run-flat, without shares; one size has far more products than slots."""
    rng = random.Random(seed)
    rows = []
    for size, count in (("205/55 R16", 400), ("225/40 ZR18", 30), ("195/65 R15", 6)):
        for vehicle, share in (("CARA", 0.5), ("CARB", 0.2), ("CARC", 0.02)):
            shares = rng.choice([(50.0, 30.0, 20.0, 0.0), (30.0, 20.0, 50.0, 60.0), (40.0, 20.0, 40.0, 90.0), (0.0, 0.0, 0.0, 0.0)])
            for i in range(count):
                if rng.random() < share:
                    pid = 10000000 + i + 1000 * len(size)
                    r = random.Random(pid)
                    rows.append((
                        pid, r.choice(["Premium", "midrange", "Budget", "MIDRANGE"]), r.choice(BRANDS_A[:6] + BRANDS_B_ONLY[:2] + ("Michelin", "Other")),
                        r.choice(["m1", "m2", "m3"]), r.choice(["Summer", "Winter"]), r.choice(["ONOFFER", "no"]), r.choice([90.0, 100.0, 140.0]),
                        r.choice([0.8, 1.0, 1.2]), 100.0, r.choice(TIERS), rng.randint(0, 40), r.choice(["Runflat", "Non-Runflat"]),
                        rng.choice(["Active", "active", "Potential"]), vehicle, size, "SEG1", *shares,
                    ))
    return rows


def relevance(r, rules):
    points = 2 * (r["OFFER"] == "ONOFFER") + 2 * (100 * (1 - rules.zone_pct / 100) <= r["PRICE"] <= 100 * (1 + rules.zone_pct / 100))
    points += (r["PRICEFLUCTUATION"] < 0.9) - (r["PRICEFLUCTUATION"] > 1.1)
    return (r["TyreScore"], -points, -r["Units"], str(r["ProductId"]))


def products(rows, rules):
    """One entry per product: its most relevant row (ties by traits), most relevant product first."""
    best = {}
    for r in rows:
        grade = {"midrange": "MidRange", "premium": "Premium", "budget": "Budget"}[r["GRADE"].lower()]
        active, brand = r["SalesStatus"].lower() == "active", r["BRAND"].lower()
        in_a = brand in {b.lower() for b in BRANDS_A}
        in_b = in_a or brand in {b.lower() for b in BRANDS_B_ONLY}
        checks = [(r["BRAND"], rules.brand), (r["Model"], rules.model), (r["SEASONAL_PERFORMANCE"], rules.season)]
        active_checks = [(x, y) for x, y in checks if y]
        item = dict(
            id=str(r["ProductId"]), grade=grade, a=active and in_a and grade != "Budget", b=active and in_b,
            runflat=r["RunflatStatus"] == "Runflat", brand=brand, units=r["Units"], tier=r["TyreScore"],
            match=bool(active_checks) and all(x.lower() == y.lower() for x, y in active_checks),
        )
        key = (relevance(r, rules), grade, item["a"], item["b"], item["runflat"], item["match"], brand)
        if item["id"] not in best or key < best[item["id"]][0]:
            best[item["id"]] = (key, item)
    return [item for _, item in sorted(best.values(), key=lambda x: x[0][0])]


def select(own_rows, size_rows, segment_mean, rules):
    own = products(own_rows or size_rows, rules)
    own_ids = {p["id"] for p in own}
    other = [p for p in products(size_rows, rules) if p["id"] not in own_ids]
    alike = [p for p in other if (p["grade"], p["runflat"]) == (own[0]["grade"], own[0]["runflat"])]
    pool = own + alike + [p for p in other if p not in alike]
    place = {p["id"]: i for i, p in enumerate(pool)}
    facts = {p["id"]: p for p in pool}
    popular = sorted(own, key=lambda p: (-p["units"], p["tier"], p["id"]))
    shares = {g: max((r[c] for r in own_rows), default=0.0) for g, c in recommend.SHARES.items()}
    known = max(shares.values()) > 0
    if not known:
        shares = segment_mean or dict(recommend.DEFAULT_SHARES)
    flat_share = max((r["RunflatShare"] for r in own_rows), default=0.0) if known else 0.0
    gate = shares["Budget"] > 35

    hot = [p["id"] for p in pool if p["a"]][:3]
    kept = []

    def displace(new):
        if new is None:
            return
        loose = [x for x in hot if x not in kept]
        if new not in hot:
            if len(hot) >= 3:
                if not loose:
                    return
                hot.remove(loose[-1])
            hot.append(new)
            hot.sort(key=place.get)
        kept.append(new)

    promoted = next((p["id"] for p in pool if p["a"] and p["match"]), None) if rules.model else None
    displace(promoted)
    open_b = [p for p in pool if p["b"] and p["id"] not in hot]
    fitting = [p for p in open_b if (p["grade"] == "Budget") == gate]
    wish = next((p["id"] for p in fitting if p["match"]), None) if promoted is None else None
    box4 = wish or next((p["id"] for p in fitting), None) or next((p["id"] for p in open_b if p["grade"] != "Budget"), None)
    first = popular[0]
    if first["id"] in hot or (first["id"] != box4 and first["a"]):
        displace(first["id"])
    elif first["id"] != box4 and first["b"] and first["grade"] == "Budget" and gate and wish is None:
        box4 = first["id"]
    boxes = hot + [box4]
    if shares["Premium"] >= 25 and not any(facts[x]["brand"] == "michelin" for x in boxes if x):
        displace(next((p["id"] for p in popular[:5] if p["brand"] == "michelin" and p["a"]), None))
    want = 3 if flat_share >= 85 else 2 if flat_share >= 55 else 1 if flat_share >= 20 else 0
    seller = next((p["id"] for p in popular if p["runflat"] and p["a"]), None)
    if want and seller != box4:
        displace(seller)
    for _ in range(3):
        if sum(facts[x]["runflat"] for x in hot) < want:
            displace(next((p["id"] for p in pool if p["a"] and p["runflat"] and p["id"] not in hot and p["id"] != box4), None))
    three = [x for x in hot if x != promoted] + [promoted] if promoted in hot else list(hot)
    boxes = (three + [None] * 3)[:3] + [box4]
    more = [first["id"]]
    if (rules.brand or rules.model or rules.season) and promoted is None and wish is None:
        more += [p["id"] for p in pool if p["match"]][:1]
    more = [x for x in more if x not in boxes] + [p["id"] for p in popular if p["id"] not in boxes][:5]
    rest = [p for p in pool if p["id"] not in boxes]
    in_share = set()
    for grade, share in shares.items():
        in_share.update([p["id"] for p in rest if p["id"] in own_ids and p["grade"] == grade][: int(share * 20 / 100 + 0.5)])
    more += [p["id"] for p in rest if p["id"] in in_share] + [p["id"] for p in rest]
    more = list(dict.fromkeys(more))
    return [x or "-" for x in boxes] + (more + ["-"] * 20)[:20]


@pytest.mark.parametrize(
    "seed,rules",
    [(1, Rules()), (2, Rules(brand="Michelin")), (3, Rules(model="m2", season="Winter")), (4, Rules(season="winter")), (5, Rules(model="m1"))],
)
def test_selection_follows_the_rules(spark, seed, rules):
    rows = fixture(seed)
    scored = spark.createDataFrame(rows, SCHEMA)
    asked = [(v, s) for v in ("CarA", "Car B", "CARC", "CARX") for s in ("205/55 R16", "225/40ZR18", "195/65 R15")]
    requests = spark.createDataFrame([(v, s, "SEG1" if i % 2 else "SEGX") for i, (v, s) in enumerate(asked)], "Vehicle string, Size string, Segment string")
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    records = [dict(zip(names, r)) for r in rows]

    def key(r):
        return r["SIZE"].lower().replace(" ", ""), r["Vehicle"].lower()

    fits = {}
    for r in records:
        fits.setdefault(key(r), []).append(r)
    known = [rs for rs in fits.values() if max(rs[0][c] for c in recommend.SHARES.values()) > 0]
    mean = {g: sum(rs[0][c] for rs in known) / len(known) for g, c in recommend.SHARES.items()} if known else None
    answers = recommend.recommend(requests, scored, rules)
    got = {(r.Vehicle, r.Size): [r[c] for c in SLOTS] for r in answers.collect()}
    for i, (v, s) in enumerate(asked):
        size = s.lower().replace(" ", "")
        own = fits.get((size, v.lower().replace(" ", "")), [])
        whole = [r for k, rs in fits.items() if k[0] == size for r in rs]
        assert got[v, s] == select(own, whole, mean if i % 2 else None, rules), (v, s)
    broken = recommend.violations(answers, requests, scored, rules).first().asDict()
    assert not any(v for k, v in broken.items()), broken


def test_unknown_size_gets_no_products(spark):
    scored = spark.createDataFrame(fixture(9), SCHEMA)
    requests = spark.createDataFrame([("CARA", "1/1 R1", "S")], "Vehicle string, Size string, Segment string")
    row = recommend.recommend(requests, scored).first()
    assert [row[c] for c in SLOTS] == ["-"] * 24 and row.success is False


def test_limits_out_of_bounds_fall_back():
    assert Rules(zone_pct=80, fluctuation_upper=3, fluctuation_lower=0.1).checked() == Rules()
    assert Rules(zone_pct=5, fluctuation_upper=2.0, fluctuation_lower=0.5).checked().zone_pct == 5

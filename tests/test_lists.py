"""Slot-list and text expressions against plain re-statements."""

import random
import re

from pyspark.sql import functions as F

from treadmark.functions import lists, parsing

VALID = re.compile(r"[0-9]{7,8}\Z")


def plain_backfill(slots, candidates):
    used, out = set(), []
    for s in slots:
        s = s.strip()
        keep = VALID.match(s) and s not in used
        out.append(s if keep else None)
        if keep:
            used.add(s)
    spare = [c for c in dict.fromkeys(candidates) if VALID.match(c) and c not in used]
    return [x if x else (spare.pop(0) if spare else "-") for x in out]


def test_backfill_and_repeats(spark):
    rng = random.Random(7)
    pool = [str(10000000 + i) for i in range(12)] + ["-", "", "123", " 10000003 ", "1234567", "FormatError"]
    rows = [
        ([rng.choice(pool) for _ in range(rng.randint(0, 24))], [rng.choice(pool[:12] + ["77"]) for _ in range(rng.randint(0, 20))])
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "s array<string>, c array<string>")
    out = df.select(
        "s", "c", lists.backfilled(F.col("s"), F.col("c")).alias("b"), lists.blank_repeats(F.col("s")).alias("r"),
        lists.repeat_count(F.col("s")).alias("n"),
    ).collect()
    for row in out:
        assert row.b == plain_backfill(row.s, row.c)
        seen, expect = set(), []
        for x in row.s:
            t = x.strip()
            expect.append("-" if t not in ("", "-") and t in seen else x)
            seen.add(t)
        assert row.r == expect
        assert row.n == sum(a != b for a, b in zip(row.s, expect))


def test_order_check_counts_repeats_at_their_last_place(spark):
    rows = [(["a", "b", "c"], ["c", "a", "b"]), (["a", "b", "a"], ["a", "b"]), (["a"], ["x"]), ([], ["x"])]
    df = spark.createDataFrame(rows, "r array<string>, g array<string>")
    got = [r[0] for r in df.select(lists.out_of_order(F.col("r"), F.col("g"))).collect()]
    assert got == [["a"], ["b"], [], []]
    missing = [r[0] for r in df.select(lists.missing_from(F.col("r"), F.col("g"))).collect()]
    assert missing == [[], [], ["a"], []]


DASHES = lambda n: " ".join(["-"] * n)
FOUR = "10000001 10000002 10000003 1000004"
MANY = " ".join(str(20000000 + i) for i in range(26))
# text, strict line, loose line; the request is VW Golf, 205/55 R16
READINGS = [
    (f"VW GOLF 205/55R16 {FOUR}", f"VW GOLF 205/55R16 {FOUR} {DASHES(20)}", f"VW_GOLF 20555R16 {FOUR} {DASHES(20)}"),
    ("vw-golf 205/55 R16 10000001 - 10000002", f"vw-golf 205/55 R16 10000001 - 10000002 {DASHES(21)}", None),
    ("VW GOLF 20555R16 111", None, None),
    ("Here it is:\nVW GOLF 205/55 R16 1 2 3 4\nthanks", f"VW GOLF 205/55 R16 1 2 3 4 {DASHES(20)}", None),
    (f"The VW GOLF 205/55 R16 {FOUR}", None, f"VW_GOLF 20555R16 {FOUR} {DASHES(20)}"),
    ("VW GOLF 205/55 R16 10000001 abc 10000002", None, None),
    ("I suggest 10000001, 10000002; 10000003 and 1000004 for the VW Golf (205/55 R16).", None, f"VW_GOLF 20555R16 {FOUR} {DASHES(20)}"),
    (f"I suggest {FOUR} for the VW Golf.", None, None),
    (f"VW Golf 205/55 R16 {MANY}", "VW Golf 205/55 R16 " + MANY[: 24 * 9 - 1], "VW_GOLF 20555R16 " + MANY[: 24 * 9 - 1]),
    ("VW Golf 205/55 R16 - 10000001 - - 10000001", f"VW Golf 205/55 R16 - 10000001 - - 10000001 {DASHES(19)}", f"VW_GOLF 20555R16 10000001 - - 10000001 {DASHES(20)}"),
    ("", None, None),
    (None, None, None),
]
# text, vehicle, size, ids
LENIENT = [
    (f"GOLF 20555R16 {FOUR}", "GOLF", "20555R16", FOUR.split()),
    (f"GOLF 205/55 R16 {FOUR} - x", "GOLF", "205/55R16", [*FOUR.split(), "-", "x"]),
    ("GOLF 20555R16 10000001 - 12 10000002", "ERROR_VEHICLE", "ERROR_SIZE", ["FormatError"] * 24),
    ("GOLF 20555R16 10000001", "ERROR_VEHICLE", "ERROR_SIZE", ["FormatError"] * 24),
    ("  ", "ERROR_VEHICLE", "ERROR_SIZE", ["FormatError"] * 24),
    ("", "ERROR_VEHICLE", "ERROR_SIZE", ["Error"] * 24),
    (None, "ERROR_VEHICLE", "ERROR_SIZE", ["Error"] * 24),
]


def read_lines(spark, texts):
    df = spark.createDataFrame([(t, "VW Golf", "205/55 R16") for t in texts], "t string, v string, s string")
    t, v, s = F.col("t"), F.col("v"), F.col("s")
    return df.select(
        "t", parsing.strict_line(t, v, s).alias("strict"), parsing.loose_line(t, v, s).alias("loose"),
        parsing.lenient_line(t).alias("plain"),
    ).collect()


def test_written_out_readings(spark):
    got = [(r.t, r.strict, r.loose) for r in read_lines(spark, [t for t, _, _ in READINGS])]
    assert got == READINGS
    got = [(r.t, r.plain.vehicle, r.plain.size, r.plain.ids) for r in read_lines(spark, [x[0] for x in LENIENT])]
    assert got == LENIENT


def test_readings_invent_nothing(spark):
    rng = random.Random(3)
    words = ["VW", "GOLF", "205/55", "R16", "20555R16", "-", "10000001", "1000002", "10000003", "12", "x,", "10000004.", "\n", "golf"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts += ["VW GOLF 205/55 R16 " + " ".join(rng.choice(words[5:10]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    rows = read_lines(spark, texts)
    assert sum(r.strict is not None for r in rows) > 20 and sum(r.loose is not None for r in rows) > 50
    for r in rows:
        for line in (r.strict, r.loose):
            if line is None:
                continue
            ids = line.split()[-24:]
            kept = [x for x in ids if x != "-"]
            rest = iter(re.findall(r"[0-9]+", r.t))
            assert len(ids) == 24 and all(x in rest for x in kept)  # in the order of the text


def test_error_line(spark):
    df = spark.createDataFrame([("VW Golf ", "205/55 R16"), (None, "")], "v string, s string")
    got = [r[0] for r in df.select(parsing.error_line(F.col("v"), F.col("s"), "NoContent")).collect()]
    tail = " ".join(["NoContent"] * 4 + ["-"] * 20)
    assert got == [f"VW_Golf 205-55_R16 {tail}", f"UNKNOWN UNKNOWN {tail}"]

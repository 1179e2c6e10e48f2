"""The subword softmax: its arithmetic, held-out labels, misspellings, and awkward tables."""

from __future__ import annotations

import numpy as np
import pytest
from plain_readings import LONG, awkward
from pyspark.sql import functions as F

from treadmark.llm import subword_toxicity as tox
from treadmark.llm.common import table

TEXTS = ["", "   ", "one Two, two!", "x" * 40_000, LONG, "é漢🎉 ...", "a"]


def one(scorer):
    return lambda text: scorer([text])[0]


def test_subwords_are_those_of_each_word_alone():
    words = ["", "a", "ab", "worthless", "é漢🎉x", "worthless", "z" * 50]
    of, buckets = tox.subwords(words)
    for k, w in enumerate(words):
        marked = f"<{w}>"
        grams = [marked[i : i + n] for n in range(tox.SHORTEST, tox.LONGEST + 1) for i in range(len(marked) - n + 1) if n < len(marked)]
        assert (of == k).sum() == 1 + len(grams)
        assert sorted(buckets[of == k]) == sorted(tox.subwords([w])[1])
        repeats = [g for g in grams if grams.count(g) > 1]
        assert len(set(buckets[of == k])) == 1 + len(set(grams)) or repeats  # no collisions among so few
    assert set(tox.subwords(["scum"])[1]) & set(tox.subwords(["scumm"])[1])


def test_a_text_is_the_mean_of_its_words_and_a_word_of_its_subwords():
    rng = np.random.default_rng(3)
    model = tox.Model(rng.normal(0, 1e-2, (tox.BUCKETS, tox.WIDTH)).astype(np.float32), rng.normal(0, 1, (tox.WIDTH, 2)), np.array([0.1, -0.2]))
    scorer = one(tox.Scorer(model))
    for text in TEXTS:
        words = [w.strip(tox.MARKS) for w in text.lower().split()]
        vectors = [np.mean(model.vectors[tox.subwords([w])[1]], axis=0) for w in (words if len(words) < 99 else [])]
        used, weights = tox.bag(text)
        assert len(used) <= tox.BUCKETS and (not words or weights.sum() == pytest.approx(1, abs=1e-3))
        mean = np.mean(vectors, axis=0) if vectors else weights @ model.vectors[used]
        assert weights @ model.vectors[used] == pytest.approx(mean, abs=1e-5)
        logits = tox.GAIN * mean @ model.out + model.shift
        want = np.exp(logits)[1] / np.exp(logits).sum()
        assert scorer(text) == pytest.approx(want, abs=1e-3)


def test_fit_tells_the_classes_apart():
    bags = [tox.bag(t) for t in ("good day to you", "you are scum", "a fine day", "scum all day")] * 4
    labels = np.array([0, 1, 0, 1] * 4, float)
    model = tox.fit(bags, labels)
    p = [one(tox.Scorer(model))(t) for t in ("good day to you", "you are scum", "a fine day", "scum all day")]
    assert max(p[0], p[2]) < 0.5 < min(p[1], p[3])


def test_misspellings_share_subwords(spark, small):
    rng = np.random.default_rng(0)
    plain = [f"w{i}ord" for i in range(300)]
    rows = []
    for i in range(600):
        words = list(rng.choice(plain, 60))
        if i % 2:
            words[7:9] = ["worthless", "disgusting"]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    model = tox.train(docs, labels)
    scorer = one(tox.Scorer(model))
    clean = " ".join(plain[:60])
    assert scorer(clean) < 0.5 < min(scorer(f"{clean} worthles disgustingg"), scorer(f"{clean} Worthlesss!! disgustin"))


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    found = tox.op11_subword_toxicity(spark, folder).join(table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id").filter("held_out").toPandas()
    right = found[found["toxic"] == 1]["predicted"].mean(), 1 - found[found["toxic"] == 0]["predicted"].mean()
    assert len(found) > 500 and right[0] > 0.55 and right[1] > 0.95  # some stems there are parts of ordinary words


def test_held_out_labels_are_not_learned(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.train(docs, labels), tox.train(docs, other)
    assert (a.vectors == b.vectors).all() and (a.out == b.out).all()


def test_without_labels(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scores = {r["score"] for r in tox.toxicity(docs, tox.train(docs, labels)).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() < 0.5


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    got = tox.toxicity(docs, tox.untrained()).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert tox.toxicity(docs.limit(0), tox.untrained()).count() == 0

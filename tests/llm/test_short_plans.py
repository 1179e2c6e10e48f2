"""What few documents need of the driver: few written tables, and the same rows as round by round."""

from __future__ import annotations

import collections
import random

from treadmark.llm import mix


def mixable(spark):
    """Documents of four sources, one of them null; null ids, null and empty texts, repeated rows."""
    rng = random.Random(7)
    rows = [(i, "w " * int(rng.lognormvariate(3, 1.5)), rng.choice(["a", "b", "c", None])) for i in range(300)]
    rows += [(None, "w " * 9, "a"), (None, "w " * 9, "a"), (900, None, "b"), (901, "", None), *rows[:40]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_a_few_documents_are_walked_in_one_step(spark, monkeypatch):
    written, durable = [], mix.durable
    monkeypatch.setattr(mix, "durable", lambda df, name="stage": written.append(name) or durable(df, name))
    assert mix.pareto_mix(mixable(spark)).count() == 344
    assert written.count("drawn") == 1 and len(written) == 8, written


def test_one_step_and_rounds_draw_the_same(spark, monkeypatch):
    found = []
    for few in (1024, 60, 0):
        monkeypatch.setattr(mix, "FEW", few, raising=False)
        found.append(collections.Counter(map(tuple, mix.pareto_mix(mixable(spark)).collect())))
    assert found[0] == found[1] == found[2]

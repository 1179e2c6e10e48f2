"""The pipeline's stages, each judged on its own input, and the registered queries of the package."""

from __future__ import annotations

import collections

import duckdb
import pytest
from plain_readings import awkward, base_spans, classes, shingles, words

import __spark_entry__ as entry
import check
import corpus_pipeline as pipeline
from treadmark.llm import mix, quality_net
from treadmark.llm.common import table
from treadmark.session import durable


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of each stage over the smallest tables that have labels enough."""
    folder, out = "/root/testdata/sf0.01", {}
    docs = table(spark, folder, "documents")
    for name, stage in pipeline.STAGES:
        after = durable(stage(spark, docs, folder), "stage")
        out[name] = ([tuple(r) for r in docs.collect()], [tuple(r) for r in after.collect()], after.columns, docs)
        docs = after
    return out


def test_stages_return_the_columns_of_documents(steps, spark, small):
    columns = table(spark, small, "documents").columns
    assert all(found[2] == columns for found in list(steps.values())[:-1])


def test_quality_keeps_what_the_network_does_not_reject(steps, spark):
    before, after, _, docs = steps["quality classifier"]
    net = quality_net.train(docs, table(spark, "/root/testdata/sf0.01", "labels"))
    bad = {r["doc_id"] for r in quality_net.quality_scores(docs, net).filter("predicted = 0").collect()}
    assert bad and sorted(r for r in before if r[0] not in bad) == sorted(after)


def test_one_document_of_each_group_stays(steps):
    before, after, _, _ = steps["n-gram Jaccard join"]
    groups = {}
    by_shingle = collections.defaultdict(list)
    sets = {r[0]: shingles(r[1]) for r in before}
    for i, s in sets.items():
        for g in s:
            by_shingle[g].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = collections.Counter((a, b) for ids in by_shingle.values() for k, a in enumerate(ids) for b in ids[k + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    groups = {find(i) for i in sets}
    assert {r[0] for r in after} == groups and len(after) == len(groups) < len(before)


def test_secrets_are_masked_and_nothing_else_changes(steps):
    before, after, _, _ = steps["secret scans"]
    texts = {r[0]: r for r in after}
    assert len(after) == len(before)
    hit = 0
    for doc_id, text, lang, source, n_chars in before:
        now = texts[doc_id]
        assert not base_spans(now[1]) and now[2:4] == (lang, source)
        if base_spans(text):
            hit += 1
            assert "[SECRET]" in now[1] and now[4] == len(now[1])
        else:
            assert now == (doc_id, text, lang, source, n_chars)
    assert hit


def test_mixture_repeats_whole_documents(steps):
    before, after, _, docs = steps["mixing sources to target weights"]
    copies = {r["doc_id"]: r["copies"] for r in mix.pareto_mix(docs).collect()}
    assert collections.Counter(after) == collections.Counter({r: copies[r[0]] for r in before if copies[r[0]]})


def test_pieces_of_the_mixture(steps):
    before, after, _, _ = steps["SentencePiece encoding and decoding"]
    assert collections.Counter(r[0] for r in before) == collections.Counter(r[0] for r in after)
    assert all(r[2] == len(r[1]) and r[3] for r in after)


def test_pipeline_of_awkward_documents(spark, tmp_path):
    docs = awkward(spark)
    folder = str(tmp_path)
    table(spark, "/root/testdata/sf0.001", "labels").write.parquet(f"{folder}/labels.parquet")
    for empty in (False, True):
        rows = docs.limit(0) if empty else docs
        for _, stage in pipeline.STAGES:
            rows = durable(stage(spark, rows, folder), "stage")
        assert (rows.count() == 0) == empty


@pytest.mark.parametrize("name", ["op1_pareto_mix", "op8_metric_search", "op10_url_filter"])
def test_queries_against_duckdb(spark, small, name):
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    verdict, _ = check.compare(spark, con, small, name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def test_joins_and_links_of_the_registered_query(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, small, "documents").collect()]
    found = collections.Counter(tuple(r) for r in entry.queries()["op6_jaccard_join"](spark, small).collect())
    assert found == classes(rows)


def test_words_are_those_of_the_contract():
    assert words("a b c\x0bd\x1ce") == ["a b", "c", "d\x1ce"]

"""The corpus pipeline, stage by stage, and the registered queries."""

import random

import duckdb
import pytest

import corpus_pipeline as cp
from tests.conftest import SMALL
from tests.llm.test_operators import SECRETS, base_spans, components, measures, shingles
from tests.oracle_check import compare, duck
from vintage.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = [(5000 + i, f"{s} and some more words to make this text long enough for any rule {i}", "en", None, 1) for i, s in enumerate(SECRETS)]
    extra += [(6000, None, None, "src0", None), (6001, "", "en", "src1", 0)]
    return docs.union(spark.createDataFrame(extra, docs.schema)).cache()


def test_rules_stage(spark, corpus):
    out = cp.quality_rules(spark, corpus, SMALL)
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == corpus.columns
    for r in corpus.collect():
        m = measures(r.text)
        if m[0] < 10 or 100 * m[4] > 20 * m[0]:
            assert r.doc_id not in kept


def test_near_duplicate_stage(spark, corpus):
    rows = corpus.collect()
    sets = {r.doc_id: shingles(r.text, 5) for r in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = {n for n, c in components(ids, links).items() if n == c}
    out = cp.near_duplicates(spark, corpus, SMALL)
    assert out.columns == corpus.columns and sorted(r.doc_id for r in out.collect()) == sorted(want)


def test_near_duplicate_stage_keeps_documents_of_null_and_repeated_ids(spark, corpus):
    rng = random.Random(12)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(None, a), (None, a), (None, b), (7, b + " more"), (1, c), (1, d), (1, d), (0, c), (2, e), (2, e + " more"), (3, e)]
    docs = spark.createDataFrame([(i, t, "en", f"src{k % 2}", len(t)) for k, (i, t) in enumerate(rows)], corpus.schema)
    want = sorted([(-1, a), (7, b + " more"), (0, c), (1, d)])
    for some in (docs, docs.repartition(5)):
        got = cp.near_duplicates(spark, some, SMALL).collect()
        near = [(-1 if r.doc_id is None else r.doc_id, r.text) for r in got if r.doc_id != 2]
        assert sorted(near) == want and [r.text in (e, e + " more") for r in got if r.doc_id == 2] == [True]


def test_secret_stage(spark, corpus):
    before = {r.doc_id: r.text for r in corpus.collect()}
    for r in cp.secret_scans(spark, corpus, SMALL).collect():
        assert not base_spans(r.text or "")
        if not base_spans(before[r.doc_id] or "") and r.doc_id < 5000:
            assert r.text == before[r.doc_id] or "[SECRET]" in r.text


def test_pipeline_runs_on_rows_of_any_order(spark, corpus):
    docs = corpus
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert set(docs.columns) == set(corpus.columns)
    out = cp.bpe_encoding(spark, docs, SMALL).collect()
    assert out and all(len(r.ids) == 4 * r.n_tokens for r in out)


def test_stages_on_an_empty_table(spark, corpus):
    docs = corpus.filter("false")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_extra_columns_stay(spark, corpus):
    names = ["key", "cell", "row", "node", "component_id", "spans", "quality", "w", "size", "m_n_words"]
    docs = corpus.limit(40)
    for n in names:
        docs = docs.withColumn(n, docs["doc_id"])
    docs = docs.cache()
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert all(r.key == r.doc_id == r.m_n_words == r.component_id for r in out.collect())


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_sql(spark, key):
    sf = "/root/testdata/sf0.01"
    df = QUERIES[key](spark, sf)
    con: duckdb.DuckDBPyConnection = duck(sf)
    res = con.execute(ORACLE_SQL[key])
    ok, msg = compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg


def test_run(spark):
    random.seed(0)
    out = cp.run(spark, SMALL)
    assert out.count() > 0 and "ids" in out.columns

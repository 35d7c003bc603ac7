"""Nearest neighbours: scores and order against brute force, recall by count."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.llm import nearest
from vintage.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, asked, k):
    """{query: [(id, score)]} over all rows of another id, equal rows once."""
    out = {}
    for q, v in asked.items():
        have = {(i, tuple(x)) for i, x in rows if i != q and len(x) == len(v)}
        out[q] = sorted(((i, float(np.dot(np.array(x), np.array(v)))) for i, x in have), key=lambda t: (-t[1], t[0]))[:k]
    return out


def found(df, asked, k):
    got = {}
    for r in nearest.search(df, asked, k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
    return {q: [r[1:] for r in rows] for q, rows in got.items()}


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in rows}) for q, rows in want.items())
    return hit / sum(map(len, want.values()))


def made(n, dim, seed, norms=False):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((20, dim))
    x = middles[rng.integers(0, 20, n)] + 0.5 * rng.standard_normal((n, dim))
    if norms:
        x *= 10.0 ** rng.uniform(-2, 2, n)[:, None]
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("block,asked,norms", [(16384, 16384, False), (256, 7, False), (256, 16384, True)])
def test_recall(spark, monkeypatch, block, asked, norms):
    monkeypatch.setattr(nearest, "BLOCK", block)
    monkeypatch.setattr(nearest, "ASKED", asked)
    rows = made(2000, 24, 5, norms)
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows, {i: v for i, v in rows if i % 20 == 0}, 20)
    got = found(df, df.filter("vec_id % 20 = 0"), 20)
    assert recall(got, want) >= 0.95
    truth = {q: dict(r) for q, r in plain(rows, {i: v for i, v in rows if i % 20 == 0}, 2000).items()}
    for q, r in got.items():
        assert len(r) == 20 and all(abs(s - truth[q][i]) <= 1e-12 * max(1, abs(s)) for i, s in r)


def test_small_tables_are_exact(spark):
    """Everything within a leaf is verified: ties, repeats, odd rows."""
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)] + [1.0]) for i in range(30)]
    rows += [(100 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(12)] + [rows[0], rows[0], (0, [5.0, 0.0, 0.0, 1.0]), (7, [0.0, 2.0]), (8, [1.0, 2.0])]
    odd = [(40, None), (41, []), (42, [0.0] * 4), (43, [float("nan")] * 4), (44, [float("inf"), 1.0, 1.0, 1.0]), (45, [None, 1.0, 1.0, 1.0]), (None, [9.0] * 4)]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumn("score", F.lit("x")).withColumn("V", F.lit(1)).repartition(4)
    asked = {}
    for i, v in rows:
        if i % 5 == 0:
            asked[i] = min(asked.get(i, v), v)
    got = found(df, df.filter("vec_id % 5 = 0"), 4)
    # a row of another length has that of the same length only; ids with several vectors appear with each
    want = plain(rows, asked, 4)
    assert got == {q: r for q, r in want.items() if r}


def test_one_vector_in_most_rows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 256)
    rows = made(900, 16, 8) + [(1000 + i, made(1, 16, 9)[0][1]) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    queries = df.filter("vec_id % 100 = 0")
    got, want = found(df, queries, 20), plain(rows, {i: v for i, v in rows if i % 100 == 0}, 20)
    # among equal vectors the smallest ids
    for q in want:
        ties = [i for i, _ in got[q] if i >= 1000]
        assert ties == sorted(ties) and (not ties or ties == [i for i in range(1000, 1000 + len(ties) + 1) if i != q][:len(ties)])
    assert recall(got, want) >= 0.95


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(20, [1.0, 2.0])], SCHEMA)
    assert nearest.search(none, none).collect() == [] and nearest.search(some, some).collect() == [] and nearest.search(some, none).collect() == []


def test_chi_square():
    assert abs(nearest.chi2_cdf(15.507313) - 0.95) < 1e-6 and abs(nearest.quantile(0.95) - 15.507313) < 1e-5
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 30))
    norm = nearest._norms(x)
    p = nearest._project(x, norm, norm.max())
    lift = np.sqrt(1 - (norm / norm.max()) ** 2)
    r = ((x[1:] - x[:-1]) ** 2).sum(axis=1) / norm.max() ** 2 + (lift[1:] - lift[:-1]) ** 2
    assert abs(np.mean(((p[1:] - p[:-1]) ** 2).sum(axis=1) <= nearest.quantile(0.9) * r) - 0.9) < 0.1


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["op13_nearest_neighbours"](spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(got, plain(rows, {i: v for i, v in rows if i % 20 == 0}, 20)) >= 0.9

"""What the near-duplicate join and the mix move between tasks, with joins as on large inputs."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.llm import common, minhash, mixing


@pytest.fixture
def large(spark):
    """No table is small enough to be broadcast unless the code says so."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def moves(df, columns):
    """Shuffles of the plan whose rows hold one of ``columns``."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    parts = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan, re.S)
    return sum(any(re.search(rf"\b{c}#", p) for c in columns) for p in parts)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_few_others_keeps_all_that_are_asked_for(large, monkeypatch):
    ids = large.range(0, 4000, 7).select(F.col("id").alias("n")).union(large.createDataFrame([(-1,), (None,), (-(1 << 63),)], "n long"))
    rows = large.range(-5, 8000).select(F.col("id").alias("n"), F.lit("t").alias("long")).union(
        large.createDataFrame([(-(1 << 63), "t"), (3 * 7, "again")], "n long, long string"))
    want = {r.n for r in ids.collect() if r.n is not None}
    for longs in (1, 16, common.FILTER):
        monkeypatch.setattr(common, "FILTER", longs)
        out = common.few_others(rows, ids, "n")
        got = [r.n for r in out.collect()]
        assert want <= set(got) and got.count(21) == 2 and out.columns == rows.columns
    assert len(got) < len(want) + 20


def test_texts_without_a_pair_are_not_moved(large):
    texts = large.range(500).select(F.col("id").alias("node"), F.concat_ws(" ", F.lit("some words"), F.col("id")).alias("text"))
    pairs = large.createDataFrame([(1, 2), (3, 400)], "a long, b long")
    plan = plan_of(minhash._needed(texts, pairs))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r.node for r in minhash._needed(texts, pairs).collect()} >= {1, 2, 3, 400}


def test_keys_move_once_and_hold_all_that_meet(large):
    rng = np.random.default_rng(5)
    low = 1 << minhash.BITS
    symbols = rng.integers(0, low, (60, minhash.CHUNKS, minhash.SYMBOLS))
    symbols[0], symbols[1] = 0, low - 1
    for i in range(20, 60):  # altered copies
        symbols[i] = symbols[i % 5]
        symbols[i].ravel()[rng.choice(40, rng.integers(1, 12), replace=False)] ^= rng.integers(1, low)
    node = [7 if i in (3, 4) else i for i in range(60)]  # two texts under one id
    chunks = (symbols << (minhash.BITS * np.arange(minhash.SYMBOLS))).sum(axis=2)
    classes = large.createDataFrame([(n, *map(int, c)) for n, c in zip(node, chunks)], "node long, " + ", ".join(f"{c} long" for c in minhash._SIG))
    members = defaultdict(list)
    for n, s in zip(node, symbols):
        for c in range(minhash.CHUNKS):
            for v in range(minhash.SYMBOLS):
                members[c, v, tuple(np.delete(s[c], v))].append(n)
    met = minhash._mixed(minhash._keys(classes), "node")
    assert plan_of(met).count("Exchange") == 1
    got = defaultdict(list)
    for r in met.collect():
        assert 0 <= r.key >> minhash._SLOT < minhash.CHUNKS * minhash.SYMBOLS
        got[r.key].append((r.node, r.n_met))
    want = [(k[0] * minhash.SYMBOLS + k[1], sorted((n, len(v)) for n in v)) for k, v in members.items() if len(set(v)) > 1]
    assert sorted((k >> minhash._SLOT, sorted(v)) for k, v in got.items()) == sorted(want)


def test_the_mix_moves_texts_once(large):
    rows = [(i, f"w{i} " * (i % 9), [None, "", "a", "b"][i % 4]) for i in range(400)] + [(None, "one two", None), (5, "w5 x", "a"), (6, None, "b")]
    docs = large.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, carry=True)
    assert moves(mixed, ["row", "text"]) == 1
    one = sorted(str((r.doc_id, r.size, r.source_size, r.target, r.taken)) for r in mixed.collect())
    assert one == sorted(str(tuple(r)) for r in mixing.mix(docs).collect()) and len(one) == len(rows)
    of = defaultdict(list)
    for r in mixed.collect():
        of[r.row.source].append(r)
    assert set(of) == {None, "", "a", "b"}
    for some in of.values():
        assert {r.source_size for r in some} == {sum(len((r.row.text or "").split()) for r in some)}
        assert sum(r.taken for r in some) == int(some[0].target)

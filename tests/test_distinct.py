"""Distinct counts by words of bits, and column partials, against plain counts."""

import random

import pytest
from pyspark.sql import functions as F

from vintage.operators import distinct, partials
from vintage.operators import distribution as dist
from vintage.operators.joins import lookup
from vintage.sources.positions import laid_out, positioned
from vintage.spec import FieldSpec, Source


def rows(n=3000, seed=1):
    rng = random.Random(seed)
    ids = [None, 0, -1, -(2 ** 63), 2 ** 63 - 1, *range(100, 400), *[rng.randrange(-2 ** 62, 2 ** 62) for _ in range(300)]]
    out = [(rng.choice(ids), rng.choice("ab"), rng.choice([None, "x", "y", "z", ""])) for _ in range(n)]
    # one id in a third of all rows, ids that occur once, a value that only NULL ids hold
    out += [(7, rng.choice("ab"), rng.choice(["x", "w"])) for _ in range(n // 2)]
    out += [(10 ** 15 + i, "a", "once") for i in range(500)] + [(None, "b", "nobody")] * 3
    return out


@pytest.mark.parametrize("place", [positioned, laid_out])
def test_distinct_ids_equal_count_distinct(spark, place):
    df = spark.createDataFrame(rows(), "id long, k string, v string").repartition(6)
    want = {(r.k, r.v): r.n for r in df.groupBy("k", "v").agg(F.count_distinct("id").alias("n")).collect()}
    placed = place(df, "id")
    assert placed.count() == df.count() and placed.filter("_once").count() >= 500
    got = distinct.distinct_ids(placed, ["k", "v"], "n").collect()
    assert {(r.k, r.v): r.n for r in got} == want and len(got) == len(want)
    # finer words merge to coarser ones
    total = distinct.counted(distinct.merged(distinct.words(placed, ["k", "v"]), ["v"]), ["v"], "n")
    wide = {r.v: r.n for r in df.groupBy("v").agg(F.count_distinct("id").alias("n")).collect()}
    assert {r.v: r.n for r in total.collect()} == wide
    flags = distinct.flagged_ids(placed, ["k"], {"x": F.col("v") == "x", "every": F.lit(True)})
    plain = df.groupBy("k").agg(F.count_distinct(F.when(F.col("v") == "x", F.col("id"))).alias("x"), F.count_distinct("id").alias("every"))
    assert sorted(flags.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("batch", [1 << 16, 100])
def test_column_words_equal_count_distinct(spark, monkeypatch, batch):
    monkeypatch.setattr(partials, "BATCH", batch)
    df = spark.createDataFrame(rows(), "id long, k string, v string").withColumn("inside", F.col("id") % 3 != 0)
    df = df.withColumn("inside", F.coalesce("inside", F.lit(True))).withColumn("w", F.length("v").cast("string"))
    parts = partials.column_words(positioned(df, "id"), ["k"], ["v", "w"], ["inside", None])
    got = {(r._field, r.k, r._value): r.n for r in
           distinct.counted(distinct.merged(parts, ["_field", "k", "_value"]), ["_field", "k", "_value"], "n").collect()}
    want = {}
    for i, (c, d) in enumerate((("v", df.filter("inside")), ("w", df))):
        want |= {(i, r.k, r.c): r.n for r in d.groupBy("k", F.col(c).alias("c")).agg(F.count_distinct("id").alias("n")).collect()}
    assert got == want


def test_column_counts_equal_group_by(spark):
    df = spark.createDataFrame([("a", None, ["x ", " y", ""]), ("a", "v", None), (None, "v", []), ("b", "v", ["x"]), ("b", "", [None, "x", "x"])],
                               "k string, v string, l array<string>").repartition(3)
    got = {(r._field, r.k, r._value): r.n for r in partials.column_counts(df, ["k"], ["v", "l"]).groupBy("_field", "k", "_value").agg(F.sum("_n").alias("n")).collect()}
    assert got == {(0, "a", "v"): 1, (0, None, "v"): 1, (0, "b", "v"): 1, (0, "b", ""): 1,
                   (1, "a", "x"): 1, (1, "a", "y"): 1, (1, "a", ""): 1, (1, "b", "x"): 3}
    assert partials.column_counts(df.limit(0), ["k"], ["v"]).count() == 0


def test_enrichment_that_copies_rows(spark):
    """A code in two groups counts its id once in each, and once in other fields."""
    df = spark.createDataFrame([(1, "c"), (2, "c"), (3, "d"), (4, None)], "id long, code string")
    groups = spark.createDataFrame([("c", "g1"), ("c", "g2"), ("d", "g1")], "code string, grp string")

    def marked(d):
        return lookup(d, groups, "code")
    marked.marks_copies = True
    for prep in (marked, lambda d: d.join(groups, "code", "left")):
        s = Source("s", lambda: df, id="id", date="d")
        fields = [FieldSpec("grp", {"s": "grp"}, prep={"s": prep}, normalize=False), FieldSpec("code", {"s": "code"}, normalize=False)]
        got = {(r.field, r.field_value): (r.s_count, r.s_frac) for r in dist.distribution_matrix([s], fields, None).collect()}
        assert got == {("grp", "g1"): (3, 0.75), ("grp", "g2"): (2, 0.5), ("code", "c"): (2, 0.5), ("code", "d"): (1, 0.25)}
        assert [tuple(r) for r in dist.coverage_matrix([s], fields, None).orderBy("field").collect()] == [("s", "code", 4, 3), ("s", "grp", 4, 3)]

"""Releases under one schema, recounts of a chain, results in order, label unions."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.operators.chain import recounted
from vintage.operators.labels import label_union
from vintage.sources.ordered import read_ordered, write_ordered
from vintage.sources.releases import Releases, versions, wider
from vintage.sources.snapshots import snapshot


def _releases(spark, root):
    spark.createDataFrame([(1, "a", 1.5)], "id int, city string, w float").write.parquet(f"{root}/v9/t")
    spark.createDataFrame([(2 ** 40, "b", 2, "x")], "ID long, town string, w int, extra string").write.parquet(f"{root}/v10/t")
    spark.createDataFrame([(3, "2020-01-01")], "id short, seen string").select("id", F.to_date("seen").alias("seen")).write.parquet(f"{root}/v11/t")
    spark.range(1).write.parquet(f"{root}/v12/other")


def test_releases_are_aligned(spark, tmp_path):
    _releases(spark, tmp_path)
    assert versions(spark, str(tmp_path), "t") == ["v9", "v10", "v11"]
    rel = Releases(spark, str(tmp_path), "t", {"town": "city"}, {"city": "?"})
    frames = rel.aligned()
    assert {tuple(df.dtypes) for df in frames.values()} == {(("id", "bigint"), ("city", "string"), ("w", "double"), ("extra", "string"), ("seen", "date"))}
    assert [tuple(frames[v].first())[:3] for v in rel.names] == [(1, "a", 1.5), (2 ** 40, "b", 2.0), (3, "?", None)]
    drift = {(v, c): change for v, c, change, _, _ in rel.drift() if change != "widened"}
    assert drift == {("v9", "extra"): "absent", ("v9", "seen"): "absent", ("v10", "city"): "renamed from town", ("v10", "seen"): "absent",
                     ("v11", "city"): "dropped", ("v11", "w"): "dropped", ("v11", "extra"): "dropped"}
    assert {(v, c) for v, c, change, _, _ in rel.drift() if change == "widened"} == {("v9", "id"), ("v9", "w"), ("v10", "w"), ("v11", "id")}
    # unused columns never leave the file
    plan = frames["v10"].select("city")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<town:string>" in plan
    with pytest.raises(ValueError, match="two columns"):
        Releases(spark, str(tmp_path), "t", {"town": "id"})


def test_wider_types():
    i, lg, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert wider(i, lg) == lg and wider(i, d) == d and wider(lg, d) == s and wider(s, i) == s and wider(T.NullType(), i) == i
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType() and wider(T.FloatType(), d) == d


def test_a_new_release_reads_only_itself(spark, tmp_path):
    rng, asked = random.Random(3), []

    def release(name, n):
        df = spark.createDataFrame([(rng.choice("US UK".split()), rng.choice(["x", "y", None, "unclassified"]), rng.choice(["p", "q"])) for _ in range(n)],
                                   "country string, a string, b string")

        def rows():
            asked.append(name)
            return df
        return df, rows

    made = {n: release(n, 50 + 10 * i) for i, n in enumerate(("r1", "r2", "r3"))}
    fields, store = {"a": None, "b": F.col("country") == "US"}, str(tmp_path / "chain")
    two = {n: ("state", made[n][1]) for n in ("r1", "r2")}
    assert recounted(spark, store, two, fields)[1] == ["r1", "r2"]
    asked.clear()
    counts, read = recounted(spark, store, {**two, "r3": ("state", made["r3"][1])}, fields)
    assert read == asked == ["r3"]
    got = {(r.field, r.country, r.field_value): (r.cnt_r1, r.cnt_r2, r.cnt_r3) for r in counts.collect()}
    want = {}
    for i, n in enumerate(("r1", "r2", "r3")):
        for f, cond in (("a", F.col("a").isin("x", "y")), ("b", F.col("country") == "US")):
            for r in made[n][0].filter(cond).groupBy("country", f).count().collect():
                want.setdefault((f, r.country, r[f]), [0, 0, 0])[i] = r["count"]
    assert got == {k: tuple(v) for k, v in want.items()}
    # other files or other fields are counted anew
    asked.clear()
    assert recounted(spark, store, {"r1": ("changed", made["r1"][1]), "r2": two["r2"]}, fields)[1] == ["r1"]
    assert recounted(spark, store, two, {"b": None})[1] == ["r1", "r2"]


def test_results_in_order(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, n int, s string").repartition(7)
    order = [F.col("n").desc_nulls_last(), F.col("s").asc_nulls_first(), F.col("id").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(df, str(tmp_path / "t"), order, ["n", "s"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or "", r[0]))
    got = {r.position: (r.id, r.n, r.s) for r in read_ordered(spark, str(tmp_path / "t")).collect()}
    assert [got[i + 1] for i in range(500)] == want
    ranges = snapshot(spark, str(tmp_path / "t"))["ranges"]
    assert len(ranges) > 3 and sum(r["rows"] for r in ranges) == 500 and ranges[0]["first"][0] == "3" and ranges[-1]["last"][0] is None
    page = read_ordered(spark, str(tmp_path / "t"), 120, 140)
    assert {r.position: r.id for r in page.collect()} == {i: want[i - 1][0] for i in range(120, 141)}
    assert "PartitionFilters: [_range" in page._jdf.queryExecution().executedPlan().toString().replace("isnotnull(_range", "[_range").replace("[[", "[") \
        or "_range" in page._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]
    write_ordered(df.limit(0), str(tmp_path / "none"), order, ["n"])
    assert read_ordered(spark, str(tmp_path / "none")).collect() == []


def test_label_union_keeps_spellings(spark):
    a = spark.createDataFrame([("Sales ",), ("SALES",), ("SALES",), ("Law",), (None,)], "l string")
    b = spark.createDataFrame([("sales", 3.0), ("Art", 1.0), (" art", 1.0)], "name string, w double")
    got = {r.key: tuple(r)[1:] for r in label_union({"a": (a, "l", None), "b": (b, "name", "w")}).collect()}
    assert got == {"sales": ("SALES", "SALES", 3.0, 0.75, "sales", 3.0, 0.6), "law": ("Law", "Law", 1.0, 0.25, None, 0.0, 0.0),
                   "art": (" art", None, 0.0, 0.0, " art", 2.0, 0.4)}

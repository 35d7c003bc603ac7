"""Snapshots and the job matrix: whole tables only, restarts, side-by-side runs."""

import threading

import pytest
from pyspark.sql import functions as F

from vintage.plans.publish import Artifact, publish
from vintage.sources import snapshots as sn
from vintage.sources.tables import read_result


def test_snapshots_replace_and_stay_readable(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sn.read_snapshot(spark, table)
    one = sn.write_snapshot(spark.range(100).withColumn("k", (F.col("id") % 3).cast("string")), table, ["k"], {"why": "first"})
    two = sn.write_snapshot(spark.range(7).withColumn("k", F.lit("x")), table, ["k"])
    none = sn.write_snapshot(spark.range(0).withColumn("k", F.lit("x")), table, ["k"])
    assert (one["rows"], two["rows"], none["rows"]) == (100, 7, 0) and [x["version"] for x in (one, two, none)] == [1, 2, 3]
    assert sn.snapshot(spark, table, 1)["why"] == "first" and sn.snapshot(spark, table, 9) is None
    assert sn.read_snapshot(spark, table).count() == 0 and sn.read_snapshot(spark, table).columns == ["id", "k"]
    assert {r.id for r in sn.read_snapshot(spark, table, 1).filter("k = '2'").collect()} == set(range(2, 100, 3))
    assert all(sn.intact(spark, table, v) for v in (1, 2, 3))
    assert sn.expire(spark, table, keep=2) == [one["folder"]]
    assert sn.snapshot(spark, table, 1) is None and sn.read_snapshot(spark, table, 2).count() == 7


def test_write_that_dies_leaves_the_old_table(spark, tmp_path):
    table = str(tmp_path / "t")
    sn.write_snapshot(spark.range(50), table)
    dies = spark.range(1000).repartition(8).select(F.when(F.col("id") == 777, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        sn.write_snapshot(dies, table)
    assert sn.read_snapshot(spark, table).count() == 50 and sn.snapshot(spark, table)["version"] == 1
    # a writer's folder that no version names goes once it is old
    assert sn.expire(spark, table, grace=3600) == [] and len(sn.expire(spark, table, grace=0)) <= 1
    assert sn.read_snapshot(spark, table).count() == 50


def test_readers_and_writers_at_once(spark, tmp_path):
    """Readers see whole tables only; of writers that meet each gets a version."""
    table, stop, seen, wrong = str(tmp_path / "t"), threading.Event(), set(), []
    sn.write_snapshot(spark.range(10).select(F.lit(0).alias("v")), table)

    def read():
        while not stop.is_set():
            rows = {(r.v, r.n) for r in sn.read_snapshot(spark, table).groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
            if len(rows) != 1 or next(iter(rows))[1] != 10 * (next(iter(rows))[0] + 1):
                wrong.append(rows)
            seen.update(rows)

    def write(v):
        sn.write_snapshot(spark.range(10 * (v + 1)).select(F.lit(v).alias("v")), table)

    reader = threading.Thread(target=read)
    reader.start()
    writers = [threading.Thread(target=write, args=(v,)) for v in range(1, 6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    stop.set()
    reader.join()
    assert not wrong and seen
    assert sorted(sn.snapshot(spark, table, n)["rows"] for n in range(2, 7)) == [20, 30, 40, 50, 60]


def test_only_what_failed_runs_again(spark, tmp_path):
    built, down = [], [True]

    def make(name, n):
        def build():
            built.append(name)
            if name == "b" and down[0]:
                raise ValueError("no")
            return spark.range(n)
        return build

    out = str(tmp_path / "out")
    arts = {"a": (make("a", 3), []), "b": Artifact(make("b", 4)), "c": Artifact(make("c", 5), after=["b"]), "d": Artifact(make("d", 6), after=["a"])}
    first = {r.artifact: r for r in publish(spark, arts, out, {"a": "note"}, inputs="x").collect()}
    assert {n: (r.status, r.rows) for n, r in first.items()} == {"a": ("ok", 3), "b": ("failed", None), "c": ("skipped", None), "d": ("ok", 6)}
    assert "ValueError: no" in first["b"].error and first["c"].error == "waits for b" and first["a"].description == "note"
    down[0], built[:] = False, []
    again = publish(spark, arts, out, inputs="x").collect()
    assert [(r.artifact, r.status) for r in again] == [("a", "kept"), ("b", "ok"), ("c", "ok"), ("d", "kept")] and sorted(built) == ["b", "c"]
    built[:] = []
    assert {r.status for r in publish(spark, arts, out, inputs="other").collect()} == {"ok"} and sorted(built) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="unknown"):
        publish(spark, {"a": Artifact(make("a", 1), after=["z"])}, out)
    with pytest.raises(ValueError, match="each other"):
        publish(spark, {"a": Artifact(make("a", 1), after=["b"]), "b": Artifact(make("b", 1), after=["a"])}, out)


def test_artifacts_run_side_by_side(spark, tmp_path):
    meet = threading.Barrier(2, timeout=60)

    def build():
        meet.wait()
        return spark.range(1)

    m = publish(spark, {"a": Artifact(build), "b": Artifact(build)}, str(tmp_path / "out"), parallel=2).collect()
    assert [r.status for r in m] == ["ok", "ok"]


def test_names_follow_the_last_snapshot(spark, tmp_path):
    for n in (2, 3):
        df = spark.range(n).withColumn("field", F.lit(7))
        publish(spark, {"comp": Artifact(lambda df=df: df, ["field"])}, str(tmp_path / "out"), database="vintage_snapshots")
        got = read_result(spark, "vintage_snapshots.comp")
        assert got.count() == n and dict(got.dtypes)["field"] == "int"

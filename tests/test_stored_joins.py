"""The two joins that the inputs are derived from are stored once, and rows
with positions cross one exchange."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vintage.sources import positions
from vintage.sources.fixtures import VIEWS, Fixtures


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Small tables with orders that come twice and keys without a partner or a value."""
    out, rng = str(tmp_path_factory.mktemp("tables")), random.Random(3)

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{out}/{name}.parquet")

    day = lambda: dt.datetime(1997, 1, 1) + dt.timedelta(days=rng.randrange(2000))
    write("region", [(0, "AMERICA"), (1, "EUROPE")], "r_regionkey long, r_name string")
    write("nation", [(i, f"NATION_{i}", i % 2) for i in range(4)], "n_nationkey long, n_name string, n_regionkey long")
    write("customer", [(i, f"c{i}", "BUILDING", i % 4) for i in range(40)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey long")
    write("supplier", [(i, f"s{i}", i % 4) for i in range(20)], "s_suppkey long, s_name string, s_nationkey long")
    write("part", [(i, f"p{i}", "B", rng.choice(["PROMO", "SMALL"]), i % 50) for i in range(90)],
          "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    orders = [(i, rng.choice([None, *range(45)]), rng.choice("FOP"), 1.0 * i, day(), rng.choice(["1-URGENT", "5-LOW", None])) for i in range(300)]
    write("orders", orders + orders[:30], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    lines = [(rng.randrange(310), rng.randrange(95), rng.randrange(21), rng.randrange(1, 8), 1.0 * rng.randrange(50), 100.0, day()) for _ in range(1500)]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz")
    return out


def test_stored_rows_equal_the_recipes(spark, root):
    kept, plain = Fixtures(spark, root), Fixtures(spark, root, staged=False)
    for name in [*sorted(VIEWS), "postings_v1", "postings_v2", "postings_ext", "imputed", "postings_ext_uk"]:
        want = getattr(plain, name)()
        got = getattr(kept, name)().select(want.columns)
        assert want.count() > 0 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0, name


def test_profile_tables_share_their_joins(spark, root):
    fx = Fixtures(spark, root)
    for names in (("profiles_base", "profiles_new", "education_base", "education_new"), ("persons_base", "persons_new")):
        files = [set(getattr(fx, n)().inputFiles()) for n in names]
        assert files[0] and all(f == files[0] for f in files), names
    assert not any("Sort" in getattr(fx, n)()._jdf.queryExecution().executedPlan().toString() for n in VIEWS)


def test_release_positions_are_exact(spark, root):
    for name in ("postings_v1", "postings_v2"):
        rows = getattr(Fixtures(spark, root), name)()
        by_id = rows.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), F.max("_once").alias("once"), F.count_distinct("_pos").alias("p"))
        assert by_id.filter("job_id IS NULL AND (once OR p > 0) OR job_id IS NOT NULL AND p <> 1").count() == 0
        assert by_id.filter("once AND n > 1").count() == 0 and by_id.filter("once").count() > 50
        assert rows.filter("NOT _once AND job_id IS NOT NULL").count() > 0


def test_rows_with_positions_cross_one_exchange(spark):
    df = spark.range(5000).select((F.col("id") % 4000).alias("id"), F.col("id").cast("string").alias("v"))
    placed = positions.laid_out(df, "id")
    placed.collect()
    plan = placed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [x for x in plan.split("\n") if "Exchange" in x and "Broadcast" not in x]
    # the rows once; another one may count rows by id
    assert len(moved) <= 2 and sum("rangepartitioning" in x for x in moved) == 1, moved
    assert placed.filter("_once").count() == 3000


def test_hot_and_unknown_ids_are_spread(spark, monkeypatch):
    monkeypatch.setattr(positions, "HOT_ROWS", 500)
    k = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = positions.laid_out(spark.range(9000).select(k.cast("long").alias("k"), F.col("id").alias("v")), "k").withColumn("p", F.spark_partition_id())
        rows = placed.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(rows) == 9000
    for key in (7, None):
        own = [r for r in rows if r.k == key]
        assert len(own) == 3000 and len({r.p for r in own}) > 1 and not any(r._once for r in own)
    assert all(r._once and r._pos == r.k for r in rows if r.k not in (7, None))


def test_known_folder_is_found_without_a_job(spark, root):
    fx = Fixtures(spark, root)
    fx.release_root()
    spark.sparkContext.setJobGroup("known folder", "")
    fx.release_root()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("known folder")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []

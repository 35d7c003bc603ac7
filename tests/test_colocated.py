"""Tables stored side by side: no exchange under their joins, hot and NULL
keys apart, the same results as plain tables."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_plans import _final_plan

from vintage.operators.changes import code_pairs
from vintage.operators.distribution import union_all
from vintage.operators.salary import salary_coverage, salary_stats
from vintage.plans.postings import PostingsJob
from vintage.sources import colocated as co

IN_PLACE = {
    "code_changes_top": lambda j: j.code_changes_top(),
    "code_agreement": lambda j: j.code_agreement(),
    "classifier_agreement": lambda j: j.classifier_agreement(),
    "salary_stats": lambda j: j.salary_stats(),
    "salary_buckets": lambda j: j.salary_buckets(),
    "salary_coverage": lambda j: j.salary_coverage(),
    "salary_outliers": lambda j: j.salary_outliers(True),
}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", IN_PLACE)
def test_bucketed_joins_move_nothing(spark, no_broadcast, key):
    """Join keys cross an exchange in the plain part at most: once for each
    side of a join of unbucketed files, never over a bucketed scan."""
    plan = _final_plan(IN_PLACE[key](PostingsJob(spark, SMALL)))
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    lines = plan.split("\n")
    for at, line in enumerate(lines):
        if not re.search(r"Exchange hashpartitioning\((job_id|desc_id)#", line):
            continue
        depth = line.index("Exchange")
        for below in lines[at + 1:]:
            if re.search(r"[A-Z]", below) and re.search(r"[A-Za-z]", below).start() <= depth:
                break
            assert "Bucketed: true" not in below, (key, line)


def _skewed(spark, root):
    """A third of the rows share key 7, some have none."""
    n = 30_000
    k = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 4000).cast("long")
    a = spark.range(n).select(k.alias("k"), (F.col("id") % 5).cast("string").alias("code"), F.lit("US").alias("country"))
    b = spark.range(9000).select(F.when(F.col("id") % 90 == 0, F.lit(None)).otherwise(F.col("id") % 4500).alias("k"), (F.col("id") % 4).cast("string").alias("code"),
                                 F.lit("YEARLY").alias("per"), ((F.col("id") % 11) * 1000.0).alias("amount"))
    a.write.parquet(f"{root}/a"), b.write.parquet(f"{root}/b")
    return spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/b")


def test_hot_and_null_keys_have_a_part_of_their_own(spark, tmp_path):
    a, b = _skewed(spark, str(tmp_path / "d"))
    parts = co.colocated(spark, str(tmp_path / "d"), "fam", "k", {"a": lambda: a, "b": lambda: b})
    cold, plain = parts
    assert sorted(r.k for r in plain["a"].select("k").distinct().collect() if r.k is not None) == [7]
    assert cold["a"].filter("k = 7 or k is null").count() == cold["b"].filter("k = 7 or k is null").count() == 0
    for m, whole in (("a", a), ("b", b)):
        both = union_all([p[m] for p in parts])
        assert both.exceptAll(whole).count() == whole.exceptAll(both).count() == 0
    got = union_all([code_pairs(p["a"], p["b"].select("k", "code"), "k", "code") for p in parts])
    want = code_pairs(a, b.select("k", "code"), "k", "code")
    total = lambda df: sorted(map(tuple, df.groupBy("old_code", "new_code").agg(F.sum("w")).collect()))
    assert total(got) == total(want)


def test_salaries_by_part_equal_the_whole(spark, tmp_path):
    a, b = _skewed(spark, str(tmp_path / "d"))
    parts = co.colocated(spark, str(tmp_path / "d"), "fam", "k", {"a": lambda: a, "b": lambda: b})
    named = lambda df: df.withColumnsRenamed({"k": "desc_id", "amount": "parsed_salary_min", "per": "salary_per"})
    pa, pb = [named(p["a"]) for p in parts], [named(p["b"]) for p in parts]
    for run in (lambda p, s: salary_stats({"s": p}, s), lambda p, s: salary_coverage({"s": p}, s, "country", {"US": "US"})):
        assert run(pa, pb).collect() == run(named(a), named(b)).collect()


def test_family_is_entered_again_by_another_application(spark, tmp_path):
    a, b = _skewed(spark, str(tmp_path / "d"))
    members = {"a": lambda: a, "b": lambda: b}
    first = co.colocated(spark, str(tmp_path / "d"), "fam", "k", members)
    for (app, path) in [m for m in co._ENTERED if co._ENTERED[m] is first]:
        for m in members:
            spark.sql(f"DROP TABLE `{co._table(path, m)}`")
        del co._ENTERED[app, path]
    again = co.colocated(spark, str(tmp_path / "d"), "fam", "k", members)
    assert sum(p["a"].count() for p in again) == a.count()


def test_empty_members(spark, tmp_path):
    root = str(tmp_path / "d")
    spark.range(0).selectExpr("id k").write.parquet(f"{root}/a")
    a = spark.read.parquet(f"{root}/a")
    (part,) = co.colocated(spark, root, "fam", "k", {"a": lambda: a, "b": lambda: a})
    assert part["a"].join(part["b"], "k").count() == 0


def test_bucket_count():
    assert co.bucket_count(0) == co.MIN_BUCKETS
    assert co.bucket_count(10 ** 11) == 32768

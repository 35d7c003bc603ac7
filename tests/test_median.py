"""The distributed exact median against numpy, including a hot group that
spans many bins and heavy ties."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vintage.operators.median import exact_median


def _np_medians(rows):
    out = {}
    for g, v in rows:
        if v is not None:
            out.setdefault(g, []).append(v)
    return {g: float(np.median(vs)) for g, vs in out.items()}


def test_hot_group_over_many_bins(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", float(x)) for x in rng.integers(0, 500, 20000)]
    rows += [("cold", float(x)) for x in rng.normal(size=101)]
    rows += [("even", 1.0), ("even", 4.0), ("one", 3.5), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    want = _np_medians(rows)
    assert set(got) == set(want)
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=0, abs=1e-12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-5, 5)), min_size=1, max_size=60))
def test_matches_numpy(spark, data):
    rows = [(g, float(v)) for g, v in data]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    want = _np_medians(rows)
    assert got == pytest.approx(want)


def test_ranks_agree_without_exchange_reuse(spark):
    """The two readers of the histogram must agree even when Spark
    recomputes the exchange."""
    rng = np.random.default_rng(3)
    rows = [("hot", float(x)) for x in rng.normal(size=5000)] + [("b", 1.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert got == pytest.approx(_np_medians(rows), abs=1e-12)


def test_edge_values_and_null_keys(spark):
    rows = [("tiny", x) for x in (5e-324, 1e-300, 1e-300, -1e-300)]
    rows += [("signs", x) for x in (-1e9, -2.0, -0.0, 0.0, 3.0, 1e12)] + [(None, 1.0), (None, 2.0)]
    rows += [("inf", x) for x in (float("-inf"), 7.0, float("inf"))] + [("close", 1.0 + i * 1e-9) for i in range(101)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    assert got == _np_medians(rows)


def test_empty_table(spark):
    assert exact_median(spark.createDataFrame([], "g string, v double"), ["g"], "v").collect() == []


def test_no_job_while_the_plan_is_built(spark):
    from tests.conftest import SMALL
    from vintage.plans.catalog import QUERIES
    keys = ["salary_stats", "salary_stats_with_vendor", "salary_median_by_group", "agreement_stats",
            "monthly_benchmark_wide"]
    for k in keys:
        QUERIES[k](spark, SMALL)  # stages the inputs
    spark.sparkContext.setJobGroup("building", "")
    for k in keys:
        QUERIES[k](spark, SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []

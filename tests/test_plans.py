"""Plan shape: scans, pushdown, exchange reuse and top-k strategy."""

import contextlib
import io
import re

from tests.conftest import SMALL

from __spark_entry__ import queries


def _final_plan(df):
    df.collect()
    s = df._jdf.queryExecution().executedPlan().toString()
    # AQE prints the final plan, then the initial plan: keep the final one.
    return s.split("== Initial Plan ==")[0]


def test_matrix_scans_each_release_once(spark):
    p = _final_plan(queries()["profile_matrix_long"](spark, SMALL))
    # three base tables of two releases, one exchange per base table
    assert len(re.findall(r"FileScan parquet", p)) == 6
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 3


def test_kpi_matrix_expands_no_rows_before_its_exchange(spark):
    p = _final_plan(queries()["profile_matrix_kpi"](spark, SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 3
    for below in p.split("Exchange hashpartitioning")[1:]:
        assert "Generate" not in below.split("Union")[0]


def test_distribution_one_scan_per_source_and_reused_exchange(spark):
    p = _final_plan(queries()["distribution_three_sources"](spark, SMALL))
    assert len(re.findall(r"FileScan parquet", p)) == 3
    assert "ReusedExchange" in p or "Reused" in p


def test_field_matrix_counts_its_columns_in_one_stage(spark):
    p = _final_plan(queries()["postings_field_matrix"](spark, SMALL))
    assert p.count("MapInArrow") == 1
    # each source once for the values and, ids and scopes only, for the totals; the lookup and its key counts
    assert len(re.findall(r"FileScan parquet", p)) <= 8
    values = p.split("MapInArrow")[1].split("BroadcastExchange HashedRelationBroadcastMode(List(input[0, string, false], input[1")[0]
    assert "Generate" not in values


def test_profile_matrix_expands_no_rows(spark):
    p = _final_plan(queries()["profile_matrix_long"](spark, SMALL))
    assert "Generate" not in p and p.count("MapInArrow") == 3


def test_distinct_counts_move_words_not_ids(spark):
    """What crosses the first exchange is keyed by word, never by id."""
    for k in ("totals_yearly", "coverage_three_sources", "postings_kpi_matrix", "distribution_three_sources"):
        p = _final_plan(queries()[k](spark, SMALL))
        for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p):
            assert "job_id" not in keys and not re.search(r"\bid#", keys), (k, keys)


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_period_and_country_reach_the_scan(spark):
    s = _formatted(queries()["distribution_three_sources"](spark, SMALL))
    assert "GreaterThanOrEqual(post_date,2000-01-01T00:00)" in s
    assert "LessThan(post_date,2001-01-01T00:00)" in s
    assert "EqualTo(country,United States)" in s


def test_column_pruning(spark):
    s = _formatted(queries()["coverage_three_sources"](spark, SMALL))
    assert "ReadSchema: struct<post_date:timestamp_ntz,country:string,naics2_name:string,_pos:bigint,_once:boolean>" in s


def test_top_k_is_take_ordered(spark):
    s = queries()["code_changes_top"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in s


def test_per_group_top_k_uses_group_limit(spark):
    s = queries()["relative_change_top"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in s


def test_no_python_udf_anywhere(spark):
    for k, q in queries().items():
        if k.startswith("publish_"):
            continue
        s = q(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in s and "ArrowEvalPython" not in s, k


def test_no_cross_joins_in_any_plan(spark):
    for k, q in queries().items():
        if k.startswith("publish_"):
            continue
        p = _final_plan(q(spark, SMALL))
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, k


def test_recommended_conf_sizes():
    from vintage.session import recommended_conf
    c = recommended_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert recommended_conf(1024, 8)["spark.sql.shuffle.partitions"] == "16"

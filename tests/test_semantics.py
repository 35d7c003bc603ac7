"""Semantics of SURVEY §2.14 on a few literal rows each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintage.functions import expr as X
from vintage.operators import compare as cmp
from vintage.operators import views as vw
from vintage.operators.coverage import coverage
from vintage.operators.distribution import distribution, distribution_anchored
from vintage.operators.salary import salary_stats
from vintage.operators.trends import monthly_totals_spine
from vintage.spec import FieldSpec, Period, Source

D = dt.datetime(2020, 3, 4)


def _postings(spark, rows):
    return spark.createDataFrame(rows, "id long, d timestamp_ntz, country string, v string, code string")


def _src(name, df, country=None):
    return Source(name, lambda: df, "id", "d", country)


# ---------------------------------------------------------------- profiles
def _profiles(spark, rows):
    return spark.createDataFrame(
        rows, "country string, v string, conf int, raw string")


def test_s2_list_split_keeps_empty_element_and_whole_string_exclusion(spark):
    base = _profiles(spark, [("X", "A, B, ", 9, "ok"), ("X", "A, Unclassified", 9, "ok"),
                             ("X", "C", 9, '"[""]'), ("X", "D", 9, None)])
    new = _profiles(spark, [("X", "A", 9, "ok")])
    out = {r.field_value: (r.cnt_base, r.cnt_new) for r in cmp.release_list_value_counts(
        {"base": base, "new": new}, "v", raw="raw").collect()}
    # '' from the trailing separator is counted; the whole entry with an
    # unclassified element is dropped; sentinel and NULL raw text drop rows.
    assert out == {"A": (1, 1), "B": (1, 0), "": (1, 0)}


def test_s4_s3_null_groups_stay_apart_and_benchmark_label(spark):
    base = _profiles(spark, [("X", None, 9, ""), ("X", "A", 9, ""), ("X", "A", 9, ""), ("X", "B", 9, "")])
    new = _profiles(spark, [("X", None, 9, ""), ("X", "A", 9, "")])
    bench = spark.createDataFrame([("A", 10.0), ("Z", 5.0)], "label string, share double")
    rel = {"base": base, "new": new}
    rows = cmp.release_share_vs_benchmark(rel, "v", bench, "label", ["share"], ("country", "X")).collect()
    got = sorted((r.v or "~", r.pct_base, r.pct_new, r.share) for r in rows)
    # NULL counts in the denominator (25% each); two separate NULL rows.
    assert got == [("A", 50.0, 50.0, 10.0), ("B", 25.0, 0.0, 0.0), ("Z", 0.0, 0.0, 5.0),
                   ("~", 0.0, 50.0, 0.0), ("~", 25.0, 0.0, 0.0)]
    strict = cmp.release_share_vs_benchmark(rel, "v", bench, "label", ["share"], ("country", "X"),
                                            strict=True).collect()
    assert sorted(r.share for r in strict if r.v is None) == [0.0, 0.0, 5.0]


def test_s5_whole_percents_round_half_up(spark):
    # 1 of 8 = 12.5% -> 13 (the original job rounds 0.125 to 0.13 then x100).
    base = _profiles(spark, [("X", "A", 9, "")] + [("X", "B", 9, "")] * 7)
    rows = cmp.release_share_vs_benchmark({"base": base}, "v",
                                          spark.createDataFrame([], "label string, s double"),
                                          "label", ["s"], ("country", "X")).collect()
    assert {r.v: r.pct_base for r in rows} == {"A": 13.0, "B": 88.0}


def test_s6_s7_coverage_test_and_gate(spark):
    base = _profiles(spark, [("X", "Unclassified", 9, ""), ("X", "Other (unclassified)", 9, ""),
                             ("X", None, 9, ""), ("X", "A", 1, "")])
    r = cmp.release_coverage({"base": base}, F.col("v") != "Unclassified",
                             gate=F.col("conf") >= 7).collect()[0]
    # the gate removes the low-confidence row from both sides; NULL is not
    # counted; only the exact word is excluded.
    assert (r.coverage_base, r.profiles_base) == (pytest.approx(1 / 3), 3)


def test_c9_country_dependent_gate(spark):
    from vintage.plans.profiles import school_gate
    df = spark.createDataFrame([("United States", 72, 0), ("usa ", 71, 99), ("France", 0, 70),
                                ("France", 99, 69)], "country string, school_confidence int, "
                               "intl_school_confidence int")
    assert [r.ok for r in df.select(school_gate().alias("ok")).collect()] == [True, False, True, False]


# ---------------------------------------------------------------- postings
def test_s8_s9_extra_predicate_in_totals_lookup_only_in_covered(spark):
    p = _postings(spark, [(1, D, "US", "a", "k1"), (2, D, "US", "b", "zz"), (3, D, "US", "c", "k1"),
                          (3, D, "US", "c", "k1")])
    lu = spark.createDataFrame([("k1", "Group")], "code string, grp string")
    f = FieldSpec("g", {"s": "grp"}, prep={"s": lambda df: df.join(lu, "code", "left")},
                  extra={"s": lambda: F.col("v") != "b"})
    r = coverage([_src("s", p)], f, None).collect()[0]
    assert (r.total, r.covered) == (2, 2)
    f2 = FieldSpec("g", {"s": "grp"}, prep={"s": lambda df: df.join(lu, "code", "left")})
    r2 = coverage([_src("s", p)], f2, None).collect()[0]
    assert (r2.total, r2.covered) == (3, 2)   # the lookup miss lowers coverage only


def test_s10_denominators(spark):
    p = _postings(spark, [(1, D, "US", "a", None), (2, D, "US", "a", None), (3, D, "US", None, None),
                          (4, D, "US", "b", None)])
    f = FieldSpec("v", {"s": "v"})
    all_ = {r.field_value: r.frac for r in distribution([_src("s", p)], f, None, long=True).collect()}
    cls = {r.field_value: r.frac for r in distribution([_src("s", p)], f, None, "classified",
                                                        long=True).collect()}
    assert all_ == {"A": 0.5, "B": 0.25}
    assert cls == pytest.approx({"A": 2 / 3, "B": 1 / 3})


def test_s18_top_k_ties_broken_by_value(spark):
    rows = [(i, D, "US", v, None) for i, v in enumerate(["b", "a", "c", "c"])]
    p = _postings(spark, rows)
    f = FieldSpec("v", {"s": "v"})
    out = distribution_anchored([_src("s", p)], f, None, anchor="s", k=2).collect()
    assert sorted(r.field_value for r in out) == ["A", "C"]


def test_s28_blank_string_is_covered(spark):
    p = _postings(spark, [(1, D, "US", "  ", None), (2, D, "US", None, None)])
    r = coverage([_src("s", p)], FieldSpec("v", {"s": "v"}), None).collect()[0]
    assert (r.total, r.covered) == (2, 1)
    r = coverage([_src("s", p)], FieldSpec("v", {"s": "v"}, blank_is_null=True), None).collect()[0]
    assert (r.total, r.covered) == (2, 0)


def test_period_is_half_open_and_country_scope(spark):
    p = _postings(spark, [(1, dt.datetime(2019, 12, 31, 23), "US", "a", None),
                          (2, dt.datetime(2020, 1, 1), "US", "a", None),
                          (3, dt.datetime(2021, 1, 1), "US", "a", None),
                          (4, dt.datetime(2020, 6, 1), "UK", "a", None)])
    r = coverage([_src("s", p, ("country", "US"))], FieldSpec("v", {"s": "v"}),
                 Period.year(2020)).collect()[0]
    assert r.total == 1


def test_s23_spine_zero_months_and_later_months_drop(spark):
    p = _postings(spark, [(1, dt.datetime(2020, 1, 5), "US", "a", None),
                          (2, dt.datetime(2020, 3, 5), "US", "a", None),
                          (3, dt.datetime(2020, 9, 5), "US", "a", None),
                          (4, dt.datetime(2019, 1, 5), "US", "a", None)])
    out = monthly_totals_spine(spark, [_src("s", p)], None, "2020-03-15", months=3).collect()
    got = {r.month_start.isoformat(): r.cnt for r in out}
    assert got == {"2020-01-01": 1, "2020-02-01": 0, "2020-03-01": 1}


# ------------------------------------------------------------------ salary
def test_x9_s16_s27_annualisation_and_counts(spark):
    posts = spark.createDataFrame([(1, "US")], "desc_id long, country string")
    sal = spark.createDataFrame(
        [(1, "Year", 100.0), (1, "HOUR", 1.0), (1, "piece", 5.0), (1, "year ", 7.0), (1, None, 9.0),
         (1, "week", 0.0), (1, "day", None)],
        "desc_id long, salary_per string, parsed_salary_min double")
    r = salary_stats({"v1": posts}, sal).collect()[0]
    # yearly values: 100, 2000, NULL (piece), 7 (untrimmed period -> raw), 9 (NULL -> raw)
    assert (r.min_salary, r.max_salary, r.n_postings_with_salary, r.n_values) == (7.0, 2000.0, 5, 4)
    assert r.median_salary == 54.5


def test_x11_bucket_and_x12_suffix(spark):
    df = spark.createDataFrame([(199999.0, "Austin, TX"), (200001.0, "NY"), (9999.0, "")],
                               "y double, c string")
    out = df.select(X.salary_bucket("y").alias("b"), X.drop_suffix("c").alias("c")).collect()
    assert [(r.b, r.c) for r in out] == [(190000, "Austin"), (210000, ""), (0, "")]


def test_x14_split_trims_every_element(spark):
    df = spark.createDataFrame([("a , b,  c1, d11",)], "s string")
    assert df.select(X.split_list("s").alias("x")).first().x == ["a", "b", "c1", "d11"]


def test_pct_round_exact_ties(spark):
    df = spark.createDataFrame([(57, 200), (1, 8), (2, 3)], "n long, d long")
    assert [r.p for r in df.select(X.pct_round("n", "d", 1).alias("p")).collect()] == [28.5, 12.5, 66.7]
    assert [r.p for r in df.select(X.pct_round("n", "d", 0).alias("p")).collect()] == [29.0, 13.0, 67.0]


# ------------------------------------------------------------------- views
def test_s25_relative_change_null_base_dropped(spark):
    c = spark.createDataFrame([("X", "a", 0, 5), ("X", "b", 10, 5), ("X", "c", 4, 8)],
                              "country string, field_value string, cnt_base long, cnt_new long")
    out = vw.relative_change_top(c, "base", "new", k=20).collect()
    assert sorted((r.field_value, r.pct_change) for r in out) == [("b", -50.0), ("c", 100.0)]


def test_s24_share_within_top_vs_total(spark):
    c = spark.createDataFrame([("X", "a", 1, 6), ("X", "b", 1, 3), ("X", "c", 1, 1)],
                              "country string, field_value string, cnt_base long, cnt_new long")
    out = {r.field_value: (r.share_within_top_new, r.share_of_total_new)
           for r in vw.top_values_share_within(c, ["base", "new"], "new", k=2).collect()}
    assert out == {"a": (pytest.approx(6 / 9), 0.6), "b": (pytest.approx(3 / 9), 0.3)}


def test_self_comparison_is_full_agreement(spark):
    from vintage.operators.changes import code_agreement, code_pairs
    p = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id long, code string")
    r = code_agreement(code_pairs(p, p, "id", "code")).collect()[0]
    # id 2 appears twice on each side: 4 joined pairs, as the inner join counts
    assert (r.same_code, r.different_code, r.total_matched) == (5, 0, 5)


# ----------------------------------------------------------------- loaders
def test_landed_series_json_and_wide_csv(spark, tmp_path):
    import json
    from vintage.operators import benchmark as bm
    payload = {"Results": {"series": [
        {"seriesID": "JTS000000060000000JOL", "data": [
            {"year": "2024", "period": "M01", "value": "1.5"},
            {"year": "2024", "period": "M02", "value": "2.5"},
            {"year": "2024", "period": "M13", "value": "9.0"},
            {"year": "2023", "period": "M01", "value": "7.0"}]},
        {"seriesID": "JTS000000990000000JOL", "data": [
            {"year": "2024", "period": "M01", "value": "1"}]}]}}
    p = tmp_path / "resp.json"
    p.write_text(json.dumps(payload, indent=2))
    s = bm.read_series_files(spark, str(p))
    out = bm.series_annual_mean(s, "2024").collect()
    assert [(r.state, r.bench_count) for r in out] == [("CALIFORNIA", 2000)]

    c = tmp_path / "wide.csv"
    c.write_text("Year,Jan,Feb\n2024,1.5,x\nnote,,\n2023.0,,2\n")
    rows = bm.wide_monthly_to_long(bm.read_wide_csv(spark, str(c))).collect()
    assert sorted((r.month.isoformat(), r.posting_count) for r in rows) == [
        ("2023-02-01", 2000), ("2024-01-01", 1500)]


def test_display_order_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("c", 5)], "k string, n int")
    assert [r.k for r in vw.display_order(df, "n", descending=["n"]).collect()] == ["c", "b", "a"]


def test_s21_two_names_for_one_code_do_not_inflate(spark):
    rows = [(1, "7", "Seven", 5, dt.datetime(2020, 1, 1), None, "US"),
            (2, "7", "Seven (old)", 5, dt.datetime(2020, 1, 1), None, "US"),
            (3, "8", "Eight", 5, dt.datetime(2020, 1, 1), None, "US")]
    rel = spark.createDataFrame(rows, "person_id long, naics2_code string, naics2_name string, "
                                      "company_id long, start_date timestamp_ntz, "
                                      "end_date timestamp_ntz, country string")
    bench = spark.createDataFrame([("B", "Ind", "7", 0.5), ("B", "Ind", "8", 0.5)],
                                  "bls_code string, industry string, naics2_code string, bls_pct double")
    r = cmp.stint_industry_share({"base": rel}, bench, "2021-01-01", "2021-12-31", ("country", "US")).first()
    assert (r.perc_bls, r.perc_base) == (0.5, 1.0)


def test_pivot_check_raises_on_duplicate_cells(spark):
    from vintage.operators.reshape import pivot_unique
    df = spark.createDataFrame([("m", "a", 1), ("m", "a", 2)], "k string, s string, v long")
    wide = pivot_unique(df, ["k"], "s", ["a"], "v", check=True)
    with pytest.raises(Exception, match="not unique"):
        wide.collect()


def test_empty_source_still_reports_a_row(spark):
    p = _postings(spark, [(1, D, "US", "a", None)])
    empty = _postings(spark, [])
    f = FieldSpec("v", {"s": "v", "e": "v"})
    got = {r.source: (r.total, r.covered)
           for r in coverage([_src("s", p), _src("e", empty)], f, None).collect()}
    assert got == {"s": (1, 1), "e": (0, 0)}
    posts = spark.createDataFrame([(1, "US")], "desc_id long, country string")
    sal = spark.createDataFrame([(2, "year", 5.0)], "desc_id long, salary_per string, parsed_salary_min double")
    r = salary_stats({"v1": posts}, sal).collect()
    assert [(x.source, x.median_salary, x.n_postings_with_salary) for x in r] == [("v1", None, 0)]

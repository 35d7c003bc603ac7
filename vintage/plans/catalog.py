"""Registry of every query: key -> callable(spark, dataset_dir) -> DataFrame.

Each key is one pipeline of the original job (SURVEY §2.13) run over the whole
derived tables of one dataset directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vintage.operators import stats as st
from vintage.operators import views as vw
from vintage.operators.salary import agreement_frame
from vintage.plans.postings import PostingsJob
from vintage.plans.profiles import BASE, NEW, ProfilesJob

Query = Callable[[SparkSession, str], DataFrame]

# Test parameter: ordinal ladder of the long view (the dashboard's degree ladder).
LADDER = ["SMALL", "MEDIUM", "STANDARD"]


def _pr(fn: Callable[[ProfilesJob], DataFrame]) -> Query:
    return lambda spark, root: fn(ProfilesJob(spark, root))


def _po(fn: Callable[[PostingsJob], DataFrame]) -> Query:
    return lambda spark, root: fn(PostingsJob(spark, root))


def _agreement(j: PostingsJob, medians: DataFrame, a: str, b: str) -> DataFrame:
    g = agreement_frame(medians, "soc2", a, b)
    return st.agreement_stats(g, "a_median", "b_median", exclude_regex="military|unclassified",
                              label="soc2")


def _publish(job: str) -> Query:
    """The job's manifest without its run's paths."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        from vintage.plans import publish
        return getattr(publish, job)(spark, root).select("artifact", "status", "rows")
    return run


def _publish_twice(spark: SparkSession, root: str) -> DataFrame:
    from vintage.plans import publish
    return publish.publish_twice(spark, root)


QUERIES: dict[str, Query] = {
    # profile job
    "value_counts_two_releases": _pr(lambda j: j.value_counts()),
    "value_counts_list_field": _pr(lambda j: j.list_value_counts()),
    "value_counts_with_benchmark": _pr(lambda j: j.value_counts_with_benchmark()),
    "coverage_two_releases": _pr(lambda j: j.coverage()),
    "coverage_country_gate": _pr(lambda j: j.coverage_country_gate()),
    "occupation_share_benchmark": _pr(lambda j: j.occupation_share()),
    "industry_share_stints": _pr(lambda j: j.industry_share()),
    "profile_matrix_long": _pr(lambda j: j.matrix_long()),
    "profile_matrix_kpi": _pr(lambda j: j.matrix_kpi()),
    # postings: totals
    "totals_yearly": _po(lambda j: j.totals_yearly()),
    "totals_monthly_spine": _po(lambda j: j.totals_monthly_spine()),
    "overlap_totals_yearly": _po(lambda j: j.overlap_totals_yearly()),
    "overlap_totals_monthly": _po(lambda j: j.overlap_totals_monthly()),
    # postings: coverage and distributions
    "coverage_three_sources": _po(lambda j: j.coverage("industry")),
    "coverage_extra_filter": _po(lambda j: j.coverage("employer")),
    "distribution_three_sources": _po(lambda j: j.distribution("industry")),
    "distribution_recode": _po(lambda j: j.distribution("degree")),
    "distribution_lookup_join": _po(lambda j: j.distribution("soc2")),
    "distribution_city_trim": _po(lambda j: j.distribution("city")),
    "distribution_top_anchor": _po(lambda j: j.distribution_top_anchor("employer")),
    "postings_field_matrix": _po(lambda j: j.distribution_matrix()),
    "postings_kpi_matrix": _po(lambda j: j.coverage_matrix()),
    "overlap_coverage": _po(lambda j: j.overlap_coverage()),
    "overlap_distribution": _po(lambda j: j.overlap_distribution()),
    "overlap_field_matrix": _po(lambda j: j.overlap_distribution_matrix()),
    "overlap_kpi_matrix": _po(lambda j: j.overlap_coverage_matrix()),
    "field_coverage_by_source": _po(lambda j: j.field_coverage_by_source()),
    "kpi_cards": _po(lambda j: j.kpi_cards("industry")),
    # postings: code changes
    "code_changes_top": _po(lambda j: j.code_changes_top()),
    "code_agreement": _po(lambda j: j.code_agreement()),
    "code_changes_lookup": _po(lambda j: j.code_changes_lookup()),
    "classifier_changes": _po(lambda j: j.classifier_changes()),
    "classifier_agreement": _po(lambda j: j.classifier_agreement()),
    # salary
    "salary_stats": _po(lambda j: j.salary_stats()),
    "salary_stats_with_vendor": _po(lambda j: j.salary_stats_with_vendor()),
    "salary_buckets": _po(lambda j: j.salary_buckets()),
    "salary_median_by_group": _po(lambda j: j.salary_median_by_group()),
    "salary_coverage": _po(lambda j: j.salary_coverage()),
    "salary_outliers_high": _po(lambda j: j.salary_outliers(True)),
    "salary_outliers_low": _po(lambda j: j.salary_outliers(False)),
    "agreement_stats": _po(lambda j: _agreement(j, j.salary_median_by_group(), "v1", "v2")),
    "agreement_stats_with_vendor": _po(lambda j: _agreement(j, j.salary_median_with_vendor(), "ext", "v1")),
    "salary_buckets_with_vendor": _po(lambda j: j.salary_buckets_with_vendor()),
    "salary_median_with_vendor": _po(lambda j: j.salary_median_with_vendor()),
    "salary_coverage_with_vendor": _po(lambda j: j.salary_coverage_with_vendor()),
    # benchmarks
    "series_json_mean": _po(lambda j: j.series_mean()),
    "state_share_benchmark": _po(lambda j: j.state_share()),
    "state_share_rows_variant": _po(lambda j: j.state_share(notebook=True)),
    "wide_month_unpivot": _po(lambda j: j.wide_month_unpivot()),
    "coded_benchmark_load": _po(lambda j: j.coded_benchmark()),
    "monthly_benchmark_long": _po(lambda j: j.monthly_benchmark_long()),
    "monthly_benchmark_wide": _po(lambda j: j.monthly_benchmark_wide()),
    "sector_share_benchmark": _po(lambda j: j.sector_share()),
    "sector_share_rows": _po(lambda j: j.sector_share_rows()),
    "sector_rollup_map": _po(lambda j: j.sector_rollup_map()),
    "group_share_vs_employment": _po(lambda j: j.group_share_vs_employment()),
    "truncated_code_share": _po(lambda j: j.truncated_code_share()),
    "group_share_rows": _po(lambda j: j.group_share_rows()),
    "loglog_r2_employment": _po(lambda j: st.loglog_fit(j.truncated_code_share(), "employment_pct", "v2_pct")),
    "top_pp_diff_employment": _po(lambda j: st.top_point_differences(
        j.truncated_code_share(), "code", "v2_pct", "employment_pct", 25)),
    "imputed_key_join": _po(lambda j: j.imputed_key_join()),
    "loglog_r2": _po(lambda j: st.loglog_fit(j.state_share(), "bench_pct", "v1_pct")),
    "top_pp_diff": _po(lambda j: st.top_point_differences(j.sector_share(), "sector",
                                                          "full_v1_pct", "benchmark_pct", 25)),
    # views over results
    "top_values_share_within": _pr(lambda j: vw.top_values_share_within(
        j.value_counts(), [BASE, NEW], NEW, k=25)),
    "relative_change_top": _pr(lambda j: vw.relative_change_top(j.value_counts(), BASE, NEW, k=20)),
    "pp_diff_pairs": _po(lambda j: vw.pp_diff_pairs(
        j.distribution("industry"), [("v1", "v2"), ("v1", "ext"), ("v2", "ext")], k=15)),
    "long_view_ordered": _pr(lambda j: vw.long_view(
        j.value_counts_with_benchmark(),
        {"cnt_base": "Base release", "cnt_new": "New release", "cnt_benchmark": "Benchmark"},
        ladder=LADDER)),
    "long_view_by_count": _pr(lambda j: vw.long_view(
        j.value_counts(), {"cnt_base": "Base release", "cnt_new": "New release"}, sort_col="cnt_new")),
    # releases by version, results in order, labels by any spelling
    "release_chain_counts": _po(lambda j: j.release_chain_counts()),
    "release_chain_incremental": _po(lambda j: j.release_chain_incremental()),
    "ordered_distribution": _po(lambda j: j.ordered_distribution()),
    "ordered_totals": _po(lambda j: j.ordered_totals()),
    "label_shares": _po(lambda j: j.label_shares()),
    # publish (each writes its job's tables and returns what it wrote)
    "publish_manifest": _publish("publish_profile_matrix"),
    "publish_postings": _publish("publish_postings"),
    "publish_overlap": _publish("publish_overlap"),
    "publish_export": _publish("publish_export_bundle"),
    "publish_restart": _publish_twice,
}

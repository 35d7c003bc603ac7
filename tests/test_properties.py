"""Metamorphic properties of the comparison operators."""

from pyspark.sql import functions as F

from tests.conftest import SMALL
from vintage.operators import compare as cmp
from vintage.operators import views as vw
from vintage.plans.postings import PostingsJob
from vintage.plans.profiles import ProfilesJob, occupation_gate

from __spark_entry__ import queries


def test_covered_never_exceeds_total(spark):
    for k in ("coverage_three_sources", "coverage_extra_filter", "overlap_coverage",
              "postings_kpi_matrix"):
        rows = queries()[k](spark, SMALL).collect()
        assert rows and all(0 <= r.covered <= r.total for r in rows), k


def test_classified_shares_sum_to_one(spark):
    df = queries()["sector_share_benchmark"](spark, SMALL)
    sums = df.agg(*[F.sum(c).alias(c) for c in df.columns if c.endswith("_pct")]).first()
    for v in sums:
        assert abs(v - 1.0) < 1e-6 or v == 0


def test_release_against_itself(spark):
    j = ProfilesJob(spark, SMALL)
    base = j.fx.profiles_base()
    counts = cmp.release_value_counts({"base": base, "new": base}, "soc2_name", gate=occupation_gate())
    assert counts.filter(F.col("cnt_base") != F.col("cnt_new")).count() == 0
    ch = vw.relative_change_top(counts, "base", "new")
    assert ch.filter(F.col("pct_change") != 0).count() == 0


def test_swapping_releases_swaps_columns(spark):
    j = ProfilesJob(spark, SMALL)
    a = cmp.release_value_counts({"base": j.fx.profiles_base(), "new": j.fx.profiles_new()},
                                 "soc2_name", gate=occupation_gate())
    b = cmp.release_value_counts({"base": j.fx.profiles_new(), "new": j.fx.profiles_base()},
                                 "soc2_name", gate=occupation_gate())
    swapped = b.select("country", "field_value", F.col("cnt_new").alias("cnt_base"),
                       F.col("cnt_base").alias("cnt_new"))
    assert a.exceptAll(swapped).count() == 0 and swapped.exceptAll(a).count() == 0


def test_matrix_equals_per_field_queries(spark):
    """The one-scan matrix gives the same rows as the per-field pipeline."""
    j = PostingsJob(spark, SMALL)
    m = j.distribution_matrix()
    for f in ("industry", "soc2"):
        one = j.distribution(f)
        part = m.filter(F.col("field") == f).drop("field")
        assert part.exceptAll(one).count() == 0 and one.exceptAll(part).count() == 0


def test_code_agreement_adds_up(spark):
    r = queries()["code_agreement"](spark, SMALL).first()
    assert r.same_code + r.different_code == r.total_matched

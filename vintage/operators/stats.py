"""Agreement statistics between two measures.

Inputs are comparison results with one row per label (bounded by the label
vocabulary); the statistics are single aggregations, the medians come from
distributed ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.operators.median import exact_median


def loglog_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """R^2 of log10(y) on log10(x) over rows where both are
    positive, with the row count."""
    pos = df.filter((F.col(x) > 0) & (F.col(y) > 0))
    r = F.corr(F.log10(x), F.log10(y))
    return pos.agg(F.count(F.lit(1)).alias("n"), F.round(r * r, 6).alias("r2"))


def top_point_differences(df: DataFrame, label: str, a: str, b: str, k: int = 25) -> DataFrame:
    """The ``k`` labels with the largest absolute difference
    ``(a - b) * 100`` in percentage points."""
    d = df.select(label, (F.col(a) * 100).alias("a_pct"), (F.col(b) * 100).alias("b_pct"),
                  ((F.col(a) - F.col(b)) * 100).alias("pp_diff"))
    return d.orderBy(F.abs("pp_diff").desc(), F.col(label).asc_nulls_last()).limit(k)


def agreement_stats(df: DataFrame, a: str, b: str, exclude_regex: str | None = None,
                    label: str | None = None) -> DataFrame:
    """How closely measure ``b`` tracks measure ``a`` over the labels
    where both are positive (C17), optionally dropping labels that match
    ``exclude_regex`` (case-insensitive; NULL labels kept, C6).

    Returns one row: n, Pearson r, regression slope and intercept of b on a,
    mean / median absolute difference and mean / median percent difference
    ``(a - b) / a * 100``.
    """
    d = df
    if exclude_regex is not None and label is not None:
        d = d.filter(~F.coalesce(F.lower(F.col(label)).rlike(exclude_regex), F.lit(False)))
    d = d.filter((F.col(a) > 0) & (F.col(b) > 0))
    diff = F.col(a) - F.col(b)
    d = d.select(F.col(a).alias("a"), F.col(b).alias("b"), F.abs(diff).alias("abs_diff"),
                 (diff / F.col(a) * 100).alias("pct_diff"))
    medians = exact_median(d.unpivot([], ["abs_diff", "pct_diff"], "measure", "v"), ["measure"], "v")

    def median(measure: str):
        return F.round(medians.filter(F.col("measure") == measure).select("median").scalar(), 4)

    found = d.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.corr("a", "b"), 6).alias("pearson_r"),
        F.round(F.regr_slope("b", "a"), 6).alias("slope"),
        F.round(F.regr_intercept("b", "a"), 4).alias("intercept"),
        F.round(F.avg("abs_diff"), 4).alias("mean_abs_diff"),
        F.round(F.avg("pct_diff"), 4).alias("mean_pct_diff"),
    )
    return found.select("n", "pearson_r", "slope", "intercept", "mean_abs_diff",
                        median("abs_diff").alias("median_abs_diff"), "mean_pct_diff",
                        median("pct_diff").alias("median_pct_diff"))

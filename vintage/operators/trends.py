"""Totals over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.functions.expr import date_lit, month_start, ts_lit
from vintage.operators.distinct import distinct_ids
from vintage.operators.scan import scan_union
from vintage.spec import Period, Source


def yearly_totals(sources: Sequence[Source], period: Period | None) -> DataFrame:
    """Distinct ids per (source, year) -> ``(source, yr, cnt)``.
    All sources are counted in one aggregation over their union."""
    t = scan_union(sources, period,
                   lambda s, df: [F.year(s.date).alias("yr")], ids=True)
    return distinct_ids(t, ["source", "yr"], "cnt")


def monthly_counts(sources: Sequence[Source], period: Period | None,
                   since: str | None = None) -> DataFrame:
    """Distinct ids per (source, month) -> ``(source, month_start, cnt)``;
    ``since`` is an extra lower bound applied to every source (timeless ones
    included)."""
    cut = None if since is None else (lambda s: F.col(s.date) >= ts_lit(since))
    t = scan_union(sources, period,
                   lambda s, df: [month_start(s.date).alias("month_start")], since=cut, ids=True)
    return distinct_ids(t, ["source", "month_start"], "cnt")


def month_spine(spark: SparkSession, names: Sequence[str], first: str, last: str) -> DataFrame:
    """One row per (source, month) from ``first`` to ``last``
    (both month starts), generated from literals (sources x months rows)."""
    base = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("source"))
    return base.select("source", F.explode(F.sequence(
        date_lit(first), date_lit(last), F.expr("interval 1 month"))).alias("month_start"))


def monthly_totals_spine(spark: SparkSession, sources: Sequence[Source], period: Period | None,
                         as_of: str, months: int = 12) -> DataFrame:
    """The last ``months`` months up to ``as_of`` (instead of the
    wall clock, for determinism), with empty months as 0.

    Counts have a lower bound only; months after ``as_of`` fall off at the
    spine join (S23). The spine is sources x months rows and the counts are
    one row per (source, month), so the join is between two aggregated
    frames; AQE picks broadcast or sort-merge from their runtime size.
    """
    import datetime as dt
    d = dt.date.fromisoformat(as_of)
    last = dt.date(d.year, d.month, 1)
    y, m = last.year, last.month - (months - 1)
    while m <= 0:
        m += 12
        y -= 1
    first = dt.date(y, m, 1)
    counts = monthly_counts(sources, period, since=first.isoformat())
    spine = month_spine(spark, [s.name for s in sources], first.isoformat(), last.isoformat())
    return (spine.join(counts, ["source", "month_start"], "left")
            .select("source", "month_start",
                    F.coalesce(F.col("cnt"), F.lit(0).cast("bigint")).alias("cnt")))


def monthly_with_benchmark(sources: Sequence[Source], period: Period, benchmark: DataFrame,
                           bench_name: str = "benchmark") -> DataFrame:
    """Benchmark monthly values (``month``, ``posting_count``) from the
    period start on, plus each source's distinct ids per month, long."""
    bench = benchmark.filter(F.col("month") >= date_lit(period.start)).select(
        F.lit(bench_name).alias("source"), F.col("month").alias("month_start"),
        F.col("posting_count").cast("bigint").alias("cnt"))
    return bench.unionByName(monthly_counts(sources, period))

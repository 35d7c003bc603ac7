"""Salary summaries.

Postings and the salary side table are joined on the description id; the
side table may hold several rows per id, so the COUNT(*) measures count
joined rows, as the original job does (S20). At scale both sides are large:
the join is a sort-merge on ``desc_id`` after each side is filtered and
pruned to the three or four columns used. Both sides may come as lists of
frames, the parts of tables stored side by side by the id
(``sources/colocated.py``): each part joins by itself, without an exchange
where it is bucketed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions.expr import annual_salary, salary_bucket, safe_div
from vintage.operators.distribution import every_source, union_all
from vintage.operators.median import histogram, summary
from vintage.operators.reshape import wide


Frames = DataFrame | Sequence[DataFrame]


def _listed(df: Frames) -> list[DataFrame]:
    return [df] if isinstance(df, DataFrame) else list(df)


def _parts(postings: Mapping[str, Frames], salary: Frames) -> Iterator[tuple[str, DataFrame, DataFrame]]:
    """(source, postings, salary) of every part; an id is in one part only."""
    for name, p in postings.items():
        for own, side in zip(_listed(p), _listed(salary), strict=True):
            yield name, own, side


def positive_salary(salary: DataFrame, amount: str = "parsed_salary_min") -> Column:
    return F.col(amount).isNotNull() & (F.col(amount) > 0)


def salaried(postings: Mapping[str, Frames], salary: Frames, keep: Sequence[str] = (),
             key: str = "desc_id", amount: str = "parsed_salary_min", period_col: str = "salary_per",
             piece_is_null: bool = True) -> DataFrame:
    """``(source, *keep, yearly, c)``: each source's postings joined to their
    positive salary rows, annualised; ``c`` is how many joined rows carry
    that yearly value. The salary side is first reduced to (id, yearly,
    count) with map-side partial aggregation, so an id repeated across a
    third of the side table is a handful of rows before the join."""
    def reduced(side: DataFrame) -> DataFrame:
        return (side.filter(positive_salary(side, amount))
                .groupBy(key, annual_salary(amount, period_col, piece_is_null).alias("yearly"))
                .agg(F.count(F.lit(1)).alias("c")))

    frames = [p.select(key, *keep).join(reduced(side), key).select(
        F.lit(name).alias("source"), *keep, "yearly", "c")
        for name, p, side in _parts(postings, salary)]
    return union_all(frames)


def direct_salaries(sources: Mapping[str, tuple[DataFrame, str]], keep: Sequence[str] = ()) -> DataFrame:
    """``(source, *keep, yearly, c)`` for sources that carry a yearly amount as a
    column of their own (the vendor's ``salary_from``), positive values only."""
    frames = [df.filter(F.col(c).isNotNull() & (F.col(c) > 0))
              .groupBy(*keep, F.col(c).cast("double").alias("yearly")).agg(F.count(F.lit(1)).alias("c"))
              .select(F.lit(name).alias("source"), *keep, "yearly", "c")
              for name, (df, c) in sources.items()]
    return union_all(frames)


def salary_stats(postings: Mapping[str, Frames], salary: Frames,
                 direct: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """``(source, min, max, avg, median, n_postings_with_salary,
    n_values)``; the row count includes piece-rate rows whose yearly value
    is NULL, the other measures skip them (S16). ``direct`` adds sources
    whose salary is a column of the postings table (no side table)."""
    rows = salaried(postings, salary)
    if direct:
        rows = rows.unionByName(direct_salaries(direct))
    hist = histogram(rows, ["source"], "yearly", weight="c")
    names = list(postings) + list(direct or {})
    found = every_source(_summary(hist, ["source"]), names, {
        "min_salary": None, "max_salary": None, "avg_salary": None, "median_salary": None,
        "n_postings_with_salary": F.lit(0).cast("bigint"), "n_values": F.lit(0).cast("bigint")})
    return found.select(
        "source", "min_salary", "max_salary", "avg_salary",
        F.round("median_salary", 2).alias("median_salary"),
        "n_postings_with_salary", "n_values")


def salary_buckets(postings: Mapping[str, Frames], salary: Frames) -> DataFrame:
    """P20: rows per (source, bucket) and the bucket's share of the source.
    NULL yearly values (piece rate) are dropped first, as in the job (S15)."""
    s = salaried(postings, salary).filter(F.col("yearly").isNotNull())
    counts = s.groupBy("source", salary_bucket("yearly").alias("salary_bucket")).agg(
        F.sum("c").alias("cnt"))
    tot = counts.groupBy("source").agg(F.sum("cnt").alias("_tot"))
    return (counts.join(F.broadcast(tot), "source")
            .select("source", "salary_bucket", "cnt",
                    (F.col("cnt") / F.col("_tot") * 100).alias("pct")))


def salary_buckets_wide(postings: Mapping[str, Frames], salary: Frames,
                        direct: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """P20, the notebook's variant: ``(salary_bucket, {src}_pct ...)`` over
    every source's buckets, 0 where a source lacks one; shares of all rows
    with a salary. Rows without a yearly value (piece rate) are a bucket of
    their own, NULL here (S15)."""
    rows = salaried(postings, salary).unionByName(direct_salaries(direct))
    counts = rows.groupBy("source", salary_bucket("yearly").alias("salary_bucket")).agg(F.sum("c").alias("n"))
    tot = counts.groupBy("source").agg(F.sum("n").alias("_tot"))
    shares = counts.join(F.broadcast(tot), "source").withColumn("pct", F.col("n") / F.col("_tot") * 100)
    names = [*direct, *postings]
    return wide(shares, ["salary_bucket"], "source", names, {"pct": 0.0}, name="{label}_{measure}")


def salary_median_by_group(postings: Mapping[str, Frames], salary: Frames, group: str,
                           cap: float | None = None,
                           direct: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Median yearly salary and row count per (source, group); groups
    with a NULL key are dropped; ``cap`` is the notebook's sanity bound on
    annualised amounts; ``direct`` adds sources with a yearly amount of
    their own, which the bound does not touch."""
    s = salaried(postings, salary, keep=[group])
    if cap is not None:
        s = s.filter(F.col("yearly") <= cap)
    if direct:
        s = s.unionByName(direct_salaries(direct, [group]))
    s = s.filter(F.col(group).isNotNull())
    hist = histogram(s, ["source", group], "yearly", weight="c")
    return _summary(hist, ["source", group]).select(
        "source", group, F.round("median_salary", 2).alias("median_salary"),
        F.col("n_postings_with_salary").alias("n_postings"))


def _summary(hist: DataFrame, keys: list[str]) -> DataFrame:
    """min / max / mean / median / row counts per group, all from one value
    histogram, so the postings-salary join behind it runs once."""
    return summary(hist, keys).select(
        *keys, F.col("_min").alias("min_salary"), F.col("_max").alias("max_salary"),
        F.round(F.col("_sum") / F.when(F.col("_n") > 0, F.col("_n")), 2).alias("avg_salary"),
        F.col("_median").alias("median_salary"), F.col("_rows").alias("n_postings_with_salary"),
        F.col("_n").alias("n_values"))


def salary_coverage(postings: Mapping[str, Frames], salary: Frames, country_col: str,
                    codes: Mapping[str, str], key: str = "desc_id",
                    amount: str = "parsed_salary_min") -> DataFrame:
    """Postings (joined rows) and postings with a positive salary per
    (source, country code), via a left join so postings without a salary
    row count in the total."""
    code = None
    for full, short in codes.items():
        cond = F.col(country_col) == F.lit(full)
        code = F.when(cond, F.lit(short)) if code is None else code.when(cond, F.lit(short))
    # The side table reduced to one row per id (rows, positive rows) before
    # the left join: adaptive execution can split only the left side of a
    # left outer join, so a hot id must not reach the join as many rows.
    # A posting with k salary rows still counts k times (1 when k = 0).
    def reduced(side: DataFrame) -> DataFrame:
        return side.groupBy(key).agg(F.count(F.lit(1)).alias("k"),
                                     F.count_if(positive_salary(side, amount)).alias("pos"))

    frames = [p.filter(F.col(country_col).isin(list(codes))).select(key, country_col)
              .join(reduced(side), key, "left")
              .select(F.lit(name).alias("source"), code.alias("country"),
                      F.coalesce(F.col("k"), F.lit(1)).alias("k"),
                      F.coalesce(F.col("pos"), F.lit(0)).alias("pos"))
              for name, p, side in _parts(postings, salary)]
    counts = union_all(frames).groupBy("source", "country").agg(
        F.sum("k").alias("total_postings"), F.sum("pos").alias("postings_with_salary"))
    return _with_pct(counts)


def _with_pct(counts: DataFrame) -> DataFrame:
    return counts.withColumn("pct_with_salary", F.col("postings_with_salary") / F.col("total_postings") * 100)


def direct_coverage(name: str, countries: Mapping[str, DataFrame], amount: str) -> DataFrame:
    """P22 for a source that carries the amount itself, one table or view per
    country code: the columns of :func:`salary_coverage`."""
    frames = [df.select(F.lit(code).alias("country"), (F.col(amount) > 0).alias("pos"))
              for code, df in countries.items()]
    return _with_pct(union_all(frames).groupBy(F.lit(name).alias("source"), "country").agg(
        F.count(F.lit(1)).alias("total_postings"), F.count_if("pos").alias("postings_with_salary")))


def salary_outliers(postings: Frames, salary: Frames, k: int = 20, highest: bool = True,
                    key: str = "desc_id", amount: str = "parsed_salary_min",
                    period_col: str = "salary_per") -> DataFrame:
    """The ``k`` highest (or lowest) yearly amounts with their raw
    fields; the outlier variant keeps piece rates at the raw amount."""
    j = union_all([
        p.select(key).join(side.filter(positive_salary(side, amount)).select(key, amount, period_col), key).select(
            key, amount, period_col, annual_salary(amount, period_col, piece_is_null=False).alias("yearly_salary_min"))
        for _, p, side in _parts({"": postings}, salary)])
    y = F.col("yearly_salary_min")
    order = [y.desc() if highest else y.asc(), F.col(key).asc(),
             F.col(period_col).asc_nulls_last(), F.col(amount).asc()]
    return j.orderBy(*order).limit(k)


def agreement_frame(medians: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """Helper for P32: per group, the two sources' medians side by side."""
    return medians.groupBy(group).agg(
        F.max(F.when(F.col("source") == a, F.col("median_salary"))).alias("a_median"),
        F.max(F.when(F.col("source") == b, F.col("median_salary"))).alias("b_median"))


__all__ = ["salaried", "salary_stats", "salary_buckets", "salary_median_by_group",
           "salary_coverage", "salary_outliers", "agreement_frame", "safe_div"]

"""Release-vs-release comparisons of a profile dataset.

The original job builds one statement per (field, country) and joins the two
releases with a FULL OUTER JOIN on the value. Here the releases are unioned
with a ``release`` column and counted in one aggregation keyed by
(country, value) with one ``count_if`` per release: one exchange, every
country at once, and the same rows as the full join (a value missing in a
release gets 0).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions.expr import not_ilike_any, pct_round, safe_div, ts_lit
from vintage.operators.distribution import union_all
from vintage.operators.partials import column_counts

UNCLASSIFIED = ("%unclassified%",)
# Fixed value: raw education text that means "no entry".
EMPTY_EDUCATION_SENTINEL = '"[""]'


def release_union(releases: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Union the releases with a ``release`` column (only ``columns`` kept,
    so each scan prunes to them)."""
    frames = []
    for name, df in releases.items():
        d = df if columns is None else df.select(*columns)
        frames.append(d.withColumn("release", F.lit(name)))
    return union_all(frames)


def _count_cols(names: Sequence[str], prefix: str = "cnt_") -> list[Column]:
    return [F.count_if(F.col("release") == F.lit(n)).alias(f"{prefix}{n}") for n in names]


def release_value_counts(releases: Mapping[str, DataFrame], value: str,
                         by: Sequence[str] = ("country",), gate: Column | None = None,
                         exclude: Sequence[str] = UNCLASSIFIED) -> DataFrame:
    """Rows per value in each release, per ``by`` group.

    Rows pass when the gate holds, the value is present and matches none of
    the case-insensitive ``exclude`` patterns. Output:
    ``(*by, field_value, cnt_<release>...)``.
    """
    u = release_union(releases)
    cond = F.col(value).isNotNull() & not_ilike_any(F.col(value), list(exclude))
    if gate is not None:
        cond = cond & gate
    return (u.filter(cond)
            .groupBy(*by, F.col(value).alias("field_value"))
            .agg(*_count_cols(list(releases))))


def release_list_value_counts(releases: Mapping[str, DataFrame], value: str,
                              by: Sequence[str] = ("country",), gate: Column | None = None,
                              exclude: Sequence[str] = UNCLASSIFIED, sep: str = ", ",
                              raw: str | None = "education_raw") -> DataFrame:
    """Like P1 for a list-valued field stored as ``sep``-joined text.

    The exclusion test is on the whole string (one bad element drops the
    entry), the raw-text sentinel drops the row (NULL raw text too), and
    elements are trimmed; a trailing separator yields an '' element that is
    counted (S2).
    """
    u = release_union(releases)
    cond = F.col(value).isNotNull() & not_ilike_any(F.col(value), list(exclude))
    if raw is not None:
        cond = cond & (F.col(raw) != F.lit(EMPTY_EDUCATION_SENTINEL))
    if gate is not None:
        cond = cond & gate
    exploded = u.filter(cond).select(*by, "release",
                                     F.explode(F.split(F.col(value), re.escape(sep))).alias("_x"))
    exploded = exploded.select(*by, "release", F.trim("_x").alias("field_value"))
    return (exploded.filter(F.col("field_value").isNotNull())
            .groupBy(*by, "field_value").agg(*_count_cols(list(releases))))


def release_value_counts_with_benchmark(releases: Mapping[str, DataFrame], value: str,
                                        benchmark: DataFrame, country: tuple[str, str],
                                        gate: Column | None = None,
                                        exclude: Sequence[str] = UNCLASSIFIED,
                                        bench_name: str = "benchmark") -> DataFrame:
    """P1 for one country plus an official count column.

    The benchmark ``(label, cnt)`` is unioned in as one more source and the
    whole thing is one aggregation. Release values are never NULL (filtered),
    so a NULL benchmark label forms its own row, as with the original job's
    placeholder key.
    """
    u = release_union(releases).filter(F.col(country[0]) == F.lit(country[1]))
    cond = F.col(value).isNotNull() & not_ilike_any(F.col(value), list(exclude))
    if gate is not None:
        cond = cond & gate
    rel = u.filter(cond).select(F.col(value).alias("field_value"), "release",
                                F.lit(None).cast("bigint").alias("bench_cnt"))
    bench = benchmark.select(F.col("label").alias("field_value"), F.lit(bench_name).alias("release"),
                             F.col("cnt").cast("bigint").alias("bench_cnt"))
    both = rel.unionByName(bench)
    return both.groupBy("field_value").agg(
        *_count_cols(list(releases)),
        F.coalesce(F.sum("bench_cnt"), F.lit(0).cast("bigint")).alias(f"cnt_{bench_name}"))


def release_coverage(releases: Mapping[str, DataFrame], covered: Column,
                     by: Sequence[str] = ("country",), gate: Column | None = None) -> DataFrame:
    """Share of rows whose field passes the coverage test, per release.

    The gate restricts numerator and denominator alike (S7). Output:
    ``(*by, coverage_<r>..., profiles_<r>...)``; coverage is NULL where a
    release has no rows.
    """
    u = release_union(releases)
    if gate is not None:
        u = u.filter(gate)
    per = u.groupBy(*by, "release").agg(F.count_if(covered).alias("nn"),
                                        F.count(F.lit(1)).alias("total"))
    names = list(releases)
    aggs = []
    for n in names:
        nn = F.sum(F.when(F.col("release") == n, F.col("nn")))
        tot = F.sum(F.when(F.col("release") == n, F.col("total")))
        aggs.append(safe_div(nn, tot).alias(f"coverage_{n}"))
    for n in names:
        aggs.append(F.coalesce(F.sum(F.when(F.col("release") == n, F.col("total"))),
                               F.lit(0).cast("bigint")).alias(f"profiles_{n}"))
    return per.groupBy(*by).agg(*aggs)


def release_share_vs_benchmark(releases: Mapping[str, DataFrame], value: str,
                               benchmark: DataFrame, bench_label: str,
                               bench_shares: Sequence[str], country: tuple[str, str],
                               gate: Column | None = None, strict: bool = False) -> DataFrame:
    """P5: rounded share of each value per release vs benchmark shares.

    Shares are ``ROUND(n / total, 2) * 100`` (whole percents, S5; computed
    as one rounding of ``100 n / total``, the exact decimal value) over all
    gated rows of the country, NULL values included in the total (S4). NULL
    groups of different releases stay separate rows, like the full join on
    plain equality. Benchmark-only rows carry the benchmark's label unless
    ``strict`` (then NULL, as in the original job, S3).
    """
    u = release_union(releases)
    u = u.filter(F.col(country[0]) == F.lit(country[1]))
    if gate is not None:
        u = u.filter(gate)
    counts = u.groupBy("release", F.col(value).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.groupBy("release").agg(F.sum("n").alias("total"))
    shares = (counts.join(F.broadcast(tot), "release")
              .select("release", "label", pct_round("n", "total", 0).alias("pct")))
    names = list(releases)
    rel_rows = shares.select(
        "label", F.when(F.col("label").isNull(), F.col("release")).alias("null_tag"),
        F.col("label").alias("rel_label"), F.lit(None).cast("string").alias("b_label"),
        *[F.when(F.col("release") == n, F.col("pct")).alias(f"pct_{n}") for n in names],
        *[F.lit(None).cast("double").alias(b) for b in bench_shares])
    b = benchmark.select(
        F.col(bench_label).alias("label"),
        F.when(F.col(bench_label).isNull(), F.lit("__benchmark__")).alias("null_tag"),
        F.lit(None).cast("string").alias("rel_label"), F.col(bench_label).alias("b_label"),
        *[F.lit(None).cast("double").alias(f"pct_{n}") for n in names],
        *[F.col(x).cast("double").alias(x) for x in bench_shares])
    both = rel_rows.unionByName(b)
    label = F.max("rel_label") if strict else F.first("label", ignorenulls=True)
    return both.groupBy("label", "null_tag").agg(
        label.alias("out_label"),
        *[F.coalesce(F.sum(f"pct_{n}"), F.lit(0.0)).alias(f"pct_{n}") for n in names],
        *[F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in bench_shares],
    ).select(F.col("out_label").alias(value), *[f"pct_{n}" for n in names], *bench_shares)


def stint_industry_share(releases: Mapping[str, DataFrame], bench_map: DataFrame,
                         period_start: str, period_end: str, country: tuple[str, str],
                         person: str = "person_id", code: str = "naics2_code",
                         company: str = "company_id", start: str = "start_date",
                         end: str = "end_date") -> DataFrame:
    """Share of distinct people employed in each industry code through a
    whole period, per release, rolled up through an official code map.

    A stint counts when it starts on or before ``period_start`` and ends on
    or after ``period_end`` (or is open). Per release: distinct people per
    code / distinct people overall; a person with stints in several codes
    counts in each (shares may sum above 1, S22). Counts are pre-aggregated
    per code before the map join, so a code with two names cannot inflate
    the sums (S21). Output: ``(bls_code, industry, perc_bls, perc_<r>...)``.
    """
    u = release_union(releases, [person, code, company, start, end, country[0]])
    u = u.filter(F.col(company).isNotNull() & F.col(code).isNotNull()
                 & (F.col(country[0]) == F.lit(country[1]))
                 & (F.col(start) <= ts_lit(period_start))
                 & ((F.col(end) >= ts_lit(period_end)) | F.col(end).isNull()))
    # distinct (release, person, code) rows; a NULL person is nobody
    held = u.select("release", person, code).distinct()
    per_code = held.groupBy("release", code).agg(F.count(person).alias("n"))
    total = (held.filter(F.col(person).isNotNull()).select("release", person).distinct()
             .groupBy("release").agg(F.count(F.lit(1)).alias("ttl")))
    names = list(releases)
    shares = (per_code.join(F.broadcast(total), "release")
              .withColumn("perc", F.col("n") / F.col("ttl")))
    by_code = shares.groupBy(code).agg(
        *[F.sum(F.when(F.col("release") == n, F.col("perc"))).alias(f"perc_{n}") for n in names])
    m = bench_map.select("bls_code", "industry", F.col("naics2_code").alias(code), "bls_pct")
    j = m.join(by_code, code, "left")
    # Sums of a handful of shares: rounded to 10 decimals so the result does
    # not depend on the order the join delivers them in.
    return j.groupBy("bls_code", "industry").agg(
        F.round(F.avg("bls_pct"), 10).alias("perc_bls"),
        *[F.round(F.sum(f"perc_{n}"), 10).alias(f"perc_{n}") for n in names])


def release_matrix_long(releases: Mapping[str, DataFrame], fields: Mapping[str, Column | None],
                        by: Sequence[str] = ("country",),
                        exclude: Sequence[str] = UNCLASSIFIED,
                        list_fields: Mapping[str, Column | None] | None = None,
                        sep: str = ", ", raw: str | None = "education_raw") -> DataFrame:
    """Value counts for many fields of both releases in ONE scan.

    Rows are not expanded: a value is NULL where its field's gate or exclusion
    fails, ``list_fields`` are arrays of their parts (with the P2 rules:
    whole-string exclusion, raw-text sentinel, parts trimmed), and a task
    counts each column by itself (``operators/partials.py``). One exchange of
    partial counts for the whole matrix instead of one statement per (field,
    country).
    """
    u = release_union(releases)
    specs = [(n, g, False) for n, g in fields.items()]
    specs += [(n, g, True) for n, g in (list_fields or {}).items()]
    values = []
    for i, (name, gate, is_list) in enumerate(specs):
        v = F.col(name).cast("string")
        ok = v.isNotNull() & not_ilike_any(v, list(exclude))
        if is_list and raw is not None:
            ok = ok & (F.col(raw) != F.lit(EMPTY_EDUCATION_SENTINEL))
        if gate is not None:
            ok = ok & gate
        values.append(F.when(ok, F.split(v, re.escape(sep)) if is_list else v).alias(f"_v_{i}"))
    parts = column_counts(u.select(*by, "release", *values), [*by, "release"], [f"_v_{i}" for i in range(len(specs))])
    field = F.element_at(F.array(*[F.lit(n) for n, _, _ in specs]), F.col("_field") + 1)
    counts = [F.sum(F.when(F.col("release") == F.lit(n), F.col("_n")).otherwise(0)).cast("bigint").alias(f"cnt_{n}") for n in releases]
    return (parts.groupBy("_field", *by, F.col("_value").alias("field_value")).agg(*counts)
            .select(field.alias("field"), *by, "field_value", *[f"cnt_{n}" for n in releases]))


def release_matrix_kpi(releases: Mapping[str, DataFrame], fields: Mapping[str, tuple[Column, Column | None]],
                       by: Sequence[str] = ("country",)) -> DataFrame:
    """P7 KPI half: coverage of many fields in one scan. ``fields`` maps a
    field to (coverage test, gate). Rows are not expanded: each group counts
    every field's rows in scope and covered per release (one exchange), and
    the few result rows are unpivoted. A group in which no row of either
    release is in a field's scope has no row for it."""
    aggs, items = [], []
    for i, (name, (test, gate)) in enumerate(fields.items()):
        row = [F.lit(name).alias("field")]
        for n in releases:
            scope = F.col("release") == F.lit(n)
            if gate is not None:
                scope = scope & gate
            aggs += [F.count_if(scope).alias(f"_t_{i}_{n}"), F.count_if(scope & test).alias(f"_c_{i}_{n}")]
            row.append(safe_div(F.col(f"_c_{i}_{n}"), F.col(f"_t_{i}_{n}")).alias(f"coverage_{n}"))
        row += [F.col(f"_t_{i}_{n}").alias(f"profiles_{n}") for n in releases]
        items.append(F.struct(*row))
    out = release_union(releases).groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*items)))
    some = F.lit(False)
    for n in releases:
        some = some | (F.col(f"profiles_{n}") > 0)
    return out.filter(some).select("field", *by, *[f"coverage_{n}" for n in releases],
                                   *[f"profiles_{n}" for n in releases])

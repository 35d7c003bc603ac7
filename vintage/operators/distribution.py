"""Value distributions across sources.

Plan shape, whatever the number of sources:

* each source is scoped (country, period, extra predicates, crosswalk),
  enriched (lookup joins as left joins, so the source's rows are kept) and
  projected ONCE to ``(source, id, field_value)``, where ``field_value`` is
  NULL for rows that do not count (absent or excluded value); the
  projections are unioned, so every source is scanned once per query;
* that frame is reduced to words of ids by (source, field_value)
  (``operators/distinct.py``): exact, merged map-side, whatever the skew; the
  per-value counts sum their bits, the per-source totals merge the same
  words; NULL ids are entities in neither;
* totals are one row per source and joined with a broadcast bounded by the
  number of sources, a parameter, not the data;
* the per-value rows are turned wide by conditional aggregation over the
  known source list (one exchange on the value, on aggregated rows).

With ``measure='rows'`` the count is of rows, not distinct ids, and no
per-id step is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.functions.expr import frac_or_zero, not_like_any
from vintage.operators.distinct import WORD, counted, distinct_ids, flagged_ids, merged, words
from vintage.operators.partials import column_words
from vintage.operators.reshape import wide
from vintage.operators.scan import scan_union
from vintage.spec import FieldSpec, Period, Source


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """U1 / U3."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def tagged(sources: Sequence[Source], field: FieldSpec, period: Period | None) -> DataFrame:
    """``(source, field_value, _pos, _once)`` for every row in scope, the last
    two standing for its id; the value is normalised and NULL where it is absent or matches an exclusion. A
    field's extra predicates narrow the scope (they apply to totals too,
    S8); its enrichment joins do not (S9). Sources over one table share a
    scan (``scan_union``)."""
    def project(s: Source, df: DataFrame) -> list:
        v = field.value(s.name, df)
        cond = v.isNotNull()
        if field.exclude:
            cond = cond & not_like_any(v, list(field.exclude))
        return [F.when(cond, v).alias("field_value")]

    return scan_union(sources, period, project, ids=True, extra=lambda s: field.extra_pred(s.name),
                      prep=lambda s: [fn for fn in [field.prep.get(s.name)] if fn is not None])


def every_source(df: DataFrame, names: Sequence[str], fills: dict) -> DataFrame:
    """Give every named source a row, like an aggregate without GROUP BY
    over an empty input: ``df`` (one row per source) is left-joined onto
    the names (a frame of ``len(names)`` rows, generated from the
    parameter) and the given columns are filled."""
    spark = df.sparkSession
    base = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("source"))
    out = base.join(df, "source", "left")
    return out.select("source", *[F.coalesce(F.col(c), F.lit(v)).alias(c) if v is not None else F.col(c)
                                  for c, v in fills.items()])


def value_words(t: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """Words of ids by ``(*keys, field_value)``."""
    return words(t, [*keys, "field_value"])


def counts_and_totals(parts: DataFrame, keys: Sequence[str] = ("source",)) -> tuple[DataFrame, DataFrame]:
    """From the values' words: ``(*keys, field_value, n)`` distinct ids per
    value, and ``(*keys, total)`` distinct ids in scope. A NULL id is no
    entity: it adds nothing to a count or total, but a value that only NULL
    ids hold stays as a 0 row, as ``COUNT(DISTINCT id)`` gives it. The NULL
    value is dropped after counting: a filter on a grouping key would be
    pushed to the scan, and the totals could not share the words' exchange."""
    known = F.max("field_value").alias("_v")
    per_value = parts.groupBy(*keys, "field_value").agg(
        F.sum(F.col("_n") + F.coalesce(F.bit_count("_bits"), F.lit(0))).cast("bigint").alias("n"), known)
    return per_value.filter(F.col("_v").isNotNull()).drop("_v"), counted(merged(parts, keys), keys, "total")


def value_counts(sources: Sequence[Source], field: FieldSpec, period: Period | None,
                 measure: str = "distinct") -> DataFrame:
    """Long ``(source, field_value, n)``; ``measure`` is ``distinct`` (count
    of distinct ids) or ``rows`` (count of rows)."""
    t = tagged(sources, field, period)
    if measure == "distinct":
        return distinct_ids(t.filter(F.col("field_value").isNotNull()), ["source", "field_value"], "n")
    if measure == "rows":
        return (t.filter(F.col("field_value").isNotNull())
                .groupBy("source", "field_value").agg(F.count(F.lit(1)).alias("n")))
    raise ValueError(f"measure must be 'distinct' or 'rows', not {measure!r}")


def with_share(counts: DataFrame, denominators: DataFrame) -> DataFrame:
    """Attach ``frac = n / total`` (0 when total is 0). ``denominators`` has
    one row per source, so broadcasting it is bounded by the source count."""
    return (counts.join(F.broadcast(denominators), "source", "left")
            .withColumn("frac", frac_or_zero("n", "total")))


def classified_totals(counts: DataFrame) -> DataFrame:
    """Denominator = sum of the classified counts per source."""
    return counts.groupBy("source").agg(F.sum("n").alias("total"))


def _wide(long_df: DataFrame, names: Sequence[str]) -> DataFrame:
    out = wide(long_df, ["field_value"], "source", names, {"n": 0, "frac": 0.0})
    return out.select("field_value",
                      *[F.col(f"{n}_{m}").alias(f"{n}_{'count' if m == 'n' else 'frac'}")
                        for n in names for m in ("n", "frac")])


def distribution(sources: Sequence[Source], field: FieldSpec, period: Period | None,
                 denominator: str = "all", long: bool = False) -> DataFrame:
    """Per value, distinct-id count and fraction for every source.

    ``denominator='all'`` divides by every id of the source in scope
    (fractions need not sum to 1); ``'classified'`` by the sum of the
    counted values. Wide output: ``field_value, {src}_count, {src}_frac``.
    """
    counts, all_ids = counts_and_totals(value_words(tagged(sources, field, period)))
    if denominator == "all":
        den = all_ids
    elif denominator == "classified":
        den = classified_totals(counts)
    else:
        raise ValueError(f"denominator must be 'all' or 'classified', not {denominator!r}")
    long_df = with_share(counts, den).select(
        "source", "field_value", "n", "frac")
    if long:
        return long_df
    return _wide(long_df, [s.name for s in sources])


def distribution_anchored(sources: Sequence[Source], field: FieldSpec, period: Period | None,
                          anchor: str, k: int = 25) -> DataFrame:
    """The ``k`` most frequent values of the ``anchor`` source, with
    every source's count and fraction for those values.

    The top-k is a ``TakeOrderedAndProject`` over the anchor's aggregated
    counts (ties broken by value, S18); its k rows are broadcast (bounded
    by ``k``) to restrict the other sources' aggregated counts.
    """
    counts, all_ids = counts_and_totals(value_words(tagged(sources, field, period)))
    top = (counts.filter(F.col("source") == anchor)
           .orderBy(F.col("n").desc(), F.col("field_value").asc()).limit(k)
           .select("field_value"))
    kept = counts.join(F.broadcast(top), "field_value", "left_semi")
    long_df = with_share(kept, all_ids).select("source", "field_value", "n", "frac")
    return _wide(long_df, [s.name for s in sources])


# ------------------------------------------------------------ many fields
def _matrix_rows(sources: Sequence[Source], fields: Sequence[FieldSpec],
                 period: Period | None) -> DataFrame:
    """R5 for the postings job: ``(source, _in_i, _v_i ..., _pos, _once)`` - one row
    per scanned row with, for every field ``i``, whether the row is in the
    field's scope (its extra predicates; NULL counts as false) and its
    counted value (NULL when absent, excluded or out of scope). One scan per
    table; every enrichment join any field needs is applied once."""
    def project(s: Source, df: DataFrame) -> list:
        cols = []
        for i, f in enumerate(fields):
            v = f.value(s.name, df)
            cond = v.isNotNull()
            if f.exclude:
                cond = cond & not_like_any(v, list(f.exclude))
            scope = f.extra_pred(s.name)
            scope = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
            cols += [scope.alias(f"_in_{i}"), F.when(scope & cond, v).cast("string").alias(f"_v_{i}")]
        return cols

    def preps(s: Source) -> list:
        return [f.prep[s.name] for f in fields if s.name in f.prep]

    return scan_union(sources, period, project, prep=preps, ids=True)


def _scope_totals(sources: Sequence[Source], fields: Sequence[FieldSpec], period: Period | None) -> DataFrame:
    """``(source, field, total)``: distinct ids in each field's scope."""
    def project(s: Source, df: DataFrame) -> list:
        scopes = [f.extra_pred(s.name) for f in fields]
        return [(F.lit(True) if c is None else F.coalesce(c, F.lit(False))).alias(f"_in_{i}") for i, c in enumerate(scopes)]

    def preps(s: Source) -> list:
        return [f.prep[s.name] for f in fields if s.name in f.prep and s.name in f.extra]

    rows = scan_union(sources, period, project, prep=preps, ids=True)
    per_source = flagged_ids(rows, ["source"], {f"_t_{i}": F.col(f"_in_{i}") for i in range(len(fields))})
    items = [F.struct(F.lit(f.name).alias("field"), F.col(f"_t_{i}").alias("total")) for i, f in enumerate(fields)]
    return per_source.select("source", F.inline(F.array(*items)))


def distribution_matrix(sources: Sequence[Source], fields: Sequence[FieldSpec],
                        period: Period | None) -> DataFrame:
    """P11 for many fields in one job: ``(field, field_value, {src}_count,
    {src}_frac ...)``.

    Rows are not expanded: a task counts each field's column by itself
    (``operators/partials.py``) and passes on words of ids by (source, field,
    value), which one exchange merges. The totals read only ids and scopes, in
    a scan of their own without the enrichment (copies of a row add nothing
    to them): Spark would not share the Arrow stage between the two sides of
    the join. Totals per (source, field) are broadcast (bounded by sources x
    fields, both parameters)."""
    rows = _matrix_rows(sources, fields, period)
    every = range(len(fields))
    parts = column_words(rows, ["source"], [f"_v_{i}" for i in every], [f"_in_{i}" for i in every])
    name = F.element_at(F.array(*[F.lit(f.name) for f in fields]), F.col("_field") + 1)
    parts = parts.select("source", name.alias("field"), F.col("_value").alias("field_value"), F.col("_word").alias(WORD), "_n", "_bits")
    keys = ["source", "field", "field_value"]
    counts = counted(merged(parts.filter(F.col("field_value").isNotNull()), keys), keys, "n")
    totals = _scope_totals(sources, fields, period)
    long_df = (counts.join(F.broadcast(totals), ["source", "field"], "left")
               .withColumn("frac", frac_or_zero("n", "total")))
    names = [s.name for s in sources]
    out = wide(long_df, ["field", "field_value"], "source", names, {"n": 0, "frac": 0.0})
    return out.select("field", "field_value",
                      *[F.col(f"{n}_{m}").alias(f"{n}_{'count' if m == 'n' else 'frac'}")
                        for n in names for m in ("n", "frac")])


def coverage_matrix(sources: Sequence[Source], fields: Sequence[FieldSpec],
                    period: Period | None) -> DataFrame:
    """P10 for many fields in one job: ``(source, field, total, covered)``.
    One row per source and word of ids, with two words per field, crosses the
    exchange; the per-source counts are unpivoted afterwards. A NULL id is
    no entity; a source with nothing in scope reports 0 / 0 for every field."""
    rows = _matrix_rows(sources, fields, period)
    flags = {}
    for i in range(len(fields)):
        flags |= {f"_t_{i}": F.col(f"_in_{i}"), f"_c_{i}": F.col(f"_v_{i}").isNotNull()}
    zero = F.lit(0).cast("bigint")
    per_source = every_source(flagged_ids(rows, ["source"], flags), [s.name for s in sources], dict.fromkeys(flags, zero))
    items = [F.struct(F.lit(f.name).alias("field"), F.col(f"_t_{i}").alias("total"),
                      F.col(f"_c_{i}").alias("covered")) for i, f in enumerate(fields)]
    return per_source.select("source", F.inline(F.array(*items)))

"""Coverage: how many entities of each source carry a usable value (P10, P17,
P22, P34, P40)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions.expr import pct_round
from vintage.operators.distinct import flagged_ids
from vintage.operators.distribution import every_source, tagged
from vintage.spec import FieldSpec, Period, Source


def coverage(sources: Sequence[Source], field: FieldSpec, period: Period | None) -> DataFrame:
    """``(source, total, covered)``.

    ``total``: distinct ids in scope (extra predicates applied, enrichment
    joins not, S9). ``covered``: distinct ids with a present, non-excluded
    value. A NULL id is no entity and counts in neither. One scan per source
    and one exchange, of a row per source and word of ids.
    """
    rows = tagged(sources, field, period)
    per_source = flagged_ids(rows, ["source"], {"total": F.lit(True), "covered": F.col("field_value").isNotNull()})
    # a source with nothing in scope still reports 0 / 0
    return every_source(per_source, [s.name for s in sources],
                        {"total": F.lit(0).cast("bigint"), "covered": F.lit(0).cast("bigint")})


def coverage_pct(cov: DataFrame) -> DataFrame:
    """KPI card row, percent covered (NULL when total is 0)."""
    return cov.withColumn("pct_covered",
                          F.when(F.col("total") > 0, pct_round("covered", "total", 1)))


def field_coverage_by_source(frames: dict[str, DataFrame], fields: dict[str, Column]) -> DataFrame:
    """Rows and rows-with-a-value per source for several fields at once
    (``SUM(CASE WHEN f IS NOT NULL THEN 1 ELSE 0 END)``), one scan per source.
    Output long: ``(source, field, total_rows, with_value, pct_with_value)``."""
    out = []
    for name, df in frames.items():
        aggs = [F.count(F.lit(1)).alias("total_rows")]
        aggs += [F.sum(F.when(c.isNotNull(), 1).otherwise(0)).alias(f"f__{k}")
                 for k, c in fields.items()]
        out.append(df.agg(*aggs).select(F.lit(name).alias("source"), "*"))
    from vintage.operators.distribution import union_all
    wide_df = union_all(out)
    stacked = wide_df.unpivot(["source", "total_rows"], [f"f__{k}" for k in fields],
                              "field", "with_value")
    return stacked.select("source", F.regexp_replace("field", "^f__", "").alias("field"),
                          "total_rows", F.coalesce(F.col("with_value"), F.lit(0)).cast("bigint").alias("with_value"),
                          (F.col("with_value") / F.when(F.col("total_rows") > 0, F.col("total_rows")) * 100)
                          .alias("pct_with_value"))

"""Result views for reading and plotting.

They read aggregated comparison results (one row per value), never the
release tables. Per-group top-k uses ``row_number() <= k`` over a window,
which Spark plans with a partial group limit before the shuffle (only k
rows per group and map task move), so a group with millions of values is
not gathered whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.expr import NULL_LABEL, null_label, safe_div


def display_order(df: DataFrame, *keys: str | Column, descending: Sequence[str] = ()) -> DataFrame:
    """Order a (small) result for display, NULLs last in
    every key; stored tables stay unordered (S33)."""
    order = []
    for k in keys:
        c = F.col(k) if isinstance(k, str) else k
        order.append(c.desc_nulls_last() if isinstance(k, str) and k in descending
                     else c.asc_nulls_last())
    return df.orderBy(*order)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """T5: the first ``k`` rows of each group under ``order`` (which should
    end with a unique tie-breaker, S18)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def top_values_share_within(counts: DataFrame, releases: Sequence[str], newest: str,
                            group: Sequence[str] = ("country",), k: int = 25) -> DataFrame:
    """Top ``k`` values per group by the newest release's count, with
    shares within the shown rows (``share_within_top``, the dashboard's
    percentages, S24) and of the group's whole total (``share_of_total``)."""
    group = list(group)
    tot = counts.groupBy(*group).agg(*[F.sum(f"cnt_{r}").alias(f"_tot_{r}") for r in releases])
    top = top_k_per_group(counts, group, [F.col(f"cnt_{newest}").desc(),
                                          F.col("field_value").asc_nulls_last()], k)
    wg = Window.partitionBy(*group)   # at most k rows per group
    cols = [*group, "field_value", *[f"cnt_{r}" for r in releases]]
    for r in releases:
        cols.append(safe_div(F.col(f"cnt_{r}"), F.sum(f"cnt_{r}").over(wg)).alias(f"share_within_top_{r}"))
        cols.append(safe_div(F.col(f"cnt_{r}"), F.col(f"_tot_{r}")).alias(f"share_of_total_{r}"))
    return top.join(tot, group).select(*cols)


def relative_change_top(counts: DataFrame, base: str, new: str,
                        group: Sequence[str] = ("country",), k: int = 20) -> DataFrame:
    """Percent change base -> new (NULL when base is 0, such rows
    dropped, S25), top ``k`` per group by absolute change."""
    pct = safe_div((F.col(f"cnt_{new}") - F.col(f"cnt_{base}")) * 100, F.col(f"cnt_{base}"))
    d = counts.select(*group, "field_value", f"cnt_{base}", f"cnt_{new}", pct.alias("pct_change"))
    d = d.filter(F.col("pct_change").isNotNull())
    return top_k_per_group(d, list(group), [F.abs("pct_change").desc(),
                                            F.col("field_value").asc_nulls_last()], k)


def pp_diff_pairs(dist: DataFrame, pairs: Sequence[tuple[str, str]], k: int = 15) -> DataFrame:
    """Percentage-point differences of the fractions of each source
    pair; top ``k`` per pair by absolute difference."""
    items = [F.struct(F.lit(f"{a}-{b}").alias("pair"),
                      (F.col(f"{a}_frac") * 100).alias("a_pct"),
                      (F.col(f"{b}_frac") * 100).alias("b_pct"),
                      ((F.col(f"{a}_frac") - F.col(f"{b}_frac")) * 100).alias("pp_diff"))
             for a, b in pairs]
    long_df = dist.select("field_value", F.inline(F.array(*items)))
    return top_k_per_group(long_df, ["pair"], [F.abs("pp_diff").desc(),
                                               F.col("field_value").asc_nulls_last()], k)


def long_view(df: DataFrame, value_cols: Mapping[str, str], sort_col: str | None = None,
              ladder: Sequence[str] | None = None) -> DataFrame:
    """Wide counts -> long ``(field_value, version, value, sort_rank)``
    for plotting; every row comes back. NULL values get a visible label
    (X25); columns are renamed to display labels (R3). ``sort_rank`` is the
    sort key, ascending: the place on a fixed ladder when given (others
    after it, T8), else minus the ``sort_col`` count (default: the first of
    ``value_cols``), so that the largest come first. Ranking or a top-k is left to the caller (``top_k_per_group``)."""
    labelled = df.withColumn("field_value", null_label("field_value"))
    if ladder:
        pos = F.array_position(F.array(*[F.lit(x) for x in ladder]), F.col("field_value"))
        rank = F.when(pos > 0, pos).otherwise(F.lit(len(ladder) + 1)).cast("bigint")
    else:
        rank = (-F.col(sort_col or next(iter(value_cols)))).cast("bigint")
    labelled = labelled.withColumn("sort_rank", rank)
    stacked = labelled.unpivot(["field_value", "sort_rank"], list(value_cols), "version", "value")
    m = F.create_map(*[F.lit(x) for kv in value_cols.items() for x in kv])
    return stacked.select("field_value", F.element_at(m, F.col("version")).alias("version"),
                          F.col("value").cast("bigint").alias("value"), "sort_rank")


__all__ = ["top_k_per_group", "top_values_share_within", "relative_change_top", "pp_diff_pairs",
           "long_view", "NULL_LABEL"]

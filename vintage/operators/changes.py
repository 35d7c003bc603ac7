"""Code changes between two releases of the same records.

Both releases are reduced to ``(id, code, n)`` before the join on id:
partial aggregation absorbs duplicated ids and hot ids before any shuffle,
and the join then multiplies ``n_old * n_new``, which equals the row count
of the plain inner join that the original job counts with ``COUNT(*)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def code_pairs(old: DataFrame, new: DataFrame, id_col: str, code: str,
               old_filter: Column | None = None, new_filter: Column | None = None) -> DataFrame:
    """``(old_code, new_code, w)`` where ``w`` is the number of joined row
    pairs; rows with a NULL code on either side are excluded."""
    o = old.filter(F.col(code).isNotNull() & (old_filter if old_filter is not None else F.lit(True)))
    n = new.filter(F.col(code).isNotNull() & (new_filter if new_filter is not None else F.lit(True)))
    o = o.groupBy(id_col, F.col(code).alias("old_code")).agg(F.count(F.lit(1)).alias("n_old"))
    n = n.groupBy(id_col, F.col(code).alias("new_code")).agg(F.count(F.lit(1)).alias("n_new"))
    return o.join(n, id_col).select("old_code", "new_code",
                                    (F.col("n_old") * F.col("n_new")).alias("w"))


def code_changes(pairs: DataFrame, k: int | None = 30) -> DataFrame:
    """Most frequent (old, new) pairs with old != new, top ``k`` by
    count, ties by the codes (S18)."""
    out = (pairs.filter(F.col("old_code") != F.col("new_code"))
           .groupBy("old_code", "new_code").agg(F.sum("w").alias("posting_count")))
    if k is not None:
        out = out.orderBy(F.col("posting_count").desc(), "old_code", "new_code").limit(k)
    return out


def code_agreement(pairs: DataFrame) -> DataFrame:
    """One row ``(same_code, different_code, total_matched, pct_same,
    pct_changed)``; the percentages are NULL when nothing matched."""
    same = F.col("old_code") == F.col("new_code")
    counts = pairs.agg(
        F.sum(F.when(same, F.col("w")).otherwise(0)).alias("same_code"),
        F.sum(F.when(~same, F.col("w")).otherwise(0)).alias("different_code"),
        F.coalesce(F.sum("w"), F.lit(0).cast("bigint")).alias("total_matched"))
    total = F.when(F.col("total_matched") > 0, F.col("total_matched"))
    return counts.select("*", (F.col("same_code") / total * 100).alias("pct_same"),
                         (F.col("different_code") / total * 100).alias("pct_changed"))


def with_code_names(changes: DataFrame, lookup: DataFrame, code: str, name: str) -> DataFrame:
    """Attach names to both codes from the same lookup under two
    aliases (left joins: a code without a name keeps its row). The changes
    are already aggregated, so these joins are between small frames."""
    a = lookup.select(F.col(code).alias("old_code"), F.col(name).alias("old_name"))
    b = lookup.select(F.col(code).alias("new_code"), F.col(name).alias("new_name"))
    return (changes.join(a, "old_code", "left").join(b, "new_code", "left")
            .select("old_code", "old_name", "new_code", "new_name", "posting_count"))

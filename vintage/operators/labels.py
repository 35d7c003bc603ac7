"""Labels that differ in case and spacing, matched without losing a spelling.

Sides are matched on the folded label (lower case, trimmed). Of each side the
most frequent spelling is kept, found by counting spellings first (partial
aggregation, so a common label does not gather its rows), and the shown
label is that of the first side that has one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.functions.expr import frac_or_zero, lower_trim
from vintage.operators.distribution import union_all


def label_union(sides: Mapping[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """``sides`` maps a name to (rows, label column, weight column or None for
    rows). ``(key, label, {side}_label, {side}_n, {side}_frac ...)``: one row
    per folded label of any side; a side without it has a NULL label and 0.
    Of spellings that tie the least is taken; NULL labels are left out."""
    spelled = union_all([
        df.filter(F.col(label).isNotNull()).select(F.lit(name).alias("side"), lower_trim(label).alias("key"), F.col(label).alias("spelling"),
                                                   (F.lit(1) if weight is None else F.col(weight)).cast("double").alias("w"))
        .groupBy("side", "key", "spelling").agg(F.sum("w").alias("w"))
        for name, (df, label, weight) in sides.items()])
    total = spelled.groupBy("side").agg(F.sum("w").alias("total"))
    # one row per spelling is left: the widest of a key first, then the least
    best = F.struct((-F.col("w")).alias("less"), "spelling")
    per_key = spelled.groupBy("side", "key").agg(F.min(best).alias("best"), F.sum("w").alias("n"))
    shares = per_key.join(F.broadcast(total), "side").select("side", "key", F.col("best.spelling").alias("spelling"), "n", frac_or_zero("n", "total").alias("frac"))
    at = lambda name, c: F.max(F.when(F.col("side") == name, F.col(c)))
    out = shares.groupBy("key").agg(*[at(n, "spelling").alias(f"{n}_label") for n in sides], *[F.coalesce(at(n, "n"), F.lit(0.0)).alias(f"{n}_n") for n in sides],
                                    *[F.coalesce(at(n, "frac"), F.lit(0.0)).alias(f"{n}_frac") for n in sides])
    return out.select("key", F.coalesce(*[f"{n}_label" for n in sides]).alias("label"), *[f"{n}_{c}" for n in sides for c in ("label", "n", "frac")])

"""Exact median without gathering a group in one task.

Spark's ``median`` / ``percentile`` keeps every distinct value of a group
in one aggregation buffer, and the groups here are often whole sources,
one of which may hold a third of all rows. This operator computes the same
interpolated median (the value DuckDB's ``median`` gives) lazily, without a
range exchange or a checkpoint:

1. histogram ``(keys, value, c)``: partial aggregation before the shuffle,
   so a value repeated a billion times is one row;
2. coarse bins: a fixed monotone function of the value (``BINS`` steps per
   e-fold, so a bin is about 0.02 % wide), counted per (keys, bin); values
   over ten orders of magnitude fall into fewer than 100,000 bins;
3. running counts over a group's bins find the at most two bins that hold
   the ranks ``(n+1) div 2`` and ``n div 2 + 1``;
4. only the histogram rows of those bins are ranked, and the at most two
   rows covering the ranks are kept and interpolated.

The bin depends on the value alone, so a recomputed stage gives the same
rows. Values that all lie within one bin are ranked together, as many as
there are distinct ones.

Defined results: NULL values have no rank (a group of NULLs only has no
median); a NULL key is a group; NaN is above every other value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins per factor e of the value's magnitude.
BINS = 4096
_NULL_BIN, _NAN_BIN = -(1 << 63), (1 << 63) - 1
#: Lifts the logarithm of the smallest positive double above zero.
_LIFT = 800


def histogram(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """``(keys..., _v, _c)``: rows per distinct value (NULL included) of each
    group, or the sum of ``weight`` when rows are already counts; map-side
    partial aggregation runs before the shuffle."""
    w = F.lit(1) if weight is None else F.col(weight)
    return (df.select(*keys, F.col(value).cast("double").alias("_v"), w.alias("_w"))
            .groupBy(*keys, "_v").agg(F.sum("_w").cast("bigint").alias("_c")))


def _bin(v: Column) -> Column:
    """Never decreases as ``v`` grows; 0 for 0, below all for NULL."""
    size = F.floor((F.log(F.abs(v)) + _LIFT) * BINS)
    return (F.when(v.isNull(), F.lit(_NULL_BIN)).when(F.isnan(v), F.lit(_NAN_BIN))
            .when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size))


def summary(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., _min, _max, _sum, _n, _rows, _median)`` of a histogram:
    ``_n`` counts non-NULL values, ``_rows`` all. The histogram's exchange is
    read twice (its bins, its middle rows) and computed once."""
    keys = list(keys)
    v, c = F.col("_v"), F.col("_c")
    binned = hist.withColumn("_bin", _bin(v))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = binned.groupBy(*keys, "_bin").agg(
        F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.sum(v * c).alias("_s"), F.sum(c).alias("_r"),
        F.coalesce(F.sum(F.when(v.isNotNull(), c)), F.lit(0)).alias("_w"))
    bins = bins.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bin").alias("_b"), "_w",
        F.sum("_w").over(upto).alias("_cum"), F.sum("_w").over(whole).alias("_n"),
        F.min("_lo").over(whole).alias("_min"), F.max("_hi").over(whole).alias("_max"),
        F.sum("_s").over(whole).alias("_sum"), F.sum("_r").over(whole).alias("_rows"))
    k1, k2 = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    before = F.col("_cum") - F.col("_w")
    middle = bins.filter((F.col("_n") == 0) | ((before < k1) & (F.col("_cum") >= k1))
                         | ((before < k2) & (F.col("_cum") >= k2))).withColumn("_before", before)

    same = F.col("_bin").eqNullSafe(F.col("_b"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    run = (Window.partitionBy(*keys, "_bin").orderBy("_v")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = binned.join(middle, same).withColumn("_to", F.col("_before") + F.sum("_c").over(run))
    first = F.col("_to") - c
    a = F.when((first < k1) & (F.col("_to") >= k1), v)
    b = F.when((first < k2) & (F.col("_to") >= k2), v)
    out = rows.groupBy(*keys).agg(F.max(a).alias("_a"), F.max(b).alias("_z"),
                                  *[F.max(x).alias(x) for x in ("_min", "_max", "_sum", "_n", "_rows")])
    return out.select(*keys, "_min", "_max", "_sum", "_n", "_rows",
                      (F.col("_a") + (F.col("_z") - F.col("_a")) * 0.5).alias("_median"))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, alias: str = "median") -> DataFrame:
    """``(keys..., alias)``: exact median of non-NULL ``value`` per group."""
    return (summary(histogram(df, keys, value), keys).filter(F.col("_n") > 0)
            .select(*keys, F.col("_median").alias(alias)))

"""Join helpers.

No helper forces a broadcast: lookups and hierarchies are ordinary
DataFrames whose size Spark measures (``autoBroadcastJoinThreshold`` at
planning, AQE at runtime), broadcasting them when small and falling back to
a sort-merge join when not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.sources.positions import ONCE


def norm_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
              how: str = "inner") -> DataFrame:
    """Equi-join on ``UPPER(TRIM(.))`` of a text column on each side.
    The normalised keys are projected first, so the join itself is a plain
    hash / sort-merge equi-join (the helper key column is dropped)."""
    key = "_norm_key"
    lk = left.withColumn(key, F.upper(F.trim(F.col(left_col))))
    rk = right.withColumn(key, F.upper(F.trim(F.col(right_col))))
    return lk.join(rk, key, how).drop(key)


def lookup(df: DataFrame, table: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Attach a code lookup (left by default, so the fact rows are
    kept and unknown codes get NULLs). A code that the lookup holds several
    times copies its rows: their ids no longer occur once."""
    if ONCE not in df.columns:
        return df.join(table, on, how)
    ways = table.withColumn("_ways", F.count(F.lit(1)).over(Window.partitionBy(on)))
    return df.join(ways, on, how).withColumn(ONCE, F.col(ONCE) & (F.coalesce("_ways", F.lit(1)) == 1)).drop("_ways")

"""Results stored in order.

A result that is to be shown in order is ranged over its sort keys, with the
NULL placement each key asks for, sorted within each range and written as a
snapshot. Its notes hold, for each range, how many rows lie in it and before
it, and its first and last key; a page of the result reads only the ranges it
lies in, and a row's place is known without sorting anything again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.sources.snapshots import read_snapshot, snapshot, write_snapshot

_RANGE, _ROW = "_range", "_row"


def write_ordered(df: DataFrame, table: str, order: Sequence[Column], keys: Sequence[str]) -> dict:
    """Write ``df`` in ``order`` (sort expressions with their NULL placement;
    a unique last key makes places unique). ``keys`` are the columns whose
    first and last values each range notes. Returns the committed snapshot."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # numbered where they lie: partition in the upper bits, row in the lower 33
    number = F.monotonically_increasing_id()
    rows = ranged.withColumn("_number", number).select(*df.columns, F.shiftright("_number", 33).cast("int").alias(_RANGE),
                                                       F.col("_number").bitwiseAND((1 << 33) - 1).alias(_ROW))
    staged = f"{table.rstrip('/')}/ranged"
    write_snapshot(rows, staged, [_RANGE])
    kept = read_snapshot(spark, staged)
    ends = kept.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("rows"), *[F.min_by(F.col(k).cast("string"), _ROW).alias(f"first_{k}") for k in keys],
                                    *[F.max_by(F.col(k).cast("string"), _ROW).alias(f"last_{k}") for k in keys]).orderBy(_RANGE).collect()
    ranges, ahead = [], 0
    for r in ends:
        ranges.append({"range": r[_RANGE], "rows": r["rows"], "ahead": ahead, "first": [r[f"first_{k}"] for k in keys], "last": [r[f"last_{k}"] for k in keys]})
        ahead += r["rows"]
    # the notes are one small row, committed once the ranges stand
    notes = spark.createDataFrame([(json.dumps(ranges),)], "ranges string")
    return write_snapshot(notes.coalesce(1), table, notes={"ranged": snapshot(spark, staged)["version"], "ranges": ranges})


def read_ordered(spark: SparkSession, table: str, first: int = 1, last: int | None = None) -> DataFrame:
    """The rows with their ``position``, from place ``first`` to ``last``
    (1-based, inclusive; None: the end): only the ranges that hold them are read."""
    found = snapshot(spark, table)
    if found is None:
        raise FileNotFoundError(f"{table} has no snapshot")
    rows = read_snapshot(spark, f"{table.rstrip('/')}/ranged", found["ranged"])
    parts = [r for r in found["ranges"] if r["ahead"] + r["rows"] >= first and (last is None or r["ahead"] < last)]
    if not parts:
        return rows.filter(F.lit(False)).withColumn("position", F.lit(0).cast("bigint")).drop(_RANGE, _ROW)
    ahead = F.element_at(F.create_map(*[F.lit(x) for r in parts for x in (r["range"], r["ahead"])]), F.col(_RANGE))
    out = rows.filter(F.col(_RANGE).isin(*[r["range"] for r in parts])).withColumn("position", (ahead + F.col(_ROW) + 1).cast("bigint")).drop(_RANGE, _ROW)
    return out.filter((F.col("position") >= first) & (F.lit(last is None) | (F.col("position") <= F.lit(last if last is not None else 0))))

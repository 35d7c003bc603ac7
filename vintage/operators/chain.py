"""Comparisons along a chain of releases, recounted release by release.

A release does not change once it is out. Its value counts are a small
aggregate, stored as a snapshot under a key of what they were made from; a
comparison merges the stored counts of all releases, and a new release scans
only itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.functions.expr import not_ilike_any
from vintage.operators.compare import UNCLASSIFIED
from vintage.operators.distribution import union_all
from vintage.operators.partials import column_counts
from vintage.sources.snapshots import intact, read_snapshot, snapshot, write_snapshot


def release_counts(df: DataFrame, fields: Mapping[str, Column | None], by: Sequence[str], exclude: Sequence[str] = UNCLASSIFIED) -> DataFrame:
    """``(field, *by, field_value, n)`` of one release: rows per value of
    every field, under its gate."""
    values = []
    for i, (name, gate) in enumerate(fields.items()):
        v = F.col(name).cast("string")
        ok = v.isNotNull() & not_ilike_any(v, list(exclude))
        values.append(F.when(ok if gate is None else ok & gate, v).alias(f"_v_{i}"))
    parts = column_counts(df.select(*by, *values), list(by), [f"_v_{i}" for i in range(len(values))])
    field = F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("_field") + 1)
    return (parts.groupBy("_field", *by, F.col("_value").alias("field_value")).agg(F.sum("_n").alias("n"))
            .select(field.alias("field"), *by, "field_value", "n"))


def recounted(spark: SparkSession, store: str, releases: Mapping[str, tuple[str, Callable[[], DataFrame]]], fields: Mapping[str, Column | None],
              by: Sequence[str] = ("country",)) -> tuple[DataFrame, list[str]]:
    """(``(field, *by, field_value, cnt_<release>...)`` over all releases, the
    releases that had to be read). ``releases`` maps a name to (state of its
    files, its rows); ``store`` holds one table of counts for each."""
    read, frames = [], []
    recipe = f"{list(by)} {[(n, str(g)) for n, g in fields.items()]}"
    for name, (state, rows) in releases.items():
        key = hashlib.sha1(f"{state}\n{recipe}".encode()).hexdigest()
        table = f"{store.rstrip('/')}/{name}"
        found = snapshot(spark, table)
        if not found or found.get("key") != key or not intact(spark, table):
            write_snapshot(release_counts(rows(), fields, by), table, notes={"key": key})
            read.append(name)
        frames.append(read_snapshot(spark, table).withColumn("release", F.lit(name)))
    counts = [F.sum(F.when(F.col("release") == n, F.col("n")).otherwise(0)).cast("bigint").alias(f"cnt_{n}") for n in releases]
    return union_all(frames).groupBy("field", *by, "field_value").agg(*counts), read

"""Table scans (A1, A2, A4).

Every input is read lazily through ``spark.read``; callers select the
columns they need so the parquet scan prunes to them and receives their
filters (``ReadSchema`` / ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a dataset directory (``{root}/{name}.parquet``)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def release_path(root: str, version: str, table: str) -> str:
    """A1: the path of one release of a versioned table."""
    return f"{root.rstrip('/')}/{version}/{table}"


def read_release(spark: SparkSession, root: str, version: str, table: str) -> DataFrame:
    """A1: one release of a versioned table, stored as parquet."""
    return spark.read.parquet(release_path(root, version, table))


def read_result(spark: SparkSession, name: str) -> DataFrame:
    """A4: a published result table (whole table, filtered by the caller)."""
    return spark.read.table(name)


class Tables:
    """Lazy accessor over one dataset directory: ``t.orders`` reads orders."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.root, name)

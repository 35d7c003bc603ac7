"""Families of tables stored side by side by the key that joins them.

The members of a family are written once, each split into the same number of
buckets by a hash of the key. A join of two members on that key, or an
aggregation whose keys hold it, then reads bucket i beside bucket i: nothing
crosses an exchange, however large the members are. Members are narrow (the
columns that such joins use), so a wide table keeps its own layout.

A task reads a whole bucket and adaptive execution cannot split it, so a key
with more rows than a bucket's fair share stays out of the buckets. There are
at most ``buckets`` such keys a member, by their definition. Their rows and those
of a NULL key form the plain part, in which a join goes through an exchange
that adaptive execution may split. A key is in one part only, in all members:
the results of the parts are united. A family without such rows has one part.

Buckets need an entry in the session's catalog. The files do not: every
application enters the stored family by itself, under a name of its folder.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.sources.staging import staged_folder

#: Rows of the largest member aimed at in a bucket; buckets at least (both are
#: powers of two in effect, so families of different sizes still divide).
BUCKET_ROWS = 4_000_000
MIN_BUCKETS = 8
#: A key below this number of rows is never worth a part of its own.
HOT_ROWS = 1_000

Parts = list[dict[str, DataFrame]]

_LAYOUT = "member string, ddl string, buckets int, plain long"
_ENTERED: dict[tuple[str, str], Parts] = {}
_ENTERING = threading.RLock()


def bucket_count(rows: int) -> int:
    """The power of two that leaves at most ``BUCKET_ROWS`` in a bucket."""
    n = MIN_BUCKETS
    while n * BUCKET_ROWS < rows:
        n *= 2
    return n


def _table(path: str, member: str) -> str:
    return f"vintage_{path.rsplit('-', 1)[-1]}_{member}"


def _write(spark: SparkSession, path: str, key: str, members: Mapping[str, Callable[[], DataFrame]]) -> None:
    rows = {m: build().count() for m, build in members.items()}
    buckets = bucket_count(max(rows.values()))
    heavy = [build().filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > max(rows[m] / buckets, HOT_ROWS)).select(key) for m, build in members.items()]
    reduce(DataFrame.union, heavy).distinct().write.parquet(f"{path}/hot")
    hot = spark.read.parquet(f"{path}/hot").withColumn("_hot", F.lit(True))
    layout = []
    for m, build in members.items():
        df = build()
        # at most ``buckets`` keys a member
        marked = df.join(F.broadcast(hot), key, "left")
        apart = F.col(key).isNull() | F.col("_hot").isNotNull()
        # one task a bucket, so one file a bucket
        (marked.filter(~apart).select(df.columns).repartition(buckets, key)
         .write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{m}").saveAsTable(_table(path, m)))
        marked.filter(apart).select(df.columns).write.parquet(f"{path}/{m}_plain")
        plain = spark.read.parquet(f"{path}/{m}_plain").count()
        layout.append((m, df._jdf.schema().toDDL(), buckets, plain))
    spark.createDataFrame(layout, _LAYOUT).coalesce(1).write.parquet(f"{path}/layout")


def _enter(spark: SparkSession, path: str, key: str) -> Parts:
    layout = spark.read.schema(_LAYOUT).parquet(f"{path}/layout").collect()  # one row a member
    for r in layout:
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{_table(path, r.member)}` ({r.ddl}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {r.buckets} BUCKETS LOCATION '{path}/{r.member}'")
    parts = [{r.member: spark.table(f"`{_table(path, r.member)}`") for r in layout}]
    if any(r.plain for r in layout):
        parts.append({r.member: spark.read.schema(r.ddl).parquet(f"{path}/{r.member}_plain") for r in layout})
    return parts


def colocated(spark: SparkSession, dataset: str, family: str, key: str,
              members: Mapping[str, Callable[[], DataFrame]], recipe: str = "") -> Parts:
    """The parts of ``family``, each a frame per member; written on first use
    of the dataset's state and recipe, entered in the catalog afterwards."""
    with _ENTERING:
        path = staged_folder(spark, dataset, family, lambda p: _write(spark, p, key, members), recipe)
        memo = (spark.sparkContext.applicationId, path)
        if memo not in _ENTERED:
            _ENTERED[memo] = _enter(spark, path, key)
        return _ENTERED[memo]

"""Staging derived inputs as tables in the shared checkpoint folder.

The comparison jobs read stored release tables. The stand-ins derived from
the driver tables are written once per state of a dataset directory as
parquet under ``spark.checkpoint.dir`` (shared storage on a cluster) and
read back by every query, which then scans them with column pruning and
pushed filters like any stored release.

A stage belongs to the dataset's files (names, sizes, times) and to the
recipe's own text: a rewritten dataset or a changed recipe gets new tables.
Each table is written to a fresh folder, and a marker naming that folder is
written last: a job that dies half-way leaves no marker, and jobs that stage
the same table at once never write into each other's files.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from vintage.session import checkpoint_dir


def dataset_state(spark: SparkSession, dataset: str) -> str:
    """Names, sizes and modification times of the dataset's files, listed
    by the file system that Spark reads them from."""
    path = spark._jvm.org.apache.hadoop.fs.Path(dataset.rstrip("/"))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    files = []
    while found.hasNext():
        f = found.next()
        files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(files))


def stage_root(spark: SparkSession, dataset: str, recipe: str = "") -> str:
    state = f"{dataset.rstrip('/')}\n{dataset_state(spark, dataset)}\n{recipe}"
    digest = hashlib.sha1(state.encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/vintage-stage/{digest}"


def _marked(spark: SparkSession, marker: str) -> str | None:
    """The folder that the marker names; none where there is no whole marker."""
    whole = spark._jvm.org.apache.hadoop.fs.Path(f"{marker}/_SUCCESS")
    if not whole.getFileSystem(spark._jsc.hadoopConfiguration()).exists(whole):
        return None
    return spark.read.schema("path string").parquet(marker).first()["path"]


# Staged tables already resolved in this application: (app id, root, name) ->
# the lazy read of the table. Resolving a parquet path lists its files and
# reads a footer, so a query that reads the same table several times (one
# source in several roles) resolves it once.
_RESOLVED: dict[tuple[str, str, str], DataFrame] = {}
# Likewise the folders: reading a marker is a job.
_FOLDERS: dict[tuple[str, str, str], str] = {}
# Jobs that run side by side in this application make a table once.
_MAKING = threading.RLock()


def staged_folder(spark: SparkSession, dataset: str, name: str, make: Callable[[str], None], recipe: str = "") -> str:
    """A folder of files derived from ``dataset`` that ``make`` fills, once per
    state of the dataset and recipe."""
    with _MAKING:
        root = stage_root(spark, dataset, recipe)
        memo = (spark.sparkContext.applicationId, root, name)
        if memo in _FOLDERS:
            return _FOLDERS[memo]
        marker = f"{root}/_done_{name}"
        path = _marked(spark, marker)
        if path is None:
            path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
            make(path)
            spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").parquet(marker)
        _FOLDERS[memo] = path
        return path


def staged(spark: SparkSession, dataset: str, name: str, build: Callable[[], DataFrame],
           sort_by: Sequence[str] = (), recipe: str = "") -> DataFrame:
    """The table ``name`` derived from ``dataset``: written on first use,
    read afterwards. ``sort_by`` orders rows within each file so parquet
    min/max statistics let date and key filters skip row groups; ``recipe``
    is the text that the table is made by."""
    with _MAKING:
        return _staged(spark, dataset, name, build, sort_by, recipe)


def _staged(spark: SparkSession, dataset: str, name: str, build: Callable[[], DataFrame],
            sort_by: Sequence[str], recipe: str) -> DataFrame:
    root = stage_root(spark, dataset, recipe)
    memo = (spark.sparkContext.applicationId, root, name)
    if memo in _RESOLVED:
        return _RESOLVED[memo]
    marker = f"{root}/_done_{name}"
    path = _marked(spark, marker)
    if path is None:
        path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
        df = build()
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
        df.write.parquet(path)
        spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").parquet(marker)
    _RESOLVED[memo] = spark.read.parquet(path)
    return _RESOLVED[memo]

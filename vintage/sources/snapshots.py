"""Result tables as snapshots: written aside, switched by one rename (B1, A4).

A table is a folder with ``data/`` and ``versions/``. A writer puts a whole
new table into a fresh folder under ``data/`` and then commits it: the file
``versions/<number>`` names the folder, its files with their sizes, the
schema, the row count and whatever the writer wants to remember. It is
written under another name and renamed to the next free number, which fails
if another writer was faster (then the next number is tried). Readers take
the highest number, so they see the last whole table: never none, never
half of one. A writer that dies leaves a folder no version names.

Snapshots stay readable, by number too, until ``expire`` removes them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Files:
    """The folder's file system, as Spark sees it."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return [f.getPath().getName() for f in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def listing(self, folder: str) -> list[list]:
        """[name below the folder, bytes] of its data files."""
        where, out = self.path(folder), []
        top = self.fs.makeQualified(where).toString().rstrip("/") + "/"
        found = self.fs.listFiles(where, True)
        while found.hasNext():
            f = found.next()
            name = f.getPath().toString().removeprefix(top)
            if not re.search(r"(^|/)[_.]", name):
                out.append([name, f.getLen()])
        return sorted(out)

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), False)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename_new(self, source: str, target: str) -> bool:
        """Whether the rename took place; it does not replace a file."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        plain = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.path(source), self.path(target), plain)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            return False

    def age(self, name: str) -> float:
        """Seconds since the last change."""
        return (self.jvm.java.lang.System.currentTimeMillis() - self.fs.getFileStatus(self.path(name)).getModificationTime()) / 1000

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _versions(files: _Files, table: str) -> list[int]:
    return sorted(int(n) for n in files.names(f"{table}/versions") if re.fullmatch(r"\d{10}", n))


def snapshot(spark: SparkSession, table: str, version: int | None = None) -> dict | None:
    """What was committed as ``version`` (default: last); None for a table
    without a snapshot."""
    table = table.rstrip("/")
    files = _Files(spark, table)
    have = _versions(files, table)
    if not have or (version is not None and version not in have):
        return None
    return json.loads(files.read(f"{table}/versions/{have[-1] if version is None else version:010d}"))


def read_snapshot(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as last committed, or as of ``version``."""
    found = snapshot(spark, table, version)
    if found is None:
        raise FileNotFoundError(f"{table} has no snapshot" + ("" if version is None else f" {version}"))
    return spark.read.schema(T.StructType.fromJson(json.loads(found["schema"]))).parquet(found["folder"])


def write_snapshot(df: DataFrame, table: str, partition_by: Sequence[str] = (), notes: Mapping | None = None) -> dict:
    """Write ``df`` as the table's next snapshot and return what was
    committed. Rows are counted as they are written."""
    spark, table = df.sparkSession, table.rstrip("/")
    files = _Files(spark, table)
    folder = f"{table}/data/{uuid.uuid4().hex}"
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
    order = [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    kept = {"folder": folder, "rows": seen.get.get("rows", 0), "files": files.listing(folder),
            "schema": json.dumps(T.StructType([T.StructField(f.name, f.dataType) for f in order]).jsonValue()), **(notes or {})}
    files.fs.mkdirs(files.path(f"{table}/versions"))
    aside = f"{table}/versions/.{uuid.uuid4().hex}"
    number = (_versions(files, table) or [0])[-1] + 1
    while True:
        kept["version"] = number
        files.write(aside, json.dumps(kept))
        if files.rename_new(aside, f"{table}/versions/{number:010d}"):
            return kept
        files.remove(aside)
        number += 1


def intact(spark: SparkSession, table: str, version: int | None = None) -> bool:
    """Whether every file of a snapshot is there with its size."""
    found = snapshot(spark, table, version)
    return found is not None and _Files(spark, table).listing(found["folder"]) == found["files"]


def expire(spark: SparkSession, table: str, keep: int = 2, grace: float = 86400.0) -> list[str]:
    """Remove all but the last ``keep`` snapshots, and folders that no
    version names if nothing changed in them for ``grace`` seconds (a younger
    one may be a writer's). Returns the folders that went."""
    table = table.rstrip("/")
    files = _Files(spark, table)
    have = _versions(files, table)
    named = {v: snapshot(spark, table, v)["folder"] for v in have}
    gone = []
    for v in have[:-keep] if keep else have:
        files.remove(named[v])
        files.remove(f"{table}/versions/{v:010d}")
        gone.append(named.pop(v))
    for name in files.names(f"{table}/data"):
        folder = f"{table}/data/{name}"
        if folder not in named.values() and files.fs.exists(files.path(folder)) and files.age(folder) >= grace:
            files.remove(folder)
            gone.append(folder)
    return gone


def register_snapshot(spark: SparkSession, name: str, found: Mapping) -> None:
    """Make a snapshot readable as ``name``, a view that one catalog
    operation replaces. (A stored table of that name, from a former
    scheme, goes first.)"""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    cols = T.StructType.fromJson(json.loads(found["schema"]))
    typed = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in cols)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {typed} FROM parquet.`{found['folder']}`")

"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (and
# falls back to sort-merge when a side is larger than the broadcast
# threshold), coalesces small shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # result tables are written side by side, each in a pool of its own
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "vintage", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. With ``master=None`` (and
    ``shuffle_partitions=None``) the submitter owns master and sizes, and
    only ``BASE_CONF`` is applied."""
    builder = SparkSession.builder.appName(app_name)
    conf = dict(BASE_CONF)
    if master is not None:
        builder = builder.master(master)
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage and we only read
    it; where it is unset there, that is an error, as executors cannot share
    a folder of the driver. With a local master a fresh scratch folder is
    created and registered for the session.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a shared folder when the master is not local")
    if not d:
        d = tempfile.mkdtemp(prefix="vintage-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def recommended_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Settings sized for one job over ``input_bytes`` of parquet on a
    cluster with ``total_cores`` task slots: scan splits and shuffle
    partitions of about ``target_partition_mb`` each (at least two waves of
    tasks), AQE left to coalesce small partitions and split skewed ones.
    For 100 TB on 1000 executors x 8 cores this gives ~400k scan splits and
    as many initial shuffle partitions, which AQE coalesces per stage."""
    target = target_partition_mb * 1024 * 1024
    shuffle = max(2 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        # only plan-time broadcasts of measured small sides (lookups); the
        # explicit ones are bounded by a parameter (sources, k)
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }

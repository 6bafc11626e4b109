"""Session settings and the shared scratch folder.

Every job that must cut lineage or stage data writes under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
(local tests) do we make a folder of our own and set it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a session for this library should carry.  Shuffle partitions are
# sized for local runs; on a cluster set them from data volume (about
# 128-256 MB of shuffle data per partition) and let AQE coalesce.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_settings(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized from the data: shuffle partitions so that each holds
    about ``target_partition_bytes`` of the largest input (at least two per
    core), file splits of the same size, and AQE aiming at the same
    partition size when it coalesces or splits skewed partitions.

    For 100 TB on 8,000 cores this gives about 400,000 shuffle partitions
    of 256 MB; AQE then coalesces the small stages.
    """
    parts = max(2 * cores, -(-int(input_bytes) // target_partition_bytes))
    size = f"{target_partition_bytes // (1 << 20)}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_bytes // (1 << 20)}m",
    }


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``.  If unset, a local master gets a folder
    under the system temp dir, registered so that ``DataFrame.checkpoint()``
    works as well; any other master is an error, since its executors would
    each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd-checkpoints"))
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder."""
    return os.path.join(shared_root(spark), "tidemark", *parts, uuid.uuid4().hex)


def stage(df, name: str = "staged"):
    """SCD5: write ``df`` to the shared folder and read it back.

    Cuts lineage so that every later read sees the same rows (a sampled or
    clock-stamped change set read twice would otherwise be recomputed).
    Survives executor loss, unlike a local checkpoint.  Returns the
    re-read DataFrame; its path is in ``inputFiles()``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staging", name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Numbered snapshots of a table as plain Parquet folders
``root/snapshot_id=<n>`` (SRC5, SRC6, VER2, VER3, VER5, VER6).

Each is written whole, so an older one reads as it was; the folder name is a
partition column, so Spark prunes to the snapshot asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID = "snapshot_id"


def publish(df: DataFrame, root: str, snapshot_id: int) -> DataFrame:
    """Write snapshot ``snapshot_id``; fails if it is there already."""
    df.write.mode("errorifexists").parquet(f"{root}/{ID}={snapshot_id}")
    return read(df.sparkSession, root, snapshot_id)


def read(spark: SparkSession, root: str, snapshot_id: int) -> DataFrame:
    """SRC5 / VER3: a snapshot with the columns it was written with."""
    return spark.read.parquet(f"{root}/{ID}={snapshot_id}")


def read_evolved(spark: SparkSession, root: str, snapshot_id: int) -> DataFrame:
    """VER5: a snapshot with the columns of all snapshots; those that it was
    written without come back null."""
    return spark.read.option("mergeSchema", True).parquet(root).filter(F.col(ID) == snapshot_id).drop(ID)


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """SRC6 / VER2: each snapshot's number, time, files and rows (from
    ``_metadata``, no data column is read)."""
    return spark.read.option("mergeSchema", True).parquet(root) \
        .select(ID, "_metadata.file_path", "_metadata.file_modification_time").groupBy(ID, "file_path") \
        .agg(F.max("file_modification_time").alias("at"), F.count(F.lit(1)).alias("n")).groupBy(ID) \
        .agg(F.max("at").alias("committed_at"), F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))


def diff(older: DataFrame, newer: DataFrame) -> DataFrame:
    """VER6: rows added and removed (bag semantics): one signed count over both
    sides.  Columns that one side lacks count as null there."""
    sides = older.withColumn("__n", F.lit(-1)).unionByName(newer.withColumn("__n", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in sides.columns if c != "__n"]
    net = sides.groupBy(*cols).agg(F.sum("__n").alias("__n")).filter("__n <> 0")
    return net.select(*cols, F.when(F.col("__n") > 0, "added").otherwise("removed").alias("change"),
                      F.explode(F.sequence(F.lit(1), F.abs("__n"))).alias("__i")).drop("__i")

"""Catalog tables in plain Parquet (SNK1, SNK2, DDL2) and the merge into one
(SCD1, SCD2).

A table may be partitioned; ``replace_partitions`` then rewrites just the
partitions that the new rows lie in.  A merge partitions its table by a hash of
the key, so that it reads and rewrites the partitions of its keys alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd2 import DATE_VALIDITY, Validity, scd2_apply
from ..session import stage
from .catalogue import quoted

BUCKET = "key_bucket"


def create_or_replace(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """SNK1 / SNK2: the table becomes ``df``, whatever it was before."""
    writer = df.write.format("parquet").mode("overwrite").partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = (),
                 path: str | None = None) -> DataFrame:
    """DDL2: create an empty typed table unless one exists."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    place = " LOCATION '{}'".format(path.replace("'", "\\'")) if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING parquet{parts}{place}")
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str) -> None:
    """SNK2: ``df`` takes the place of the partitions that its rows lie in; the
    others keep their files.  ``df`` may read the table: it is staged first."""
    spark = df.sparkSession
    rows = stage(df.select(*spark.table(name).columns), "partitions")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The partition of a row; null keys have one like all others."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int").alias(BUCKET)


def create_keyed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """SNK1 for a table that merges go into: partitioned by ``key_bucket``."""
    return create_or_replace(df.withColumn(BUCKET, key_bucket(keys, buckets)).repartition(BUCKET), name, [BUCKET], path)


def merge_into(name: str, changes: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective, buckets: int,
               v: Validity = DATE_VALIDITY, close_rule: str = "changed", insert_rule: str = "new_or_changed",
               null_safe: bool = True, dedupe_by: Sequence[str] | None = None) -> list[int]:
    """Merge ``changes`` into a table made by ``create_keyed``; returns the
    partitions rewritten (at most ``buckets`` numbers reach the driver).

    The rules are those of ``scd2_apply``.  ``changes`` must be repeatable:
    stage it if it is sampled or stamped.
    """
    spark = changes.sparkSession
    touched = sorted(r[0] for r in changes.select(key_bucket(keys, buckets)).distinct().collect())
    if not touched:
        return []
    table = spark.table(name).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = scd2_apply(table, changes, keys, tracked, effective, v, close_rule, insert_rule, null_safe, dedupe_by)
    replace_partitions(merged.withColumn(BUCKET, key_bucket(keys, buckets)).repartition(BUCKET), name)
    return touched


def data_files(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC9: ``file_name, file_size, rows`` of each Parquet file under the
    paths, from the hidden ``_metadata`` columns: no data column is read, and
    counts combine map-side."""
    return spark.read.parquet(*paths).select("_metadata.file_path", "_metadata.file_name", "_metadata.file_size") \
        .groupBy("file_path", "file_name", "file_size").agg(F.count(F.lit(1)).alias("rows")).drop("file_path")

"""Event topics: Kafka when its connector is on the classpath, otherwise a
directory of JSON-lines files with the same ``value`` column (SRC2, SNK5,
STR11).

A directory topic is an append-only folder; each publish adds a sub-folder,
written by one Spark job.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.json import to_json_value


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName(  # noqa: SLF001 - a class lookup, nothing else
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def publish_events(df: DataFrame, topic: str, servers: str | None = None) -> None:
    """SNK5: publish every row as one JSON object (nulls left out), in one
    write.  Readers pace themselves (``maxFilesPerTrigger``)."""
    values = to_json_value(df)
    if servers:
        (values.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
    else:
        values.write.mode("errorifexists").text(os.path.join(topic, f"batch-{uuid.uuid4().hex}"))


def topic_stream(spark: SparkSession, topic: str, servers: str | None = None,
                 starting: str = "earliest", max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC2 / STR11: a stream with a ``value`` column, from the start."""
    if servers:
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic).option("startingOffsets", starting).load())
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(os.path.join(topic, "batch-*"))


def topic_batch(spark: SparkSession, topic: str) -> DataFrame:
    """The whole directory topic as a batch DataFrame."""
    return spark.read.text(os.path.join(topic, "batch-*"))

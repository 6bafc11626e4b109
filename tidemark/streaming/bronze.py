"""Bronze: topic → parsed columns → append-only parquet table
(STR1-STR5, STR11, SNK3).

One code path for batch and stream: ``parse_events`` works on either.  Bad
records can go to a quarantine folder instead of becoming all-null rows (L8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.json import parse_json, parse_json_split


def parse_events(raw: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """STR1: ``CAST(value AS STRING)`` → ``from_json`` → ``data.*``."""
    return parse_json(raw, col, schema)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_bronze(raw_stream: DataFrame, schema: T.StructType, path: str, checkpoint: str,
                 name: str = "bronze", trigger: str | None = None,
                 required: Sequence[str] = (), quarantine_path: str | None = None,
                 table: str | None = None) -> StreamingQuery:
    """SNK3: append parsed events to a parquet folder (or catalog table
    ``table``), checkpointed, named, with a processing-time trigger
    (``trigger="30 seconds"``) or ``availableNow`` (default, for replays and
    tests).

    With ``quarantine_path`` the stream goes through ``foreachBatch``: good
    rows to ``path``, bad rows with their raw text to the quarantine.  The
    batch id makes each write idempotent on replay.
    """
    if quarantine_path is None:
        parsed = parse_events(raw_stream, schema)
        w = (parsed.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).queryName(name))
        w = _trigger(w, trigger)
        return w.toTable(table) if table else w.start(path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by both writes; recomputable from the source
        try:
            good, bad = parse_json_split(batch, "value", schema, required)
            # Idempotent per batch: a replayed batch overwrites its own folder.
            good.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    w = (raw_stream.writeStream.foreachBatch(write_batch).outputMode("append")
         .option("checkpointLocation", checkpoint).queryName(name))
    return _trigger(w, trigger).start()

"""Running queries: stop, status and progress (STR8-STR10).

Progress comes from the query's own reports (``numInputRows`` per trigger),
so watching a stream never re-counts its sink.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = ("query_name string, batch_id long, timestamp string, num_input_rows long, "
                   "input_rows_per_second double, processed_rows_per_second double, "
                   "trigger_ms long")


def stop_all(spark: SparkSession) -> list[str]:
    """STR8: stop every active query; returns their ids."""
    stopped = []
    for q in spark.streams.active:
        q.stop()
        stopped.append(q.id)
    return stopped


def status(spark: SparkSession) -> list[dict]:
    """STR9: name, id and status of each active query."""
    return [{"name": q.name, "id": q.id, **q.status} for q in spark.streams.active]


def _row(p) -> tuple:
    return (p.name, p.batchId, p.timestamp, p.numInputRows,
            float(p.inputRowsPerSecond or 0.0), float(p.processedRowsPerSecond or 0.0),
            int((p.durationMs or {}).get("triggerExecution", 0)))


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The query's recent reports (Spark keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates``, 100 by default)."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], PROGRESS_SCHEMA)


class ProgressLog(StreamingQueryListener):
    """STR10: every report of every query, from ``start`` to ``stop``.

    Reports are one small row per trigger; they are written to ``path`` as
    Parquet, ``every`` at a time, so the driver holds few of them however long
    a stream runs.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self._held: list[tuple] = []
        self._lock = threading.Lock()

    def start(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        self._flush()

    def _flush(self) -> None:
        with self._lock:
            rows, self._held = self._held, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._lock:
            self._held.append(_row(event.progress))
            full = len(self._held) >= self.every
        if full:
            self._flush()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def reports(self) -> DataFrame:
        """All reports so far."""
        self._flush()
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)

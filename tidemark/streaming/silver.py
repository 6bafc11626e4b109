"""Silver: a stream of change events → type-2 history (SCD2, SNK4, STR4, STR6,
STR7, STR12, EXT1).

The table holds the *entries* that a history is computed from: the last event
per key and period (for example the event day).  A micro-batch is cut to its
own entries and written to a folder of its own, so what a trigger reads and
writes follows the batch, not the table.  Reading folds the entries (per key
and period the greatest event time wins, whichever came first) and marks the
versions.  So the history equals a rebuild from the whole log however
micro-batches cut or order it: late events, a change back within a period and
null keys included.

Folding the same entries twice changes nothing.  That makes replays safe
without a commit log: a batch that runs again after a crash overwrites its own
folder, a folder counts once Spark has marked it complete, and ``compact`` (run
outside the trigger, to bound the number of folders) may stop at any point.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import latest_per_key
from ..operators.scd2 import TIME_VALIDITY, Validity, history_from_entries

AT = "entry_at"


@dataclass(frozen=True)
class SilverTable:
    """A folder of entries and how its history is read.

    ``schema`` holds the data columns kept (keys, tracked columns, payload,
    and ``order``, which decides between two events of a period: event time,
    then tie-breaks) and the period ``entry_at``.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    order: tuple[str, ...]
    v: Validity = TIME_VALIDITY
    mode: str = "sound"

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
        return path, path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())  # noqa: SLF001

    def folders(self) -> list[str]:
        """Folders that Spark has marked complete."""
        path, fs = self._fs()
        found = fs.globStatus(path(f"{self.root}/*/_SUCCESS"))
        return sorted(s.getPath().getParent().toString() for s in (found or []))

    def append(self, events: DataFrame, folder: str) -> None:
        """Write the entries of ``events`` (which hold ``entry_at``) to a folder
        of their own, in place of what it held."""
        one = latest_per_key(events.select(*self.schema.names), [*self.keys, AT], list(self.order))
        one.write.mode("overwrite").parquet(f"{self.root}/{folder}")

    def entries(self, folders: Sequence[str] | None = None) -> DataFrame:
        """One entry per key and period."""
        paths = self.folders() if folders is None else folders
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        return latest_per_key(rows, [*self.keys, AT], list(self.order))

    def history(self, segment: str | None = None) -> DataFrame:
        """The type-2 history; ``segment`` as in ``history_from_entries``."""
        hist = history_from_entries(self.entries(), self.keys, self.tracked, AT, (), self.v, self.mode, segment)
        return hist.select(*[c for c in self.schema.names if c != AT], *self.v.names)

    def compact(self) -> None:
        """Fold all complete folders into one.  Readers that planned on the
        folders before must read again."""
        path, fs = self._fs()
        old = self.folders()
        if len(old) > 1:
            self.entries(old).write.parquet(f"{self.root}/folded-{uuid.uuid4().hex}")
            for f in old:
                fs.delete(path(f), True)

    def rebuild(self, events: DataFrame) -> None:
        """Replace all entries by those of a whole change log (for example the
        bronze table)."""
        path, fs = self._fs()
        old = self.folders()
        self.append(events, f"folded-{uuid.uuid4().hex}")
        for f in old:
            fs.delete(path(f), True)


def silver_table(spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 ts: str, period: Column | None, columns: Sequence[str], tiebreak: Sequence[str] = (),
                 v: Validity = TIME_VALIDITY, mode: str = "sound") -> SilverTable:
    """The table of a source's ``columns``; nothing is written yet."""
    order = [ts, *tiebreak]
    if not set(order) <= set(columns):
        raise ValueError(f"columns must hold {order}: they decide between events of a period")
    return SilverTable(spark, root.rstrip("/"), stamped(source.select(*columns), period).schema, tuple(keys),
                       tuple(tracked), tuple(order), v, mode)


def stamped(events: DataFrame, period: Column | None) -> DataFrame:
    """Events with their period.  ``None`` makes a whole micro-batch one period
    at its processing time, as the per-trigger MERGE does (its history then
    depends on how batches are cut)."""
    return events.withColumn(AT, period if period is not None else F.current_timestamp())


def silver_batch(target: SilverTable, period: Column | None, writer: str = "silver") -> Callable[[DataFrame, int], None]:
    """EXT1: the per-micro-batch function for ``foreachBatch``.  ``writer``
    names one checkpoint: its batch ids name the folders."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():  # STR6
            target.append(stamped(batch, period), f"{writer}-{batch_id}")

    return run


def start_foreach_batch(source: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                        name: str, trigger: str | None = None) -> StreamingQuery:
    """EXT1: run user code once per micro-batch (``fn(batch_df, batch_id)``),
    checkpointed and named.  Inside ``fn`` use ``batch_df.sparkSession``,
    not an outer session (L3)."""
    w = (source.writeStream.foreachBatch(fn).outputMode("append")
         .option("checkpointLocation", checkpoint).queryName(name))
    w = w.trigger(availableNow=True) if trigger in (None, "availableNow") else w.trigger(processingTime=trigger)
    return w.start()


def start_silver(source: DataFrame, target: SilverTable, period: Column | None, checkpoint: str,
                 name: str = "silver", trigger: str | None = None) -> StreamingQuery:
    """SNK4 / STR12: run the silver merge over a stream (for example the
    bronze folder read with ``readStream``).  ``trigger="15 seconds"`` for a
    service; ``availableNow`` (default) drains what is there and stops."""
    return start_foreach_batch(source, silver_batch(target, period, writer=name), checkpoint, name, trigger)

"""Topic → bronze → silver: the history equals a rebuild however micro-batches
cut and order the log; restart and replay add nothing."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF0001
from tidemark.operators.scd2 import TIME_VALIDITY, history_from_log
from tidemark.plans.queries import EVENT_SCHEMA, HISTORY_COLUMNS, event_day
from tidemark.session import scratch_path
from tidemark.sources.topic import publish_events, topic_stream
from tidemark.streaming.bronze import start_bronze
from tidemark.streaming.monitor import progress, status, stop_all
from tidemark.streaming.silver import silver_batch, silver_table, stamped, start_foreach_batch, start_silver

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()),
                       T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])


def _key(r):
    return str((r.user_id, r.event_type, r.event_id, r.ts, r.effective_time, r.end_time, r.is_current))


def _sorted(df):
    return sorted(map(_key, df.collect()))


def _events(spark, rows):
    return spark.createDataFrame(rows, EVENTS).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _silver(spark, name, source, mode="sound", period=True):
    p = event_day() if period else None
    target = silver_table(spark, scratch_path(spark, "t", name), source, ["user_id"], ["event_type"], "ts", p,
                          HISTORY_COLUMNS, ["event_id"], TIME_VALIDITY, mode)
    return target, silver_batch(target, p, writer="w")


def _rebuilt(log, mode="sound"):
    return history_from_log(log, ["user_id"], ["event_type"], "ts", ["event_id"], event_day(), TIME_VALIDITY, mode,
                            payload=["event_id", "ts"])


@pytest.mark.parametrize("mode", ["sound", "compat"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_is_the_same_however_batches_cut_and_order_the_log(spark, mode, seed):
    """Cuts inside days, batches in random order, null keys and values, equal
    times: late events and changes back are all in it."""
    rng = random.Random(seed)
    rows = [(i, f"2024-01-0{rng.randint(1, 5)} {rng.randint(0, 23):02d}:00:00", rng.choice([None, 1, 2, 3]),
             rng.choice(["a", "b", None])) for i in range(70)]
    log = _events(spark, rows)
    target, fn = _silver(spark, f"any-{mode}-{seed}", log, mode)
    rng.shuffle(rows)
    at, batch = 0, 0
    while at < len(rows):
        n = rng.randint(8, 25)
        fn(_events(spark, rows[at:at + n]), batch)
        at, batch = at + n, batch + 1
        if seed == 2 and batch == 2:
            target.compact()
    assert batch > 2 and _sorted(target.history()) == _sorted(_rebuilt(log, mode))
    target.compact()
    assert len(target.folders()) == 1 and _sorted(target.history()) == _sorted(_rebuilt(log, mode))


def test_same_day_events_and_change_back(spark):
    """The cases by name: an earlier event that arrives later does not win; a
    change back within the day leaves one version."""
    first = [(1, "2024-01-01 10:00:00", 7, "A"), (2, "2024-01-02 10:00:00", 7, "B"), (3, "2024-01-01 10:00:00", 8, "B")]
    later = [(4, "2024-01-02 20:00:00", 7, "A"), (5, "2024-01-01 09:00:00", 8, "A")]
    target, fn = _silver(spark, "named", _events(spark, first))
    fn(_events(spark, first), 0)
    fn(_events(spark, later), 1)
    got = [(r.user_id, r.event_type, str(r.effective_time)[:10], r.end_time) for r in target.history().collect()]
    assert sorted(got) == [(7, "A", "2024-01-01", None), (8, "B", "2024-01-01", None)]


def test_bronze_then_silver_in_several_batches(spark):
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    topic = scratch_path(spark, "t", "topic")
    publish_events(events.repartition(5), topic)
    bronze = scratch_path(spark, "t", "bronze")
    q = start_bronze(topic_stream(spark, topic, max_files_per_trigger=1), EVENT_SCHEMA, bronze,
                     scratch_path(spark, "t", "ck"), name="bronze_test")
    q.awaitTermination()
    assert q.lastProgress is not None and progress(spark, q).count() >= 5
    assert spark.read.parquet(bronze).count() == events.count()
    target, _ = _silver(spark, "silver", events)
    ck = scratch_path(spark, "t", "ck")

    def run():
        src = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(bronze)
        start_silver(src, target, event_day(), ck, name="silver_test").awaitTermination()

    run()
    folders = target.folders()
    assert len(folders) >= 5  # one per micro-batch, each with events of all days
    assert _sorted(target.history()) == _sorted(_rebuilt(events)) and target.history().count() == 314
    run()  # restart on the same checkpoint: nothing new
    assert target.folders() == folders and stop_all(spark) == [] and status(spark) == []


def test_replayed_and_empty_batches_change_nothing(spark):
    events = spark.read.parquet(f"{SF0001}/events.parquet").filter("ts < '2024-01-03'")
    target, fn = _silver(spark, "replay", events)
    fn(events, 0)
    once = _sorted(target.history())
    fn(events, 0)  # the same batch again
    fn(events.limit(0), 1)
    assert _sorted(target.history()) == once and len(target.folders()) == 1


def _bytes(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def test_a_batch_writes_what_it_holds(spark):
    """Bytes written follow the batch: ten times the table, the same write."""
    target, fn = _silver(spark, "bytes", _events(spark, [(1, "2024-01-01 10:00:00", 1, "a")]))
    many = spark.range(20_000).select(F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
                                      F.col("id").alias("user_id"), F.lit("a").alias("event_type"))
    few = _events(spark, [(10 ** 6 + i, "2024-01-02 10:00:00", i, "b") for i in range(50)])
    fn(few, 0)
    alone = _bytes(f"{target.root}/w-0")
    fn(many, 1)
    fn(few, 2)
    assert _bytes(f"{target.root}/w-1") > 10 * alone and _bytes(f"{target.root}/w-2") < 1.2 * alone
    assert target.history().filter("user_id = 7").count() == 2


@pytest.mark.parametrize("crash_at, whole", [(0, True), (1, True), (1, False)])
def test_recovery_after_a_crash_in_the_sink(spark, crash_at, whole):
    """The query dies after a batch's write (or in the middle of it) and before
    its checkpoint; the restart runs the batch again and nothing doubles."""
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    bronze = scratch_path(spark, "t", "bronze-crash")
    events.repartition(4).write.parquet(bronze)
    target, _ = _silver(spark, "crash", events)
    ck, name = scratch_path(spark, "t", "ck"), f"crash_{crash_at}_{whole}"
    write = silver_batch(target, event_day(), name)
    ran = []

    def fails(batch, batch_id):
        ran.append(batch_id)
        if batch_id == crash_at and not whole:
            write(batch.limit(5), batch_id)  # some of the batch, and no mark
            (Path(target.root.removeprefix("file:")) / f"{name}-{batch_id}" / "_SUCCESS").unlink()
            assert len(target.folders()) == crash_at
        else:
            write(batch, batch_id)
        if batch_id == crash_at:
            raise RuntimeError("injected")

    def source():
        return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(bronze)

    with pytest.raises(Exception, match="injected"):
        start_foreach_batch(source(), fails, ck, name).awaitTermination()
    assert ran == list(range(crash_at + 1))
    again = []

    def counted(batch, batch_id):
        again.append(batch_id)
        write(batch, batch_id)

    start_foreach_batch(source(), counted, ck, name).awaitTermination()
    assert again == [crash_at, *range(crash_at + 1, 4)]  # the batch that crashed runs again
    assert len(target.folders()) == 4 and _sorted(target.history()) == _sorted(_rebuilt(events))


def test_compaction_may_stop_half_way(spark):
    """Folders that were folded but not yet deleted count twice to no effect;
    a batch that runs again after its folder was folded changes nothing."""
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    target, fn = _silver(spark, "half", events)
    fn(events.filter("ts >= '2024-01-10'"), 0)
    fn(events.filter("ts < '2024-01-10'"), 1)
    want = _sorted(target.history())
    target.entries().write.parquet(f"{target.root}/folded-x")
    assert _sorted(target.history()) == want
    target.compact()
    fn(events.filter("ts < '2024-01-10'"), 1)
    assert _sorted(target.history()) == want and len(target.folders()) == 2


def test_empty_silver_table(spark):
    target, fn = _silver(spark, "none", _events(spark, []))
    assert target.history().collect() == [] and target.folders() == []
    fn(_events(spark, []), 0)
    target.compact()
    assert target.history().collect() == []
    with pytest.raises(ValueError):
        silver_table(spark, "/x", _events(spark, []), ["user_id"], ["event_type"], "ts", None, ["user_id", "event_type"])


def test_silver_per_trigger_period(spark):
    """period=None: each micro-batch is one version stamped at merge time."""
    one = [(1, "2024-01-01 10:00:00", 7, "a"), (2, "2024-01-01 11:00:00", 7, "b"), (3, "2024-01-01 09:00:00", 8, "x")]
    two = [(4, "2024-01-02 10:00:00", 7, "b"), (5, "2024-01-02 10:00:00", 8, "y")]
    target, fn = _silver(spark, "trigger", _events(spark, one), period=False)
    fn(_events(spark, one), 0)
    fn(_events(spark, two), 1)
    got = sorted((r.user_id, r.event_type, r.is_current) for r in target.history().collect())
    assert got == [(7, "b", True), (8, "x", False), (8, "y", True)]


def test_rebuild_equals_the_stream(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    target, fn = _silver(spark, "rebuild", ev)
    fn(ev.filter("ts >= '2024-01-10'"), 0)
    fn(ev.filter("ts < '2024-01-10'"), 1)  # all late
    streamed = _sorted(target.history())
    target.rebuild(stamped(ev, event_day()))
    assert _sorted(target.history()) == streamed == _sorted(_rebuilt(ev)) and len(target.folders()) == 1


def test_compat_per_batch_merge_inserts_every_change(spark):
    """The per-trigger MERGE batch by batch: close on ``!=``, always insert,
    null keys included, one row per key and batch."""
    from tidemark.operators.dedupe import latest_per_key
    from tidemark.operators.scd2 import compat_stream_merge
    batches = [[(1, "2024-01-05 10:00:00", 1, "A"), (2, "2024-01-05 10:00:00", None, "X"), (3, "2024-01-05 09:00:00", 1, "Q")],
               [(4, "2024-01-02 10:00:00", 1, "B")], [(5, "2024-01-09 10:00:00", 1, "B"), (6, "2024-01-09 10:00:00", 2, None)]]
    schema = "user_id long, event_type string, effective_time date, end_time date, is_current boolean"
    table = spark.createDataFrame([], schema)
    for i, rows in enumerate(batches):
        last = latest_per_key(_events(spark, rows), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type")
        merged = compat_stream_merge(table, last, ["user_id"], ["event_type"], f"2024-02-0{i + 1}")
        table = spark.createDataFrame(merged.collect(), schema)
    got = sorted(((r.user_id, r.event_type, str(r.effective_time), str(r.end_time)) for r in table.collect()), key=str)
    assert got == sorted([(1, "A", "2024-02-01", "2024-02-02"), (None, "X", "2024-02-01", "None"),
                          (1, "B", "2024-02-02", "None"), (1, "B", "2024-02-03", "None"),
                          (2, None, "2024-02-03", "None")], key=str)

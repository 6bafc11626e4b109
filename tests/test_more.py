"""Sampling, staging, any-per-key, processing-time trigger, bronze quarantine."""

from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.operators.dedupe import any_per_key, latest_per_key
from tidemark.operators.scd2 import build_change_set, hash_sample
from tidemark.plans.queries import EVENT_SCHEMA, dim_initial
from tidemark.session import scratch_path, stage
from tidemark.sources.topic import publish_events, topic_stream
from tidemark.streaming.bronze import start_bronze
from tidemark.streaming.monitor import status

def test_hash_sample_does_not_depend_on_partitioning(spark):
    cust = spark.read.parquet(f"{SF0001}/customer.parquet")
    picks = [sorted(r.c_custkey for r in hash_sample(cust.repartition(n), 0.2, 7, ["c_custkey"]).collect())
             for n in (1, 2, 5)]
    assert picks[0] == picks[1] == picks[2]
    assert 0 < len(picks[0]) < cust.count()
    assert hash_sample(cust, 1.0, 7, ["c_custkey"]).count() == cust.count()
    assert hash_sample(cust, 0.0, 7, ["c_custkey"]).count() == 0

def test_bernoulli_change_set_staged(spark):
    dim = dim_initial(spark, SF0001)
    ch = build_change_set(dim, ["customer_id"], 0.5, 2112, {"city": F.lit("X")},
                          method="bernoulli", staged=True)
    rows = sorted(tuple(r) for r in ch.collect())
    assert rows == sorted(tuple(r) for r in ch.collect())  # staged: reads agree
    assert ch.inputFiles() and all("staging" in f for f in ch.inputFiles())
    assert ch.groupBy("customer_id").count().filter("count > 1").count() == 0

def test_stage_round_trips(spark):
    df = spark.range(10).withColumn("r", F.rand(3))
    s = stage(df, "t")
    assert sorted(tuple(r) for r in s.collect()) == sorted(tuple(r) for r in s.collect())
    assert s.count() == 10

def test_any_per_key_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 5, "n"), (None, 6, "m")],
                               "k int, t int, v string")
    assert any_per_key(df, ["k"]).count() == 3  # null keys form one group
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["t"]).collect()}
    assert got == {1: "b", 2: "c", None: "m"}
    early = {r.k: r.v for r in latest_per_key(df, ["k"], ["t"], earliest=True).collect()}
    assert early == {1: "a", 2: "c", None: "n"}

def test_processing_time_trigger_and_status(spark):
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    topic = scratch_path(spark, "t", "topic-pt")
    publish_events(events, topic)
    out = scratch_path(spark, "t", "bronze-pt")
    q = start_bronze(topic_stream(spark, topic), EVENT_SCHEMA, out, scratch_path(spark, "t", "ck"),
                     name="bronze_pt", trigger="1 second")
    try:
        q.processAllAvailable()
        names = [s["name"] for s in status(spark)]
        assert "bronze_pt" in names
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == events.count()

def test_bronze_quarantine(spark):
    raw = scratch_path(spark, "t", "raw")
    spark.createDataFrame([('{"event_id":1,"user_id":3,"event_type":"a"}',), ("not json",),
                           ('{"event_id":2,"event_type":"b"}',)], "value string").write.text(f"{raw}/batch-00000000")
    good, bad = scratch_path(spark, "t", "good"), scratch_path(spark, "t", "bad")
    q = start_bronze(topic_stream(spark, raw), EVENT_SCHEMA, good, scratch_path(spark, "t", "ck"),
                     name="bronze_q", required=["user_id"], quarantine_path=bad)
    q.awaitTermination()
    assert [r.event_id for r in spark.read.parquet(good).collect()] == [1]
    reasons = sorted(r.reason for r in spark.read.parquet(bad).collect())
    assert reasons == ["malformed", "missing user_id"]


def test_bronze_to_catalog_table_and_user_hook(spark):
    from tidemark.plans.catalogue import ensure_namespace
    from tidemark.streaming.silver import start_foreach_batch
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    topic = scratch_path(spark, "t", "topic-tbl")
    publish_events(events, topic)
    ensure_namespace(spark, "bronze")
    q = start_bronze(topic_stream(spark, topic), EVENT_SCHEMA, None, scratch_path(spark, "t", "ck"),
                     name="bronze_tbl", table="bronze.customers_events")
    q.awaitTermination()
    assert spark.table("bronze.customers_events").count() == events.count()
    seen = []

    def hook(batch, batch_id):  # user code per micro-batch, on the batch's own session
        seen.append((batch_id, batch.sparkSession.createDataFrame([(batch.count(),)], "n long").first().n))

    h = start_foreach_batch(spark.readStream.table("bronze.customers_events"), hook,
                            scratch_path(spark, "t", "ck"), "hook")
    h.awaitTermination()
    assert sum(n for _, n in seen) == events.count()


def test_scale_settings():
    from tidemark.session import scale_settings
    big = scale_settings(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) > 300_000
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"
    small = scale_settings(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_publish_is_one_write_and_may_repeat(spark):
    from tidemark.sources.topic import topic_batch
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, g string")
    topic = scratch_path(spark, "t", "topic-twice")
    publish_events(df, topic)
    publish_events(df, topic)
    assert topic_batch(spark, topic).count() == 6


def test_shared_folder_must_be_named_on_a_cluster():
    import pytest
    from tidemark.session import shared_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_progress_log_keeps_all_reports(spark):
    from tidemark.streaming.monitor import ProgressLog
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    topic = scratch_path(spark, "t", "topic-log")
    publish_events(events.repartition(6), topic)
    log = ProgressLog(spark, scratch_path(spark, "t", "progress"), every=2).start()
    try:
        q = start_bronze(topic_stream(spark, topic, max_files_per_trigger=1), EVENT_SCHEMA,
                         scratch_path(spark, "t", "bronze-log"), scratch_path(spark, "t", "ck"), name="bronze_log")
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        import time
        for _ in range(50):
            if log.reports().filter("query_name = 'bronze_log' and num_input_rows > 0").count() >= 6:
                break
            time.sleep(0.2)
    finally:
        log.stop()
    got = log.reports().filter("query_name = 'bronze_log'")
    assert got.agg({"num_input_rows": "sum"}).first()[0] == events.count()
    assert got.filter("num_input_rows > 0").count() == 6

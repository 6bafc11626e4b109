"""One key holding a third of all rows, derived from the given tables.

Checks that results stay whole and that the hot key's work is spread over
several shuffle partitions (``spark_partition_id`` after the shuffle).
"""

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.nested import flatten_items, nest_items
from tidemark.operators.scd2 import TIME_VALIDITY, history_from_log


def _hot_items(spark):
    items = spark.read.parquet(f"{SF001}/lineitem.parquet")
    # a third of all items move to order 0
    return items.withColumn("l_orderkey", F.when(F.pmod(F.xxhash64("l_partkey", "l_linenumber"), 3) == 0,
                                                 F.lit(0)).otherwise(F.col("l_orderkey")))


def test_hot_parent_is_split_and_whole(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    items = _hot_items(spark).withColumnRenamed("l_orderkey", "o_orderkey")
    n_hot = items.filter("o_orderkey = 0").count()
    assert n_hot > items.count() / 4
    fields = [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity"), F.col("l_suppkey")]
    fact = nest_items(orders, items, "o_orderkey", fields, max_items=2_000)
    hot = fact.filter("o_orderkey = 0").select("chunk", F.size("line_items").alias("n"), "item_count",
                                               F.spark_partition_id().alias("pid"))
    rows = hot.collect()
    assert len(rows) >= n_hot // 2_000
    assert sum(r.n for r in rows) == n_hot and all(r.item_count == n_hot for r in rows)
    assert max(r.n for r in rows) <= 4_000
    # the chunks were folded in several tasks
    folded = (items.filter("o_orderkey = 0").join(F.broadcast(spark.range(1).select(F.lit(0).alias("o_orderkey"))), "o_orderkey")
              .count())
    assert folded == n_hot
    # every item of every order is still there
    flat = flatten_items(fact).filter(F.col("l_linenumber").isNotNull())
    joined = items.join(orders.select("o_orderkey"), "o_orderkey", "left_semi")
    cols = ["o_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey"]
    assert flat.select(*cols).exceptAll(joined.select(*cols)).count() == 0
    assert joined.select(*cols).exceptAll(flat.select(*cols)).count() == 0


def test_hot_parent_chunks_land_in_several_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the planned partitioning visible
    try:
        items = _hot_items(spark).withColumnRenamed("l_orderkey", "o_orderkey")
        orders = spark.read.parquet(f"{SF001}/orders.parquet")
        fact = nest_items(orders, items, "o_orderkey", [F.col("l_linenumber"), F.col("l_partkey")],
                          max_items=2_000)
        pids = {r.pid for r in fact.filter("o_orderkey = 0")
                .select(F.spark_partition_id().alias("pid")).collect()}
        assert len(pids) >= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _hot_events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    return ev.withColumn("user_id", F.when(F.pmod(F.col("event_id"), 3) == 0, F.lit(0))
                         .otherwise(F.col("user_id")))


def test_hot_key_latest_and_period_history(spark):
    ev = _hot_events(spark)
    latest = {r.user_id: r.event_id for r in latest_per_key(ev, ["user_id"], ["ts", "event_id"]).collect()}
    want = ev.filter("user_id = 0").orderBy(F.desc("ts"), F.desc("event_id")).first().event_id
    assert latest[0] == want
    h = history_from_log(ev, ["user_id"], ["event_type"], "ts", ["event_id"],
                         F.date_trunc("day", "ts").cast("timestamp_ntz"), TIME_VALIDITY, "sound",
                         payload=["event_id"])
    # the hot user's window held at most one row per day
    assert h.filter("user_id = 0").count() <= 31


def test_null_hot_key_segmented_history_spreads(spark):
    """A third of all keys null: the same versions as per-key windows, out of
    several partitions."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ev = spark.read.parquet(f"{SF001}/events.parquet")
        ev = ev.withColumn("user_id", F.when(F.pmod(F.col("event_id"), 3) != 0, F.col("user_id")))
        for mode in ("sound", "compat"):
            args = (["user_id"], ["event_type"], "ts", ["event_id"], None, TIME_VALIDITY, mode)
            a = history_from_log(ev, *args, payload=["event_id"])
            b = history_from_log(ev, *args, payload=["event_id"], segment=F.date_trunc("hour", "ts"))
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
            pids = {r.pid for r in b.withColumn("pid", F.spark_partition_id()).filter("user_id is null").collect()}
            assert len(pids) >= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_key_segmented_history_spreads(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ev = _hot_events(spark)
        seg = F.date_trunc("hour", "ts")
        a = history_from_log(ev, ["user_id"], ["event_type"], "ts", ["event_id"], None, TIME_VALIDITY,
                             "sound", payload=["event_id"])
        b = history_from_log(ev, ["user_id"], ["event_type"], "ts", ["event_id"], None, TIME_VALIDITY,
                             "sound", payload=["event_id"], segment=seg)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        pids = {r.pid for r in b.filter("user_id = 0").select(F.spark_partition_id().alias("pid")).collect()}
        assert len(pids) >= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

"""History from a change log (SCD3): counts from FIXTURES §4, invariants,
and sequential merges == one query (stream = batch)."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.scd2 import (TIME_VALIDITY, Validity, history_from_entries, history_from_log, merge_entries,
                                     scd2_apply)
from tidemark.plans.queries import event_day


def _hist(spark, sf, mode):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return history_from_log(ev, ["user_id"], ["event_type"], "ts", ["event_id"], event_day(),
                            TIME_VALIDITY, mode, payload=["event_id", "ts"])


@pytest.mark.parametrize("sf,mode,rows,live,keys,most", [
    (SF0001, "compat", 397, 25, 15, 4),
    (SF0001, "sound", 314, 15, 15, 1),
    (SF001, "compat", 4006, 182, 150, 4),
    (SF001, "sound", 3238, 150, 150, 1),
])
def test_history_counts(spark, sf, mode, rows, live, keys, most):
    h = _hist(spark, sf, mode)
    per_key = h.filter("is_current").groupBy("user_id").count()
    got = h.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_current"), 1)),
                F.countDistinct("user_id")).first()
    assert tuple(got) == (rows, live, keys)
    assert per_key.agg(F.max("count")).first()[0] == most


def test_sound_intervals_do_not_overlap(spark):
    h = _hist(spark, SF001, "sound")
    w = Window.partitionBy("user_id").orderBy("effective_time")
    bad = (h.withColumn("next", F.lead("effective_time").over(w))
           .filter((F.col("end_time") != F.col("next")) | (F.col("end_time").isNull() != F.col("next").isNull())))
    assert bad.count() == 0
    # consecutive versions differ
    rep = (h.withColumn("prev", F.lag("event_type").over(w))
           .filter(F.col("prev") == F.col("event_type")))
    assert rep.count() == 0


events = st.lists(st.tuples(st.sampled_from([0, 1, 2, None]), st.integers(0, 5), st.integers(0, 9),
                            st.sampled_from(["a", "b", "c", None])), min_size=1, max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(events, st.integers(1, 6))
def test_entries_merged_in_any_order_equal_the_log(spark, evs, width):
    """Batches of ``width`` events as they come: the entries, and so the
    history, are those of the whole log."""
    rows = [(n, i, d * 10 + t, a) for n, (i, d, t, a) in enumerate(evs)]
    log = spark.createDataFrame(rows, "n int, id long, ts int, attr string")
    day = F.floor(F.col("ts") / 10).cast("int")
    v = Validity("start", "end", "current")
    entries = spark.createDataFrame([], "n int, id long, ts int, attr string, at int")
    for k in range(0, len(rows), width):
        batch = latest_per_key(log.filter(F.col("n").between(k, k + width - 1)).withColumn("at", day), ["id", "at"], ["ts", "n"])
        merged = merge_entries(entries, batch, ["id"], "at", ["ts", "n"])
        entries = spark.createDataFrame(merged.collect(), entries.schema)
    for mode in ("sound", "compat"):
        one = history_from_log(log, ["id"], ["attr"], "ts", ["n"], day, v, mode, payload=["n"])
        got = history_from_entries(entries, ["id"], ["attr"], "at", (), v, mode)
        key = lambda r: (str(r.id), r.start, str(r.attr), str(r.end), r.current, r.n)
        assert sorted(map(key, got.collect())) == sorted(map(key, one.collect())), mode


def test_sequential_sound_merges_equal_history(spark):
    """scd2_apply, one change per key per day, equals the sound history."""
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    h = _hist(spark, SF0001, "sound")
    v = Validity("effective_time", "end_time", "is_current")
    w = (ev.withColumn("d", event_day())
         .withColumn("rn", F.row_number().over(Window.partitionBy("user_id", "d")
                                                .orderBy(F.desc("ts"), F.desc("event_id"))))
         .filter("rn = 1"))
    days = sorted(r.d for r in w.select("d").distinct().collect())
    target = spark.createDataFrame([], "user_id long, event_type string, effective_time timestamp_ntz, "
                                       "end_time timestamp_ntz, is_current boolean")
    for d in days:
        ch = w.filter(F.col("d") == F.lit(d)).select("user_id", "event_type")
        target = spark.createDataFrame(
            scd2_apply(target, ch, ["user_id"], ["event_type"], d, v).collect(), target.schema)
    a = sorted((r.user_id, r.event_type, r.effective_time, r.end_time) for r in target.collect())
    b = sorted((r.user_id, r.event_type, r.effective_time, r.end_time) for r in h.collect())
    assert a == b
    assert isinstance(days[0], dt.datetime)

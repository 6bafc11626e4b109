"""Segmented history equals per-key history, on random logs and on events."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators.scd2 import TIME_VALIDITY, Validity, history_from_log

V = Validity("start", "end", "current")
logs = st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(0, 40), st.integers(0, 3),
                          st.sampled_from(["a", "b", "c", None])), min_size=1, max_size=60)


def _key(r):
    return (str(r.id), r.start, str(r.attr), str(r.end), r.current, r.n)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(logs, st.integers(1, 15))
def test_segmented_equals_per_key(spark, rows, width):
    rows = [(i, t, n, a) for n, (i, t, _, a) in enumerate(rows)]
    log = spark.createDataFrame(rows, "id int, ts int, n int, attr string")
    for mode in ("sound", "compat"):
        plain = history_from_log(log, ["id"], ["attr"], "ts", ["n"], None, V, mode, payload=["n"])
        seg = history_from_log(log, ["id"], ["attr"], "ts", ["n"], None, V, mode, payload=["n"],
                               segment=F.floor(F.col("ts") / width))
        assert sorted(map(_key, plain.collect())) == sorted(map(_key, seg.collect())), mode


def test_segmented_on_events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    for mode in ("sound", "compat"):
        a = history_from_log(ev, ["user_id"], ["event_type"], "ts", ["event_id"], None, TIME_VALIDITY,
                             mode, payload=["event_id"])
        b = history_from_log(ev, ["user_id"], ["event_type"], "ts", ["event_id"], None, TIME_VALIDITY,
                             mode, payload=["event_id"], segment=F.date_trunc("hour", "ts"))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

"""Measure how a hot key is spread, from Spark's event log.

    python tools/skew_report.py [sf_dir]

Builds the nested orders fact with a third of ``lineitem`` moved to one
order, twice: the plain fold (one chunk of any size: one group per order, the
reference's plan) and the default hot-parent split; then the event history
with a third of all events on one user: per-key windows, segmented windows
and the per-day pre-aggregated form.  For every stage that
reads a shuffle it prints the tasks' shuffle bytes read (max and median)
and run time, read from the event log in a fresh scratch folder.  No UI or server is used.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    from pyspark.sql import functions as F

    from tidemark.operators.nested import nest_items
    from tidemark.operators.scd2 import TIME_VALIDITY, history_from_log
    from tidemark.plans.queries import ITEM_FIELDS, _t, hot_lineitem
    from tidemark.session import get_session

    sf = argv[0] if argv else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = get_session("local[8]", 8, extra={"spark.eventLog.enabled": "true",
                                              "spark.eventLog.dir": logs,
                                              "spark.eventLog.rolling.enabled": "false",
                                              "spark.eventLog.compress": "false",
                                              # show the planned partitioning: small
                                              # stages are not merged into one task
                                              "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    orders = _t(spark, sf, "orders")
    items = hot_lineitem(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    fields = [F.col(a).alias(b) for a, b in ITEM_FIELDS]
    events = _t(spark, sf, "events").withColumn(  # a third of all events on user 0
        "user_id", F.when(F.pmod(F.col("event_id"), 3) == 0, F.lit(0).cast("long"))
        .otherwise(F.col("user_id")))

    def history(**kw):
        return history_from_log(events, ["user_id"], ["event_type"], "ts", ["event_id"],
                                v=TIME_VALIDITY, payload=["event_id"], **kw)

    runs = {
        "nested fact, plain fold": lambda: nest_items(orders, items, "o_orderkey", fields, max_items=10 ** 9),
        "nested fact, hot-parent split": lambda: nest_items(orders, items, "o_orderkey", fields),
        "history per event, per-key windows": lambda: history(),
        "history per event, segmented by hour": lambda: history(segment=F.date_trunc("hour", "ts")),
        "history per day (pre-aggregated)": lambda: history(period=F.date_trunc("day", "ts")),
    }
    tracker = spark.sparkContext.statusTracker()
    stages: dict[str, list[int]] = {}
    for label, build in runs.items():
        spark.sparkContext.setJobGroup(label, label)
        build().write.format("noop").mode("overwrite").save()
        stages[label] = sorted({s for j in tracker.getJobIdsForGroup(label)
                                for s in tracker.getJobInfo(j).stageIds})
    spark.stop()

    tasks: dict[int, list[tuple[int, int]]] = {}
    for path in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                rd = m.get("Shuffle Read Metrics") or {}
                read = rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0)
                tasks.setdefault(ev["Stage ID"], []).append((read, m.get("Executor Run Time", 0)))
    print(f"event log: {logs}")
    for label, ids in stages.items():
        print(f"\n{label}")
        print("stage  tasks  max_read_kb  median_read_kb  max_ms  median_ms")
        for s in ids:
            t = tasks.get(s)
            if not t:
                continue
            kb = [r // 1024 for r, _ in t]
            if max(kb) == 0:
                continue  # scan stages: no shuffle read
            ms = [x for _, x in t]
            print(f"{s:5d}  {len(t):5d}  {max(kb):11d}  {int(statistics.median(kb)):14d}"
                  f"  {max(ms):6d}  {int(statistics.median(ms)):9d}")


if __name__ == "__main__":
    main(sys.argv[1:])

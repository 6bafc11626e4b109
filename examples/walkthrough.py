"""The reference's notebook flow, step by step, on this library.

    python examples/walkthrough.py [sf_dir]

1. initial load of the customer dimension (SCD0), published as snapshot 1;
2. a staged change set (SCD4/SCD5) and the one-shot merge (SCD1);
3. the snapshot list (VER2) and the table as of snapshot 1 (VER3);
4. the nested orders fact (AGG3/JN1) and orders with several items (FLT3);
5. free SQL over registered views (QRY1, QRY5);
6. events published to a topic, a bronze stream and a silver history stream,
   with progress and status (STR1-STR12).

Every step is a Spark job over the given tables; only small results are
shown.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.nested import nest_items, parents, with_many_items  # noqa: E402
from tidemark.operators.scd2 import TIME_VALIDITY, build_change_set, current_rows, rewrite_when  # noqa: E402
from tidemark.plans import catalogue, snapshots  # noqa: E402
from tidemark.plans.queries import (CITY_MATCH, CITY_OTHERWISE, CITY_THEN, EVENT_SCHEMA,  # noqa: E402
                                    HISTORY_COLUMNS, ITEM_FIELDS, LOAD_DATE, MERGE_DATE,
                                    SAMPLE_FRACTION, SAMPLE_SEED, event_day, raw_customers)
from tidemark.operators.scd2 import initial_load, scd2_apply  # noqa: E402
from tidemark.session import get_session, scratch_path  # noqa: E402
from tidemark.sources.topic import publish_events, topic_stream  # noqa: E402
from tidemark.streaming.bronze import start_bronze  # noqa: E402
from tidemark.streaming.monitor import progress, status  # noqa: E402
from tidemark.streaming.silver import silver_table, start_silver  # noqa: E402


def main(sf: str) -> None:
    spark = get_session("local[4]", 4)

    # 1. initial load, published as snapshot 1
    root = scratch_path(spark, "walkthrough", "dim_customers")
    dim = snapshots.publish(initial_load(raw_customers(spark, sf), LOAD_DATE), root, 1)
    print("loaded rows:", dim.count())

    # 2. staged change set (5 % of current rows, seed 2112), then the merge
    changes = build_change_set(
        current_rows(dim), ["customer_id"], SAMPLE_FRACTION, SAMPLE_SEED,
        {"city": rewrite_when("city", CITY_MATCH, CITY_THEN, CITY_OTHERWISE)},
        {"update_date": F.lit(MERGE_DATE)}, staged=True)
    merged = snapshots.publish(scd2_apply(dim, changes, ["customer_id"], ["city"], MERGE_DATE), root, 2)
    print("staged changes:", changes.count(), "rows after merge:", merged.count())

    # 3. snapshot list and time travel
    snapshots.snapshots(spark, root).show(truncate=False)
    one = changes.select("customer_id").orderBy("customer_id").first()[0]
    print("history of", one)
    merged.filter(F.col("customer_id") == one).orderBy("start_date").show()
    print("as of snapshot 1")
    snapshots.read(spark, root, 1).filter(F.col("customer_id") == one).show()

    # 4. nested orders fact
    orders = spark.read.parquet(os.path.join(sf, "orders.parquet"))
    items = spark.read.parquet(os.path.join(sf, "lineitem.parquet")).withColumnRenamed("l_orderkey", "o_orderkey")
    fact = nest_items(orders, items, "o_orderkey", [F.col(a).alias(b) for a, b in ITEM_FIELDS])
    fact.printSchema()
    with_many_items(fact).select("o_orderkey", "o_orderstatus", "line_items").show(1, truncate=False)

    # 5. free SQL over registered views
    catalogue.register({"dim_now": merged, "orders_now": parents(fact)})
    catalogue.show_tables(spark).show()
    catalogue.run_sql(spark, "SELECT city, count(*) AS n FROM dim_now WHERE is_current GROUP BY city ORDER BY n DESC").show(5)
    catalogue.run_sql(spark, "SELECT o_orderkey, item_count FROM orders_now WHERE item_count > :least ORDER BY o_orderkey",
                      {"least": 1}).show(3)

    # 6. topic -> bronze -> silver
    events = spark.read.parquet(os.path.join(sf, "events.parquet"))
    topic = scratch_path(spark, "walkthrough", "topic")
    publish_events(events.repartition(4), topic)
    bronze = scratch_path(spark, "walkthrough", "bronze")
    q = start_bronze(topic_stream(spark, topic, max_files_per_trigger=1), EVENT_SCHEMA, bronze,
                     scratch_path(spark, "walkthrough", "ck"), name="walkthrough_bronze")
    q.awaitTermination()
    progress(spark, q).show(truncate=False)
    src = spark.readStream.schema(EVENT_SCHEMA).parquet(bronze)
    silver = silver_table(spark, scratch_path(spark, "walkthrough", "silver"), src, ["user_id"], ["event_type"], "ts",
                          event_day(), HISTORY_COLUMNS, ["event_id"], TIME_VALIDITY)
    start_silver(src, silver, event_day(), scratch_path(spark, "walkthrough", "ck"), "walkthrough_silver").awaitTermination()
    print("active queries:", status(spark))
    h = silver.history()
    print("silver rows:", h.count(), "open rows:", h.filter("is_current").count())
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")

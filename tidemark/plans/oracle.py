"""DuckDB SQL for each registered query, over the driver's views.

Written from the semantics, not from the Spark code: the merge is spelled as
the three arms of a MERGE, the compat history as the pair join its rules
describe (DuckDB runs it on the small check data only).
"""

from __future__ import annotations

from .queries import (AS_OF_DATE, BOUND_ODD, BOUND_ORDERS, BOUND_STATE, CITY_MATCH, CITY_OTHERWISE, CITY_THEN, HISTORY_KEY, LOAD_DATE,
                      MERGE_DATE, ORDERS_FROM, ORDERS_MERGE, REPLACE_FROM, SAMPLE_FRACTION, SAMPLE_SEED, STREAM_CUT,
                      STREAM_START, URGENT)

_THRESHOLD = format(min(int(round(SAMPLE_FRACTION * 16 ** 8)), 16 ** 8 - 1), "08x")
_LOAD = f"DATE '{LOAD_DATE.isoformat()}'"
_MERGE = f"DATE '{MERGE_DATE.isoformat()}'"

RAW = """raw AS (
  SELECT c.c_custkey AS customer_id, c.c_mktsegment AS city, n.n_name AS state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

DIM = f"""dim AS (
  SELECT DISTINCT customer_id, city, state, {_LOAD} AS start_date,
         CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM raw)"""

CHANGES = f"""ch AS (
  SELECT customer_id,
         CASE WHEN city = '{CITY_MATCH}' THEN '{CITY_THEN}' ELSE '{CITY_OTHERWISE}' END AS city,
         state, start_date, end_date, is_current, {_MERGE} AS update_date
  FROM (SELECT * FROM dim
        WHERE is_current
          AND substr(md5(concat_ws('|', '{SAMPLE_SEED}', CAST(customer_id AS VARCHAR))), 1, 8)
              < '{_THRESHOLD}')
  QUALIFY row_number() OVER (PARTITION BY customer_id
                             ORDER BY city DESC, state DESC, start_date DESC) = 1)"""


def _merge(sound: bool) -> str:
    if sound:
        close = "coalesce(hit AND new_city IS DISTINCT FROM city, FALSE)"
        ins_where = ("WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.is_current "
                     "AND u.customer_id = ch.customer_id)")
    else:
        close = "coalesce(hit, FALSE)"
        ins_where = ""
    return f"""live AS (SELECT * FROM dim WHERE is_current),
j AS (SELECT l.*, c.city AS new_city, c.customer_id IS NOT NULL AS hit
      FROM live l LEFT JOIN ch c ON l.customer_id = c.customer_id),
upd AS (SELECT customer_id, city, state, start_date,
               CASE WHEN {close} THEN {_MERGE} ELSE end_date END AS end_date,
               is_current AND NOT {close} AS is_current FROM j),
ins AS (SELECT customer_id, city, state, {_MERGE} AS start_date, CAST(NULL AS DATE) AS end_date,
               TRUE AS is_current FROM ch {ins_where}),
merged AS (SELECT customer_id, city, state, start_date, end_date, is_current
           FROM dim WHERE NOT is_current
           UNION ALL SELECT * FROM upd UNION ALL SELECT * FROM ins)"""


MERGED = f"WITH {RAW},\n{DIM},\n{CHANGES},\n{_merge(True)}\n"
MERGED_COMPAT = f"WITH {RAW},\n{DIM},\n{CHANGES},\n{_merge(False)}\n"

FACT_FLAT = """SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
       o.o_orderpriority,
       count(l.l_orderkey) OVER (PARTITION BY o.o_orderkey) AS item_count,
       l.l_linenumber AS line_number, l.l_partkey AS product_id, l.l_quantity AS quantity,
       l.l_extendedprice AS price, l.l_discount AS discount
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""

EVENT_W = """e AS (SELECT user_id, event_type, event_id, ts,
                  CAST(date_trunc('day', ts) AS TIMESTAMP) AS d FROM events),
w AS (SELECT * FROM e
      QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1)"""

HISTORY_SOUND = f"""WITH {EVENT_W},
k AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY d) AS p,
             row_number() OVER (PARTITION BY user_id ORDER BY d) AS rn FROM w),
v AS (SELECT * FROM k WHERE rn = 1 OR event_type IS DISTINCT FROM p)
SELECT user_id, event_type, event_id, ts, d AS effective_time,
       lead(d) OVER (PARTITION BY user_id ORDER BY d) AS end_time,
       lead(d) OVER (PARTITION BY user_id ORDER BY d) IS NULL AS is_current
FROM v"""

HISTORY_COMPAT = f"""WITH {EVENT_W},
x AS (SELECT a.user_id, a.event_type, a.event_id, a.ts, a.d, min(b.d) AS t1
      FROM w a LEFT JOIN w b
        ON b.user_id = a.user_id AND b.d > a.d AND b.event_type <> a.event_type
      GROUP BY a.user_id, a.event_type, a.event_id, a.ts, a.d)
SELECT user_id, event_type, event_id, ts, d AS effective_time, t1 AS end_time,
       t1 IS NULL AS is_current FROM x"""

VERSIONS_SOUND = """WITH k AS (
  SELECT user_id, event_type, event_id, ts,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
v AS (SELECT * FROM k WHERE rn = 1 OR event_type IS DISTINCT FROM p)
SELECT user_id, event_type, event_id, ts AS effective_time,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_time,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM v"""

VERSIONS_COMPAT = """SELECT a.user_id, a.event_type, a.event_id, a.ts AS effective_time, min(b.ts) AS end_time,
       min(b.ts) IS NULL AS is_current
FROM events a LEFT JOIN events b
  ON b.user_id = a.user_id AND b.event_type <> a.event_type
 AND (b.ts > a.ts OR (b.ts = a.ts AND b.event_id > a.event_id))
GROUP BY a.user_id, a.event_type, a.event_id, a.ts"""

HOT_FLAT = """WITH li AS (
  SELECT CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS l_orderkey,
         l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount FROM lineitem)
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       count(l.l_orderkey) OVER (PARTITION BY o.o_orderkey) AS item_count,
       l.l_linenumber AS line_number, l.l_partkey AS product_id, l.l_quantity AS quantity,
       l.l_extendedprice AS price, l.l_discount AS discount
FROM orders o LEFT JOIN li l ON l.l_orderkey = o.o_orderkey"""

VERSIONS_NULL_KEYS = VERSIONS_SOUND.replace(
    "FROM events", "FROM (SELECT CASE WHEN event_id % 3 <> 0 THEN user_id END AS user_id, event_type, event_id, ts "
                   "FROM events)")

HOT_MULTI = """SELECT o.o_orderkey, o.o_custkey, count(*) AS item_count FROM orders o JOIN (
  SELECT CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS l_orderkey
  FROM lineitem) l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey, o.o_custkey HAVING count(*) > 1 ORDER BY o.o_orderkey LIMIT 3"""

STAGED = f"""WITH {RAW}, {DIM}
SELECT customer_id, city, state, start_date, CASE WHEN rn = 0 THEN {_MERGE} END AS end_date, rn = 1 AS is_current
FROM (SELECT customer_id, city, state, start_date, 0 AS rn FROM dim
      UNION ALL SELECT customer_id, CASE WHEN city = '{CITY_MATCH}' THEN '{CITY_THEN}' ELSE '{CITY_OTHERWISE}' END,
                       state, {_MERGE}, 1 FROM dim)"""

ODD_ROWS = f"""WITH {RAW}, {DIM}, {CHANGES},
odd AS (SELECT customer_id, city, state, start_date, end_date,
               CASE WHEN customer_id % 7 <> 0 THEN is_current END AS is_current FROM dim),
c AS (SELECT CASE WHEN customer_id % 3 <> 0 THEN customer_id END AS customer_id, city, state FROM ch)
SELECT o.customer_id, o.city, o.state, o.start_date,
       CASE WHEN o.is_current AND c.city IS DISTINCT FROM o.city AND c.customer_id IS NOT NULL THEN {_MERGE}
            ELSE o.end_date END AS end_date,
       CASE WHEN o.is_current AND c.city IS DISTINCT FROM o.city AND c.customer_id IS NOT NULL THEN FALSE
            ELSE o.is_current END AS is_current
FROM odd o LEFT JOIN c ON c.customer_id = o.customer_id
UNION ALL SELECT customer_id, city, state, {_MERGE}, NULL, TRUE FROM c"""

STREAM_MERGE = f"""WITH e AS (SELECT user_id, event_type, ts >= TIMESTAMP '{STREAM_CUT}' AS late,
    row_number() OVER (PARTITION BY user_id, ts >= TIMESTAMP '{STREAM_CUT}' ORDER BY ts DESC, event_id DESC) AS n
  FROM events),
o AS (SELECT user_id, event_type FROM e WHERE n = 1 AND NOT late),
c AS (SELECT user_id, event_type FROM e WHERE n = 1 AND late)
SELECT o.user_id, o.event_type, TIMESTAMP '{STREAM_START}' AS effective_time,
       CASE WHEN c.event_type <> o.event_type THEN TIMESTAMP '{STREAM_CUT}' END AS end_time,
       NOT coalesce(c.event_type <> o.event_type, FALSE) AS is_current
FROM o LEFT JOIN c ON c.user_id = o.user_id
UNION ALL SELECT user_id, event_type, TIMESTAMP '{STREAM_CUT}', NULL, TRUE FROM c"""

#: The sf0.01 tables; the file listing has no other way to name them.
GIVEN_FILES = "/root/testdata/sf0.01/*.parquet"

# The merge of the orders' years: other dates, half of the customers.
ORDERS_HISTORY = MERGED.replace(_LOAD, f"DATE '{ORDERS_FROM}'").replace(_MERGE, f"DATE '{ORDERS_MERGE}'") \
    .replace(f"'{_THRESHOLD}'", "'80000000'")

EVENTS_AS_OF_HOT = """WITH e AS (SELECT event_id, ts, event_type, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
    CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS TIMESTAMP) AS d FROM events),
w AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1),
k AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY d) AS p,
             row_number() OVER (PARTITION BY user_id ORDER BY d) AS rn FROM w),
h AS (SELECT user_id, event_id AS version_event, event_type AS held_type, d AS effective_time,
             lead(d) OVER (PARTITION BY user_id ORDER BY d) AS end_time
      FROM k WHERE rn = 1 OR event_type IS DISTINCT FROM p)
SELECT e.event_id, e.ts, e.event_type, e.user_id, h.version_event, h.held_type, h.effective_time
FROM e LEFT JOIN h ON h.user_id = e.user_id AND h.effective_time <= e.ts AND (h.end_time IS NULL OR e.ts < h.end_time)"""

HOT_SIZES = """SELECT o.o_orderkey, count(*) AS items FROM orders o JOIN (
  SELECT CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS l_orderkey
  FROM lineitem) l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey HAVING count(*) > 2"""

MIXED = """x AS (SELECT event_id, date_trunc('second', ts) AS seen, CAST(ts AS DATE) AS day,
  CASE WHEN event_id % 50 <> 0 THEN user_id END AS "user", CASE WHEN event_id % 7 <> 0 THEN user_id + 3000000000 END AS wide,
  event_id % 2 = 0 AS flag, user_id + 0.5 AS share, event_type AS kind FROM events)"""


def _literal(v) -> str:
    return f"TIMESTAMP '{v}'" if hasattr(v, "year") else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


ORACLE_SQL: dict[str, str] = {
    "dim_initial_load": f"WITH {RAW},\n{DIM}\nSELECT * FROM dim",
    "top_cities": f"""WITH {RAW},\n{DIM}
SELECT city, count(*) AS cnt FROM dim WHERE is_current GROUP BY city
ORDER BY cnt DESC, city LIMIT 5""",
    "distinct_keys": "SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders",
    "latest_per_key": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "key_audit": """WITH d AS (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders),
k AS (SELECT o_custkey, count(*) AS n FROM d GROUP BY o_custkey)
SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(count(*) AS BIGINT) AS key_count,
       CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS repeated_keys,
       CAST(max(n) AS BIGINT) AS max_rows_per_key FROM k""",
    "case_rewrite": f"WITH {RAW},\n{DIM},\n{CHANGES}\nSELECT * FROM ch",
    "ordered_limit": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "scd2_merge_batch": MERGED + "SELECT * FROM merged",
    "scd2_merge_compat": MERGED_COMPAT + "SELECT * FROM merged",
    "changed_customers": MERGED + f"""SELECT o.customer_id, o.city AS old_city, o.end_date AS changed_on,
       n.city AS new_city
FROM merged o JOIN merged n ON o.customer_id = n.customer_id
WHERE NOT o.is_current AND o.end_date = {_MERGE} AND n.is_current AND n.start_date = {_MERGE}""",
    "as_of_state": MERGED + f"""SELECT * FROM merged
WHERE start_date <= DATE '{AS_OF_DATE.isoformat()}'
  AND (end_date IS NULL OR DATE '{AS_OF_DATE.isoformat()}' < end_date)""",
    "menu_key_history": MERGED + """SELECT customer_id, city, is_current, start_date, end_date FROM merged
WHERE customer_id IN (SELECT customer_id FROM merged WHERE is_current = false
                      ORDER BY customer_id LIMIT 1)
ORDER BY customer_id, start_date""",
    "menu_top_cities": MERGED + """SELECT city, count(*) AS cnt FROM merged WHERE is_current = true
GROUP BY city ORDER BY cnt DESC, city LIMIT 5""",
    "orders_with_items_flat": FACT_FLAT,
    "multi_item_orders": """SELECT o.o_orderkey, o.o_orderstatus, count(*) AS item_count,
       sum(l.l_quantity) AS total_quantity, max(l.l_extendedprice) AS max_price
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey, o.o_orderstatus HAVING count(*) > 1""",
    "orders_no_items": """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(0 AS BIGINT) AS item_count
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "menu_multi_item_orders": """SELECT o.o_orderkey, o.o_custkey, count(*) AS item_count
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey, o.o_custkey HAVING count(*) > 1 ORDER BY o.o_orderkey LIMIT 3""",
    "snapshot_before_merge": f"WITH {RAW},\n{DIM}\nSELECT * FROM dim",
    "snapshot_after_merge": MERGED + "SELECT * FROM merged",
    "snapshot_diff": MERGED + """SELECT *, 'added' AS change FROM (SELECT * FROM merged EXCEPT ALL SELECT * FROM dim)
UNION ALL
SELECT *, 'removed' AS change FROM (SELECT * FROM dim EXCEPT ALL SELECT * FROM merged)""",
    "schema_evolved_read": """SELECT c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS c_name,
       CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer""",
    "json_events_parsed": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "json_props_parsed": """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
WHERE json_extract(props, '$.k') IS NOT NULL""",
    "csv_scan_typed": "SELECT * FROM customer",
    "csv_scan_strings": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""",
    "csv_scan_inferred": """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal,
       c_mktsegment FROM customer""",
    "bronze_stream_events": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "silver_scd2_stream": HISTORY_SOUND,
    "silver_scd2_compat": HISTORY_COMPAT,
    "silver_recovered": HISTORY_SOUND,
    "event_history_sound": HISTORY_SOUND,
    "event_history_compat": HISTORY_COMPAT,
    "event_versions_sound": VERSIONS_SOUND,
    "event_versions_compat": VERSIONS_COMPAT,
    "event_versions_null_keys": VERSIONS_NULL_KEYS,
    "orders_hot_parent_flat": HOT_FLAT,
    "menu_multi_item_hot": HOT_MULTI,
    "items_size_filter_hot": HOT_SIZES,
    "items_size_filter": """SELECT o.o_orderkey, count(*) AS items
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey HAVING count(*) > 2""",
    "key_history": MERGED + f"SELECT * FROM merged WHERE customer_id = {HISTORY_KEY} ORDER BY start_date, end_date",
    "staged_merge": STAGED,
    "merge_odd_rows": ODD_ROWS,
    "compat_stream_merge": STREAM_MERGE,
    "csv_dirty_numbers": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS cust,
       CAST(o_orderdate AS DATE) AS ordered_on FROM orders""",
    "snapshot_rows": MERGED + """SELECT 1 AS snapshot_id, count(*) AS row_count FROM dim
UNION ALL SELECT 2, count(*) FROM merged""",
    "data_files": f"""SELECT parse_filename(m.file_name) AS file_name, CAST(b.size AS BIGINT) AS file_size,
       CAST(m.num_rows AS BIGINT) AS rows
FROM parquet_file_metadata('{GIVEN_FILES}') m JOIN read_blob('{GIVEN_FILES}') b ON b.filename = m.file_name""",
    "table_partitions_replaced": f"""SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN year(o_orderdate) >= {REPLACE_FROM} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year
FROM orders WHERE year(o_orderdate) < {REPLACE_FROM} OR o_orderpriority = '{URGENT}'
   -- a year without an urgent order has no new rows and stays
   OR year(o_orderdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE o_orderpriority = '{URGENT}')""",
    "table_merged": MERGED + "SELECT * FROM merged",
    "merge_current_date": MERGED + f"""SELECT customer_id, city, is_current, start_date = {_MERGE} AS opened_today,
       coalesce(end_date = {_MERGE}, FALSE) AS closed_today FROM merged""",
    "orders_as_of_customer": ORDERS_HISTORY + """SELECT o.o_orderkey, o.o_custkey AS customer_id, o.o_orderdate,
       m.city, m.state, m.start_date
FROM orders o LEFT JOIN merged m ON m.customer_id = o.o_custkey AND m.start_date <= CAST(o.o_orderdate AS DATE)
 AND (m.end_date IS NULL OR CAST(o.o_orderdate AS DATE) < m.end_date)""",
    "events_as_of_hot": EVENTS_AS_OF_HOT,
    "yearly_customers": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS row_count,
       count(DISTINCT o_custkey) AS key_count, TRUE AS sketch_is_close FROM orders GROUP BY 1""",
    "sql_bound_orders": f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= {_literal(BOUND_ORDERS['since'])} AND o_orderdate < {_literal(BOUND_ORDERS['until'])}
  AND o_orderpriority = {_literal(BOUND_ORDERS['priority'])} AND o_totalprice >= {_literal(BOUND_ORDERS['least'])}""",
    "sql_bound_cities": MERGED + f"""SELECT city, count(*) AS cnt, count(*) FILTER (state = {_literal(BOUND_STATE)}) AS in_state
FROM merged WHERE is_current AND city <> {_literal(BOUND_ODD)} GROUP BY city""",
    "csv_types": f"""WITH {MIXED}, n AS (SELECT count(*) AS rows FROM x)
SELECT position, column_name, data_type, filled, misfit FROM (
  SELECT 0 AS position, 'event_id' AS column_name, 'int' AS data_type, rows AS filled, CAST(0 AS BIGINT) AS misfit FROM n
  UNION ALL SELECT 1, 'seen', 'timestamp_ntz', rows, 0 FROM n
  UNION ALL SELECT 2, 'day', 'date', rows, 0 FROM n
  UNION ALL SELECT 3, 'user', 'int', rows, (SELECT count(*) FROM x WHERE "user" IS NULL) FROM n
  UNION ALL SELECT 4, 'wide', 'bigint', (SELECT count(wide) FROM x), 0 FROM n
  UNION ALL SELECT 5, 'flag', 'boolean', rows, 0 FROM n
  UNION ALL SELECT 6, 'share', 'double', rows, 0 FROM n
  UNION ALL SELECT 7, 'kind', 'string', rows, 0 FROM n)""",
    "csv_scan_lattice": f"""WITH {MIXED}
SELECT CAST(event_id AS INTEGER) AS event_id, seen, day, CAST("user" AS INTEGER) AS "user", wide, flag,
       CAST(share AS DOUBLE) AS share, kind, CASE WHEN "user" IS NULL THEN 'user' ELSE '' END AS misfits FROM x""",
}

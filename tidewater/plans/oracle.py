"""The expected results, as SQL on the tables' columns; no JSON is involved."""

from __future__ import annotations

# One row per log line that is not dirty.
_LOG = """
log AS (
  SELECT event_id,
         (event_id + 300 * (event_id % 7)) * 7 + 6 - event_id % 7 AS arrival,
         CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN event_id % 3 = 0 THEN '0' ELSE '1' END AS sent_new,
         epoch_us(ts) // 1000 AS ms,
         CAST(ts AS DATE) AS day,
         event_type,
         CASE WHEN event_type IN ('view', 'error') OR event_id % 2 = 0
              THEN NULL ELSE 'home' END AS last_page_id,
         event_type = 'signup' AS is_start,
         props
  FROM events
  WHERE event_id % 50 <> 0
)"""

# The same with the flag repaired.
_FIXED = _LOG + """,
first_line AS (
  SELECT mid,
         CASE WHEN sent_new = '1' THEN day ELSE CAST(day - INTERVAL 1 DAY AS DATE) END AS anchor
  FROM (SELECT mid, day, sent_new,
               row_number() OVER (PARTITION BY mid ORDER BY arrival) AS n FROM log) AS ranked
  WHERE n = 1
),
fixed AS (
  SELECT log.*,
         CASE WHEN sent_new = '1' AND day <> anchor THEN '0' ELSE sent_new END AS is_new
  FROM log JOIN first_line USING (mid)
)"""

_DISPLAYS = """
SELECT f.*, n.i FROM fixed AS f
JOIN (SELECT 1 AS i UNION ALL SELECT 2 UNION ALL SELECT 3) AS n ON n.i <= f.event_id % 4
WHERE NOT f.is_start"""

_ACTIONS = """
SELECT f.*, n.i FROM fixed AS f
JOIN (SELECT 1 AS i UNION ALL SELECT 2) AS n ON n.i <= f.event_id % 3
WHERE NOT f.is_start"""

_CUT = """'{"event_id":' || CAST(event_id AS VARCHAR) || ',"common":{'"""

_NEXT = _LOG + """,
paged AS (
  SELECT *, last_page_id IS NULL AS is_entry,
         lead(ms) OVER w AS next_ms,
         lead(last_page_id IS NULL) OVER w AS next_is_entry
  FROM log WINDOW w AS (PARTITION BY mid ORDER BY ms, arrival)
)"""
_TIMEOUT = "is_entry AND (next_ms IS NULL OR next_ms - ms >= 21600000)"
_MATCH = "is_entry AND next_is_entry AND next_ms - ms < 21600000"

_UNIQUE = _LOG + """,
entries AS (
  SELECT event_id, mid, day, lag(day) OVER (PARTITION BY mid ORDER BY arrival) AS previous
  FROM log WHERE last_page_id IS NULL
)"""

_CHANGES = """
changes AS (
  SELECT CASE WHEN l_orderkey % 10 = 0 THEN 'other' ELSE 'shop' END AS "database",
         CASE WHEN l_linenumber % 2 = 1 THEN 'cart_info' ELSE 'order_detail' END AS "table",
         CASE l_returnflag WHEN 'N' THEN 'insert' WHEN 'R' THEN 'bootstrap-insert'
              ELSE 'update' END AS "type",
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS cart_price,
         CAST(l_quantity AS INTEGER) AS quantity,
         CASE WHEN l_returnflag = 'A' AND l_partkey % 3 <> 0
              THEN CAST(l_quantity AS INTEGER) + l_linenumber - 4 END AS old_quantity,
         '24' || CAST(l_linenumber % 4 AS VARCHAR) AS source_type
  FROM lineitem
)"""

_CART = """
SELECT id, user_id, sku_id, cart_price,
       CAST(CASE WHEN "type" = 'insert' THEN quantity
                 ELSE quantity - old_quantity END AS VARCHAR) AS sku_num,
       'thing' AS sku_name, '1' AS is_checked, '2023-02-22 01:14:14' AS create_time,
       CAST(NULL AS VARCHAR) AS operate_time, '0' AS is_ordered,
       CAST(NULL AS VARCHAR) AS order_time, source_type, '1' AS source_id
FROM changes"""
_CART_LITERAL = _CART + """
WHERE "database" = 'shop' AND "table" = 'cart_info' AND "type" = 'insert'
   OR ("type" = 'update' AND old_quantity IS NOT NULL AND quantity > old_quantity)"""

_DIMENSIONS = """
source_rows AS (
  SELECT 'customer' AS "table", CAST(c_custkey AS BIGINT) AS number, c_name AS title,
         c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'supplier', CAST(s_suppkey AS BIGINT), s_name, NULL FROM supplier
  UNION ALL SELECT 'part', CAST(p_partkey AS BIGINT), p_name, NULL FROM part
  UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name, NULL FROM nation
),
versions AS (
  SELECT "table", number, title, segment, 1 AS version FROM source_rows
  UNION ALL
  SELECT "table", number, title || '-v2', NULL, 2 FROM source_rows WHERE number % 3 = 0
),
changes AS (
  SELECT "table", CAST(number AS VARCHAR) AS key, title, segment, version,
         CASE number % 5 WHEN 1 THEN 'update' WHEN 2 THEN 'bootstrap-insert'
              ELSE 'insert' END AS "type"
  FROM versions WHERE number % 5 <> 0
),
routed AS (
  SELECT "table", 'dim_' || "table" AS sink_table, key, version,
         CASE "table" WHEN 'customer' THEN 'c_custkey' WHEN 'supplier' THEN 's_suppkey'
              ELSE 'p_partkey' END AS "column", key AS value
  FROM changes WHERE "table" <> 'nation'
  UNION ALL
  SELECT "table", 'dim_customer', key, version, 'c_name', title
  FROM changes WHERE "table" = 'customer'
  UNION ALL
  SELECT "table", 'dim_customer', key, version, 'c_mktsegment', segment
  FROM changes WHERE "table" = 'customer' AND version = 1
  UNION ALL
  SELECT "table", 'dim_supplier', key, version, 's_name', title
  FROM changes WHERE "table" = 'supplier'
)"""

_CONFIG = """
config_changes AS (
  SELECT p_partkey,
         'src_' || CAST(p_partkey // 3 AS VARCHAR) AS source_table,
         lower(p_type) AS kind, 'size_' || CAST(p_size AS VARCHAR) AS size_column,
         row_number() OVER (PARTITION BY p_partkey // 3 ORDER BY p_partkey DESC) AS age
  FROM part
),
config AS (
  SELECT source_table, 'dim_' || source_table AS sink_table, kind, size_column,
         'id,' || kind || ',' || size_column AS sink_columns,
         CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN kind END AS sink_pk,
         CASE WHEN p_partkey % 2 = 0 THEN 'buckets=4' END AS sink_extend
  FROM config_changes WHERE age = 1 AND p_partkey % 11 <> 0
)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["src_text_lines"] = """
SELECT CASE WHEN event_id % 50 <> 0 THEN event_id END AS event_id,
       event_id % 50 = 0 AND (event_id // 50) % 10 = 1 AS is_empty FROM events"""
    sql["log_parse"] = f"""WITH {_LOG}
SELECT event_id, mid, sent_new AS is_new, ms AS ts,
       CASE WHEN NOT is_start THEN event_type END AS page_id,
       CASE WHEN NOT is_start THEN last_page_id END AS last_page_id, props AS extra FROM log"""
    sql["log_dirty"] = f"""
SELECT CASE (event_id // 50) % 10 WHEN 0 THEN {_CUT} WHEN 1 THEN '' WHEN 2 THEN '[1]'
       ELSE {_CUT} || '"mid":"m"}},"page":{{}},"ts":' || CASE (event_id // 50) % 10
            WHEN 3 THEN '1}}] junk' WHEN 4 THEN '1}}]' WHEN 5 THEN '1}}],[{{}}'
            WHEN 6 THEN '9223372036854775807}}' WHEN 7 THEN '-9223372036854775808}}'
            WHEN 8 THEN '9223371950454776}}' ELSE '-9223371950454776}}' END END AS value
FROM events WHERE event_id % 50 = 0"""
    sql["visitor_flag_repair"] = f"""WITH {_FIXED}
SELECT event_id, mid, ms AS ts, is_new FROM fixed"""
    sql["visitor_flag_repair_arrival"] = sql["visitor_flag_repair"]
    sql["log_split_error"] = f"""WITH {_FIXED}
SELECT event_id, mid, is_new, ms AS ts, event_id % 5 AS err_code
FROM fixed WHERE event_type = 'error'"""
    sql["log_split_start"] = f"""WITH {_FIXED}
SELECT event_id, mid, is_new, ms AS ts FROM fixed WHERE is_start"""
    sql["log_split_page"] = f"""WITH {_FIXED}
SELECT event_id, mid, is_new, ms AS ts, event_type AS page_id, last_page_id, props AS extra
FROM fixed WHERE NOT is_start"""
    displays = f"""WITH {_FIXED}
SELECT mid, is_new, event_type AS page_id, CAST(i AS BIGINT) AS item, CAST(i AS BIGINT) AS pos,
       ms AS ts FROM ({_DISPLAYS}) AS d"""
    actions = f"""WITH {_FIXED}
SELECT mid, is_new, event_type AS page_id, CAST(i AS BIGINT) AS item, event_type AS action_id
FROM ({_ACTIONS}) AS a"""
    sql["log_split_display"] = displays
    sql["log_split_display_flat"] = displays
    sql["log_split_action"] = actions
    sql["log_split_action_flat"] = actions
    sql["log_split_all"] = f"""WITH {_FIXED}
SELECT 'dwd_traffic_error_log' AS topic, mid,
       CASE WHEN NOT is_start THEN event_type END AS page_id, ms AS ts
FROM fixed WHERE event_type = 'error'
UNION ALL SELECT 'dwd_traffic_start_log', mid, NULL, ms FROM fixed WHERE is_start
UNION ALL SELECT 'dwd_traffic_page_log', mid, event_type, ms FROM fixed WHERE NOT is_start
UNION ALL SELECT 'dwd_traffic_display_log', mid, event_type, ms FROM ({_DISPLAYS}) AS d
UNION ALL SELECT 'dwd_traffic_action_log', mid, event_type, NULL FROM ({_ACTIONS}) AS a
UNION ALL SELECT 'dirty_data', NULL, NULL, NULL FROM events WHERE event_id % 50 = 0"""
    sql["uv_entry_pages"] = f"""WITH {_LOG}
SELECT event_id, mid, CAST(day AS VARCHAR) AS dt FROM log WHERE last_page_id IS NULL"""
    sql["unique_visitor_detail"] = f"""WITH {_UNIQUE}
SELECT event_id, mid, CAST(day AS VARCHAR) AS dt FROM entries
WHERE previous IS NULL OR previous <> day"""
    sql["unique_visitor_per_day"] = f"""WITH {_LOG}
SELECT DISTINCT mid, CAST(day AS VARCHAR) AS dt FROM log WHERE last_page_id IS NULL"""
    for name, condition in (
        ("match", _MATCH),
        ("timeout", _TIMEOUT),
        ("detail", f"({_MATCH}) OR ({_TIMEOUT})"),
    ):
        sql[f"user_jump_{name}"] = f"""WITH {_NEXT}
SELECT event_id, mid, ms AS ts FROM paged WHERE {condition}"""
    sql["cdc_decode"] = f"""WITH {_CHANGES}
SELECT "database", "table", "type", id, CAST(quantity AS VARCHAR) AS sku_num,
       CAST(old_quantity AS VARCHAR) AS old_sku_num FROM changes"""
    sql["cart_add"] = f"WITH {_CHANGES}{_CART_LITERAL}"
    sql["cart_add_scoped"] = f"""WITH {_CHANGES}{_CART}
WHERE "database" = 'shop' AND "table" = 'cart_info'
  AND ("type" = 'insert'
       OR ("type" = 'update' AND old_quantity IS NOT NULL AND quantity > old_quantity))"""
    sql["cart_add_enriched"] = f"""WITH {_CHANGES}, added AS ({_CART_LITERAL})
SELECT added.*, CASE source_type WHEN '240' THEN 'search' WHEN '241' THEN 'advert'
       WHEN '242' THEN 'friend' END AS source_type_name FROM added"""
    sql["dim_change_filter"] = f"""WITH {_DIMENSIONS}
SELECT "table", "type", key FROM changes"""
    sql["dim_config_decode"] = f"""WITH {_CONFIG}
SELECT source_table, sink_table, sink_columns, sink_pk, sink_extend FROM config"""
    sql["dim_schema_plan"] = f"""WITH {_CONFIG}, listed AS (
  SELECT sink_table, CAST(1 AS BIGINT) AS position, 'id' AS "column", sink_pk FROM config
  UNION ALL SELECT sink_table, 2, kind, sink_pk FROM config
  UNION ALL SELECT sink_table, 3, size_column, sink_pk FROM config
)
SELECT sink_table, position, "column",
       "column" = coalesce(nullif(sink_pk, ''), 'id') AS is_pk FROM listed"""
    sql["dim_route"] = f"""WITH {_DIMENSIONS}
SELECT "table", sink_table, key, "column", value FROM routed"""
    sql["dim_unrouted"] = f"""WITH {_DIMENSIONS}
SELECT "table", key FROM changes WHERE "table" = 'nation'"""
    sql["dim_upsert_latest"] = f"""WITH {_DIMENSIONS}, ranked AS (
  SELECT sink_table, key, "column", value,
         row_number() OVER (PARTITION BY sink_table, key, "column" ORDER BY version DESC) AS age
  FROM routed
)
SELECT sink_table, key, "column", value FROM ranked WHERE age = 1"""
    asof = f"""{_DIMENSIONS},
arrivals AS (
  SELECT changes.*, CAST(key AS BIGINT) * 2 + version AS arrival,
         least(24, (CAST(key AS BIGINT) * 2 + version) // 20) AS k FROM changes
),
routed_then AS (
  SELECT "table", 'dim_' || "table" || '_' || CAST(k % 2 AS VARCHAR) AS sink_table, key,
         CASE "table" WHEN 'customer' THEN 'c_custkey' WHEN 'supplier' THEN 's_suppkey'
              ELSE 'p_partkey' END AS "column", key AS value, arrival
  FROM arrivals WHERE "table" <> 'nation' AND k % 5 <> 3
  UNION ALL
  SELECT "table", 'dim_' || "table" || '_0', key,
         CASE "table" WHEN 'customer' THEN 'c_name' WHEN 'supplier' THEN 's_name' ELSE 'p_name' END,
         title, arrival
  FROM arrivals WHERE "table" <> 'nation' AND k % 5 <> 3 AND k % 2 = 0
)"""
    sql["dim_route_asof"] = f"""WITH {asof}
SELECT "table", sink_table, key, "column", value, arrival FROM routed_then"""
    sql["dim_unrouted_asof"] = f"""WITH {asof}
SELECT "table", key, arrival FROM arrivals WHERE "table" = 'nation' OR k % 5 = 3"""
    sql["dim_config_stream"] = f"""WITH {asof}, ranked AS (
  SELECT sink_table, key, "column", value,
         row_number() OVER (PARTITION BY sink_table, key, "column" ORDER BY arrival DESC) AS age
  FROM routed_then
)
SELECT sink_table, key, "column", value FROM ranked WHERE age = 1"""
    sql["fn_to_date"] = "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events"
    sql["fn_to_ymd_hms"] = (
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second FROM events"
    )
    sql["fn_to_ts"] = """
SELECT o_orderkey, epoch_us(date_trunc('day', o_orderdate)) // 1000 - 28800000 AS day_ms,
       epoch_us(date_trunc('second', o_orderdate)) // 1000 - 28800000 AS full_ms FROM orders"""
    for stream, batch in (
        ("log_split_stream", "log_split_all"),
        ("visitor_flag_stream", "visitor_flag_repair"),
        ("unique_visitor_stream", "unique_visitor_detail"),
        ("user_jump_stream", "user_jump_detail"),
        ("user_jump_replay_stream", "user_jump_detail"),
        ("user_jump_partitions_stream", "user_jump_detail"),
        ("cart_add_stream", "cart_add_enriched"),
        ("dim_upsert_stream", "dim_upsert_latest"),
    ):
        sql[stream] = sql[batch]
    sql["dim_tables_stream"] = f"SELECT * FROM ({sql['dim_upsert_latest']}) WHERE value IS NOT NULL"
    sql["drops_stream"] = f"""WITH {_DIMENSIONS}
SELECT 'user-jumps' AS job, 'no page log' AS reason, count(*) AS "count"
FROM events WHERE event_id % 50 = 0
UNION ALL SELECT 'dimensions', 'no route: nation', count(*) FROM changes WHERE "table" = 'nation'"""
    # Three slices of equal width in arrival order, over dirty lines too.
    sql["user_jump_late_stream"] = f"""WITH arrivals AS (
  SELECT (event_id + 300 * (event_id % 7)) * 7 + 6 - event_id % 7 AS arrival,
         event_id % 50 <> 0 AS good, epoch_us(ts) // 1000 AS ms FROM events
),
sliced AS (
  SELECT good, ms, (arrival - min(arrival) OVER ())
         // ((max(arrival) OVER () - min(arrival) OVER ()) // 3 + 1) AS slice FROM arrivals
),
highs AS (SELECT slice, max(ms) AS high FROM sliced WHERE good GROUP BY slice)
SELECT count(*) AS late FROM sliced AS s
WHERE good AND ms <= (SELECT max(high) FROM highs AS h WHERE h.slice < s.slice) - 2000 - 1"""
    return sql

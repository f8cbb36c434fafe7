"""SQL that states each query's result over the driver tables, independent of the Spark code."""

from __future__ import annotations

_LOG = """pl AS (
  SELECT event_id AS seq, user_id AS mid, epoch_us(ts) // 1000 AS ts,
    strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS d,
    strftime(ts + INTERVAL 8 HOUR - INTERVAL 24 HOUR, '%Y-%m-%d') AS dm,
    CAST(props->>'$.k' AS INTEGER) AS k,
    CASE WHEN CAST(props->>'$.k' AS INTEGER) % 2 = 0 THEN '1' ELSE '0' END AS is_new,
    CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN '' ELSE event_type END AS lp,
    event_type
  FROM events)"""

_RAW = (
    _LOG
    + """, raw AS (
  SELECT *, event_type = 'purchase' AND k >= 90 AS dirty,
    event_type NOT IN ('error', 'signup') AS is_page FROM pl),
fixed AS (
  SELECT seq, mid, ts, d, k, lp, event_type, is_page,
    CASE WHEN is_new = '1' AND d <> first_value(CASE WHEN is_new = '1' THEN d ELSE dm END)
      OVER (PARTITION BY mid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    THEN '0' ELSE is_new END AS is_new
  FROM raw WHERE NOT dirty),
items AS (
  SELECT *, 'action' AS channel, CAST(unnest(range(k % 3)) AS INTEGER) AS position FROM fixed WHERE is_page
  UNION ALL
  SELECT *, 'display' AS channel, CAST(unnest(range(k % 2)) AS INTEGER) AS position FROM fixed WHERE is_page),
routed AS (
  SELECT seq, mid, channel, position, is_new, event_type AS page_id,
    CASE channel WHEN 'action' THEN 'a' || position ELSE CAST(k AS VARCHAR) END AS item, NULL AS code, ts
  FROM items
  UNION ALL
  SELECT seq, mid, 'page', 0, is_new, event_type, NULL, NULL, ts FROM fixed WHERE is_page
  UNION ALL
  SELECT seq, mid, 'err', 0, is_new, NULL, NULL, k, ts FROM fixed WHERE event_type = 'error'
  UNION ALL
  SELECT seq, mid, 'start', 0, NULL, NULL, CAST(k AS VARCHAR), NULL, NULL FROM fixed WHERE event_type = 'signup'
  UNION ALL
  SELECT seq, NULL, 'dirty', 0, NULL, NULL, NULL, NULL, NULL FROM raw WHERE dirty)"""
)

_DIM = """chg AS (
  SELECT o_orderkey AS seq, CASE WHEN o_totalprice > 100000 THEN 'shop' ELSE 'archive' END AS db,
    'orders_' || lower(o_orderstatus) AS tbl,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'insert' WHEN '2-HIGH' THEN 'update'
      WHEN '3-MEDIUM' THEN 'bootstrap-start' WHEN '4-NOT SPECIFIED' THEN 'delete'
      ELSE 'bootstrap-insert' END AS type,
    o_custkey AS id, o_orderkey AS last_order, o_totalprice AS price
  FROM orders),
cfg AS (
  SELECT CAST(n_nationkey AS BIGINT) * 500 AS seq,
    'orders_' || CASE n_nationkey % 3 WHEN 0 THEN 'f' WHEN 1 THEN 'o' ELSE 'p' END AS source_table,
    'dim_' || lower(n_name) AS sink_table,
    CASE WHEN n_nationkey % 2 = 0 THEN 'id,price' ELSE 'id,last_order,price' END AS sink_columns,
    n_nationkey % 7 = 6 AS deleted
  FROM nation),
cur AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn FROM cfg) x
  WHERE rn = 1 AND NOT deleted),
wanted AS (SELECT * FROM chg WHERE db = 'shop' AND type NOT IN ('bootstrap-start', 'bootstrap-complete')),
asof_routed AS (
  SELECT w.seq, c.sink_table, w.type, w.id,
    CASE WHEN c.sink_columns LIKE '%last_order%' THEN w.last_order END AS last_order, w.price
  FROM wanted w ASOF JOIN cfg c ON w.tbl = c.source_table AND w.seq >= c.seq
  WHERE NOT c.deleted),
last_routed AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sink_table, id ORDER BY seq DESC) AS rn FROM asof_routed) x
  WHERE rn = 1)"""

_REPAIR = f"""WITH {_LOG} SELECT seq, mid, ts,
  CASE WHEN is_new = '1' AND d <> first_value(CASE WHEN is_new = '1' THEN d ELSE dm END)
    OVER (PARTITION BY mid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  THEN '0' ELSE is_new END AS is_new FROM pl"""

_UV = f"""WITH {_LOG} SELECT seq, mid, d FROM (
  SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY seq) AS p FROM pl WHERE lp IS NULL) x
WHERE p IS NULL OR p <> d"""

_JUMP = f"""WITH {_LOG} SELECT mid, seq, s2, ts, t2 FROM (
  SELECT *, lead(seq) OVER w AS s2, lead(ts) OVER w AS t2, lead(coalesce(length(lp), 0) = 0) OVER w AS e2
  FROM pl WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)) x
WHERE coalesce(length(lp), 0) = 0 AND e2 AND t2 - ts < 3600000"""

_SPLIT = f"WITH {_RAW} SELECT seq, channel, position, is_new, page_id, item, CAST(code AS BIGINT) AS code, ts FROM routed"

_DIM_ROWS = f"WITH {_DIM} SELECT id, price FROM last_routed WHERE sink_table = 'dim_nation_0'"

_CONFIG_ASOF = """SELECT e.event_id, o.o_orderkey AS k FROM events e
ASOF JOIN orders o ON e.user_id = o.o_custkey AND e.event_id >= o.o_orderkey
WHERE o.o_orderstatus <> 'F'"""

_CONFIG_JOIN = f"""WITH {_DIM} SELECT chg.seq, chg.tbl AS "table", cur.sink_table, cur.sink_columns
FROM chg JOIN cur ON chg.tbl = cur.source_table WHERE db = 'shop'"""

_PARSED = f"""WITH {_RAW} SELECT seq, dirty AS is_dirty, CASE WHEN NOT dirty THEN CAST(mid AS VARCHAR) END AS mid,
  CASE WHEN NOT dirty THEN is_new END AS is_new, CASE WHEN NOT dirty THEN ts END AS ts FROM raw"""

_PAGE_UV = f"""WITH {_RAW} SELECT seq, CAST(mid AS VARCHAR) AS mid, d FROM (
  SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY seq) AS p FROM fixed WHERE is_page AND lp IS NULL) x
WHERE p IS NULL OR p <> d"""

_PAGE_JUMP = f"""WITH {_RAW} SELECT CAST(mid AS VARCHAR) AS mid, seq, s2 FROM (
  SELECT *, lead(seq) OVER w AS s2, lead(ts) OVER w AS t2, lead(coalesce(length(lp), 0) = 0) OVER w AS e2
  FROM fixed WHERE is_page WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)) x
WHERE coalesce(length(lp), 0) = 0 AND e2 AND t2 - ts < 3600000"""

_FOLDED = f"WITH {_DIM} SELECT sink_table, id, last_order, price FROM last_routed"

ORACLES: dict[str, str] = {
    "first_visit_repair": _REPAIR,
    "daily_uv": _UV,
    "jump_out": _JUMP,
    "changelog_fold": """SELECT o_custkey, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) x
WHERE rn = 1 AND o_orderstatus <> 'F'""",
    "config_fold": f"""WITH {_DIM} SELECT chg.tbl AS "table", cur.sink_table, cur.sink_columns,
  'id' AS sink_primary_key, CAST(NULL AS VARCHAR) AS sink_extend, count(*) AS n_records
FROM chg JOIN cur ON chg.tbl = cur.source_table GROUP BY ALL""",
    "config_join": _CONFIG_JOIN,
    "config_asof_join": _CONFIG_ASOF,
    "prune_columns": f"""WITH {_DIM} SELECT chg.seq, len(string_split(sink_columns, ',')) AS n_columns, id,
  CASE WHEN list_contains(string_split(sink_columns, ','), 'last_order') THEN last_order END AS last_order, price
FROM chg JOIN cur ON chg.tbl = cur.source_table""",
    "filter_db": f"""WITH {_DIM} SELECT seq, tbl AS "table", type FROM wanted""",
    "dimension_routing": f"""WITH {_DIM} SELECT w.seq, c.sink_table, w.type, w.id,
  CASE WHEN c.sink_columns LIKE '%last_order%' THEN w.last_order END AS last_order, w.price
FROM wanted w JOIN cur c ON w.tbl = c.source_table""",
    "dimension_routing_asof": f"WITH {_DIM} SELECT seq, sink_table, type, id, last_order, price FROM asof_routed",
    "parse_dirty": _PARSED,
    "json_paths": f"""WITH {_RAW} SELECT seq, CASE WHEN NOT dirty THEN CAST(mid AS VARCHAR) END AS mid,
  CASE WHEN NOT dirty THEN ts END AS ts, event_type = 'error' AS has_err,
  CAST(CASE WHEN is_page AND NOT dirty THEN k % 3 END AS BIGINT) AS n_actions,
  dirty OR NOT is_page OR lp IS NULL AS no_last_page,
  dirty OR NOT is_page OR coalesce(lp, '') = '' AS blank_last_page FROM raw""",
    "to_json_round_trip": f"""WITH {_RAW} SELECT seq, CASE WHEN lp IS NULL
    THEN CAST(json_object('page_id', event_type) AS VARCHAR)
    ELSE CAST(json_object('last_page_id', lp, 'page_id', event_type) AS VARCHAR) END AS page
FROM raw WHERE is_page AND NOT dirty""",
    "route_split": f"""WITH {_LOG} SELECT seq, CASE WHEN event_type = 'purchase' AND k >= 90 THEN 'dirty'
  WHEN event_type = 'error' THEN 'err' WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS channel FROM pl""",
    "explode_actions": f"""WITH {_RAW} SELECT seq, channel, position, item, ts FROM routed
WHERE channel IN ('action', 'display')""",
    "field_drop": f"""WITH {_RAW} SELECT seq, TRUE AS no_actions, TRUE AS no_displays, event_type AS page_id,
  lp AS last_page_id, ts FROM raw WHERE is_page AND NOT dirty""",
    "traffic_split": _SPLIT,
    "page_log_uv": _PAGE_UV,
    "page_log_jump_out": _PAGE_JUMP,
    "time_fns": """SELECT event_id AS seq, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS moment,
  epoch_us(date_trunc('day', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR) // 1000 AS day_ms,
  epoch_us(date_trunc('second', ts)) // 1000 AS moment_ms,
  strftime(ts - INTERVAL 16 HOUR, '%Y-%m-%d') AS day_before FROM events""",
    "upsert_last": """SELECT event_type, user_id, event_id, k FROM (
  SELECT *, CAST(props->>'$.k' AS BIGINT) AS k,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS rn FROM events) x
WHERE rn = 1""",
    "dimension_upsert": f"""WITH {_DIM} SELECT sink_table, id, last_order, price FROM last_routed
WHERE type <> 'delete'""",
    "dimension_compacted": _FOLDED,
    "create_table": _DIM_ROWS,
    "channel_files": f"WITH {_RAW} SELECT channel, count(*) AS n FROM routed GROUP BY channel",
    "topic_rows": f"""WITH {_RAW} SELECT 'dwd_traffic_' || channel || '_log' AS topic, CAST(mid AS VARCHAR) AS mid,
  count(*) AS n FROM routed WHERE channel <> 'dirty' GROUP BY ALL""",
    "first_visit_repair_stream": _REPAIR,
    "daily_uv_stream": _UV,
    "jump_out_stream": _JUMP,
    "traffic_split_stream": _SPLIT,
    "dimension_stream": _FOLDED,
    "page_files_uv": _PAGE_UV,
    "page_files_jump_out": _PAGE_JUMP,
    "uv_topic_rows": f"""WITH {_RAW} SELECT 'dwd_traffic_uv_log' AS topic, CAST(mid AS VARCHAR) AS mid, event_type AS page_id, ts FROM (
  SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY seq) AS p FROM fixed WHERE is_page AND lp IS NULL) x
WHERE p IS NULL OR p <> d""",
    "traffic_split_element": f"""WITH {_RAW} SELECT seq, channel, position,
  CASE WHEN channel = 'start' THEN CAST(mid AS VARCHAR) END AS common_mid, CAST(NULL AS VARCHAR) AS page_id, item,
  CASE WHEN channel <> 'action' THEN coalesce(ts, start_ts) END AS ts
FROM (SELECT r.seq, r.channel, r.position, r.item, r.ts, f.mid, f.ts AS start_ts
  FROM routed r JOIN fixed f ON f.seq = r.seq WHERE r.channel IN ('action', 'display', 'start')) x""",
    "parse_padded": _PARSED,
    "page_rejected": f"""WITH {_RAW} SELECT seq, length('{{"common":{{"mid":"' || mid || '","is_new":"' || is_new || '"}},"page":{{"page_id":"purchase"'
  || ',"last_page_id":"purchase"}},"actions":' || CASE k % 3 WHEN 0 THEN '[]' WHEN 1 THEN '[{{"action_id":"a0"}}]'
    ELSE '[{{"action_id":"a0"}},{{"action_id":"a1"}}]' END
  || ',"displays":' || CASE k % 2 WHEN 0 THEN '[]' ELSE '[{{"item":' || k || ',"order":1}}]' END || ',"ts":' || ts || '}}') - 2 AS n_chars
FROM raw WHERE dirty""",
    "dimension_dirty": f"""WITH {_DIM} SELECT 'change' AS kind, seq, 'unreadable' AS problem FROM chg
  WHERE seq % 11 = 0 OR (seq % 13 = 0 AND seq % 11 <> 0)
UNION ALL SELECT 'config', seq, CASE WHEN (seq // 500) % 9 = 1 THEN 'unreadable' ELSE 'no primary key among the columns' END
FROM cfg WHERE (seq // 500) % 9 = 1 OR ((seq // 500) % 9 IN (3, 5) AND NOT deleted)""",
    "dimension_compacted_delete": f"""WITH {_DIM} SELECT sink_table, id, last_order, price FROM last_routed WHERE type <> 'delete'""",
    "dimension_widened": f"""WITH {_DIM} SELECT id, last_order, price FROM last_routed WHERE sink_table = 'dim_nation_1'""",
    "first_visit_repair_large": _REPAIR,
    "daily_uv_large": _UV,
    "daily_uv_sparse": _UV,
    "config_asof_join_large": _CONFIG_ASOF,
    "config_join_large": _CONFIG_JOIN,
    "dimension_stream_delete": f"""WITH {_DIM} SELECT sink_table, id, last_order, price FROM last_routed WHERE type <> 'delete'""",
    "dimension_late_config": _FOLDED,
    "dimension_published": f"""WITH {_DIM}, widened AS (
  SELECT seq, source_table, sink_table, sink_columns, deleted FROM cfg
  UNION ALL SELECT seq + 250, source_table, sink_table, 'id,last_order,price', FALSE FROM cfg WHERE NOT deleted),
rows AS (SELECT w.seq, c.sink_table, w.id, CASE WHEN c.sink_columns LIKE '%last_order%' THEN w.last_order END AS last_order, w.price
  FROM wanted w ASOF JOIN widened c ON w.tbl = c.source_table AND w.seq >= c.seq WHERE NOT c.deleted)
SELECT sink_table, id, arg_max(last_order, seq) FILTER (last_order IS NOT NULL) AS last_order, arg_max(price, seq) AS price
FROM rows GROUP BY sink_table, id""",
    "customer_log": """WITH c AS (SELECT *, c_custkey % 17 = 0 AS broken FROM customer)
SELECT c_custkey AS seq, CASE WHEN broken THEN NULL WHEN c_custkey % 5 = 0 THEN 'd' WHEN c_custkey % 3 = 0 THEN 'u' ELSE 'r' END AS op,
  CASE WHEN NOT broken THEN c_custkey % 5 = 0 END AS is_deleted, CASE WHEN NOT broken THEN c_custkey END AS c_custkey,
  CASE WHEN NOT broken THEN c_name END AS c_name, CASE WHEN NOT broken THEN c_mktsegment END AS c_mktsegment FROM c""",
    "daily_uv_clustered": f"""WITH {_LOG} SELECT seq, mid, d FROM (
  SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY CASE WHEN seq % 3 = 0 THEN seq WHEN seq = 1 THEN seq + 1000000000000
    ELSE seq + 1000000000000000 END) AS p FROM pl WHERE lp IS NULL) x
WHERE p IS NULL OR p <> d""",
    "daily_uv_partitions": f"""WITH {_LOG}, moved AS (
  SELECT seq, mid, ts, lp, strftime(make_timestamp((ts - (seq % 2) * 30000000 + 28800000) * 1000), '%Y-%m-%d') AS d FROM pl)
SELECT seq, mid, d FROM (
  SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY ts // 1000, seq % 2, seq // 2) AS p FROM moved WHERE lp IS NULL) x
WHERE p IS NULL OR p <> d""",
    "first_visit_repair_partitions": f"""WITH {_LOG} SELECT seq, mid, ts,
  CASE WHEN is_new = '1' AND d <> first_value(CASE WHEN is_new = '1' THEN d ELSE dm END) OVER (PARTITION BY mid
    ORDER BY ts // 1000, seq % 2, seq // 2 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  THEN '0' ELSE is_new END AS is_new FROM pl""",
    "daily_uv_partitions_stream": _UV,
    "jump_out_timeouts": f"""WITH {_LOG} SELECT mid, seq, ts FROM (
  SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, seq) AS t2 FROM pl) x
WHERE coalesce(length(lp), 0) = 0 AND (t2 IS NULL OR t2 - ts >= 3600000)""",
    "jump_out_timeouts_stream": f"""WITH {_LOG} SELECT mid, seq, CASE WHEN t2 - ts < 3600000 THEN s2 END AS s2 FROM (
  SELECT *, lead(seq) OVER w AS s2, lead(ts) OVER w AS t2, lead(coalesce(length(lp), 0) = 0) OVER w AS e2
  FROM pl WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)) x
WHERE coalesce(length(lp), 0) = 0 AND (e2 AND t2 - ts < 3600000 OR t2 IS NULL OR t2 - ts >= 3600000)""",
    "daily_visitor_counts": f"""WITH {_LOG} SELECT d, count(DISTINCT mid) AS n_visitors, count(*) AS n_visits FROM (
  SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY seq) AS p FROM pl WHERE lp IS NULL) x
WHERE p IS NULL OR p <> d GROUP BY d""",
    "daily_uv_distinct_stream": f"""WITH {_LOG}, moved AS (
  SELECT seq, mid, CASE WHEN seq % 5 = 0 THEN dm ELSE d END AS d FROM pl WHERE lp IS NULL)
SELECT mid, d, TRUE AS emitted, count(*) FILTER (p IS NULL OR p <> d) AS n_exact
FROM (SELECT *, lag(d) OVER (PARTITION BY mid ORDER BY seq) AS p FROM moved) x GROUP BY mid, d""",
}

"""The registered queries in SQL, written from the tables up: no JSON is built
or parsed, and nothing is split. The fragments below restate the stand-ins."""

USERS = """
  SELECT c_custkey::VARCHAR AS id,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'M'
              WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'F' END AS gender,
         CASE WHEN c_acctbal < -900 THEN 'unknown'
              ELSE strftime(DATE '1950-01-01' + (c_custkey * 37 % 20000)::INTEGER, '%Y-%m-%d') END AS birthday
  FROM customer
"""

PROVINCES = """
  SELECT n_nationkey::VARCHAR AS id, n_name AS name, 'ISO-' || n_nationkey AS iso_code,
         'R' || n_regionkey || '-' || n_nationkey AS iso_3166_2,
         lpad((n_nationkey * 10)::VARCHAR, 6, '0') AS area_code
  FROM nation
"""

HEADERS = """
  SELECT o_orderkey AS id, (o_custkey % 27)::VARCHAR AS province_id, o_orderstatus AS order_status,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'guest'
              WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED')
              THEN o_custkey::VARCHAR END AS user_id,
         o_totalprice AS total_amount,
         o_totalprice * 0.125::DOUBLE AS activity_reduce_amount,
         o_totalprice * 0.0625::DOUBLE AS coupon_reduce_amount,
         o_totalprice * 1.25::DOUBLE AS original_total_amount,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 20.0 ELSE 8.5 END::DOUBLE AS freight_fee,
         0.0::DOUBLE AS freight_fee_reduce,
         strftime(created + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS expire_time,
         strftime(created + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS refundable_time,
         strftime(created, '%Y-%m-%d %H:%M:%S') AS create_time,
         CASE WHEN o_orderstatus = 'F'
              THEN strftime(created + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') END AS operate_time
  FROM (SELECT *, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS created FROM orders)
"""

LINES = """
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         l_extendedprice AS order_price, l_quantity::BIGINT AS sku_num, 'sku_' || l_partkey AS sku_name,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         l_extendedprice * (1 - l_discount) AS split_total_amount,
         l_extendedprice * l_discount AS split_activity_amount,
         l_tax AS split_coupon_amount
  FROM lineitem
"""

# Events that are readable logs: "log", or "error", or "rejected".
EVENTS = """
  SELECT *, epoch_us(ts) // 1000 AS ms, (props::JSON ->> '$.k')::INTEGER AS k,
         CASE WHEN event_type = 'error' THEN 'error'
              WHEN event_type = 'view' AND value > 150 THEN 'rejected'
              WHEN event_type = 'purchase' AND value > 200 THEN 'rejected'
              ELSE 'log' END AS fate
  FROM events
"""

COMMON = """
  'mid_' || user_id AS mid,
  CASE WHEN value >= 4 THEN user_id::VARCHAR WHEN value >= 2 THEN 'guest' END AS user_id,
  (k % 27)::VARCHAR AS province_id, event_type AS channel,
  CASE WHEN value > 50 THEN '1' ELSE '0' END AS is_new,
  'model ' || (k % 10) AS model, 'os ' || (k % 3) AS operate_system,
  'v2.1' AS version_code, 'brand ' || (k % 5) AS brand
"""

PAGE = """
  CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'payment' ELSE 'home' END AS page_id,
  CASE WHEN event_type = 'purchase' THEN '' WHEN event_type IN ('click', 'error') THEN 'home' END AS last_page_id,
  k::VARCHAR AS page_item, 'sku_id' AS page_item_type, floor(value * 100)::BIGINT AS during_time,
  CASE WHEN k < 50 THEN 'promotion' ELSE 'query' END AS "sourceType"
"""

HAS_PAGE = "fate = 'log' AND (event_type <> 'signup' OR value < 50)"
HAS_START = "fate = 'log' AND event_type = 'signup'"


def _display(columns: str) -> str:
    return f"""
      SELECT {columns} FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM ({EVENTS})
      WHERE {HAS_PAGE} AND event_type IN ('view', 'purchase'))"""


def _action(columns: str) -> str:
    return f"""
      SELECT {columns} FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM ({EVENTS})
      WHERE {HAS_PAGE} AND event_type IN ('click', 'purchase'))"""


ENTRIES = f"""
  SELECT event_id AS "offset", strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
         ms, {COMMON}, {PAGE}
  FROM ({EVENTS}) WHERE {HAS_PAGE} AND event_type IN ('view', 'signup')
"""

FIRSTS = f"""
  SELECT * FROM ({ENTRIES})
  QUALIFY row_number() OVER (PARTITION BY dt, mid ORDER BY ms, "offset") = 1
"""


def _age(born: str, as_of: str) -> str:
    months = f"((year({as_of}) - year({born})) * 12 + month({as_of}) - month({born}))"
    days = f"(day({as_of}) - day({born}))"
    return f"""(({months} + CASE WHEN {months} > 0 AND {days} < 0 THEN -1
                 WHEN {months} < 0 AND {days} > 0 THEN 1 ELSE 0 END) // 12)::INTEGER"""


AGE_NOW = _age("try_cast(u.birthday AS DATE)", "DATE '2024-12-31'") + "::VARCHAR"

WIDE_HEADERS = f"""
  SELECT h.*, u.gender AS user_gender, {AGE_NOW} AS user_age, p.name AS province_name,
         p.iso_code AS province_iso_code, p.iso_3166_2 AS province_3166_2,
         p.area_code AS province_area_code,
         h.create_time[1:10] AS create_date, h.create_time[12:13] AS create_hour
  FROM ({HEADERS}) h LEFT JOIN ({USERS}) u ON h.user_id = u.id
  LEFT JOIN ({PROVINCES}) p ON h.province_id = p.id
"""

ORDER_WIDE = f"""
  SELECT l.id AS detail_id, l.order_id, l.sku_id, l.order_price, l.sku_num, l.sku_name,
         l.split_total_amount, l.split_activity_amount, l.split_coupon_amount,
         h.province_id, h.order_status, h.user_id, h.total_amount, h.activity_reduce_amount,
         h.coupon_reduce_amount, h.original_total_amount, h.freight_fee, h.freight_fee_reduce,
         h.expire_time, h.refundable_time, l.create_time, h.operate_time,
         h.create_date, h.create_hour, h.province_name, h.province_area_code,
         h.province_3166_2 AS province_3166_2_code, h.province_iso_code, h.user_age, h.user_gender
  FROM ({WIDE_HEADERS}) h JOIN ({LINES}) l ON h.id = l.order_id
"""

WRITES = """sku_id DESC, order_price DESC, sku_num DESC, split_total_amount DESC,
            split_activity_amount DESC, split_coupon_amount DESC, create_time DESC"""

CHANGES = f"""
  SELECT 'order_info' AS "table", id AS key,
         CASE order_status WHEN 'O' THEN 'insert' WHEN 'F' THEN 'update' WHEN 'P' THEN 'bootstrap-start' END AS type,
         total_amount AS amount, NULL::VARCHAR AS what
  FROM ({HEADERS})
  UNION ALL
  SELECT 'order_detail', id, CASE WHEN order_price > 50000 THEN 'bootstrap-insert' END, order_price, NULL FROM ({LINES})
  UNION ALL
  SELECT 'user_info', id::BIGINT, CASE gender WHEN 'M' THEN 'insert' WHEN 'F' THEN 'delete' END, NULL, gender FROM ({USERS})
  UNION ALL
  SELECT 'base_province', id::BIGINT, 'bootstrap-insert', NULL, name FROM ({PROVINCES})
  UNION ALL
  SELECT 'supplier_info', s_suppkey, 'insert', NULL, NULL FROM supplier
"""

OP = """CASE WHEN type IN ('bootstrap-insert', 'insert') THEN 'I'
             WHEN type = 'update' THEN 'U' WHEN type = 'delete' THEN 'D' END"""

USER_VERSIONS = """
  SELECT c_custkey::VARCHAR AS id, 'g' || version AS gender, c_name AS birthday, version
  FROM (SELECT *, unnest(range(1, c_nationkey % 3 + 2)) AS version FROM customer)
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY version * (c_custkey % 5 + 1) % 7 DESC) = 1
"""

_NO_PAGE = "NULL AS page_id, NULL AS during_time"

FANOUT = f"""
  SELECT 'DWD_PAGE_LOG_TOPIC' AS topic, mid AS key, ts, page_id, during_time, NULL AS item
  FROM (SELECT {COMMON}, {PAGE}, ms AS ts FROM ({EVENTS}) WHERE {HAS_PAGE})
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC', mid, ts, page_id, during_time, item
  FROM ({_display(f"{COMMON}, {PAGE}, ms AS ts, (k + i)::VARCHAR AS item")})
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC', mid, ts, page_id, during_time, item
  FROM ({_action(f"{COMMON}, {PAGE}, ms AS ts, k::VARCHAR AS item")})
  UNION ALL SELECT 'DWD_START_LOG_TOPIC', 'mid_' || user_id, ms, {_NO_PAGE}, k::VARCHAR FROM ({EVENTS}) WHERE {HAS_START}
  UNION ALL SELECT 'DWD_ERROR_LOG_TOPIC', 'mid_' || user_id, ms, {_NO_PAGE}, NULL FROM ({EVENTS}) WHERE fate = 'error'
  UNION ALL SELECT 'REJECTED_BASE_LOG', CASE WHEN event_type = 'view' THEN 'mid_' || user_id END, NULL, {_NO_PAGE}, NULL
  FROM ({EVENTS}) WHERE fate = 'rejected'
"""

# One clock in ten is 40 days ahead of the moment its message arrived.
_AHEAD = "CASE WHEN event_id % 10 = 0 THEN 40 ELSE 0 END"

FIRST_ARRIVED = f"""
  SELECT strftime(ts + to_days({_AHEAD}), '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
         ms + {_AHEAD}::BIGINT * 86400000 AS ms, {COMMON}, {PAGE}
  FROM ({EVENTS}) user_events WHERE {HAS_PAGE} AND event_type IN ('view', 'signup')
  QUALIFY row_number() OVER (
    PARTITION BY strftime(ts + to_days({_AHEAD}), '%Y-%m-%d'), user_events.user_id ORDER BY epoch_us(ts), event_id) = 1
"""


def _dau_wide(firsts: str) -> str:
    return f"""
  SELECT f.mid, f.user_id, f.province_id, f.channel, f.is_new, f.model, f.operate_system,
         f.version_code, f.brand, f.page_id, f.page_item, f.page_item_type, f."sourceType",
         f.during_time, u.gender AS user_gender, {AGE_NOW} AS user_age, p.name AS province_name,
         p.iso_code AS province_iso_code, p.iso_3166_2 AS province_3166_2,
         p.area_code AS province_area_code, f.dt, f.hr, f.ms AS ts
  FROM ({firsts}) f LEFT JOIN ({USERS}) u ON f.user_id = u.id
  LEFT JOIN ({PROVINCES}) p ON f.province_id = p.id
"""


DAU_WIDE = _dau_wide(FIRSTS)

HEADER_AT = "TIMESTAMP '2024-01-01' + to_seconds(h.id * 7919 % 259200)"
LINE_AT = "TIMESTAMP '2024-01-01' + to_seconds(l.sku_id * 104729 % 259200)"

STREAM_ORDERS = f"""
  SELECT l.id AS detail_id, l.order_id, l.sku_id, l.order_price, l.sku_num, l.sku_name,
         l.split_total_amount, l.split_activity_amount, l.split_coupon_amount,
         h.province_id, h.order_status, h.user_id, h.total_amount, h.activity_reduce_amount,
         h.coupon_reduce_amount, h.original_total_amount, h.freight_fee, h.freight_fee_reduce,
         h.expire_time, h.refundable_time, strftime({LINE_AT}, '%Y-%m-%d %H:%M:%S') AS create_time, h.operate_time,
         h.create_date, h.create_hour, h.province_name, h.province_area_code,
         h.province_3166_2 AS province_3166_2_code, h.province_iso_code, h.user_age, h.user_gender,
         strftime({LINE_AT}, '%Y-%m-%d') AS dt, epoch_ms({LINE_AT}) AS line_ms
  FROM ({WIDE_HEADERS}) h JOIN ({LINES}) l ON h.id = l.order_id
  WHERE {LINE_AT} BETWEEN {HEADER_AT} - INTERVAL 24 HOUR AND {HEADER_AT} + INTERVAL 24 HOUR
  QUALIFY row_number() OVER (
    PARTITION BY strftime({LINE_AT}, '%Y-%m-%d'), l.id
    ORDER BY {LINE_AT} DESC, order_price DESC, sku_num DESC, split_total_amount DESC,
             split_activity_amount DESC, split_coupon_amount DESC) = 1
"""

NEAR = f"{LINE_AT} BETWEEN {HEADER_AT} - INTERVAL 24 HOUR AND {HEADER_AT} + INTERVAL 24 HOUR"

UNMATCHED = f"""
  SELECT 'UNMATCHED_ORDER_INFO' AS topic, h.id AS order_id, h.id, NULL::BIGINT AS sku_id, NULL::DOUBLE AS order_price,
         epoch_ms({HEADER_AT}) AS ms
  FROM ({HEADERS}) h WHERE NOT EXISTS (FROM ({LINES}) l WHERE l.order_id = h.id AND {NEAR})
  UNION ALL
  SELECT 'UNMATCHED_ORDER_DETAIL', l.order_id, l.id, l.sku_id, l.order_price, epoch_ms({LINE_AT})
  FROM ({LINES}) l WHERE NOT EXISTS (FROM ({HEADERS}) h WHERE l.order_id = h.id AND {NEAR})
"""

ORACLE = {
    "json_field": "SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events",
    "json_typed": f"""
        SELECT id, province_id, order_status, user_id,
               CASE WHEN order_status = 'O' THEN total_amount ELSE 0 END AS total_amount,
               activity_reduce_amount, 0::DOUBLE AS coupon_reduce_amount,
               0::DOUBLE AS original_total_amount, freight_fee, 0::DOUBLE AS freight_fee_reduce,
               NULL::VARCHAR AS expire_time, NULL::VARCHAR AS refundable_time, create_time,
               NULL::VARCHAR AS operate_time
        FROM ({HEADERS})""",
    "json_round_trip": LINES,
    "dt_hr": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr FROM events",
    "create_date_hour": f"""
        SELECT id, create_time[1:10] AS create_date, create_time[12:13] AS create_hour FROM ({HEADERS})""",
    "age_years": f"""
        SELECT o_orderkey, {_age("o_orderdate", "DATE '2024-12-31'")} AS age_after,
               {_age("o_orderdate", "DATE '1998-03-01'")} AS age_amid
        FROM orders""",
    "cdc_op_map": f"""
        SELECT "table", type, {OP} AS op, count(*) AS n FROM ({CHANGES}) GROUP BY ALL""",
    "cdc_fact_route": f"""
        SELECT 'DWD_' || upper("table") || '_' || {OP} AS topic, key::VARCHAR AS key
        FROM ({CHANGES}) WHERE {OP} IS NOT NULL
          AND "table" IN ('order_info', 'order_detail', 'base_province')""",
    "cdc_fact_payload": """
        SELECT 'DWD_ORDER_INFO_I' AS topic, o_orderkey::VARCHAR AS key,
               '12345678901234567890.' || lpad((o_orderkey % 1000000000)::VARCHAR, 9, '0') AS amount,
               'a ]} of ' || o_orderkey AS note, o_orderkey AS n
        FROM orders""",
    "json_whole_text": """
        SELECT o_orderkey AS "offset", o_orderkey % 5 = 0 AS rejected,
               CASE WHEN o_orderkey % 5 <> 0 THEN 'order_info' END AS "table",
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey::VARCHAR END AS id
        FROM orders""",
    "dau_bad_time": """
        SELECT (user_id % 4)::INTEGER AS "partition", event_id AS "offset",
               event_id % 7 = 0 OR event_id % 11 = 0 AS rejected,
               CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS dt
        FROM events""",
    "cdc_dim_rows": f"""
        SELECT 'user_info' AS "table", id, gender AS what FROM ({USERS}) WHERE gender IS NOT NULL
        UNION ALL SELECT 'base_province', id, name FROM ({PROVINCES})""",
    "cdc_dim_latest": f"SELECT id, gender, birthday FROM ({USER_VERSIONS})",
    "cdc_dim_drop": f"SELECT id, gender, birthday FROM ({USER_VERSIONS}) WHERE version <> 3",
    "log_error_split": f"""
        SELECT 'mid_' || user_id AS mid, k::BIGINT AS error_code, ms AS ts
        FROM ({EVENTS}) WHERE fate = 'error'""",
    "log_rejected": f"""
        SELECT (user_id % 4)::INTEGER AS "partition", event_id AS "offset"
        FROM ({EVENTS}) WHERE fate = 'rejected'""",
    "log_page": f"SELECT {COMMON}, {PAGE}, ms AS ts FROM ({EVENTS}) WHERE {HAS_PAGE}",
    "log_display": _display(
        f"""{COMMON}, {PAGE}, CASE WHEN i % 2 = 1 THEN 'query' ELSE 'promotion' END AS display_type,
            (k + i)::VARCHAR AS display_item, 'sku_id' AS display_item_type,
            i::VARCHAR AS display_order, i::VARCHAR AS display_pos_id, ms AS ts"""
    ),
    "log_action": _action(
        f"""{COMMON}, {PAGE}, 'action_' || i AS action_id, k::VARCHAR AS action_item,
            'sku_id' AS action_item_type, ms + i * 100 AS action_ts, ms AS ts"""
    ),
    "log_start": f"""
        SELECT {COMMON}, 'icon' AS entry, k::VARCHAR AS open_ad_id, (k * 10)::BIGINT AS loading_time_ms,
               (k * 20)::BIGINT AS open_ad_ms, CASE WHEN k >= 50 THEN k END::BIGINT AS open_ad_skip_ms,
               ms AS ts
        FROM ({EVENTS}) WHERE {HAS_START}""",
    "log_fanout": FANOUT,
    "dau_entry": f"""SELECT "offset", mid, dt, page_id FROM ({ENTRIES})""",
    "dau_dedup": f"""
        SELECT dt, mid, "offset", ms AS ts, page_item, during_time FROM ({FIRSTS})""",
    "dau_wide": DAU_WIDE,
    "dau_restore": f"""
        SELECT dt, mid, "offset" FROM ({FIRSTS}) WHERE NOT (dt < '2024-01-16' OR is_new = '1')""",
    "order_enrich": WIDE_HEADERS,
    "order_outer": f"""
        SELECT CASE WHEN l.id IS NULL THEN 'header only' WHEN h.id IS NULL THEN 'line only' ELSE 'both' END AS side,
               h.id AS header_id, h.total_amount, l.id AS line_id, l.order_id, l.sku_id, l.order_price
        FROM ({HEADERS}) h
        FULL OUTER JOIN (SELECT * REPLACE (CASE WHEN order_price < 5000 THEN -1 - order_id ELSE order_id END AS order_id) FROM ({LINES})) l
          ON h.id = l.order_id""",
    "order_wide": ORDER_WIDE,
    "order_late": f"""
        SELECT l.id AS detail_id, h.id AS order_id, l.sku_id, l.order_price
        FROM ({HEADERS}) h JOIN ({LINES}) l ON h.id = l.order_id
        WHERE {LINE_AT} BETWEEN {HEADER_AT} - INTERVAL 24 HOUR AND {HEADER_AT} + INTERVAL 24 HOUR""",
    "line_distinct": f"SELECT DISTINCT * FROM ({LINES})",
    "sink_upsert": f"""
        SELECT create_time[1:10] AS dt, detail_id::VARCHAR AS doc_id, order_id, sku_id,
               CASE WHEN order_status = 'F' THEN 'S' ELSE order_status END AS order_status,
               CASE WHEN order_status = 'F' THEN 2 ELSE 1 END AS version, order_price, user_id
        FROM ({ORDER_WIDE})
        QUALIFY row_number() OVER (PARTITION BY create_time[1:10], detail_id ORDER BY {WRITES}) = 1""",
    "sink_by_day": f"""
        SELECT strftime({LINE_AT}, '%Y-%m-%d') AS dt, l.id AS detail_id, l.order_id, l.sku_id, l.sku_num,
               l.order_price, h.user_age, h.province_name
        FROM ({WIDE_HEADERS}) h JOIN ({LINES}) l ON h.id = l.order_id
        QUALIFY row_number() OVER (
          PARTITION BY strftime({LINE_AT}, '%Y-%m-%d'), l.id
          ORDER BY {", ".join("l." + w.strip() for w in WRITES.split(",") if "create_time" not in w)}) = 1""",
    "end_offsets": """
        SELECT 'ODS_BASE_LOG' AS topic, (user_id % 4)::INTEGER AS "partition",
               max(event_id) + 1 AS end_offset
        FROM events GROUP BY ALL""",
    "stream_log_routes": FANOUT,
    "stream_changes": f"""
          SELECT 'DWD_' || upper("table") || '_' || {OP} AS topic, key, amount, what
          FROM ({CHANGES}) WHERE {OP} IS NOT NULL
            AND "table" IN ('order_info', 'order_detail', 'base_province')
          UNION ALL
          SELECT 'DIM:' || "table", key, NULL, what FROM ({CHANGES})
          WHERE {OP} IS NOT NULL AND "table" IN ('user_info', 'base_province')""",
    "stream_dim_upsert": f"SELECT id, gender, birthday FROM ({USER_VERSIONS})",
    "stream_dau": DAU_WIDE,
    "stream_dau_state": _dau_wide(FIRST_ARRIVED),
    "stream_orders": STREAM_ORDERS,
    "stream_unmatched": UNMATCHED,
}

"""The registered queries once more, as ANSI SQL over the given tables."""

from __future__ import annotations

DAILY = """
    CAST({ts} AS DATE) AS summary_date, COUNT(*) AS order_cnt,
    CAST(SUM(CAST({amount} AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
"""
EVENTS_DAILY = DAILY.format(ts="ts", amount="value")
ALL_DAYS = f"""
    SELECT {EVENTS_DAILY} FROM events WHERE ts IS NOT NULL GROUP BY CAST(ts AS DATE)
"""
ORDERS_DAILY = DAILY.format(ts="o_orderdate", amount="o_totalprice")

# Every midnight from the first to the last day of the events.
TICKS = """
    SELECT UNNEST(generate_series(
        (SELECT date_trunc('day', MIN(ts)) FROM events),
        (SELECT date_trunc('day', MAX(ts)) FROM events),
        INTERVAL 1 DAY)) AS tick
"""
# A further week lets the last weekly run find the next one.
WEEK_TICKS = """
    SELECT UNNEST(generate_series(
        (SELECT date_trunc('day', MIN(ts)) FROM events),
        (SELECT date_trunc('day', MAX(ts)) FROM events) + INTERVAL 7 DAY,
        INTERVAL 1 DAY)) AS tick
"""
HOLIDAYS = "(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-15')"
AFTER_HOLIDAYS = "(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-16')"

DAILY_CALENDAR = f"""
    SELECT tick AS interval_start, tick + INTERVAL 1 DAY AS interval_end, tick AS logical_date
    FROM ({TICKS}) t
"""
CRON_INTERVAL = f"""
    SELECT interval_start, interval_end, interval_start AS logical_date
    FROM (
        SELECT tick AS interval_start, LEAD(tick) OVER (ORDER BY tick) AS interval_end
        FROM ({WEEK_TICKS}) t
        WHERE dayofweek(tick) BETWEEN 2 AND 6
    ) runs
    WHERE interval_start <= (SELECT MAX(ts) FROM events)
"""
CRON_POINT = f"""
    SELECT tick - INTERVAL 1 DAY AS interval_start, tick AS interval_end, tick AS logical_date
    FROM ({TICKS}) t
    WHERE dayofweek(tick) BETWEEN 2 AND 6
"""
BUSINESS_INTERVAL = f"""
    SELECT * FROM ({DAILY_CALENDAR}) c
    WHERE isodow(logical_date) NOT IN (6, 7) AND logical_date NOT IN {HOLIDAYS}
"""
BUSINESS_POINT = f"""
    SELECT tick - INTERVAL 1 DAY AS interval_start, tick AS interval_end, tick AS logical_date
    FROM ({TICKS}) t
    WHERE isodow(tick) NOT IN (7, 1) AND tick NOT IN {AFTER_HOLIDAYS}
"""


def interval_summary(calendar: str) -> str:
    return f"""
        SELECT interval_start, interval_end, {EVENTS_DAILY}
        FROM events JOIN ({calendar}) c ON ts >= interval_start AND ts < interval_end
        GROUP BY interval_start, interval_end, CAST(ts AS DATE)
    """


def loaded_summary(calendar: str) -> str:
    return f"SELECT summary_date, order_cnt, total_amount FROM ({interval_summary(calendar)}) s"


RUN_BOUNDS = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'"
HOURLY = "SELECT date_trunc('hour', ts) AS order_hour, COUNT(*) AS cnt FROM events"
NUMBERED = """
    SELECT row_number() OVER (ORDER BY {order}) AS id, c_name AS name, c_nationkey + 18 AS age
    FROM customer
"""

# Every hour of the events, from the first midnight to the last.
HOUR_TICKS = TICKS.replace("INTERVAL 1 DAY", "INTERVAL 1 HOUR")

CLICK_RANGES = """
    SELECT ts AS s, ts + (event_id % 91) * INTERVAL 1 MINUTE AS e
    FROM events WHERE event_type = 'click' AND ts IS NOT NULL AND event_id % 91 > 0
"""
# The wanted days leave no gap, so what is missing lies before, between and after the islands.
UNCOVERED = f"""
    WITH reached AS (
        SELECT s, e, MAX(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far
        FROM ({CLICK_RANGES}) r
    ), wanted AS (
        SELECT date_trunc('day', MIN(ts)) AS w0, date_trunc('day', MAX(ts)) + INTERVAL 1 DAY AS w1 FROM events
    ), gaps AS (
        SELECT COALESCE(so_far, w0) AS a, s AS b FROM reached, wanted WHERE so_far IS NULL OR s > so_far
        UNION ALL
        SELECT COALESCE((SELECT MAX(e) FROM ({CLICK_RANGES}) r), w0), w1 FROM wanted
    )
    SELECT GREATEST(a, w0) AS interval_start, LEAST(b, w1) AS interval_end
    FROM gaps, wanted WHERE GREATEST(a, w0) < LEAST(b, w1)
"""

PAGE_LISTING = """
    SELECT 'processed/' || string_split(url, '?')[1] || '/' || page_id || '.html' AS key,
           strlen(html)::BIGINT AS size
    FROM pages
"""

ORACLES = {
    "a1_market_json_scan": """
        SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms, value AS price FROM events
        UNION ALL
        SELECT event_id, epoch_us(ts) // 1000 + 300000, value FROM events
    """,
    "a4_select_projection": """
        SELECT c_custkey AS id, c_name AS name, c_nationkey + 18 AS age FROM customer
    """,
    "a5_full_scan": "SELECT * FROM events",
    "a6_orders_scan": "SELECT o_orderdate AS order_dt, o_totalprice AS amount FROM orders",
    "a7_values_rows": """
        SELECT c_name AS name, c_nationkey + 18 AS age FROM customer
        UNION ALL
        SELECT * FROM (VALUES ('Alice', 30), ('Bob', 25), ('Charlie', 40),
                              ('Min', 50), ('Jane', 28), ('John', 20)) v(name, age)
    """,
    "a9_current_schema": "SELECT ts AS order_dt, value AS amount FROM events",
    "a10_first_row": "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 1",
    "b1_write_csv": "SELECT * FROM events",
    "b1_csv_documents": "SELECT * REPLACE (nullif(text, '') AS text) FROM documents",
    "b2_write_parquet": "SELECT * FROM customer",
    "b3_write_dispatch": """
        SELECT c_name AS name, c_nationkey + 18 AS age, file_format
        FROM customer, (VALUES ('csv'), ('parquet')) f(file_format)
    """,
    "b4_publish_replace": "SELECT * FROM orders",
    "b5_copy_dataset": "SELECT * FROM orders",
    "b5_copy_partitioned": """
        SELECT event_id, value, lpad(CAST(event_id % 3 AS VARCHAR), 3, '0') AS code FROM events
    """,
    "b6_table_to_lake": "SELECT ts AS order_dt, value AS amount FROM events",
    "b7_partitioned_by_run_date": """
        SELECT event_id,
               CASE WHEN ts < TIMESTAMP '2024-01-11' THEN -value ELSE value END AS value,
               CAST(ts AS DATE) AS run_date
        FROM events
    """,
    "b8_recreate_users": NUMBERED.format(order="c_custkey"),
    "b9_insert_with_ids": NUMBERED.format(order="c_mktsegment <> 'BUILDING', c_custkey"),
    "b10_create_summary": f"""
        SELECT {ORDERS_DAILY} FROM orders
        WHERE o_orderdate IS NOT NULL GROUP BY CAST(o_orderdate AS DATE)
    """,
    "b11_upsert_summary": f"""
        WITH early AS (
            SELECT {EVENTS_DAILY} FROM events WHERE event_type <> 'error' GROUP BY 1
        ), mended AS (
            SELECT {EVENTS_DAILY} FROM events
            WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1
        )
        SELECT COALESCE(mended.summary_date, early.summary_date) AS summary_date,
               COALESCE(mended.order_cnt, early.order_cnt) AS order_cnt,
               COALESCE(mended.total_amount, early.total_amount) AS total_amount,
               CASE WHEN early.summary_date IS NULL
                    THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS created_at,
               CASE WHEN mended.summary_date IS NULL
                    THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS updated_at
        FROM early FULL JOIN mended ON early.summary_date = mended.summary_date
    """,
    "b12_merge_actions": """
        SELECT CAST(o_orderdate AS DATE) AS summary_date,
               CASE WHEN NOT bool_or(o_orderpriority = '5-LOW') THEN 'keep'
                    WHEN NOT bool_or(o_orderpriority = '1-URGENT') THEN 'insert'
                    ELSE 'update' END AS action
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
        GROUP BY CAST(o_orderdate AS DATE)
    """,
    "b13_constraint_violations": """
        SELECT 'unique' AS rule, 'user_id' AS column_name,
               COUNT(user_id) - COUNT(DISTINCT user_id) AS violations FROM events
        UNION ALL
        SELECT 'not_null', 'ts', COUNT(*) - COUNT(ts) FROM events
        UNION ALL
        SELECT 'not_null', 'value', COUNT(*) - COUNT(value) FROM events
        UNION ALL
        SELECT 'max_length', 'event_type', COUNT(*) FROM events WHERE length(event_type) > 5
        UNION ALL
        SELECT 'numeric', 'value', COUNT(*) FROM events
        WHERE round(abs(CAST(value AS DECIMAL(38,10))), 2) >= 100
    """,
    "b13_extreme_values": """
        SELECT 'numeric' AS rule, 'value' AS column_name, count(*) AS violations FROM events
        WHERE CASE event_id % 4 WHEN 0 THEN abs(value * 1e30) >= 1e16 WHEN 3 THEN abs(value) >= 1e16
              ELSE event_id IS NOT NULL END
    """,
    "c4_half_open_filter": """
        SELECT event_id, ts, value FROM events
        WHERE ts >= TIMESTAMP '2024-01-05 09:00:00' AND ts < TIMESTAMP '2024-01-20 18:30:00'
    """,
    "c5_point_window_filter": """
        SELECT event_id, ts, value FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'
    """,
    "c6_request_range_filter": """
        SELECT event_id, ts FROM events
        WHERE ts <= date_trunc('day', ts) + INTERVAL 1439 MINUTE
    """,
    "c7_weekday_filter": "SELECT event_id, ts FROM events WHERE isodow(ts) IN (6, 7)",
    "c8_no_rows_no_summary": interval_summary(DAILY_CALENDAR),
    "d1_market_three_way_join": """
        WITH moments AS MATERIALIZED (
            SELECT row_number() OVER () AS payload_id, event_id,
                   epoch_us(ts) // 1000 AS ms, value, user_id, event_type
            FROM events
        ), two AS (
            SELECT payload_id, event_id, ms, value, user_id FROM moments
            UNION ALL
            SELECT payload_id, event_id, ms + 300000, value, user_id FROM moments
        ), caps AS (
            SELECT payload_id, ms, CAST(event_id AS DOUBLE) AS market_cap
            FROM moments WHERE event_type <> 'error'
        )
        SELECT p.event_id, epoch_ms(p.ms) AS datetime, p.value AS price,
               CAST(v.user_id AS DOUBLE) AS volume, m.market_cap
        FROM two p
        JOIN two v ON p.payload_id = v.payload_id AND p.ms = v.ms
        JOIN caps m ON p.payload_id = m.payload_id AND p.ms = m.ms
    """,
    "d2_interval_join": f"""
        SELECT event_id, ts, interval_start, interval_end
        FROM events JOIN ({CRON_INTERVAL}) c ON ts >= interval_start AND ts < interval_end
    """,
    "d3_holiday_anti_join": f"""
        SELECT * FROM ({DAILY_CALENDAR}) c WHERE logical_date NOT IN {HOLIDAYS}
    """,
    "d4_missing_intervals": """
        WITH days AS (
            SELECT UNNEST(generate_series(
                (SELECT MIN(o_orderdate) FROM orders), (SELECT MAX(o_orderdate) FROM orders),
                INTERVAL 1 DAY)) AS tick
        )
        SELECT tick AS interval_start, tick + INTERVAL 1 DAY AS interval_end, tick AS logical_date
        FROM days
        WHERE NOT EXISTS (
            SELECT 1 FROM orders
            WHERE o_orderpriority = '1-URGENT' AND date_trunc('day', o_orderdate) = tick
        )
    """,
    "e1_daily_summary": ALL_DAYS,
    "d4_uncovered_ranges": UNCOVERED,
    "d4_partly_covered": f"""
        SELECT tick AS interval_start, tick + INTERVAL 1 HOUR AS interval_end, tick AS logical_date
        FROM ({HOUR_TICKS}) t
        WHERE EXISTS (
            SELECT 1 FROM ({UNCOVERED}) u
            WHERE u.interval_start < t.tick + INTERVAL 1 HOUR AND u.interval_end > t.tick
        )
    """,
    "a8_keys_by_prefix": f"SELECT * FROM ({PAGE_LISTING}) p WHERE key LIKE 'processed/https://%'",
    "a8_listing_roll_up": f"""
        SELECT CASE WHEN goes_on THEN host || '/' ELSE key END AS entry, goes_on AS is_folder,
               COUNT(*) AS objects, CAST(SUM(size) AS BIGINT) AS size
        FROM (
            SELECT *, 'processed/https://' || string_split(key[19:], '/')[1] AS host,
                   contains(key[19:], '/') AS goes_on
            FROM ({PAGE_LISTING}) p WHERE key LIKE 'processed/https://%'
        ) h GROUP BY 1, 2
    """,
    "a8_listing_changes": f"""
        WITH old AS (SELECT * FROM ({PAGE_LISTING}) p WHERE size % 5 > 0),
        new AS (
            SELECT key, size + CASE WHEN size % 3 = 0 THEN 1 ELSE 0 END AS size
            FROM ({PAGE_LISTING}) p WHERE size % 7 > 0
        )
        SELECT key, CASE WHEN old.size IS NULL THEN 'added' WHEN new.size IS NULL THEN 'gone' ELSE 'changed' END AS change,
               COALESCE(new.size, old.size) AS size
        FROM old FULL OUTER JOIN new USING (key) WHERE old.size IS DISTINCT FROM new.size
    """,
    "b13_key_against_table": """
        SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    """,
    "d4_catch_up_ranges": f"""
        WITH marked AS (
            SELECT *, ts >= TIMESTAMP '2024-01-07' AND ts < TIMESTAMP '2024-01-14' AS from_first
            FROM events WHERE ts IS NOT NULL
        )
        SELECT {EVENTS_DAILY}, from_first FROM marked
        WHERE NOT (from_first AND event_type = 'error')
        GROUP BY CAST(ts AS DATE), from_first
    """,
    "d4_catch_up_summary": f"""
        SELECT summary_date, order_cnt, total_amount,
               isodow(summary_date) IN (6, 7) AS from_first,
               isodow(summary_date) IN (6, 7) AS left_alone
        FROM ({ALL_DAYS}) d
    """,
    "e1_zoned_daily_summary": f"""
        SELECT {DAILY.format(ts="ts + INTERVAL 9 HOUR", amount="value")}
        FROM events WHERE ts IS NOT NULL GROUP BY CAST(ts + INTERVAL 9 HOUR AS DATE)
    """,
    "e2_hourly_count": f"{HOURLY} WHERE ts IS NOT NULL GROUP BY 1",
    "e4_backfill_summary": interval_summary(CRON_INTERVAL),
    "e4_sliding_summary": f"""
        SELECT tick - INTERVAL 30 DAY AS interval_start, tick AS interval_end, COUNT(*) AS order_cnt,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
        FROM ({HOUR_TICKS}) t JOIN events ON ts >= tick - INTERVAL 30 DAY AND ts < tick
        GROUP BY tick
    """,
    "e4_overlapping_days": interval_summary(f"""
        SELECT tick - INTERVAL 60 HOUR AS interval_start, tick AS interval_end
        FROM ({HOUR_TICKS}) t WHERE hour(tick) % 6 = 0
    """),
    "f2_latest_interval": f"""
        SELECT * FROM ({DAILY_CALENDAR}) c
        WHERE interval_end <= (SELECT MAX(ts) FROM events)
        ORDER BY interval_start DESC LIMIT 1
    """,
    "f3_last_interval_wins": f"""
        WITH calendar AS (
            SELECT interval_start, interval_end FROM ({DAILY_CALENDAR}) c
            UNION ALL
            SELECT interval_start + INTERVAL 12 HOUR, interval_end + INTERVAL 12 HOUR
            FROM ({DAILY_CALENDAR}) c
        )
        SELECT summary_date, order_cnt, total_amount
        FROM ({interval_summary("SELECT * FROM calendar")}) s
        QUALIFY row_number() OVER (PARTITION BY summary_date ORDER BY interval_start DESC) = 1
    """,
    "h1_daily_calendar": DAILY_CALENDAR,
    "h2_cron_interval_calendar": CRON_INTERVAL,
    "h3_cron_point_calendar": CRON_POINT,
    "h4_business_interval_calendar": BUSINESS_INTERVAL,
    "h5_business_point_calendar": BUSINESS_POINT,
    "h6_summary_cron_interval": loaded_summary(CRON_INTERVAL),
    "h6_summary_cron_point": loaded_summary(CRON_POINT),
    "h6_summary_business_interval": loaded_summary(BUSINESS_INTERVAL),
    "h6_summary_business_point": loaded_summary(BUSINESS_POINT),
    "i3_epoch_ms": """
        SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_ms(epoch_us(ts) // 1000) AS datetime
        FROM events
    """,
    "i4_zone_convert": "SELECT event_id, ts + INTERVAL 9 HOUR AS local_ts FROM events",
    "i5_date_format": """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS dashed, strftime(ts, '%Y%m%d') AS compact
        FROM events
    """,
    "i6_run_date_strings": """
        SELECT event_id, strftime(utc, '%Y-%m-%d') AS ds, strftime(utc, '%Y%m%d') AS ds_nodash,
               strftime(utc, '%Y-%m-%dT%H:%M:%S')
                   || CASE WHEN microsecond(utc) % 1000000 = 0 THEN ''
                           ELSE strftime(utc, '.%f') END || '+00:00' AS ts,
               strftime(utc, '%Y%m%dT%H%M%S') AS ts_nodash
        FROM (SELECT event_id, ts - INTERVAL 9 HOUR AS utc FROM events) e
    """,
    "i10_object_key": """
        SELECT page_id, 'processed/' || split_part(split_part(url, '?', 1), '/', -1) AS object_key
        FROM pages
    """,
    "i11_strip_query": "SELECT page_id, split_part(url, '?', 1) AS uri FROM pages",
    "j1_param_hourly_count": f"{HOURLY} WHERE {RUN_BOUNDS} GROUP BY 1",
    "j1_declared_parameters": f"{HOURLY} WHERE {RUN_BOUNDS} GROUP BY 1",
    "j2_param_equals_inline": f"""
        SELECT order_hour, cnt, cnt AS inline_cnt
        FROM ({HOURLY} WHERE {RUN_BOUNDS} GROUP BY 1) h
    """,
    "j3_sql_file_summary": f"""
        SELECT {EVENTS_DAILY} FROM events WHERE {RUN_BOUNDS} GROUP BY CAST(ts AS DATE)
    """,
    "j3_zoned_sql_file_summary": f"""
        SELECT {DAILY.format(ts="ts + INTERVAL 9 HOUR", amount="value")}
        FROM events WHERE ts >= TIMESTAMP '2024-01-04 15:00:00' AND ts < TIMESTAMP '2024-01-24 15:00:00'
        GROUP BY CAST(ts + INTERVAL 9 HOUR AS DATE)
    """,
    "j4_query_to_files": f"{HOURLY} WHERE {RUN_BOUNDS} GROUP BY 1",
    "j5_summary_load_from_file": f"""
        SELECT {EVENTS_DAILY} FROM events WHERE {RUN_BOUNDS} GROUP BY CAST(ts AS DATE)
    """,
    "h2_cron_text": """
        WITH ticks AS (
            SELECT UNNEST(generate_series(
                (SELECT date_trunc('day', MIN(ts)) FROM events),
                (SELECT date_trunc('day', MAX(ts)) FROM events) + INTERVAL 40 DAY,
                INTERVAL 30 MINUTE)) AS tick
        ), runs AS (
            SELECT tick AS interval_start, LEAD(tick) OVER (ORDER BY tick) AS interval_end
            FROM ticks
            WHERE minute(tick) = 30 AND hour(tick) IN (6, 18)
              AND (day(tick) IN (1, 3, 5, 7, 9, 11, 13, 15) OR isodow(tick) = 1)
        )
        SELECT interval_start, interval_end, interval_start AS logical_date FROM runs
        WHERE interval_start <= (SELECT date_trunc('day', MAX(ts)) FROM events)
    """,
    "h3_cron_text_points": CRON_POINT,
    "b12_merge_into": """
        WITH first AS (
            SELECT o_custkey, o_orderpriority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
            FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey, o_orderpriority
        ), later AS (
            SELECT o_custkey, o_orderpriority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
            FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' GROUP BY o_custkey, o_orderpriority
        ), loads AS (
            SELECT TIMESTAMP '2024-02-01 00:00:00' AS one, TIMESTAMP '2024-02-02 00:00:00' AS two
        )
        SELECT o_custkey, o_orderpriority, COALESCE(l.n, f.n) AS order_cnt, COALESCE(l.total, f.total) AS total_amount,
               CASE WHEN f.n IS NULL THEN two ELSE one END AS created_at,
               CASE WHEN l.n IS NULL THEN one ELSE two END AS updated_at
        FROM first f FULL OUTER JOIN later l USING (o_custkey, o_orderpriority), loads
    """,
    "b7_sized_files": "SELECT *, CAST(date_trunc('year', o_orderdate) AS DATE) AS run_date FROM orders",
    "b14_atomic_upsert": f"""
        WITH urgent AS (
            SELECT {ORDERS_DAILY} FROM orders
            WHERE o_orderdate IS NOT NULL AND o_orderpriority = '1-URGENT' GROUP BY CAST(o_orderdate AS DATE)
        ), mended AS (
            SELECT {ORDERS_DAILY} FROM orders
            WHERE o_orderdate >= DATE '1996-07-01' AND o_orderdate < DATE '1998-07-01'
            GROUP BY CAST(o_orderdate AS DATE)
        ), loads AS (
            SELECT TIMESTAMP '2024-02-01 00:00:00' AS one, TIMESTAMP '2024-02-02 00:00:00' AS two
        )
        SELECT 1 AS version, u.*, one AS created_at, one AS updated_at FROM urgent u, loads
        UNION ALL
        SELECT 2, summary_date, COALESCE(m.order_cnt, u.order_cnt), COALESCE(m.total_amount, u.total_amount),
               CASE WHEN u.order_cnt IS NULL THEN two ELSE one END,
               CASE WHEN m.order_cnt IS NULL THEN one ELSE two END
        FROM urgent u FULL OUTER JOIN mended m USING (summary_date), loads
    """,
    "k1_incremental_daily_summary": ALL_DAYS,
}

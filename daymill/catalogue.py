"""The registered queries: each operator run over the given tables.

``events`` stands for the orders table where the time of day matters and
``orders`` where a long history does; ``customer`` stands for users. Queries
that write do so below the shared folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import clock, text
from daymill.operators import coverage, filters, intervals, keys, market, summaries, upsert
from daymill.operators.constraints import constraint_report
from daymill.plans import calendars, cron, loads, parameters, sql_files, tables
from daymill.session import scratch_path
from daymill.sinks import files, sized, snapshots
from daymill.sources import listings, market_json, objects
from daymill.sources.tables import (
    current_schema,
    ensure_schema,
    first_row,
    full_scan,
    register_orders,
    scan_orders,
    session_zone,
)
from daymill.streaming.incremental import run_incremental_summary

SEOUL = "Asia/Seoul"
CRON_TUE_SAT = range(2, 7)
HOLIDAYS = (date(2024, 1, 1), date(2024, 1, 15))
FIRST_LOAD = datetime(2024, 2, 1, tzinfo=timezone.utc)
SECOND_LOAD = datetime(2024, 2, 2, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return full_scan(spark, f"{sf_dir}/{name}.parquet")


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` under the column names of orders."""
    events = table(spark, sf_dir, "events")
    return events.withColumnsRenamed({"ts": "order_dt", "value": "amount"})


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` under the column names of orders."""
    orders = table(spark, sf_dir, "orders")
    return orders.withColumnsRenamed({"o_orderdate": "order_dt", "o_totalprice": "amount"})


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as users, with the key they are numbered by."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") + 18).alias("age"),
    )


def fresh_schema(spark: SparkSession, name: str) -> str:
    schema = f"daymill_{name}_{uuid.uuid4().hex}"
    ensure_schema(spark, schema, scratch_path(spark, name))
    return schema


def stage_schema(spark: SparkSession, sf_dir: str) -> str:
    """A schema whose ``orders`` view reads ``events``."""
    schema = fresh_schema(spark, "stage")
    register_orders(spark, schema, f"{sf_dir}/events.parquet", "ts", "value")
    return schema


def measures(summary: DataFrame) -> DataFrame:
    return summary.select("summary_date", "order_cnt", "total_amount")


# A. Sources


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price-feed payloads from ``events``, landed as JSON and read back.

    One payload per event, of two moments five minutes apart. The market cap
    is given for the first only, and for error events not at all. Payloads
    have a number of their own, as events may be copies of each other.
    """
    ms = clock.epoch_ms("ts").cast("double")

    def points(value: str) -> list:
        point = F.col(value).cast("double")
        return [F.array(ms, point), F.array(ms + 300_000, point)]

    nothing = F.array().cast("array<array<double>>")
    payload = table(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                F.monotonically_increasing_id().alias("payload_id"),
                "event_id",
                F.array(*points("value")).alias("prices"),
                F.array(*points("user_id")).alias("total_volumes"),
                F.when(F.col("event_type") == "error", nothing)
                .otherwise(F.array(points("event_id")[0]))
                .alias("market_caps"),
            )
        )
    )
    path = scratch_path(spark, "payloads")
    payload.write.text(path)
    return market_json.read_payloads(spark, path, keys="payload_id BIGINT, event_id BIGINT")


@registered
def a1_market_json_scan(spark, sf_dir):
    payloads = landed_payloads(spark, sf_dir)
    return market.explode_series(payloads, "prices", "price", keys=["event_id"])


@registered
def a4_select_projection(spark, sf_dir):
    return sql_files.run_query(
        spark,
        "SELECT c_custkey AS id, c_name AS name, c_nationkey + 18 AS age "
        f"FROM parquet.`{sf_dir}/customer.parquet`",
    )


@registered
def a5_full_scan(spark, sf_dir):
    return table(spark, sf_dir, "events")


@registered
def a6_orders_scan(spark, sf_dir):
    schema = fresh_schema(spark, "orders_scan")
    register_orders(spark, schema, f"{sf_dir}/orders.parquet", "o_orderdate", "o_totalprice")
    return scan_orders(spark, schema)


@registered
def a7_values_rows(spark, sf_dir):
    return users(spark, sf_dir).select("name", "age").unionByName(tables.sample_users(spark))


@registered
def a8_list_objects(spark, sf_dir):
    return objects.list_objects(spark, sf_dir, "*.parquet")


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as stored objects: a key made of the address and the page's number."""
    key = F.concat_ws("/", F.lit("processed"), text.strip_query("url"), F.concat("page_id", F.lit(".html")))
    return table(spark, sf_dir, "pages").select(key.alias("key"), F.octet_length("html").cast("bigint").alias("size"))


@registered
def a8_keys_by_prefix(spark, sf_dir):
    """What lies below the secure pages, from a listing that is kept in order."""
    path = listings.write_listing(page_listing(spark, sf_dir), scratch_path(spark, "listing"))
    return listings.keys_by_prefix(listings.read_listing(spark, path), "processed/https://")


@registered
def a8_listing_roll_up(spark, sf_dir):
    """Hosts, as folders, with their objects and bytes."""
    return listings.rolled_up(page_listing(spark, sf_dir), "processed/https://")


@registered
def a8_listing_changes(spark, sf_dir):
    """Some pages came, some went, and every third of the others by size grew."""
    pages = page_listing(spark, sf_dir)
    before, after = pages.where("size % 5 > 0"), pages.where("size % 7 > 0")
    grown = after.withColumn("size", F.when(F.col("size") % 3 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return listings.listing_changes(before, grown)


@registered
def a9_current_schema(spark, sf_dir):
    with current_schema(spark, stage_schema(spark, sf_dir)):
        return spark.table("orders")


@registered
def a10_first_row(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return first_row(events, "ts", "event_id")


@registered
def a10_session_tz(spark, sf_dir):
    bounds = calendars.data_bounds(table(spark, sf_dir, "events"), "ts")
    return bounds.select(session_zone(), "first", "last")


# B. Sinks and tables


@registered
def b1_write_csv(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = files.write_csv(events, scratch_path(spark, "csv"))
    return files.read_csv(spark, path, events.schema)


@registered
def b1_csv_documents(spark, sf_dir):
    """Texts with line breaks and quotes, through CSV and back."""
    docs = table(spark, sf_dir, "documents")
    return files.read_csv(spark, files.write_csv(docs, scratch_path(spark, "csv")), docs.schema)


@registered
def b2_write_parquet(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return full_scan(spark, files.write_parquet(customers, scratch_path(spark, "parquet")))


@registered
def b3_write_dispatch(spark, sf_dir):
    rows = users(spark, sf_dir).select("name", "age")
    csv = files.write_files(rows, scratch_path(spark, "dispatch"), "csv")
    parquet = files.write_files(rows, scratch_path(spark, "dispatch"), "parquet")
    back = {
        "csv": files.read_csv(spark, csv, "name STRING, age INT"),
        "parquet": full_scan(spark, parquet),
    }
    csv_rows, parquet_rows = (
        frame.withColumn("file_format", F.lit(name)) for name, frame in back.items()
    )
    return csv_rows.unionByName(parquet_rows)


@registered
def b4_publish_replace(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    uri = scratch_path(spark, "publish")
    files.publish(orders.where("o_orderstatus = 'F'"), uri, replace=False)
    files.publish(orders, uri, replace=True)
    return full_scan(spark, uri)


@registered
def b5_copy_dataset(spark, sf_dir):
    processed = scratch_path(spark, "processed")
    files.copy_dataset(spark, f"{sf_dir}/orders.parquet", processed)
    return full_scan(spark, processed)


@registered
def b5_copy_partitioned(spark, sf_dir):
    """A dataset in folders whose names look like numbers, copied."""
    events = table(spark, sf_dir, "events").select("event_id", "value", F.lpad((F.col("event_id") % 3).cast("string"), 3, "0").alias("code"))
    source, target = scratch_path(spark, "coded"), scratch_path(spark, "copied")
    events.write.partitionBy("code").parquet(source)
    files.copy_dataset(spark, source, target)
    return spark.read.schema(events.schema).parquet(target)


@registered
def b6_table_to_lake(spark, sf_dir):
    rows = scan_orders(spark, stage_schema(spark, sf_dir))
    return full_scan(spark, loads.table_to_lake(rows, scratch_path(spark, "lake")))


@registered
def b7_partitioned_by_run_date(spark, sf_dir):
    """All dates are written, then those before 11 January again, with the sign changed."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", F.to_date("ts").alias("run_date")
    )
    path = scratch_path(spark, "run_date")
    files.write_by_run_date(events, path)
    rerun = events.where("run_date < DATE '2024-01-11'").withColumn("value", -F.col("value"))
    files.write_by_run_date(rerun, path)
    return full_scan(spark, path).select("event_id", "value", "run_date")


@registered
def b7_sized_files(spark, sf_dir):
    """Orders by year of their date, in files of half a megabyte."""
    orders = table(spark, sf_dir, "orders").withColumn("run_date", F.trunc("o_orderdate", "year"))
    path = sized.write_sized(orders, scratch_path(spark, "sized"), target_bytes=1 << 19)
    return full_scan(spark, path)


@registered
def b8_recreate_users(spark, sf_dir):
    name = f"{fresh_schema(spark, 'recreate')}.users"
    everyone = users(spark, sf_dir)
    tables.recreate_users(spark, name)
    tables.insert_users(everyone.where("c_mktsegment = 'BUILDING'"), name, ["c_custkey"])
    tables.recreate_users(spark, name)
    tables.insert_users(everyone, name, ["c_custkey"])
    return spark.table(name).select("id", "name", "age")


@registered
def b9_insert_with_ids(spark, sf_dir):
    name = f"{fresh_schema(spark, 'insert')}.users"
    everyone = users(spark, sf_dir)
    tables.recreate_users(spark, name)
    tables.insert_users(everyone.where("c_mktsegment = 'BUILDING'"), name, ["c_custkey"])
    tables.insert_users(everyone.where("c_mktsegment <> 'BUILDING'"), name, ["c_custkey"])
    return spark.table(name).select("id", "name", "age")


@registered
def b10_create_summary(spark, sf_dir):
    """Creating the table once more must leave its rows alone."""
    name = f"{fresh_schema(spark, 'create')}.orders_daily_summary"
    tables.create_summary(spark, name)
    upsert.upsert_table(summaries.daily_summary(dated_orders(spark, sf_dir)), name)
    tables.create_summary(spark, name)
    return measures(tables.read_summary(spark, name))


@registered
def b11_upsert_summary(spark, sf_dir):
    """A first load misses the errors; a second mends ten days of it, and is run twice."""
    name = f"{fresh_schema(spark, 'upsert')}.orders_daily_summary"
    facts = event_orders(spark, sf_dir)
    tables.create_summary(spark, name)
    early = summaries.daily_summary(facts.where("event_type <> 'error'"))
    upsert.upsert_table(early, name, as_of=FIRST_LOAD)
    mended = summaries.daily_summary(facts, start=date(2024, 1, 10), end=date(2024, 1, 20))
    for _ in range(2):
        upsert.upsert_table(mended, name, as_of=SECOND_LOAD)
    return tables.read_summary(spark, name).select(
        "summary_date",
        "order_cnt",
        "total_amount",
        clock.instant_to_wall("created_at").alias("created_at"),
        clock.instant_to_wall("updated_at").alias("updated_at"),
    )


@registered
def b14_atomic_upsert(spark, sf_dir):
    """Urgent orders first, then all orders of two years: the newest version and the one before."""
    path, orders = scratch_path(spark, "snapshot"), dated_orders(spark, sf_dir)
    urgent = summaries.daily_summary(orders.where("o_orderpriority = '1-URGENT'"))
    upsert.upsert_snapshot(urgent, path, as_of=FIRST_LOAD)
    mended = summaries.daily_summary(orders, start=date(1996, 7, 1), end=date(1998, 7, 1))
    upsert.upsert_snapshot(mended, path, as_of=SECOND_LOAD)
    of_version = [
        snapshots.read_snapshot(spark, path, v).withColumn("version", F.lit(v)) for v in (1, 2)
    ]
    return of_version[0].unionByName(of_version[1]).select(
        "version", "summary_date", "order_cnt", "total_amount",
        clock.instant_to_wall("created_at").alias("created_at"),
        clock.instant_to_wall("updated_at").alias("updated_at"),
    )


@registered
def b12_merge_into(spark, sf_dir):
    """Finished orders first, then all orders of urgent customers, by customer and priority."""
    path, orders = scratch_path(spark, "merged"), table(spark, sf_dir, "orders")
    keyed = ["o_custkey", "o_orderpriority"]

    def totals(rows: DataFrame) -> DataFrame:
        total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)")
        return rows.groupBy(*keyed).agg(F.count("*").alias("order_cnt"), total.alias("total_amount"))

    upsert.merge_into(totals(orders.where("o_orderstatus = 'F'")), path, keyed, upsert.MEASURES, FIRST_LOAD)
    later = orders.where("o_orderpriority = '1-URGENT' OR o_orderstatus = 'P'")
    upsert.merge_into(totals(later), path, keyed, upsert.MEASURES, SECOND_LOAD)
    return snapshots.read_snapshot(spark, path).select(
        *keyed, "order_cnt", "total_amount",
        clock.instant_to_wall("created_at").alias("created_at"),
        clock.instant_to_wall("updated_at").alias("updated_at"),
    )


@registered
def b12_merge_actions(spark, sf_dir):
    orders = dated_orders(spark, sf_dir)
    urgent = summaries.daily_summary(orders.where("o_orderpriority = '1-URGENT'"))
    low = summaries.daily_summary(orders.where("o_orderpriority = '5-LOW'"))
    return upsert.merge_actions(urgent, low)


@registered
def b13_extreme_values(spark, sf_dir):
    """Values beyond any decimal, infinite, or no number are counted, not raised."""
    kind, value = F.col("event_id") % 4, F.col("value")
    extreme = (
        F.when(kind == 0, value * 1e30).when(kind == 1, F.lit(float("nan")))
        .when(kind == 2, F.lit(float("inf"))).otherwise(value)
    )
    events = table(spark, sf_dir, "events").select(extreme.alias("value"))
    return constraint_report(events, numeric={"value": (18, 2)})


@registered
def b13_key_against_table(spark, sf_dir):
    """Finished orders, of which some are in the table of urgent ones already."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    stored = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    finished = orders.join(
        table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey", "left_semi"
    )
    return keys.present_keys(finished, "o_orderkey", keys.key_bitmaps(stored, "o_orderkey"))


@registered
def b13_constraint_violations(spark, sf_dir):
    return constraint_report(
        table(spark, sf_dir, "events"),
        key="user_id",
        not_null=("ts", "value"),
        max_length={"event_type": 5},
        numeric={"value": (4, 2)},
    )


# C. Filters


@registered
def c4_half_open_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return filters.half_open(events, "ts", "2024-01-05 09:00:00", "2024-01-20 18:30:00")


@registered
def c5_point_window_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return filters.point_window(events, "ts", date(2024, 1, 16))


@registered
def c6_request_range_filter(spark, sf_dir):
    """One request for each day that the data has."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    ends = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return filters.request_range(events, "ts", *ends) if ends[0] else events


@registered
def c7_weekday_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return filters.on_weekdays(events, "ts", (clock.SATURDAY, clock.SUNDAY))


@registered
def c8_no_rows_no_summary(spark, sf_dir):
    """The calendar reaches ten days beyond the data on both sides."""
    facts = event_orders(spark, sf_dir)
    bounds = calendars.observed_bounds(facts, "order_dt").select(
        (F.col("first") - F.expr("INTERVAL 10 DAY")).alias("first"),
        (F.col("last") + F.expr("INTERVAL 10 DAY")).alias("last"),
    )
    return summaries.interval_summary(facts, calendars.daily_calendar(bounds))


# D. Joins


@registered
def d1_market_three_way_join(spark, sf_dir):
    payloads = landed_payloads(spark, sf_dir)
    frame = market.build_coin_frame(payloads, keys=["event_id"])
    return frame.withColumn("datetime", clock.instant_to_wall("datetime"))


@registered
def d2_interval_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    bounds = calendars.observed_bounds(events, "ts")
    calendar = calendars.cron_interval_calendar(bounds, CRON_TUE_SAT)
    return intervals.interval_join(events, calendar, "ts")


@registered
def d3_holiday_anti_join(spark, sf_dir):
    bounds = calendars.data_bounds(table(spark, sf_dir, "events"), "ts")
    return calendars.drop_holidays(calendars.daily_calendar(bounds), HOLIDAYS)


@registered
def d4_missing_intervals(spark, sf_dir):
    """Days without an urgent order, as if only those had been processed."""
    orders = dated_orders(spark, sf_dir)
    calendar = calendars.daily_calendar(calendars.data_bounds(orders, "order_dt"))
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    done = urgent.select(clock.day_start(F.col("order_dt")).alias("interval_start")).distinct()
    return calendars.missing_intervals(calendar, done)


def click_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to an hour and a half after each click, as if that had been processed: ranges overlap, nest and touch."""
    clicks = table(spark, sf_dir, "events").where("event_type = 'click'")
    length = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 91).cast("int"))
    return clicks.select(F.col("ts").alias("interval_start"), (F.col("ts") + length).alias("interval_end"))


@registered
def d4_uncovered_ranges(spark, sf_dir):
    wanted = calendars.daily_calendar(event_bounds(spark, sf_dir))
    return coverage.uncovered_ranges(wanted, click_ranges(spark, sf_dir))


@registered
def d4_partly_covered(spark, sf_dir):
    """Hours that were not processed, or not as a whole."""
    hours = cron.cron_calendar(event_bounds(spark, sf_dir), "@hourly")
    return coverage.not_covered(hours, click_ranges(spark, sf_dir))


@registered
def d4_catch_up_summary(spark, sf_dir):
    """Weekends are processed first; the catch-up finds all other days."""
    facts = event_orders(spark, sf_dir)
    calendar = calendars.daily_calendar(calendars.observed_bounds(facts, "order_dt"))
    schema = fresh_schema(spark, "catch_up")
    target, processed = f"{schema}.orders_daily_summary", f"{schema}.processed"
    weekends = calendar.where(clock.is_weekend("logical_date"))
    for intervals_so_far, as_of in ((weekends, FIRST_LOAD), (calendar, SECOND_LOAD)):
        loads.catch_up(facts, intervals_so_far, target, processed, as_of=as_of)
    return tables.read_summary(spark, target).select(
        "summary_date", "order_cnt", "total_amount",
        (F.col("created_at") == F.lit(FIRST_LOAD)).alias("from_first"),
        (F.col("updated_at") == F.lit(FIRST_LOAD)).alias("left_alone"),
    )


@registered
def d4_catch_up_ranges(spark, sf_dir):
    """A week was loaded before errors came in; a catch-up by days then finds the rest."""
    facts, path = event_orders(spark, sf_dir), scratch_path(spark, "caught_up")
    weeks = cron.cron_calendar(
        calendars.fixed_bounds(spark, date(2024, 1, 1), date(2024, 1, 8)), "@weekly"
    )
    loads.catch_up_snapshot(facts.where("event_type <> 'error'"), weeks, path, as_of=FIRST_LOAD)
    days = calendars.daily_calendar(calendars.observed_bounds(facts, "order_dt"))
    loads.catch_up_snapshot(facts, days, path, as_of=SECOND_LOAD)
    return snapshots.read_snapshot(spark, path).select(
        "summary_date", "order_cnt", "total_amount",
        (F.col("created_at") == F.lit(FIRST_LOAD)).alias("from_first"),
    )


# E. Aggregations


@registered
def e1_daily_summary(spark, sf_dir):
    return summaries.daily_summary(event_orders(spark, sf_dir))


@registered
def e1_zoned_daily_summary(spark, sf_dir):
    """Times read as UTC instants, summed up by the date in Seoul."""
    instants = event_orders(spark, sf_dir).select(
        clock.epoch_ms_to_instant(clock.epoch_ms("order_dt")).alias("order_dt"), "amount"
    )
    return summaries.daily_summary(instants, zone=SEOUL)


@registered
def e2_hourly_count(spark, sf_dir):
    return summaries.hourly_count(event_orders(spark, sf_dir))


@registered
def e4_backfill_summary(spark, sf_dir):
    facts = event_orders(spark, sf_dir)
    bounds = calendars.observed_bounds(facts, "order_dt")
    calendar = calendars.cron_interval_calendar(bounds, CRON_TUE_SAT)
    return summaries.interval_summary(facts, calendar)


@registered
def e4_sliding_summary(spark, sf_dir):
    """Every hour, the thirty days up to it."""
    facts = event_orders(spark, sf_dir)
    bounds = calendars.observed_bounds(facts, "order_dt")
    windows = cron.cron_window_calendar(bounds, "0 * * * *", "30 DAY")
    return summaries.interval_totals(facts, windows)


@registered
def e4_overlapping_days(spark, sf_dir):
    """Every quarter of a day, the days of the sixty hours up to it."""
    facts = event_orders(spark, sf_dir)
    bounds = calendars.observed_bounds(facts, "order_dt")
    windows = cron.cron_window_calendar(bounds, "0 */6 * * *", "60 HOUR")
    return summaries.interval_summary(facts, windows)


# F. Windows and top-k


@registered
def f2_latest_interval(spark, sf_dir):
    """The last day that was over when the last event came."""
    events = table(spark, sf_dir, "events").where("ts IS NOT NULL")
    span = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    calendar = calendars.daily_calendar(
        span.select(clock.day_start(F.col("first")).alias("first"), "last")
    )
    return calendars.latest_interval(calendar, span.select("last").scalar())


@registered
def f3_last_interval_wins(spark, sf_dir):
    """Days from midnight and days from noon, which overlap."""
    facts = event_orders(spark, sf_dir)
    daily = calendars.daily_calendar(calendars.observed_bounds(facts, "order_dt"))
    half_a_day = F.expr("INTERVAL 12 HOUR")
    from_noon = daily.select(*((F.col(c) + half_a_day).alias(c) for c in calendars.COLUMNS))
    overlapping = summaries.interval_summary(facts, daily.unionByName(from_noon))
    return summaries.last_interval_wins(overlapping)


# H. Calendars, and the summaries over them


def event_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.data_bounds(table(spark, sf_dir, "events"), "ts")


@registered
def h1_daily_calendar(spark, sf_dir):
    return calendars.daily_calendar(event_bounds(spark, sf_dir))


@registered
def h2_cron_interval_calendar(spark, sf_dir):
    return calendars.cron_interval_calendar(event_bounds(spark, sf_dir), CRON_TUE_SAT)


@registered
def h2_cron_text(spark, sf_dir):
    """Twice a day, on Mondays and on the odd days up to the fifteenth."""
    return cron.cron_calendar(event_bounds(spark, sf_dir), "30 6,18 1-15/2 * MON")


@registered
def h3_cron_text_points(spark, sf_dir):
    return cron.cron_window_calendar(event_bounds(spark, sf_dir), "0 0 * * TUE-SAT", "1 DAY")


@registered
def h3_cron_point_calendar(spark, sf_dir):
    return calendars.cron_point_calendar(event_bounds(spark, sf_dir), CRON_TUE_SAT)


@registered
def h4_business_interval_calendar(spark, sf_dir):
    return calendars.business_interval_calendar(event_bounds(spark, sf_dir), HOLIDAYS)


@registered
def h5_business_point_calendar(spark, sf_dir):
    return calendars.business_point_calendar(event_bounds(spark, sf_dir), HOLIDAYS)


def loaded_summary(spark, sf_dir, name, calendar_of) -> DataFrame:
    facts = event_orders(spark, sf_dir)
    calendar = calendar_of(calendars.observed_bounds(facts, "order_dt"))
    target = f"{fresh_schema(spark, name)}.orders_daily_summary_{name}"
    loads.load_summary(facts, calendar, target, as_of=FIRST_LOAD)
    return measures(tables.read_summary(spark, target))


@registered
def h6_summary_cron_interval(spark, sf_dir):
    return loaded_summary(
        spark, sf_dir, "interval_wd",
        lambda bounds: calendars.cron_interval_calendar(bounds, CRON_TUE_SAT),
    )


@registered
def h6_summary_cron_point(spark, sf_dir):
    return loaded_summary(
        spark, sf_dir, "point_wd",
        lambda bounds: calendars.cron_point_calendar(bounds, CRON_TUE_SAT),
    )


@registered
def h6_summary_business_interval(spark, sf_dir):
    return loaded_summary(
        spark, sf_dir, "interval_wd_skip",
        lambda bounds: calendars.business_interval_calendar(bounds, HOLIDAYS),
    )


@registered
def h6_summary_business_point(spark, sf_dir):
    return loaded_summary(
        spark, sf_dir, "point_wd_skip",
        lambda bounds: calendars.business_point_calendar(bounds, HOLIDAYS),
    )


# I. Scalar functions


@registered
def i3_epoch_ms(spark, sf_dir):
    ms = table(spark, sf_dir, "events").select("event_id", clock.epoch_ms("ts").alias("ms"))
    instant = clock.epoch_ms_to_instant("ms")
    return ms.withColumn("datetime", clock.instant_to_wall(instant))


@registered
def i4_zone_convert(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", clock.shift_zone("ts", "UTC", SEOUL).alias("local_ts"))


@registered
def i5_date_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", clock.dashed_day("ts").alias("dashed"), clock.compact_day("ts").alias("compact")
    )


@registered
def i6_run_date_strings(spark, sf_dir):
    """Event times as run dates kept in Seoul."""
    events = table(spark, sf_dir, "events")
    return events.select("event_id", *clock.run_date_strings("ts", SEOUL))


@registered
def i10_object_key(spark, sf_dir):
    key = text.object_key("processed", text.strip_query("url"))
    return table(spark, sf_dir, "pages").select("page_id", key.alias("object_key"))


@registered
def i11_strip_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", text.strip_query("url").alias("uri"))


# J. Parameterised queries

# The interval as its run sees it: UTC instants of midnights in Seoul.
RUN_START = datetime(2024, 1, 4, 15, tzinfo=timezone.utc)
RUN_END = datetime(2024, 1, 24, 15, tzinfo=timezone.utc)


def run_parameters(spark: SparkSession, sf_dir: str) -> dict:
    return {
        "src_schema": stage_schema(spark, sf_dir),
        "start": RUN_START,
        "end": RUN_END,
        "zone": SEOUL,
    }


@registered
def j1_param_hourly_count(spark, sf_dir):
    return sql_files.run_file(spark, "hourly_count", **run_parameters(spark, sf_dir))


# The same parameters, declared: the zone has a default, and moments must be moments.
DECLARED = {
    "zone": parameters.Param("string", default=SEOUL, choices=(SEOUL, "UTC")),
    "src_schema": parameters.Param("string"),
    "start": parameters.Param("moment"),
    "end": parameters.Param("moment", minimum=RUN_START),
}


@registered
def j1_declared_parameters(spark, sf_dir):
    given = {k: v for k, v in run_parameters(spark, sf_dir).items() if k != "zone"}
    return parameters.run_declared_file(spark, "hourly_count", DECLARED, **given)


@registered
def j2_param_equals_inline(spark, sf_dir):
    """The bound statement beside the same text with its values written out."""
    params = run_parameters(spark, sf_dir)
    bound = sql_files.run_file(spark, "hourly_count", **params)
    inline = spark.sql(
        f"""
        SELECT CAST(to_date(order_dt) AS TIMESTAMP_NTZ)
                 + make_dt_interval(0, hour(order_dt)) AS order_hour,
               count(*) AS inline_cnt
        FROM {params["src_schema"]}.orders
        WHERE order_dt >= TIMESTAMP_NTZ '{clock.wall_time(params["start"], SEOUL)}'
          AND order_dt < TIMESTAMP_NTZ '{clock.wall_time(params["end"], SEOUL)}'
        GROUP BY ALL
        """
    )
    return bound.join(inline, "order_hour", "full_outer")


@registered
def j3_sql_file_summary(spark, sf_dir):
    return sql_files.run_file(spark, "daily_summary", **run_parameters(spark, sf_dir))


@registered
def j3_zoned_sql_file_summary(spark, sf_dir):
    """Times read as UTC instants, summed up by the date in Seoul."""
    schema = fresh_schema(spark, "instants")
    register_orders(
        spark, schema, f"{sf_dir}/events.parquet",
        "timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', ts))", "value",
    )
    return sql_files.run_file(
        spark, "daily_summary", zone=SEOUL, instants=True, src_schema=schema, start=RUN_START, end=RUN_END
    )


@registered
def j4_query_to_files(spark, sf_dir):
    path = sql_files.query_to_files(
        spark,
        sql_files.sql_text("hourly_count"),
        scratch_path(spark, "hourly"),
        "csv",
        **run_parameters(spark, sf_dir),
    )
    return files.read_csv(spark, path, "order_hour TIMESTAMP_NTZ, cnt BIGINT")


@registered
def j5_summary_load_from_file(spark, sf_dir):
    target = f"{fresh_schema(spark, 'template')}.orders_daily_summary_for_template"
    loads.load_summary_from_file(
        spark, table=target, as_of=FIRST_LOAD, **run_parameters(spark, sf_dir)
    )
    return measures(tables.read_summary(spark, target))


# K. Streaming


@registered
def k1_incremental_daily_summary(spark, sf_dir):
    target = f"{fresh_schema(spark, 'incremental')}.orders_daily_summary"
    run_incremental_summary(
        spark,
        # A pattern, as a stream takes folders or patterns but no single file.
        source=f"{sf_dir}/events.parque[t]",
        schema=table(spark, sf_dir, "events").schema,
        table=target,
        checkpoint=scratch_path(spark, "offsets"),
        ts="ts",
        amount="value",
    )
    return measures(tables.read_summary(spark, target))

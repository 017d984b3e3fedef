from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from frames import plan_of, tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daymill.functions import clock
from daymill.operators import upsert
from daymill.operators.constraints import ConstraintViolation
from daymill.operators.summaries import daily_summary
from daymill.plans import calendars as C
from daymill.plans import loads, tables

T1, T2, T3 = (datetime(2024, 5, d, 12, tzinfo=timezone.utc) for d in (1, 2, 3))


@pytest.fixture
def target(spark, schema):
    name = f"{schema}.orders_daily_summary"
    tables.create_summary(spark, name)
    return name


def summary(spark, *rows):
    """Rows ``(day, count, total)``."""
    typed = [
        (date.fromisoformat(d), n, None if a is None else Decimal(a)) for d, n, a in rows
    ]
    return spark.createDataFrame(typed, "summary_date DATE, order_cnt BIGINT, total_amount DECIMAL(18,2)")


def stored(spark, table):
    rows = tables.read_summary(spark, table).select(
        "summary_date", "order_cnt", "total_amount",
        clock.instant_to_wall("created_at"), clock.instant_to_wall("updated_at"),
    ).orderBy("summary_date").collect()
    return [(str(r[0]), r[1], r[2], r[3].day, r[4].day) for r in rows]


def test_insert_update_and_keep(spark, target):
    upsert.upsert_table(summary(spark, ("2024-01-30", 1, 1), ("2024-01-31", 2, 2), ("2024-03-01", 3, 3)), target, as_of=T1)
    upsert.upsert_table(summary(spark, ("2024-01-31", 20, 20), ("2024-02-01", 4, 4)), target, as_of=T2)
    assert stored(spark, target) == [
        ("2024-01-30", 1, 1, 1, 1),
        ("2024-01-31", 20, 20, 1, 2),
        ("2024-02-01", 4, 4, 2, 2),
        ("2024-03-01", 3, 3, 1, 1),
    ]


def test_twice_is_once(spark, target):
    rows = summary(spark, ("2024-01-31", 2, 2), ("2024-02-01", 4, 4))
    upsert.upsert_table(rows, target, as_of=T1)
    once = stored(spark, target)
    upsert.upsert_table(rows, target, as_of=T1)
    assert stored(spark, target) == once


def test_nothing_to_upsert_changes_nothing(spark, target):
    upsert.upsert_table(summary(spark, ("2024-01-31", 2, 2)), target, as_of=T1)
    upsert.upsert_table(summary(spark), target, as_of=T2)
    assert stored(spark, target) == [("2024-01-31", 2, 2, 1, 1)]


def test_now_is_read_once(spark, target):
    upsert.upsert_table(summary(spark, ("2024-01-31", 2, 2), ("2024-02-01", 4, 4)), target)
    moments = {m for r in tables.read_summary(spark, target).collect() for m in (r.created_at, r.updated_at)}
    assert len(moments) == 1


def test_naive_clock_is_refused(spark, target):
    with pytest.raises(ValueError, match="zone"):
        upsert.upsert_table(summary(spark, ("2024-01-31", 2, 2)), target, as_of=datetime(2024, 1, 1))


@pytest.mark.parametrize("bad", [
    [("2024-01-31", 2, 2), ("2024-01-31", 3, 3)],
    [("2024-01-30", 9, 9), ("2024-01-31", 2, None)],
])
def test_a_bad_row_fails_the_whole_upsert(spark, target, bad):
    upsert.upsert_table(summary(spark, ("2024-01-30", 1, 1)), target, as_of=T1)
    with pytest.raises(ConstraintViolation):
        upsert.upsert_table(summary(spark, *bad), target, as_of=T2)
    assert stored(spark, target) == [("2024-01-30", 1, 1, 1, 1)]


def test_scratch_tables_are_dropped(spark, target):
    upsert.upsert_table(summary(spark, ("2024-01-31", 2, 2)), target)
    with pytest.raises(ConstraintViolation):
        upsert.upsert_table(summary(spark, ("2024-01-31", 2, None)), target)
    assert spark.catalog.listTables("daymill_scratch") == []


def test_a_table_that_would_lose_other_months_is_refused(spark, schema):
    name = f"{schema}.plain"
    spark.sql(
        f"CREATE TABLE {name} (summary_date DATE, order_cnt BIGINT, total_amount DECIMAL(18,2), "
        "created_at TIMESTAMP, updated_at TIMESTAMP, summary_month STRING) "
        "USING PARQUET PARTITIONED BY (summary_month)"
    )
    spark.sql(f"INSERT INTO {name} VALUES (DATE '2024-03-01', 1, 1, now(), now(), '2024-03')")
    with pytest.raises(AnalysisException, match="overwrite"):
        upsert.upsert_table(summary(spark, ("2024-01-31", 2, 2)), name)
    assert spark.table(name).count() == 1


def test_many_partitions_are_matched_by_a_join(spark, target, monkeypatch):
    monkeypatch.setattr(upsert, "LISTED_PARTITIONS", 1)
    upsert.upsert_table(summary(spark, ("2024-01-30", 1, 1), ("2024-03-01", 3, 3)), target, as_of=T1)
    upsert.upsert_table(summary(spark, ("2024-01-31", 2, 2), ("2024-03-01", 5, 5)), target, as_of=T2)
    assert stored(spark, target) == [
        ("2024-01-30", 1, 1, 1, 1), ("2024-01-31", 2, 2, 2, 2), ("2024-03-01", 5, 5, 1, 2),
    ]


def test_one_file_per_touched_month(spark, target):
    days = [(str(date(2024, m, d)), d, d) for m in (1, 2, 3) for d in range(1, 29)]
    upsert.upsert_table(summary(spark, *days).repartition(8), target)
    assert len(spark.table(target).inputFiles()) == 3


def test_untouched_months_are_not_read(spark, target):
    upsert.upsert_table(summary(spark, ("2024-01-30", 1, 1), ("2024-03-01", 3, 3)), target, as_of=T1)
    touched = spark.table(target).where(F.col(upsert.PARTITION).isin("2024-01"))
    assert "PartitionFilters: [isnotnull(summary_month" in plan_of(touched)
    assert len(touched.inputFiles()) == 1


def test_merge_rows_on_any_key(spark):
    clocks = "created_at TIMESTAMP, updated_at TIMESTAMP"
    old = spark.createDataFrame([("a", 1, T1, T1), ("b", 2, None, T1)], f"k STRING, v INT, {clocks}")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k STRING, v INT")
    got = upsert.merge_rows(old, new, key="k", measures=["v"], as_of=T3)
    assert [r[:2] for r in tuples(got)] == [("a", 1), ("b", 20), ("c", 30)]
    created = [r[0] for r in got.orderBy("k").select(clock.instant_to_wall("created_at")).collect()]
    assert [c and c.day for c in created] == [1, None, 3]


def test_merge_actions(spark):
    old = summary(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 1))
    new = summary(spark, ("2024-01-02", 1, 1), ("2024-01-03", 1, 1))
    assert [(str(d), a) for d, a in tuples(upsert.merge_actions(old, new))] == [
        ("2024-01-01", "keep"), ("2024-01-02", "update"), ("2024-01-03", "insert"),
    ]


def test_load_keeps_dates_whose_rows_are_gone(spark, target, orders):
    facts = orders(("2024-01-02 10:00:00", 1), ("2024-01-03 10:00:00", 2))
    calendar = C.daily_calendar(C.fixed_bounds(spark, date(2024, 1, 1), date(2024, 1, 5)))
    loads.load_summary(facts, calendar, target, as_of=T1)
    left = facts.where("order_dt >= TIMESTAMP_NTZ '2024-01-03'")
    loads.load_summary(left, calendar, target, as_of=T2)
    assert stored(spark, target) == [("2024-01-02", 1, 1, 1, 1), ("2024-01-03", 1, 2, 1, 2)]


def test_chunked_catch_up_equals_one_backfill(spark, schema, orders):
    facts = orders(*((f"2024-01-{d:02} {h:02}:00:00", d * h) for d in range(1, 21) for h in (1, 9, 23)))

    def calendar(first, last):
        return C.daily_calendar(C.fixed_bounds(spark, date(2024, 1, first), date(2024, 1, last)))

    loads.load_summary(facts, calendar(1, 20), f"{schema}.at_once", as_of=T1)
    for first, last in ((1, 7), (8, 8), (9, 20)):
        loads.load_summary(facts, calendar(first, last), f"{schema}.in_parts", as_of=T1)
    assert stored(spark, f"{schema}.in_parts") == stored(spark, f"{schema}.at_once")
    once = {(r.summary_date, r.order_cnt, r.total_amount) for r in daily_summary(facts).collect()}
    assert {tuple(r)[:3] for r in tables.read_summary(spark, f"{schema}.at_once").collect()} == once


def test_part_of_a_day_replaces_the_whole_total(spark, target, orders):
    facts = orders(("2024-01-02 08:00:00", 1), ("2024-01-02 20:00:00", 2))
    loads.load_summary(facts, C.daily_calendar(C.fixed_bounds(spark, date(2024, 1, 2), date(2024, 1, 2))), target, as_of=T1)
    noon = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 12:00:00' AS interval_start, TIMESTAMP_NTZ '2024-01-03' AS interval_end")
    loads.load_summary(facts, noon, target, as_of=T2)
    assert stored(spark, target) == [("2024-01-02", 1, 2, 1, 2)]

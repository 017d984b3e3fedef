from datetime import date, datetime, timezone

import pytest
from frames import tuples
from pyspark.sql import functions as F

from daymill.operators.summaries import daily_summary
from daymill.plans import calendars, loads, tables
from daymill.sinks import snapshots

MONDAY, TUESDAY = (datetime(2024, 2, d, tzinfo=timezone.utc) for d in (5, 6))


def test_holes_are_filled_and_nothing_is_redone(spark, schema, orders):
    facts = orders(
        ("2024-01-01 10:00:00", 1), ("2024-01-02 10:00:00", 2), ("2024-01-04 00:00:00", 4),
        ("2024-01-04 23:00:00", 8), (None, 9),
    )
    calendar = calendars.daily_calendar(calendars.fixed_bounds(spark, date(2024, 1, 1), date(2024, 1, 5)))
    target, processed = f"{schema}.s", f"{schema}.processed"
    first = calendar.where("logical_date IN (TIMESTAMP_NTZ '2024-01-02', TIMESTAMP_NTZ '2024-01-03')")
    loads.catch_up(facts, first, target, processed, as_of=MONDAY)
    loads.catch_up(facts, calendar, target, processed, as_of=TUESDAY)
    rows = tuples(tables.read_summary(spark, target))
    assert [r[:3] for r in rows] == tuples(daily_summary(facts))
    assert [r[0].day for r in rows if r[4] != rows[0][4]] == [2]

    # The third and fifth have no rows and are listed all the same, once.
    spark.catalog.refreshTable(processed)
    assert [s.day for s, _ in tuples(spark.table(processed))] == [1, 2, 3, 4, 5]
    loads.catch_up(facts, calendar, target, processed)
    spark.catalog.refreshTable(processed)
    assert spark.table(processed).count() == 5
    assert tuples(tables.read_summary(spark, target)) == rows


def test_catch_up_by_ranges_however_they_are_cut(spark, tmp_path, orders):
    rows = [(f"2024-01-{d:02} {h:02}:00:00", d) for d in range(1, 15) for h in (3, 15)]
    facts, path = orders(*rows), str(tmp_path / "s")
    bounds = calendars.fixed_bounds(spark, date(2024, 1, 1), date(2024, 1, 14))
    days = calendars.daily_calendar(bounds)
    week = days.where("logical_date = TIMESTAMP_NTZ '2024-01-03'").withColumn(
        "interval_end", F.expr("interval_start + INTERVAL 7 DAY")
    )
    loads.catch_up_snapshot(facts, week, path, as_of=MONDAY)
    assert snapshots.manifest(spark, path).notes == {"processed": [["2024-01-03T00:00:00", "2024-01-10T00:00:00"]]}
    made = loads.catch_up_snapshot(facts, days, path, as_of=TUESDAY)
    assert made.notes == {"processed": [["2024-01-01T00:00:00", "2024-01-15T00:00:00"]]}
    found = snapshots.read_snapshot(spark, path)
    assert tuples(found.select("summary_date", "order_cnt", "total_amount")) == tuples(daily_summary(facts))
    again = found.where("updated_at > created_at").count(), found.where(F.col("created_at") == F.lit(MONDAY)).count()
    assert again == (0, 7)
    # Nothing is missing of the weeks that the days make up.
    assert loads.catch_up_snapshot(facts, week, path).version == made.version == 2
    # An interval that reaches beyond is loaded as a whole.
    longer = week.withColumn("interval_end", F.expr("interval_start + INTERVAL 13 DAY"))
    assert loads.catch_up_snapshot(facts, longer, path, as_of=TUESDAY).version == 3
    assert snapshots.read_snapshot(spark, path).where("updated_at > created_at").count() == 7


def test_of_two_catch_ups_the_later_fails(spark, tmp_path, orders, monkeypatch):
    facts, path = orders(("2024-01-01 10:00:00", 1), ("2024-01-02 10:00:00", 1)), str(tmp_path / "s")
    days = calendars.daily_calendar(calendars.fixed_bounds(spark, date(2024, 1, 1), date(2024, 1, 2)))
    first, both = days.where("logical_date < TIMESTAMP_NTZ '2024-01-02'"), days
    real = loads.interval_summary

    def while_another_publishes(*args):
        monkeypatch.setattr(loads, "interval_summary", real)
        loads.catch_up_snapshot(facts, first, path, as_of=MONDAY)
        return real(*args)

    loads.catch_up_snapshot(facts.limit(0), days.where("logical_date < TIMESTAMP_NTZ '1990-01-01'"), path)
    loads.catch_up_snapshot(facts, first.withColumn("interval_end", F.expr("interval_start + INTERVAL 1 HOUR")), path, as_of=MONDAY)
    monkeypatch.setattr(loads, "interval_summary", while_another_publishes)
    with pytest.raises(snapshots.CommitConflict):
        loads.catch_up_snapshot(facts, both, path, as_of=TUESDAY)
    assert snapshots.read_snapshot(spark, path).count() == 1

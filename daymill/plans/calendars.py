"""Processing calendars.

A calendar has one row per run: ``interval_start`` and ``interval_end`` bound
the data of the run and ``logical_date`` names it, all in local wall-clock
time. Bounds are a one-row DataFrame, ``first`` and ``last``, both inclusive
for the tick that starts an interval.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import clock
from daymill.operators.filters import Moment

COLUMNS = ("interval_start", "interval_end", "logical_date")

def fixed_bounds(
    spark: SparkSession, first: Moment, last: Moment, zone: str | None = None
) -> DataFrame:
    return spark.range(1, numPartitions=1).select(
        clock.wall_literal(first, zone).alias("first"), clock.wall_literal(last, zone).alias("last")
    )


def data_bounds(df: DataFrame, ts: str, zone: str | None = None) -> DataFrame:
    """From the first to the last day that has data."""
    wall = clock.wall_clock(df, ts, zone)
    return df.agg(
        clock.day_start(F.min(wall)).alias("first"), clock.day_start(F.max(wall)).alias("last")
    )


def observed_bounds(df: DataFrame, ts: str, zone: str | None = None) -> DataFrame:
    """The same, looked up once, so that plans on it do not scan the data again."""
    found = data_bounds(df, ts, zone)
    row = found.first()
    if row["first"] is None:
        return found.where(F.lit(False))
    return fixed_bounds(df.sparkSession, row["first"], row["last"])


def _midnights(bounds: DataFrame, days: Iterable[int] | None = None) -> DataFrame:
    """Midnights within the bounds, all or those of some cron days (0 = Sunday)."""
    opening = clock.day_start(F.col("first") + F.expr("INTERVAL '23:59:59.999999' HOUR TO SECOND"))
    ticks = F.when(
        opening <= F.col("last"), F.sequence(opening, F.col("last"), F.expr(clock.ONE_DAY))
    )
    midnights = bounds.select(F.explode(ticks).alias("tick"))
    if days is None:
        return midnights
    return midnights.where(clock.cron_day("tick").isin(*_cron_days(days)))


def _cron_days(days: Iterable[int]) -> set[int]:
    chosen = set(days)
    if not chosen or not chosen <= set(range(7)):
        raise ValueError("days must be some of 0 (Sunday) to 6 (Saturday)")
    return chosen


def _intervals(ticks: DataFrame, length: Column) -> DataFrame:
    tick = F.col("tick")
    return ticks.select(
        tick.alias("interval_start"),
        (tick + length).alias("interval_end"),
        tick.alias("logical_date"),
    )


def _points(ticks: DataFrame) -> DataFrame:
    tick = F.col("tick")
    return ticks.select(
        (tick - F.expr(clock.ONE_DAY)).alias("interval_start"),
        tick.alias("interval_end"),
        tick.alias("logical_date"),
    )


def daily_calendar(bounds: DataFrame) -> DataFrame:
    """One interval per day."""
    return _intervals(_midnights(bounds), F.expr(clock.ONE_DAY))


def cron_interval_calendar(bounds: DataFrame, days: Iterable[int]) -> DataFrame:
    """Midnight runs on some days of the week, each covering up to the next run.

    The days are few, so the way to the next run is looked up by the day of the
    week, which needs neither a sort nor the run after the last.
    """
    runs = _cron_days(days)
    gaps = [next(g for g in range(1, 8) if (day + g) % 7 in runs) for day in range(7)]
    gap = F.element_at(F.array(*map(F.lit, gaps)), clock.cron_day("tick") + 1)
    return _intervals(_midnights(bounds, runs), F.make_dt_interval(gap))


def cron_point_calendar(bounds: DataFrame, days: Iterable[int]) -> DataFrame:
    """Midnight runs on some days of the week, each covering the day before it."""
    return _points(_midnights(bounds, days))


def drop_holidays(
    calendar: DataFrame, holidays: DataFrame | Sequence[date], shift_days: int = 0
) -> DataFrame:
    """Leave out runs whose logical date is midnight of a holiday, or of days after it.

    Holidays are a list or a DataFrame with a ``holiday`` column.
    """
    if not isinstance(holidays, DataFrame):
        if not holidays:
            return calendar
        closed = F.array(*(clock.wall_literal(h) for h in holidays))
        holidays = calendar.sparkSession.range(1, numPartitions=1).select(
            F.explode(closed).alias("holiday")
        )
    skipped = clock.day_start(F.date_add("holiday", shift_days))
    skips = holidays.select(skipped.alias("logical_date")).distinct()
    return calendar.join(skips, "logical_date", "left_anti").select(*COLUMNS)


def business_interval_calendar(
    bounds: DataFrame, holidays: DataFrame | Sequence[date]
) -> DataFrame:
    """Daily intervals without those of weekends and holidays."""
    daily = daily_calendar(bounds)
    return drop_holidays(daily.where(~clock.is_weekend("logical_date")), holidays)


def business_point_calendar(bounds: DataFrame, holidays: DataFrame | Sequence[date]) -> DataFrame:
    """Daily runs over the day before, without those that would cover weekends and holidays.

    A run comes a day after its data, so Sundays and Mondays are left out, and
    the days after holidays.
    """
    daily = _points(_midnights(bounds))
    working = ~clock.falls_on("logical_date", (clock.SUNDAY, clock.MONDAY))
    return drop_holidays(daily.where(working), holidays, shift_days=1)


def missing_intervals(calendar: DataFrame, done: DataFrame) -> DataFrame:
    """Catch-up: intervals whose start is not among the ``interval_start`` of ``done``."""
    return calendar.join(done.select("interval_start"), "interval_start", "left_anti").select(
        *calendar.columns
    )


def latest_interval(calendar: DataFrame, now: Column) -> DataFrame:
    """The last interval that has ended by ``now``."""
    return (
        calendar.where(F.col("interval_end") <= now).orderBy(F.desc("interval_start")).limit(1)
    )


def with_utc_bounds(calendar: DataFrame, zone: str) -> DataFrame:
    """Adds ``start_utc`` and ``end_utc``."""
    return calendar.select(
        "*",
        clock.shift_zone("interval_start", zone, "UTC").alias("start_utc"),
        clock.shift_zone("interval_end", zone, "UTC").alias("end_utc"),
    )


def with_run_dates(calendar: DataFrame, zone: str = "UTC") -> DataFrame:
    """Adds ``ds``, ``ds_nodash``, ``ts`` and ``ts_nodash`` of the logical date."""
    return calendar.select("*", *clock.run_date_strings("logical_date", zone))

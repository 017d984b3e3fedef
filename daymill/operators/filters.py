"""Row filters on time columns.

Each keeps the column bare on one side, so that the bounds reach the file scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, time, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions import clock

Moment = date | datetime | str


def half_open(
    df: DataFrame, ts: str, start: Moment, end: Moment, zone: str | None = None
) -> DataFrame:
    """Rows in ``[start, end)``."""
    return within_any(df, ts, [(start, end)], zone)


def within_any(
    df: DataFrame, ts: str, ranges: Sequence[tuple[Moment, Moment]], zone: str | None = None
) -> DataFrame:
    """Rows in any of several ``[start, end)``, of which there must be one at least."""
    inside = [
        (F.col(ts) >= clock.bound_literal(df, ts, start, zone))
        & (F.col(ts) < clock.bound_literal(df, ts, end, zone))
        for start, end in ranges
    ]
    return df.where(reduce(or_, inside))


def point_window(
    df: DataFrame, ts: str, logical_date: Moment, zone: str | None = None
) -> DataFrame:
    """Rows of the day before a run: ``[logical_date - 1 day, logical_date)``."""
    end = clock.wall_time(logical_date, zone)
    return half_open(df, ts, end - timedelta(days=1), end, zone)


def within_request_range(wall: Column, end_of_day: time = time(23, 59)) -> Column:
    """Whether a time lies in its own day's request, ``00:00`` to ``end_of_day`` inclusive.

    What follows ``end_of_day`` belongs to no request and is lost.
    """
    reach = F.make_dt_interval(
        F.lit(0), F.lit(end_of_day.hour), F.lit(end_of_day.minute), F.lit(end_of_day.second)
    )
    return wall <= clock.day_start(wall) + reach


def request_range(
    df: DataFrame,
    ts: str,
    first_day: date,
    last_day: date,
    end_of_day: time = time(23, 59),
    zone: str | None = None,
) -> DataFrame:
    """What one request per day from ``first_day`` to ``last_day`` returns."""
    days = half_open(df, ts, first_day, last_day + timedelta(days=1), zone)
    return days.where(within_request_range(clock.wall_clock(df, ts, zone), end_of_day))


def on_weekdays(df: DataFrame, ts: str, days: Iterable[int], zone: str | None = None) -> DataFrame:
    """Rows whose local date falls on one of ``days``, numbered from Monday = 0."""
    return df.where(clock.falls_on(clock.wall_clock(df, ts, zone), days))

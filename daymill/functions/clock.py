"""Dates, times and zones.

``timestamp_ntz`` columns hold wall-clock time and ``timestamp`` columns hold
instants. Nothing here depends on the session time zone, so a job gives the
same rows wherever it runs.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Day numbers with Monday first.
MONDAY, TUESDAY, WEDNESDAY, THURSDAY, FRIDAY, SATURDAY, SUNDAY = range(7)

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
ONE_DAY = "INTERVAL 1 DAY"
MICROSECOND = "INTERVAL 0.000001 SECOND"


def wall_time(value: date | datetime | str, zone: str | None = None) -> datetime:
    """``value`` as naive wall-clock time; aware values are moved to ``zone`` first."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        return value
    if zone is None:
        raise ValueError("an aware bound needs the zone it is read in")
    return value.astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def wall_literal(value: date | datetime | str, zone: str | None = None) -> Column:
    """A ``timestamp_ntz`` literal, which the file scan can compare with statistics."""
    return F.expr(f"TIMESTAMP_NTZ '{wall_time(value, zone).isoformat(sep=' ')}'")


def instant_literal(value: date | datetime | str, zone: str | None = None) -> Column:
    """A ``timestamp`` literal; naive values are wall-clock time in ``zone``."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if isinstance(value, datetime) and value.tzinfo is not None:
        return F.lit(value)
    if zone is None:
        raise ValueError("a bound without a zone of its own needs one to be an instant")
    return F.lit(wall_time(value).replace(tzinfo=ZoneInfo(zone)))


def bound_literal(
    df: DataFrame, column: str, value: date | datetime | str, zone: str | None = None
) -> Column:
    """``value`` as a literal of the type of ``column``, so that the column stays bare.

    Naive values are wall-clock time in ``zone``; instants need the zone.
    """
    kind = df.schema[column].dataType.typeName()
    if kind != "timestamp":
        return wall_literal(value, zone)
    return instant_literal(value, zone)


def instant_to_wall(instant: Column | str, zone: str = "UTC") -> Column:
    """The wall-clock time a zone shows at an instant."""
    instant = F.col(instant) if isinstance(instant, str) else instant
    in_utc = F.expr(EPOCH) + F.expr(MICROSECOND) * F.unix_micros(instant)
    return in_utc if zone == "UTC" else shift_zone(in_utc, "UTC", zone)


def wall_clock(df: DataFrame, column: str, zone: str | None = None) -> Column:
    """``column`` as wall-clock time: itself, or shown in ``zone`` if it holds instants."""
    if df.schema[column].dataType.typeName() != "timestamp":
        return F.col(column).cast("timestamp_ntz")
    if zone is None:
        raise ValueError(f"{column} holds instants: give the zone to read them in")
    return instant_to_wall(column, zone)


def shift_zone(wall: Column | str, source: str, target: str) -> Column:
    """Move wall-clock time from one zone to another."""
    wall = F.col(wall) if isinstance(wall, str) else wall
    return F.convert_timezone(F.lit(source), F.lit(target), wall)


def day_start(wall: Column) -> Column:
    return F.to_date(wall).cast("timestamp_ntz")


def hour_start(wall: Column) -> Column:
    """The full hour, without leaving wall-clock time as ``date_trunc`` would."""
    return day_start(wall) + F.make_dt_interval(F.lit(0), F.hour(wall))


def epoch_ms(wall: Column | str) -> Column:
    """Milliseconds since 1970 of wall-clock time read as UTC, rounded down."""
    wall = F.col(wall) if isinstance(wall, str) else wall
    within_minute = F.floor(F.extract(F.lit("SECOND"), wall) * 1000).cast("bigint")
    return (
        F.unix_date(F.to_date(wall)).cast("bigint") * 86_400_000
        + F.hour(wall).cast("bigint") * 3_600_000
        + F.minute(wall).cast("bigint") * 60_000
        + within_minute
    )


def epoch_ms_to_instant(ms: Column | str) -> Column:
    return F.timestamp_millis(ms)


def dashed_day(wall: Column | str) -> Column:
    """``2024-01-31``"""
    return F.to_date(wall).cast("string")


def compact_day(wall: Column | str) -> Column:
    """``20240131``"""
    return F.replace(dashed_day(wall), F.lit("-"), F.lit(""))


def run_date_strings(wall: Column | str, zone: str = "UTC") -> list[Column]:
    """Columns ``ds``, ``ds_nodash``, ``ts`` and ``ts_nodash`` of a run date.

    They show UTC, whatever zone the run date is kept in. ``ts`` carries
    microseconds only where there are any.
    """
    wall = F.col(wall) if isinstance(wall, str) else wall
    in_utc = wall if zone == "UTC" else shift_zone(wall, zone, "UTC")
    text = F.replace(in_utc.cast("string"), F.lit(" "), F.lit("T"))
    day, seconds = F.substring(text, 1, 10), F.substring(text, 1, 19)
    bare_day, bare_seconds = (F.replace(t, F.lit("-"), F.lit("")) for t in (day, seconds))
    fraction = F.when(
        F.length(text) > 19, F.concat(F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
    ).otherwise("")
    return [
        day.alias("ds"),
        bare_day.alias("ds_nodash"),
        F.concat(seconds, fraction, F.lit("+00:00")).alias("ts"),
        F.replace(bare_seconds, F.lit(":"), F.lit("")).alias("ts_nodash"),
    ]


def falls_on(day: Column | str, days: Iterable[int]) -> Column:
    """Whether a date falls on one of ``days``, numbered from Monday = 0."""
    return F.weekday(day).isin(*days)


def is_weekend(day: Column | str) -> Column:
    return falls_on(day, (SATURDAY, SUNDAY))


def cron_day(day: Column | str) -> Column:
    """Day of the week as a cron line counts it, from Sunday = 0."""
    return F.dayofweek(day) - 1

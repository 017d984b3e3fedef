"""Cron text as calendars.

A line of five fields, minute, hour, day of month, month and day of week, is
compiled to a set of values each. Ticks are made by joining those values: days
that fit, times every such hour and minute. Only days are ever listed one by
one, and a run finds the next one within its day or at the first time of the
next day that fits.

Times are wall-clock times of the zone the calendar is kept in. Two rules hold
where its clocks change, once a calendar is moved to UTC by ``with_utc_bounds``:
a time that is left out stands for the one an hour (or whatever is left out)
later, and a time that comes twice stands for the first.
"""

from __future__ import annotations

import calendar as months
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymill.functions import clock
from daymill.plans.calendars import COLUMNS

# The ranges and names of the fields, and short forms of whole lines.
RANGES = {"minute": (0, 59), "hour": (0, 23), "day": (1, 31), "month": (1, 12), "weekday": (0, 7)}
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
WEEKDAYS = ("SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT")
SHORT_FORMS = {
    "@hourly": "0 * * * *",
    "@daily": "0 0 * * *",
    "@midnight": "0 0 * * *",
    "@weekly": "0 0 * * 0",
    "@monthly": "0 0 1 * *",
    "@quarterly": "0 0 1 */3 *",
    "@yearly": "0 0 1 1 *",
    "@annually": "0 0 1 1 *",
}

# A 29 February may be eight years from the one before it.
LONGEST_WAIT = "INTERVAL 9 YEAR"


@dataclass(frozen=True)
class Cron:
    """The values that each field of a line allows.

    If neither days of the month nor days of the week are open, a day that fits
    either fits.
    """

    minutes: tuple[int, ...]
    hours: tuple[int, ...]
    days: tuple[int, ...]
    months: tuple[int, ...]
    weekdays: tuple[int, ...]
    any_day: bool
    any_weekday: bool

    @property
    def times(self) -> list[int]:
        """Minutes of the day, ascending."""
        return [60 * h + m for h in self.hours for m in self.minutes]

    def fits(self, day: Column) -> Column:
        """Whether a date fits."""
        of_month = F.dayofmonth(day).isin(*self.days)
        of_week = clock.cron_day(day).isin(*self.weekdays)
        either = of_month & of_week if self.any_day or self.any_weekday else of_month | of_week
        return F.month(day).isin(*self.months) & either


def _number(text: str, name: str) -> int:
    names = {"month": {n: i for i, n in enumerate(MONTHS, 1)}, "weekday": {n: i for i, n in enumerate(WEEKDAYS)}}
    value = names.get(name, {}).get(text.upper())
    if value is None:
        if not (text.isascii() and text.isdigit()):
            raise ValueError(f"{text!r} is no {name}")
        value = int(text)
    low, high = RANGES[name]
    if not low <= value <= high:
        raise ValueError(f"{name} {value} is not within {low} to {high}")
    return value


def _values(field: str, name: str) -> set[int]:
    """The values of lists of single values, ranges and steps."""
    low, high = RANGES[name]
    found: set[int] = set()
    for item in field.split(","):
        span, slash, step_text = item.partition("/")
        if slash and not (step_text.isascii() and step_text.isdigit() and int(step_text)):
            raise ValueError(f"{item!r} has no step above 0")
        if span == "*":
            first, last = low, 6 if name == "weekday" else high
        else:
            begin, dash, end = span.partition("-")
            first = _number(begin, name)
            # A single value with a step goes on to the end of the range.
            last = _number(end, name) if dash else high if slash else first
            if last < first:
                raise ValueError(f"{item!r} runs backwards")
        found.update(range(first, last + 1, int(step_text) if slash else 1))
    return {v % 7 for v in found} if name == "weekday" else found


def compile_cron(line: str) -> Cron:
    """A line of five fields, or one of the short forms.

    Fields hold ``*``, values, ranges, lists of these, and steps; months and
    days of the week may be named, and Sunday is 0 or 7. A line that can never
    come true is an error.
    """
    fields = SHORT_FORMS.get(line.strip().lower(), line).split()
    if len(fields) != len(RANGES):
        raise ValueError(f"{line!r} does not have the fields {', '.join(RANGES)}")
    found = {name: tuple(sorted(_values(f, name))) for name, f in zip(RANGES, fields)}
    cron = Cron(
        found["minute"], found["hour"], found["day"], found["month"], found["weekday"],
        any_day=fields[2].startswith("*"), any_weekday=fields[4].startswith("*"),
    )
    longest = max(months.monthrange(2024, m)[1] for m in cron.months)
    by_weekday = not cron.any_weekday and not cron.any_day
    if min(cron.days) > longest and not by_weekday:
        raise ValueError(f"{line!r} names a day that no month has")
    return cron


def _days(bounds: DataFrame, cron: Cron, last: Column) -> DataFrame:
    """``day`` of each date up to ``last`` that fits, with the bounds."""
    listed = F.sequence(F.to_date("first"), F.to_date(last), F.expr(clock.ONE_DAY))
    days = bounds.where(F.col("first") <= F.col("last"))
    return days.select("first", "last", F.explode(listed).alias("day")).where(cron.fits(F.col("day")))


def _moment(day: Column, minute: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minute)


def cron_ticks(bounds: DataFrame, line: str) -> DataFrame:
    """``tick``: every time of a line within the bounds, both inclusive."""
    cron = compile_cron(line)
    times = F.explode(F.array(*map(F.lit, cron.times))).alias("minute")
    ticks = _days(bounds, cron, F.col("last")).select("first", "last", "day", times)
    tick = _moment(F.col("day"), F.col("minute"))
    return ticks.withColumn("tick", tick).where("tick BETWEEN first AND last").select("tick")


def cron_calendar(bounds: DataFrame, line: str) -> DataFrame:
    """Runs at the times of a line within the bounds, each covering up to the next run."""
    cron = compile_cron(line)
    times = cron.times
    horizon = F.col("last") + F.expr(LONGEST_WAIT)
    next_day = F.lead("day").over(W.orderBy("day"))  # a row for each day at most
    days = _days(bounds, cron, horizon).withColumn("next_day", next_day).where("day <= to_date(last)")
    pairs = [F.struct(F.lit(a).alias("minute"), F.lit(b).alias("then")) for a, b in zip(times, [*times[1:], -1])]
    runs = days.select("first", "last", "day", "next_day", F.inline(F.array(*pairs)))
    start, then = _moment(F.col("day"), F.col("minute")), F.col("then")
    end = F.when(then >= 0, _moment(F.col("day"), then)).otherwise(_moment(F.col("next_day"), F.lit(times[0])))
    runs = runs.select("first", "last", start.alias("interval_start"), end.alias("interval_end"))
    runs = runs.where("interval_start BETWEEN first AND last")
    return runs.withColumn("logical_date", F.col("interval_start")).select(*COLUMNS)


def cron_window_calendar(bounds: DataFrame, line: str, length: str, ahead: bool = False) -> DataFrame:
    """Runs at the times of a line, each covering a stretch of fixed length, like ``30 DAY``.

    The stretch ends at the run, or begins there if it lies ``ahead``. Stretches
    may overlap, and leave time out.
    """
    tick, stretch = F.col("tick"), F.expr(f"INTERVAL {length}")
    start, end = (tick, tick + stretch) if ahead else (tick - stretch, tick)
    return cron_ticks(bounds, line).select(
        start.alias("interval_start"), end.alias("interval_end"), tick.alias("logical_date")
    )

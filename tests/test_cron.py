from datetime import date, datetime, timedelta

import pytest
from frames import tuples

from daymill.plans import calendars as C
from daymill.plans import cron


def bounds(spark, first, last):
    return C.fixed_bounds(spark, first, last)


def brute_ticks(line, first, last):
    """Every minute, looked at one by one."""
    minute, hour, day, month, weekday = (cron.SHORT_FORMS.get(line, line)).split()
    names = {n: i for i, n in enumerate(cron.MONTHS, 1)} | {n: i for i, n in enumerate(cron.WEEKDAYS)}

    def number(text):
        return names.get(text.upper(), None) if text.upper() in names else int(text)

    def allows(field, value, low, high):
        for item in field.split(","):
            span, _, step = item.partition("/")
            if span == "*":
                a, b = low, high
            elif "-" in span:
                a, b = map(number, span.split("-"))
            else:
                a = number(span)
                b = high if step else a
            if value in range(a, b + 1, int(step or 1)):
                return True
        return False

    found, at = [], first
    while at <= last:
        of_week = any(allows(weekday, d, 0, 7) for d in ((0, 7) if at.isoweekday() == 7 else (at.isoweekday(),)))
        of_month = allows(day, at.day, 1, 31)
        both = day.startswith("*") or weekday.startswith("*")
        if (
            allows(minute, at.minute, 0, 59) and allows(hour, at.hour, 0, 23) and allows(month, at.month, 1, 12)
            and ((of_month and of_week) if both else (of_month or of_week))
        ):
            found.append(at)
        at += timedelta(minutes=1)
    return found


LINES = [
    "0 0 * * 2-6", "*/15 9-17/4 * * *", "5,35 */6 1,15 * *", "30 6 1-15/2 * MON", "0 12 * 2 SUN", "0 0 */10 * 7",
    "59 23 31 * *", "0 8/5 * jan-mar 1-5", "@hourly", "@weekly", "@monthly", "17 3 * * 5-7",
]


@pytest.mark.parametrize("line", LINES)
def test_ticks_equal_brute_force(spark, line):
    first, last = datetime(2024, 1, 30, 7, 10), datetime(2024, 3, 11, 23, 30)
    ticks = [r[0] for r in tuples(cron.cron_ticks(bounds(spark, first, last), line))]
    assert ticks == brute_ticks(line, first, last)
    runs = tuples(cron.cron_calendar(bounds(spark, first, last), line))
    onward = brute_ticks(line, first, last + timedelta(days=40 if " 2 " not in line and "jan" not in line else 400))
    assert runs == [(a, b, a) for a, b in zip(onward, onward[1:]) if a <= last]


def test_the_next_run_may_be_years_away(spark):
    around = bounds(spark, date(2096, 1, 1), date(2096, 12, 31))
    assert tuples(cron.cron_calendar(around, "0 0 29 2 *")) == [
        (datetime(2096, 2, 29), datetime(2104, 2, 29), datetime(2096, 2, 29))
    ]


def test_text_gives_the_calendars_of_sets_of_days(spark):
    january = bounds(spark, date(2024, 1, 1), date(2024, 1, 31))
    assert tuples(cron.cron_calendar(january, "0 0 * * 2-6")) == tuples(C.cron_interval_calendar(january, range(2, 7)))
    points = cron.cron_window_calendar(january, "0 0 * * 2-6", "1 DAY")
    assert tuples(points) == tuples(C.cron_point_calendar(january, range(2, 7)))
    assert tuples(cron.cron_calendar(january, "@daily")) == tuples(C.daily_calendar(january))


def test_windows_lie_behind_or_ahead(spark):
    day = bounds(spark, datetime(2024, 1, 1), datetime(2024, 1, 1, 12))
    behind, ahead = (tuples(cron.cron_window_calendar(day, "0 12 * * *", "36 HOUR", ahead=a)) for a in (False, True))
    noon = datetime(2024, 1, 1, 12)
    assert behind == [(noon - timedelta(hours=36), noon, noon)] and ahead == [(noon, noon + timedelta(hours=36), noon)]


@pytest.mark.parametrize("line", [
    "", "0 0 * *", "0 0 * * * *", "60 0 * * *", "0 24 * * *", "0 0 0 * *", "0 0 * 13 *", "0 0 * * 8", "*/0 * * * *",
    "5-1 * * * *", "a * * * *", "0 0 31 2 *", "0 0 30 FEB *", "1,,2 * * * *", "1- * * * *", "-1 * * * *", "@often", "0 0 * * FRI-MON",
])
def test_lines_that_are_refused(line):
    with pytest.raises(ValueError):
        cron.compile_cron(line)


def test_a_day_that_no_month_has_is_fine_beside_a_weekday():
    assert cron.compile_cron("0 0 31 2 MON").weekdays == (1,)


@pytest.mark.parametrize("line,zone,start_utc", [
    # The clock goes from 2 to 3 in New York: 02:30 is left out and stands for 03:30.
    ("30 2 10 3 *", "America/New_York", datetime(2024, 3, 10, 7, 30)),
    # And from 2 back to 1: 01:30 comes twice and stands for the first.
    ("30 1 3 11 *", "America/New_York", datetime(2024, 11, 3, 5, 30)),
])
def test_times_where_clocks_change(spark, line, zone, start_utc):
    year = bounds(spark, date(2024, 1, 1), date(2024, 12, 31))
    runs = C.with_utc_bounds(cron.cron_calendar(year, line), zone)
    assert [r.start_utc for r in runs.collect()] == [start_utc]


@pytest.mark.parametrize("line,days", [
    # Tuesday to Saturday, and Monday to Friday: the run before a free day covers it.
    ("0 0 * * 2-6", [1, 2, 3, 6, 7]), ("0 0 * * 1-5", [1, 2, 5, 6, 7]),
])
def test_worked_answers_from_text(spark, line, days):
    runs = tuples(cron.cron_calendar(bounds(spark, date(2026, 1, 1), "2026-01-06 23:59:59"), line))
    starts = [datetime(2026, 1, d) for d in days]
    assert [r[:2] for r in runs] == list(zip(starts, starts[1:]))


def test_business_days_from_text(spark):
    holidays = [date(2026, 2, d) for d in (16, 17, 18)]
    month = bounds(spark, date(2026, 2, 6), "2026-02-20 23:59:59")
    daily = C.drop_holidays(cron.cron_window_calendar(month, "0 0 * * MON-FRI", "1 DAY", ahead=True), holidays)
    assert tuples(daily) == tuples(C.business_interval_calendar(month, holidays))
    behind = C.drop_holidays(cron.cron_window_calendar(month, "0 0 * * 2-6", "1 DAY"), holidays, shift_days=1)
    assert tuples(behind) == tuples(C.business_point_calendar(month, holidays))

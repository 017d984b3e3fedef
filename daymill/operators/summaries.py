"""Counts and sums per day, hour and interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions import clock
from daymill.operators.filters import Moment, half_open, within_any
from daymill.operators.intervals import (
    BROADCAST_PIECES,
    calendar_extent,
    day_pieces,
    interval_join,
)
from daymill.operators.prefix import totals_between

MONEY = "decimal(18,2)"
INTERVAL = ("interval_start", "interval_end")

# Intervals that a moment may lie in, on average, for facts to be joined to each of them.
MOST_OVERLAP = 4


def _totals(amount: str) -> list[Column]:
    # Cast before summing: sums of doubles depend on the order of the rows.
    return [
        F.count("*").alias("order_cnt"),
        F.sum(F.col(amount).cast(MONEY)).cast(MONEY).alias("total_amount"),
    ]


def _within(
    facts: DataFrame, ts: str, start: Moment | None, end: Moment | None, zone: str | None
) -> DataFrame:
    """Facts of the interval, or of all time. A row without a time is in neither."""
    if (start is None) != (end is None):
        raise ValueError("give both ends of an interval, or neither")
    if start is None:
        return facts.where(F.col(ts).isNotNull())
    return half_open(facts, ts, start, end, zone)


def daily_summary(
    facts: DataFrame,
    ts: str = "order_dt",
    amount: str = "amount",
    start: Moment | None = None,
    end: Moment | None = None,
    zone: str | None = None,
) -> DataFrame:
    """``summary_date``, ``order_cnt`` and ``total_amount`` of every day that has rows.

    A day without rows yields no row, and a day of null amounts a null total.
    """
    facts = _within(facts, ts, start, end, zone)
    day = F.to_date(clock.wall_clock(facts, ts, zone))
    return facts.groupBy(day.alias("summary_date")).agg(*_totals(amount))


def hourly_count(
    facts: DataFrame,
    ts: str = "order_dt",
    start: Moment | None = None,
    end: Moment | None = None,
    zone: str | None = None,
) -> DataFrame:
    """``order_hour`` and ``cnt``, in order of the hour."""
    facts = _within(facts, ts, start, end, zone)
    hour = clock.hour_start(clock.wall_clock(facts, ts, zone))
    return (
        facts.groupBy(hour.alias("order_hour"))
        .agg(F.count("*").alias("cnt"))
        .orderBy("order_hour")
    )


def interval_summary(
    facts: DataFrame,
    calendar: DataFrame,
    ts: str = "order_dt",
    amount: str = "amount",
    zone: str | None = None,
    broadcast_pieces: int = BROADCAST_PIECES,
) -> DataFrame:
    """The daily summary of every interval of a calendar, in one job.

    Rows carry their interval, as overlapping intervals report the same date.
    Facts are counted before they are shuffled, so a date that holds most of
    the rows is no heavier than another.
    """
    facts = facts.select(ts, amount)
    calendar = calendar.select(*INTERVAL)
    extent = calendar_extent(calendar)
    if extent is not None and extent.repeats:
        calendar = calendar.distinct()
    if extent is not None and extent.whole_days:
        # A day is in an interval as a whole or not at all: count days, then join those.
        daily = daily_summary(within_any(facts, ts, extent.ranges, zone), ts, amount, zone=zone)
        pieces = day_pieces(calendar).withColumnRenamed("day", "summary_date")
        return daily.join(pieces, "summary_date").select(
            *INTERVAL, "summary_date", "order_cnt", "total_amount"
        )
    if extent is None or (extent.pieces <= broadcast_pieces and extent.overlap <= MOST_OVERLAP):
        joined = interval_join(facts, calendar, ts, zone, extent)
        day = F.to_date(clock.wall_clock(facts, ts, zone))
        return joined.groupBy(*INTERVAL, day.alias("summary_date")).agg(*_totals(amount))

    # Each piece of an interval is the difference of two running sums, so facts
    # are added up once, however many intervals they lie in.
    facts = within_any(facts, ts, extent.ranges, zone)
    day = F.col("day").cast("timestamp_ntz")
    pieces = day_pieces(calendar).withColumns({
        "_from": F.greatest("interval_start", day),
        "_to": F.least("interval_end", day + F.expr(clock.ONE_DAY)),
    })
    spans = pieces.select("_from", "_to").distinct()
    totals = _totals_of(facts, spans, ts, amount, zone, "_from", "_to")
    return pieces.join(totals, ["_from", "_to"]).select(
        *INTERVAL, F.col("day").alias("summary_date"), "order_cnt", "total_amount"
    )


def _totals_of(
    facts: DataFrame, spans: DataFrame, ts: str, amount: str, zone: str | None, start: str, end: str
) -> DataFrame:
    """``spans`` that have rows, with ``order_cnt`` and ``total_amount``."""
    money = F.col(amount).cast(MONEY)
    measures = {
        "order_cnt": F.lit(1).cast("bigint"),
        "given": money.isNotNull().cast("bigint"),
        "money": F.coalesce(money, F.lit(0).cast(MONEY)),
    }
    sums = totals_between(facts, spans, measures, clock.wall_clock(facts, ts, zone), start, end)
    total = F.when(F.col("given") > 0, F.col("money").cast(MONEY))
    return sums.where("order_cnt > 0").select(*spans.columns, "order_cnt", total.alias("total_amount"))


def interval_totals(
    facts: DataFrame,
    calendar: DataFrame,
    ts: str = "order_dt",
    amount: str = "amount",
    zone: str | None = None,
) -> DataFrame:
    """``interval_start``, ``interval_end``, ``order_cnt`` and ``total_amount`` of every interval.

    One row for each distinct interval that has rows, over all its days. Facts
    and ends of intervals are each added up once, so windows that slide by an
    hour over a month cost no more than hours.
    """
    facts, calendar = facts.select(ts, amount), calendar.select(*INTERVAL)
    extent = calendar_extent(calendar)
    facts = within_any(facts, ts, extent.ranges, zone) if extent else facts.where(F.lit(False))
    spans = calendar.where("interval_start < interval_end").distinct()
    return _totals_of(facts, spans, ts, amount, zone, *INTERVAL)


def last_interval_wins(summary: DataFrame) -> DataFrame:
    """One row per date, as runs in order of their intervals leave it.

    A later interval replaces what an earlier one reported; nothing is added up.
    """
    order = F.struct(*INTERVAL)
    return summary.groupBy("summary_date").agg(
        F.max_by("order_cnt", order).alias("order_cnt"),
        F.max_by("total_amount", order).alias("total_amount"),
    )

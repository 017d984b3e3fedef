"""Joining facts to a calendar of intervals.

A range condition alone would make Spark compare every fact with every
interval. Intervals are cut into days instead, and days into buckets as wide as
suits the calendar, which leaves an equality on both and checks the range only
within a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions import clock
from daymill.operators.filters import within_any

# A day piece takes some tens of bytes, so this many fit in any executor.
BROADCAST_PIECES = 500_000


# Widths of a bucket in seconds: a day, an hour, a minute, a second. The narrowest
# counts that cuts an interval into no more pieces than this on average.
DAY_SECONDS = 86_400
WIDTHS = (DAY_SECONDS, 3_600, 60, 1)
MEAN_PIECES = 2

# Of a calendar with no more intervals than this, the gaps are looked at.
LISTED_INTERVALS = 10_000

# Gaps shorter than this are not worth leaving out of a scan, nor are too many.
WORTHWHILE_GAP = timedelta(days=7)
MAX_RANGES = 16

Range = tuple[datetime, datetime]


@dataclass(frozen=True)
class Extent:
    """How much a calendar covers.

    ``ranges`` hold all its intervals, ``width`` is that of the buckets they are
    cut to, ``pieces`` how many these are, ``whole_days`` tells whether all
    start and end at midnight, ``repeats`` whether one may be listed twice, and
    ``overlap`` in how many intervals a covered moment lies on average.
    """

    ranges: tuple[Range, ...]
    width: int
    pieces: int
    whole_days: bool
    repeats: bool
    overlap: float


def _last_moment() -> Column:
    return F.col("interval_end") - F.expr(clock.MICROSECOND)


def _at_midnight(name: str) -> Column:
    return F.col(name) == clock.day_start(F.col(name))


def bucket_of(moment: Column, width: int) -> Column:
    """The number of the bucket within its day that a wall-clock time falls in."""
    second = F.hour(moment) * 3_600 + F.minute(moment) * 60 + F.second(moment)
    return F.floor(second / width).cast("int")


def _fitting_width(intervals: int, pieces: Mapping[int, int]) -> tuple[int, int]:
    fitting = [w for w in pieces if pieces[w] <= MEAN_PIECES * intervals]
    width = min(fitting, default=DAY_SECONDS)
    return width, pieces[width]


def covering_ranges(intervals: Iterable[Range]) -> tuple[Range, ...]:
    """Few ranges that hold all intervals and leave out the widest gaps between them."""
    merged = _merged(intervals)
    gaps = [(after[0] - before[1], after[0]) for before, after in pairwise(merged)]
    widest = sorted((g for g in gaps if g[0] >= WORTHWHILE_GAP), reverse=True)[: MAX_RANGES - 1]
    cuts = {start for _, start in widest}
    ranges: list[Range] = []
    for start, end in merged:
        if not ranges or start in cuts:
            ranges.append((start, end))
        else:
            ranges[-1] = (ranges[-1][0], end)
    return tuple(ranges)


def _overlap(seconds: float, ranges: Iterable[Range]) -> float:
    covered = sum((end - start).total_seconds() for start, end in ranges)
    return seconds / covered if covered else 0.0


def _merged(intervals: Iterable[Range]) -> list[Range]:
    """Disjoint ranges of what the intervals cover, in order."""
    merged: list[Range] = []
    for start, end in sorted(intervals):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _listed_extent(listed: list[Range]) -> Extent:
    """The extent of intervals at hand. Widths are tried from the widest, as far as they fit."""
    midnight = datetime.min.time()
    whole = all(s.time() == midnight == e.time() for s, e in listed)
    lasts = [(s, e - timedelta(microseconds=1)) for s, e in listed]

    def second(moment: datetime) -> int:
        return moment.hour * 3_600 + moment.minute * 60 + moment.second

    def pieces(width: int) -> int:
        a_day = DAY_SECONDS // width
        return sum(
            (last.date() - start.date()).days * a_day + second(last) // width - second(start) // width + 1
            for start, last in lasts
        )

    widths = WIDTHS[:1] if whole else WIDTHS
    width, count = _fitting_width(len(listed), {w: pieces(w) for w in widths})
    seconds = sum((e - s).total_seconds() for s, e in listed)
    return Extent(
        covering_ranges(listed), width, count, whole, len(set(listed)) < len(listed),
        _overlap(seconds, _merged(listed)),
    )


def _covered_days(measured: DataFrame) -> list[Range]:
    """Disjoint ranges of whole days that hold all intervals.

    Starts and ends are counted by day where they lie, so what is collected has
    a row for each day at most, not for each interval.
    """
    edges = F.array(
        F.struct(F.to_date("interval_start").alias("day"), F.lit(1).alias("opened")),
        F.struct(F.date_add(F.to_date(_last_moment()), 1).alias("day"), F.lit(-1).alias("opened")),
    )
    changes = measured.select(F.inline(edges)).groupBy("day").agg(F.sum("opened").alias("opened"))
    ranges, still_open, since = [], 0, None
    for day, opened in sorted(map(tuple, changes.where("opened != 0").collect())):
        if not still_open:
            since = day
        still_open += opened
        if not still_open:
            ranges.append(tuple(datetime(d.year, d.month, d.day) for d in (since, day)))
    return ranges


def calendar_extent(calendar: DataFrame) -> Extent | None:
    """Measure a calendar; ``None`` if it has no interval.

    Of a calendar too long to list, only sums and the days it covers are taken.
    """
    given = calendar.where("interval_start < interval_end").select("interval_start", "interval_end")
    listed = given.limit(LISTED_INTERVALS + 1).collect()
    if not listed:
        return None
    if len(listed) <= LISTED_INTERVALS:
        return _listed_extent([tuple(r) for r in listed])
    days = F.datediff(F.to_date(_last_moment()), F.to_date("interval_start")).cast("bigint")

    def pieces(width: int) -> Column:
        first, last = (bucket_of(m, width) for m in (F.col("interval_start"), _last_moment()))
        return days * (DAY_SECONDS // width) + last - first + 1

    length = F.unix_micros(F.col("interval_end").cast("timestamp")) - F.unix_micros(F.col("interval_start").cast("timestamp"))
    total = given.agg(
        F.min("interval_start").alias("start"),
        F.max("interval_end").alias("end"),
        F.count("*").alias("intervals"),
        *(F.sum(pieces(w)).alias(f"of_{w}") for w in WIDTHS),
        F.bool_and(_at_midnight("interval_start") & _at_midnight("interval_end")).alias("whole"),
        (F.sum(length.cast("double")) / 1e6).alias("seconds"),
    ).first()
    covered = _covered_days(given)
    # The first and last day need not be covered as a whole.
    ranges = [(max(a, total.start), min(b, total.end)) for a, b in covering_ranges(covered)]
    return Extent(
        tuple(ranges),
        *_fitting_width(total.intervals, {w: total[f"of_{w}"] for w in WIDTHS}),
        total.whole,
        True,
        _overlap(total.seconds, covered),
    )


def day_pieces(calendar: DataFrame) -> DataFrame:
    """One row per interval and day it touches, in column ``day``."""
    days = F.sequence(F.to_date("interval_start"), F.to_date(_last_moment()), F.expr(clock.ONE_DAY))
    return calendar.where("interval_start < interval_end").select(
        "*", F.explode(days).alias("day")
    )


def bucket_pieces(calendar: DataFrame, width: int) -> DataFrame:
    """One row per interval and bucket it touches, in columns ``day`` and ``bucket``.

    Buckets as wide as a day are the days, and have no number.
    """
    if width == DAY_SECONDS:
        return day_pieces(calendar)
    last = F.lit(DAY_SECONDS // width - 1)
    starts, ends = (F.to_date(m) == F.col("day") for m in (F.col("interval_start"), _last_moment()))
    buckets = F.sequence(
        F.when(starts, bucket_of(F.col("interval_start"), width)).otherwise(0),
        F.when(ends, bucket_of(_last_moment(), width)).otherwise(last),
    )
    return day_pieces(calendar).select("*", F.explode(buckets).alias("bucket"))


def interval_join(
    facts: DataFrame,
    calendar: DataFrame,
    ts: str,
    zone: str | None = None,
    extent: Extent | None = None,
    broadcast_pieces: int = BROADCAST_PIECES,
) -> DataFrame:
    """Facts with ``interval_start`` and ``interval_end`` of each interval they fall in.

    The calendar is measured first. Within ``broadcast_pieces`` it is sent to
    the facts, which then need no shuffle; beyond, both sides are shuffled on
    the day and bucket, where adaptive execution splits those that are too
    heavy. Measuring runs a job when the frame is built.
    """
    extent = extent or calendar_extent(calendar)
    width = extent.width if extent else DAY_SECONDS
    pieces = bucket_pieces(calendar.select("interval_start", "interval_end"), width)
    if extent is None:
        facts = facts.where(F.lit(False))
    else:
        facts = within_any(facts, ts, extent.ranges, zone)
        if extent.pieces <= broadcast_pieces:
            pieces = F.broadcast(pieces)
    wall = clock.wall_clock(facts, ts, zone)
    inside = F.to_date(wall) == F.col("day")
    if width < DAY_SECONDS:
        inside &= bucket_of(wall, width) == F.col("bucket")
    inside &= (wall >= F.col("interval_start")) & (wall < F.col("interval_end"))
    return facts.join(pieces, inside).drop("day", "bucket")

"""Running sums over time, without one task that sees all rows.

Moments lie in seconds, seconds in days. Sums run within a second (at most a
million moments), over the seconds of a day, and over days, one row each; the
three are then added up. A day or second with most of the rows is no longer
than that. An interval's total is the difference of two running sums, so work
grows with rows and intervals, however much these overlap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymill.session import kept

# Moments that one task sums up.
ONE_TASK = 100_000

EARLIER = (W.unboundedPreceding, -1)


def before(measure: str) -> str:
    """The column that holds the sum of a measure over earlier moments."""
    return f"{measure}_before"


def running_sums(rows: DataFrame, measures: Sequence[str], moment: str = "moment") -> DataFrame:
    """``rows``, one for each moment, with the sums of all earlier moments.

    ``moment`` is wall-clock time and not null. The rows are written once, as
    they are read for every level; few enough are summed up by one task.
    """
    rows = kept(rows, "moments")
    if rows.count() <= ONE_TASK:
        earlier = W.orderBy(moment).rowsBetween(*EARLIER)
        return rows.select("*", *(F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(before(m)) for m in measures))
    at = F.col(moment)
    second = F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)
    placed = rows.withColumns({"_day": F.to_date(at), "_second": second})
    seconds = placed.groupBy("_day", "_second").agg(*(F.sum(m).alias(m) for m in measures))
    days = seconds.groupBy("_day").agg(*(F.sum(m).alias(m) for m in measures))

    def summed(frame: DataFrame, level: str, *keys: str, order: str) -> DataFrame:
        over = W.partitionBy(*keys).orderBy(order).rowsBetween(*EARLIER)
        return frame.withColumns({f"_{level}_{m}": F.sum(m).over(over) for m in measures})

    within = summed(placed, "moment", "_day", "_second", order=moment)
    of_second = summed(seconds, "second", "_day", order="_second").drop(*measures)
    of_day = summed(days, "day", order="_day").drop(*measures)
    levels = ("day", "second", "moment")

    def earlier(m: str) -> Column:
        parts = (F.coalesce(F.col(f"_{level}_{m}"), F.lit(0)) for level in levels)
        return sum(parts, F.lit(0)).alias(before(m))

    joined = within.join(of_second, ["_day", "_second"]).join(of_day, "_day")
    return joined.select(*rows.columns, *map(earlier, measures))


def totals_between(
    rows: DataFrame,
    ranges: DataFrame,
    measures: Mapping[str, Column],
    moment: Column,
    start: str = "interval_start",
    end: str = "interval_end",
) -> DataFrame:
    """``ranges`` with the sum of each measure over the rows whose moment is in ``[start, end)``.

    Measures are numbers without nulls. Rows and ends of ranges are added up by
    moment where they lie, so equal moments travel once.
    """
    values = rows.select(moment.alias("moment"), *(c.alias(m) for m, c in measures.items()))
    values = values.where("moment IS NOT NULL")
    types = dict(values.dtypes)
    ends = ranges.select(F.explode(F.array(start, end)).alias("moment"))
    ends = ends.select("moment", *(F.lit(0).cast(types[m]).alias(m) for m in measures), F.lit(1).alias("_end"))
    merged = values.withColumn("_end", F.lit(0)).unionByName(ends).groupBy("moment")
    merged = merged.agg(*(F.sum(m).alias(m) for m in measures), F.max("_end").alias("_end"))
    sums = running_sums(merged, list(measures)).where("_end = 1")

    def sums_at(edge: str) -> DataFrame:
        return sums.select(F.col("moment").alias(edge), *(F.col(before(m)).alias(f"_{edge}_{m}") for m in measures))

    found = ranges.join(sums_at(start), start).join(sums_at(end), end)
    spans = ((F.col(f"_{end}_{m}") - F.col(f"_{start}_{m}")).alias(m) for m in measures)
    return found.select(*ranges.columns, *spans)

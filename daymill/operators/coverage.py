"""Differences of sets of intervals, however they are cut.

Starts count up and ends down; running sums tell at each moment how many
intervals are open. Nothing depends on how long, nested or crowded they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.operators.prefix import before, running_sums

START, END = "interval_start", "interval_end"


def _edges(intervals: DataFrame, measure: str, others: tuple[str, ...] = ()) -> DataFrame:
    """``moment`` and what it adds to the number of open intervals. Empty intervals add nothing."""
    ends = F.array(
        F.struct(F.col(START).alias("moment"), F.lit(1).alias(measure)),
        F.struct(F.col(END).alias("moment"), F.lit(-1).alias(measure)),
    )
    edges = intervals.where(F.col(START) < F.col(END)).select(F.inline(ends))
    return edges.withColumns({other: F.lit(0) for other in others})


def uncovered_ranges(wanted: DataFrame, processed: DataFrame) -> DataFrame:
    """``interval_start`` and ``interval_end`` of the time that is wanted and not processed.

    Both sides are intervals that may overlap, nest, touch and repeat; intervals
    that are empty, or lack an end, hold no time. The ranges are as long as can
    be and do not touch.
    """
    edges = _edges(wanted, "wanted", ("done",)).unionByName(_edges(processed, "done", ("wanted",)))
    moments = edges.groupBy("moment").agg(F.sum("wanted").alias("wanted"), F.sum("done").alias("done"))

    def missing(wanted: Column, done: Column) -> Column:
        return (wanted > 0) & (done == 0)

    counts = running_sums(moments, ("wanted", "done"))
    was = missing(F.col(before("wanted")), F.col(before("done")))
    then = missing(
        F.col(before("wanted")) + F.col("wanted"), F.col(before("done")) + F.col("done")
    )
    turns = counts.select("moment", was.alias("was"), then.alias("then")).where("was != then")
    # Beginnings and ends take turns, so the n-th beginning belongs to the n-th end.
    numbered = running_sums(turns.select("moment", F.col("then").cast("bigint").alias("begins")), ("begins",))
    place = F.col(before("begins"))
    begins = numbered.where("begins = 1").select(place.alias("n"), F.col("moment").alias(START))
    ends = numbered.where("begins = 0").select((place - 1).alias("n"), F.col("moment").alias(END))
    return begins.join(ends, "n").select(START, END)


def not_covered(intervals: DataFrame, processed: DataFrame) -> DataFrame:
    """The intervals, with all their columns, of which some time is not processed.

    An interval meets an uncovered range if more ranges begin before its end
    than end up to its start. Empty intervals are left out.
    """
    intervals = intervals.where(F.col(START) < F.col(END))
    gaps = uncovered_ranges(intervals, processed)
    begun = gaps.select(F.col(START).alias("moment"), F.lit(1).alias("begun"), F.lit(0).alias("ended"))
    ended = gaps.select(F.col(END).alias("moment"), F.lit(0).alias("begun"), F.lit(1).alias("ended"))
    asked = intervals.select(F.explode(F.array(START, END)).alias("moment"), F.lit(0).alias("begun"), F.lit(0).alias("ended"))
    merged = begun.unionByName(ended).unionByName(asked).groupBy("moment")
    sums = running_sums(merged.agg(F.sum("begun").alias("begun"), F.sum("ended").alias("ended")), ("begun", "ended"))
    at_end = sums.select(F.col("moment").alias(END), F.col(before("begun")).alias("_begun"))
    at_start = sums.select(F.col("moment").alias(START), (F.col(before("ended")) + F.col("ended")).alias("_ended"))
    met = intervals.join(at_end, END).join(at_start, START).where("_begun > _ended")
    return met.select(*intervals.columns)

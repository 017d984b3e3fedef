"""Dense ascending ids without a global sort in one task."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymill.session import staged

# monotonically_increasing_id keeps the row's place below bit 33 and its partition above.
PLACE_BITS = 33

# Rows of a part that is sorted by itself, parts at most, and sampled rows for each.
PART_ROWS = 1_000_000
MOST_PARTS, SAMPLES = 1_000, 64
# Copies of a row that a task numbers.
COPIES = 100_000


@contextmanager
def with_dense_ids(
    df: DataFrame, order_by: Sequence[str] = (), after: int = 0, id_column: str = "id"
) -> Iterator[DataFrame]:
    """``df`` with ids ``after + 1, after + 2, …``, in the order of ``order_by`` or as it comes.

    Rows are written once with their task and their place in it. Only the row
    counts of the tasks are then added up, and each task's rows move up by
    those before it.

    Sorting adds a second write: rows that tie are told apart by the place
    they first had, so that a value most rows share is spread over many tasks,
    and that place must not change when a task is run again.
    """
    spot = F.monotonically_increasing_id()
    with staged(df.withColumn("_spot", spot), "arrivals") as arrivals:
        if not order_by:
            yield _numbered(arrivals, after, id_column)
            return
        placed = (
            arrivals.repartitionByRange(*order_by, "_spot")
            .sortWithinPartitions(*order_by, "_spot")
            .withColumn("_spot", spot)
        )
        with staged(placed, "placed") as rows:
            yield _numbered(rows, after, id_column)


def _numbered(rows: DataFrame, after: int, id_column: str) -> DataFrame:
    names = [c for c in rows.columns if c != "_spot"]
    rows = rows.withColumn("_task", F.shiftright("_spot", PLACE_BITS))
    # One row per task that wrote: few enough to order.
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_task")
        .agg(F.count("*").alias("_n"))
        .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    place = F.col("_spot").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    dense = (F.lit(after) + F.col("_before") + place + 1).alias(id_column)
    return rows.join(offsets, "_task").select(dense, *names)


def numbered(
    df: DataFrame, order_by: Sequence[str], after: int = 0, id_column: str = "id", part_rows: int = PART_ROWS
) -> DataFrame:
    """``df`` with ids ``after + 1, after + 2, …`` in the order of ``order_by``, without writing it first.

    Rows that tie are told apart by a hash of the row, and then by its values,
    so ids depend on the rows alone: a task that runs again gives equal ones.
    Parts are ranges of that order, cut at sampled rows. What comes to the
    driver is the cuts and a row count for each part, from which every part
    knows where its ids begin. Where copies of one row fill more than a part,
    copies are counted before they are shuffled and numbered in pieces. This
    call runs the jobs that count.
    """
    if not order_by:
        raise ValueError("ids follow an order")
    columns = df.columns
    keyed = df.withColumn("_tie", F.xxhash64(*columns))
    order = [*order_by, "_tie"]
    rows = df.count()
    parts = min(MOST_PARTS, math.ceil(rows / part_rows))
    part, starts, crowded = F.lit(0), {0: after}, False
    if parts > 1:
        part = _part(keyed, order, _cuts(keyed, order, rows, parts))
        counts = dict(keyed.groupBy(part.alias("part")).count().collect())
        crowded = max(counts.values()) > 4 * max(part_rows, rows // parts)
        total = after
        for number in sorted(counts):
            starts[number] = total
            total += counts[number]
    starting = F.element_at(F.array(*(F.lit(starts.get(i, 0)) for i in range(max(starts) + 1))), F.col("_part") + 1)
    sort = list(dict.fromkeys([*order, *columns]))
    within = W.partitionBy("_part").orderBy(*sort)
    if not crowded:
        placed = keyed.withColumn("_part", part)
        place = starting + F.row_number().over(within)
        return placed.select(place.cast("bigint").alias(id_column), *columns)
    copies = keyed.groupBy(*columns, "_tie").agg(F.count("*").alias("_copies")).withColumn("_part", part)
    earlier = F.coalesce(F.sum("_copies").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    pieces = copies.withColumn("_first", starting + earlier + 1).withColumn(
        "_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(COPIES).cast("bigint")))
    )
    begin = F.col("_first") + F.col("_at")
    end = F.col("_first") + F.least(F.col("_at") + COPIES, F.col("_copies")) - 1
    ids = F.explode(F.sequence(begin, end)).alias(id_column)
    return pieces.repartition("_first", "_at").select(ids, *columns)


def _cuts(keyed: DataFrame, order: Sequence[str], rows: int, parts: int) -> list:
    """Rows that cut the order into parts of about equal size; copies are sampled together."""
    every = max(1, rows // (parts * SAMPLES))
    sampled = keyed.where(F.pmod(F.col("_tie"), F.lit(every)) == 0).groupBy(*order).agg(F.count("*").alias("_n"))
    found = sampled.orderBy(*order).collect()
    total, seen, cuts = sum(r["_n"] for r in found), 0, []
    for row in found:
        if seen and seen * parts >= total * (len(cuts) + 1):
            cuts.append(row)
        seen += row["_n"]
    return cuts


def _part(keyed: DataFrame, order: Sequence[str], cuts: list) -> Column:
    """The number of cuts up to a row, found by halving."""
    types = {f.name: f.dataType for f in keyed.schema}
    key = F.struct(*order)

    def halves(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        cut = F.struct(*(F.lit(cuts[middle][c]).cast(types[c]).alias(c) for c in order))
        return F.when(key < cut, halves(low, middle)).otherwise(halves(middle + 1, high))

    return halves(0, len(cuts))

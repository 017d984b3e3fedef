"""What several operators of this subpackage need."""

from __future__ import annotations

import gc
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.session import scratch_path

# Words are runs of anything but these six characters.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(text: Column | str = "text") -> Column:
    """The text, a null one read as empty."""
    return F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS, -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words, counted as the beginnings of words."""
    return F.size(words_of(text)).cast("bigint")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


# Who holds caches in this Python worker, and how they are let go.
_holders: dict[str, Callable[[], object]] = {}


def seldom_collected() -> None:
    """Let this worker look for cycles less often: operators make many objects and hardly any cycle."""
    gc.set_threshold(200_000, 20, 50)


def only_holder(name: str, let_go: Callable[[], object]) -> None:
    """Let go of what other operators keep in this worker.

    A worker serves the tasks of one operator after another, and caches that
    outlive tasks would add up.
    """
    for other in [n for n in _holders if n != name]:
        _holders.pop(other)()
    _holders[name] = let_go


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, where no lost executor takes it along."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def source_key(source: Column | str = "source") -> Column:
    """A text that tells sources apart and orders them by code point, the null one last."""
    col = source if isinstance(source, Column) else F.col(source)
    return F.coalesce(F.concat(F.lit("a"), col.cast("string")), F.lit("b"))


def shuffle_key(seed: int, *parts: Column) -> Column:
    """32 hexadecimal digits that look random and depend on the row's values alone."""
    texts = (F.coalesce(p.cast("string"), F.lit("null")) for p in parts)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def rank_cells(
    df: DataFrame, group: str, cell: Sequence[str], sums: dict[str, Column] | None = None
) -> DataFrame:
    """A row per group and cell: its rows, and the group's rows in the cells before it.

    Rows are counted where they lie, so a group with most of the rows is one
    row per cell when it meets itself. ``sums`` adds totals of the group.
    """
    sums = sums or {}
    cells = df.groupBy(group, *cell).agg(
        F.count(F.lit(1)).alias("__rows"), *(F.sum(c).alias(n) for n, c in sums.items())
    )
    whole = Window.partitionBy(group)
    before = whole.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(
        group,
        *cell,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(whole).alias("__group_rows"),
        *(F.sum(n).over(whole).alias(n) for n in sums),
    )


def with_rank(
    df: DataFrame, cells: DataFrame, group: str, cell: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``__rank`` from 1 within the group by cell, then ``order``; cells are sorted apart.

    Rows meet in a task by cell only, never by group.
    """
    within = Window.partitionBy(group, *cell).orderBy(*order)
    ranked = df.withColumn("__within", F.row_number().over(within))
    return ranked.join(cells, [group, *cell]).withColumn(
        "__rank", F.col("__before") + F.col("__within")
    ).drop("__within", "__before")

"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.shared import (
    rank_cells, shuffle_key, source_key, whole_text, with_rank, word_count, written,
)


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: int
) -> DataFrame:
    """``target`` of each source (``__source``, ``source_size``).

    Weights repeat over the sources in order. ``share`` of all words is dealt
    out by weight; a target stops at ``most`` times its source, and the rest of
    it is dealt out again to the others until none is above. Sources fill up in
    the order of size to weight, so the level at which that ends is found by
    running sums over one row per source.
    """
    by_name = Window.orderBy("__source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn(
        "__weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    )
    filling = Window.orderBy(F.col("source_size") / F.col("__weight"), "__source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # The level a source would get if all that fill up sooner were full.
    left = F.sum("source_size").over(everything) * share - F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    ) * most
    weight_left = F.sum("__weight").over(everything) - F.coalesce(
        F.sum("__weight").over(before), F.lit(0)
    )
    levels = weighed.withColumn("__level", left / weight_left)
    full = F.col("__weight") * F.col("__level") >= F.col("source_size") * most
    levels = levels.withColumn("__level", F.when(~full, F.col("__level")))
    # The first source that does not fill up sets the level for all after it.
    first_open = F.first("__level", ignorenulls=True).over(
        filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    capped = (F.col("source_size") * most).cast("double")
    target = F.least(capped, F.coalesce(F.col("__weight") * first_open, capped))
    return levels.select("__source", "source_size", target.alias("target"))


def size_class(size: Column) -> Column:
    """Sizes of the same length in binary and the same first four digits, as sortable text."""
    digits = F.bin(size)
    return F.concat(
        F.lpad(F.length(digits).cast("string"), 2, "0"),
        F.rpad(F.substring(digits, 1, 4), 4, "0"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int],
    *,
    share: float = 1.5,
    most: int = 2,
    seed: int = 23,
    cells: int = 16,
    size: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, replaced if there.

    A document of a source is expected ``target / source_size`` times. Within a
    source these are summed over an order by size class, then a seeded random
    key; one random offset is added, and a document is taken once for each
    whole number its sum crosses, ``most`` times at the most. The order by size
    keeps the words taken near the target.

    Size is the number of words unless given; null texts have none. Sources
    without words have the target 0 and are not taken. The null source is a
    source of its own, the last. Equal rows may change places with each other.
    An empty table gives no rows. Reruns and retries agree, as the order is
    made of values alone. Rows are sorted by size class and cell, never by
    source, and sources are summed before they meet.
    """
    added = ("size", "source_size", "target", "copies")
    size = word_count(whole_text(text)) if size is None else size
    kept = [c for c in docs.columns if c not in added]
    sized = docs.withColumn("__size", size).select(*kept, "__size").withColumns({
        "__source": source_key(source),
        "__class": size_class(F.col("__size")),
        "__key": shuffle_key(seed, F.col(doc_id), F.col("__size"), source_key(source)),
    })
    cell = F.conv(F.substring("__key", 1, 8), 16, 10).cast("bigint") * cells / 2**32
    sized = sized.withColumn("__cell", F.floor(cell).cast("int"))
    at = ["__class", "__cell"]
    narrow = sized.select("__source", *at, "__size")
    places = written(
        rank_cells(narrow, "__source", at, {"source_size": F.col("__size")}), "mix-cells"
    )
    sizes = places.groupBy("__source").agg(F.max("source_size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most).select("__source", "target")
    places = places.join(targets, "__source")
    ranked = with_rank(sized, places, "__source", at, ["__key"])
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "__source")), 1, 8), 16, 10)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ranked = ranked.withColumns({"__rate": rate, "__offset": offset.cast("double") / 2**32})
    copies = F.floor(F.col("__rank") * F.col("__rate") + F.col("__offset")) - F.floor(
        (F.col("__rank") - 1) * F.col("__rate") + F.col("__offset")
    )
    return ranked.select(
        *kept, F.col("__size").alias("size"), "source_size", "target", copies.alias("copies")
    )


def mixed_rows(docs: DataFrame, weights: Sequence[int], **options) -> DataFrame:
    """The mixture itself: every document as often as it is taken, with its own columns."""
    added = [c for c in ("size", "source_size", "target", "copies") if c in docs.columns]
    own = docs.withColumnsRenamed({c: f"__own_{c}" for c in added})
    taken = mix(own, weights, **options).filter("copies > 0")
    repeated = taken.withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    return repeated.select(
        *(F.col(f"__own_{c}").alias(c) if c in added else F.col(c) for c in docs.columns)
    )

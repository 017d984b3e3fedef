"""Shards that each hold every source in its share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.shared import rank_cells, shuffle_key, source_key, whole_text, with_rank, written

KEY_BYTES = 8


def interleave(
    docs: DataFrame,
    shards: int,
    *,
    seed: int = 17,
    cells: int = 256,
    doc_id: str = "doc_id",
    content: Column | None = None,
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``shard`` from 0 and ``slot`` from 0 within it; columns so named are replaced.

    Rows of a source are ranked in a seeded random order. The row of rank r
    among n stands at the fraction (2r - 1) / 2n, all rows are ordered by that
    fraction, then source, and the order is cut into ``shards`` runs whose
    counts differ by one at most. Every run thus has each source in its share.

    The order depends on the values of a row alone: its id, ``content`` (a hash
    of the text unless given), and source.
    Null ids, texts and sources are values of their own (the null source comes
    last), equal rows may change places with each other, and an empty table
    gives no rows. Sorting is by cell, ``cells`` to a source and ``cells`` times
    16 along the fractions, so a source with most of the rows is spread out.
    """
    spread = cells * 16
    content = F.crc32(whole_text()) if content is None else content
    keyed = docs.drop("shard", "slot").withColumns({
        "__source": source_key(source),
        "__key": shuffle_key(seed, F.col(doc_id), content, source_key(source)),
    })
    cell = F.conv(F.substring("__key", 1, 8), 16, 10).cast("bigint") * cells / 2**32
    keyed = keyed.withColumn("__cell", F.floor(cell).cast("int"))
    at = ["__source", "__cell"]
    narrow = keyed.select(*at)
    places = written(rank_cells(narrow, "__source", ["__cell"]), "shard-cells")
    n, r = F.col("__group_rows"), F.col("__rank")
    ranked = with_rank(keyed, places, "__source", ["__cell"], ["__key"]).withColumns({
        "__part": F.expr(f"(2 * __rank - 1) * {spread} div (2 * __group_rows)"),
        "__fraction": (r - 0.5) / n,
    })
    # Rows before part k: of each source, those with (2r - 1) * spread < 2nk.
    sizes = places.groupBy("__source").agg(F.max("__group_rows").alias("n"))
    each_part = F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<bigint>")
    before = sizes.select("n", F.explode(each_part).alias("__part")).groupBy("__part").agg(
        F.sum(F.expr(f"(2 * n * __part + {spread} - 1) div {2 * spread}")).alias("__start"),
        F.sum("n").alias("__all"),
    )
    order = Window.partitionBy("__part").orderBy("__fraction", "__source")
    placed = ranked.withColumn("__place", F.row_number().over(order)).join(before, "__part")
    placed = placed.withColumn("__place", F.col("__start") + F.col("__place") - 1)
    placed = placed.withColumn("shard", F.expr(f"int(__place * {shards} div __all)"))
    first = F.expr(f"(shard * __all + {shards - 1}) div {shards}")
    return placed.withColumn("slot", F.col("__place") - first).select(
        *(c for c in docs.columns if c not in ("shard", "slot")), "shard", "slot"
    )

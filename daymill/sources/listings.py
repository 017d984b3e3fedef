"""Listings of objects as tables: kept in order of their keys, compared, rolled up.

A listing has ``key``, ``size`` and whatever else tells versions of an object
apart. Kept in order, each row group of its files holds a stretch of keys, whose
first and last the file knows, so a scan by the beginning of keys reads only the
stretches it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Uncompressed bytes of a row group: small ones make the index finer.
GROUP_BYTES = 8 << 20


def write_listing(listing: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> str:
    """Keep a listing in order of its keys, over as many files as its size asks for."""
    ordered = listing.repartitionByRange("key").sortWithinPartitions("key")
    ordered.write.option("parquet.block.size", group_bytes).mode("overwrite").parquet(path)
    return path


def keys_by_prefix(listing: DataFrame, beginning: str) -> DataFrame:
    """The objects whose key begins with ``beginning``, which may end within a name."""
    return listing.where(F.col("key").startswith(beginning))


def rolled_up(listing: DataFrame, beginning: str = "", delimiter: str = "/") -> DataFrame:
    """``entry``, ``is_folder``, ``objects`` and ``size`` of what lies right below a beginning.

    Keys that go on after the next delimiter are one folder, which ends with it;
    the others stand for themselves. They are counted where they lie.
    """
    rest = F.substring("key", len(beginning) + 1, 2**31 - 1)
    at = F.instr(rest, delimiter)
    folder = F.substring(F.col("key"), F.lit(1), at + len(beginning) + len(delimiter) - 1)
    entries = keys_by_prefix(listing, beginning).select(
        F.when(at > 0, folder).otherwise(F.col("key")).alias("entry"), (at > 0).alias("is_folder"), "size"
    )
    return entries.groupBy("entry", "is_folder").agg(
        F.count("*").alias("objects"), F.sum("size").alias("size")
    )


def listing_changes(
    before: DataFrame, after: DataFrame, compared: Sequence[str] = ("size",)
) -> DataFrame:
    """``key``, ``change`` and ``size`` of what was ``added``, ``changed`` or is ``gone``.

    Keys are unique in each listing. An object has changed if any of
    ``compared`` has, null being a value of its own; ``size`` is the newer, or
    of what is gone the last. Objects that are alike are left out.
    """
    old = before.select("key", F.struct(*dict.fromkeys(("size", *compared))).alias("old"))
    new = after.select("key", F.struct(*dict.fromkeys(("size", *compared))).alias("new"))
    differs: Column = F.lit(False)
    for name in compared:
        differs |= ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone").when(differs, "changed")
    )
    size = F.when(F.col("new").isNull(), F.col("old.size")).otherwise(F.col("new.size"))
    both = old.join(new, "key", "full_outer").select("key", change.alias("change"), size.alias("size"))
    return both.where("change IS NOT NULL")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

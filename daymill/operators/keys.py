"""Primary keys against what a table holds, by bitmaps of its ids.

A bucket stands for 32,768 neighbouring ids, one bit each. An append looks at
the buckets of its own ids only, so no key of the table is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.constraints import ConstraintViolation, require_constraints
from daymill.session import staged
from daymill.sinks import snapshots

# Buckets kept in one folder, which is what an append rewrites.
SHARD_BUCKETS = 4_096
SHARD = "shard"


def key_bitmaps(ids: DataFrame, key: str) -> DataFrame:
    """``bucket`` and ``bits`` of whole-number keys; null keys have none."""
    placed = ids.where(F.col(key).isNotNull()).select(
        F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("at")
    )
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def present_keys(rows: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """The rows whose key is in the bitmaps."""
    at = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    taken = F.getbit(byte, (at % 8).cast("int")) == 1
    bucketed = rows.where(F.col(key).isNotNull()).withColumn("bucket", F.bitmap_bucket_number(key))
    return bucketed.join(bitmaps, "bucket").where(taken).select(*rows.columns)


def _shard(bucket: str = "bucket"):
    return F.floor(F.col(bucket) / SHARD_BUCKETS).cast("string")


def index_keys(spark: SparkSession, table: str, key: str, path: str) -> snapshots.Manifest:
    """Bitmaps of all keys of a table, in place of any earlier ones."""
    spark.catalog.refreshTable(table)
    stored = spark.table(table)
    return _kept(key_bitmaps(stored, key), path, stored.count(), None)


def _kept(bitmaps: DataFrame, path: str, rows: int, base: snapshots.Manifest | None) -> snapshots.Manifest:
    """Publish bitmaps, added to those of ``base`` or in place of all there are."""
    spark = bitmaps.sparkSession
    newest = snapshots.manifest(spark, path)
    with staged(bitmaps.withColumn(SHARD, _shard()), "bitmaps") as new:
        shards = [r[0] for r in new.select(SHARD).distinct().collect()]
        merged = new
        if base is not None:
            merged = new.unionByName(snapshots.read_parts(spark, path, base, shards))
        merged = merged.groupBy("bucket", SHARD).agg(F.bitmap_or_agg("bits").alias("bits")).select("bucket", "bits", SHARD)
        if base is None and newest is not None:
            # What is not written again holds no key any more.
            newest = snapshots.Manifest(newest.version, newest.schema, newest.partition, {}, newest.notes)
        return snapshots.commit(merged, path, SHARD, shards, newest, {"rows": rows})


def append_with_key(rows: DataFrame, table: str, key: str, path: str) -> None:
    """Append rows whose whole-number key is new, or fail before anything is written.

    A null key, a key that rows share, and one that the table holds already are
    violations. ``path`` has the bitmaps of the table's keys. They are made if
    there are none, or if the table was changed by anyone else or an append was
    stopped on its way, which the row count tells. One writer at a time: a
    second one that gets as far as the bitmaps fails with ``CommitConflict``.
    """
    spark = rows.sparkSession
    spark.catalog.refreshTable(table)
    with staged(rows, "append") as new:
        require_constraints(new, key=key, not_null=(key,))
        base, held = snapshots.manifest(spark, path), spark.table(table).count()
        if base is None or base.notes.get("rows") != held:
            base = index_keys(spark, table, key, path)
        bitmaps = key_bitmaps(new, key)
        shards = [r[0] for r in bitmaps.select(_shard().alias(SHARD)).distinct().collect()]
        known = snapshots.read_parts(spark, path, base, shards).drop(SHARD)
        repeated = present_keys(new.select(key), key, known).count()
        if repeated:
            raise ConstraintViolation(f"{repeated} rows have a {key} that {table} holds already")
        new.select(*spark.table(table).columns).write.insertInto(table)
        _kept(bitmaps, path, held + new.count(), base)

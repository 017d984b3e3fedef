"""Insert-or-replace by key.

Keys new to the target are inserted, known ones get the new measures and
``updated_at`` and keep ``created_at``, and all others stay as they are: a key
whose source rows are gone is not deleted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from daymill.operators.constraints import require_constraints
from daymill.session import staged
from daymill.sinks import snapshots

MEASURES = ("order_cnt", "total_amount")
PARTITION = "summary_month"
# Of tables that are merged by other keys than a date.
BUCKET, BUCKETS = "key_bucket", 64

# More touched partitions than this are matched by a join, not by a list.
LISTED_PARTITIONS = 2_000


def as_of_column(as_of: datetime | None) -> Column:
    """The clock of a write: given, or now. One query reads it once."""
    if as_of is None:
        return F.current_timestamp()
    if as_of.tzinfo is None:
        raise ValueError("as_of needs a zone")
    return F.lit(as_of)


def month_of(day: Column | str) -> Column:
    """``2024-01``, the partition a date is kept in."""
    return F.substring(F.to_date(day).cast("string"), 1, 7)


Key = str | Sequence[str]


def _columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _matched(target: DataFrame, source: DataFrame, key: Key) -> DataFrame:
    old = target.withColumn("in_target", F.lit(True)).alias("old")
    new = source.withColumn("in_source", F.lit(True)).alias("new")
    return old.join(new, _columns(key), "full_outer")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: Key = "summary_date",
    measures: Sequence[str] = MEASURES,
    as_of: datetime | None = None,
) -> DataFrame:
    """The target after the upsert. ``source`` must hold each key once."""
    now = as_of_column(as_of)
    touched, known = F.col("in_source").isNotNull(), F.col("in_target").isNotNull()

    def latest(measure: str) -> Column:
        new, old = F.col(f"new.{measure}"), F.col(f"old.{measure}")
        return F.when(touched, new).otherwise(old).alias(measure)

    return _matched(target, source, key).select(
        *_columns(key),
        *map(latest, measures),
        F.when(known, F.col("old.created_at")).otherwise(now).alias("created_at"),
        F.when(touched, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
    )


def merge_actions(target: DataFrame, source: DataFrame, key: str = "summary_date") -> DataFrame:
    """What the upsert does to each key: ``insert``, ``update`` or ``keep``."""
    action = (
        F.when(F.col("in_source").isNull(), "keep")
        .when(F.col("in_target").isNull(), "insert")
        .otherwise("update")
    )
    keys = _matched(target.select(key), source.select(key), key)
    return keys.select(key, action.alias("action"))


def _checked(new: DataFrame, key: Sequence[str], measures: Sequence[str], part: Column) -> list[str]:
    """The partitions that rows fall in, in the pass that checks keys and measures.

    Rows are counted by key where they lie, then by partition.
    """
    missing = [F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate((*key, *measures))]
    by_key = new.groupBy(*key).agg(F.count("*").alias("_n"), *missing)
    broken = sum((F.col(f"_{i}") for i in range(len(missing))), F.col("_n") - 1)
    found = by_key.groupBy(part.alias("_part")).agg(F.sum(broken).alias("_broken")).collect()
    if any(r["_broken"] for r in found):
        if len(key) == 1:
            require_constraints(new, key=key[0], not_null=(*key, *measures))
        else:
            require_constraints(new.withColumn("_key", F.struct(*key)), key="_key", not_null=(*key, *measures))
    return [r["_part"] for r in found]


def upsert_table(
    source: DataFrame,
    table: str,
    key: str = "summary_date",
    measures: Sequence[str] = MEASURES,
    as_of: datetime | None = None,
) -> None:
    """Upsert into a summary table, partitioned by the month of its key.

    The source is computed once and checked before the target is touched. Only
    months it reports are read and rewritten, for which the table must have
    ``partitionOverwriteMode`` among its options; Spark refuses to overwrite
    it otherwise. One writer per table at a time.
    """
    spark = source.sparkSession
    incoming = source.select(key, *measures)
    with staged(incoming, "upsert") as new:
        months = _checked(new, [key], measures, month_of(key))
        # Other sessions may have written since this one last listed the files.
        spark.catalog.refreshTable(table)
        target = spark.table(table)
        if not months:
            return
        if len(months) <= LISTED_PARTITIONS:
            existing = target.where(F.col(PARTITION).isin(*months))
        else:
            touched = new.select(month_of(key).alias(PARTITION)).distinct()
            existing = target.join(touched, PARTITION, "left_semi")
        merged = (
            merge_rows(existing.drop(PARTITION), new, key, measures, as_of)
            .withColumn(PARTITION, month_of(key))
            .select(*target.columns)
            .hint("rebalance", PARTITION)
        )
        merged.write.insertInto(table, overwrite=True)


def upsert_snapshot(
    source: DataFrame,
    path: str,
    key: str = "summary_date",
    measures: Sequence[str] = MEASURES,
    as_of: datetime | None = None,
    notes: dict | None = None,
    base: snapshots.Manifest | None = None,
) -> snapshots.Manifest | None:
    """Upsert into a snapshot table, all months in one commit.

    A job that stops on the way leaves the table as it was, and readers never
    see some months new and others old. The first upsert makes the table. Only
    months that the source reports are read and written. Two writers at once
    are told apart: the later one fails with ``CommitConflict``. ``base`` is the
    version to start from, the newest if not given; ``notes`` are published
    along with the rows. Without rows and notes there is no new version.
    """
    return _publish_merged(source, path, key, measures, as_of, PARTITION, month_of(key), notes, base)


def merge_into(
    source: DataFrame,
    path: str,
    key: Key,
    measures: Sequence[str],
    as_of: datetime | None = None,
    buckets: int = BUCKETS,
    base: snapshots.Manifest | None = None,
) -> snapshots.Manifest | None:
    """Merge into a snapshot table by any key: matched rows are updated, others inserted, in one commit.

    The key may have several columns, none null and no two rows alike. The
    table is kept in ``buckets`` by a hash of the key, of which those that the
    source reports are read and written; the number must not change once the
    table is made. All else is as with ``upsert_snapshot``.
    """
    bucket = F.lpad(F.pmod(F.xxhash64(*_columns(key)), F.lit(buckets)).cast("string"), 6, "0")
    made = base or snapshots.manifest(source.sparkSession, path)
    if made is not None and made.notes.get("buckets") != buckets:
        raise ValueError(f"{path} is kept in {made.notes.get('buckets')} buckets")
    return _publish_merged(source, path, key, measures, as_of, BUCKET, bucket, {"buckets": buckets}, made)


def _publish_merged(
    source: DataFrame,
    path: str,
    key: Key,
    measures: Sequence[str],
    as_of: datetime | None,
    partition: str,
    part: Column,
    notes: dict | None,
    base: snapshots.Manifest | None,
) -> snapshots.Manifest | None:
    spark = source.sparkSession
    names = _columns(key)
    with staged(source.select(*names, *measures), "upsert") as new:
        touched = _checked(new, names, measures, part)
        base = base or snapshots.manifest(spark, path)
        if not touched and (notes is None or base and notes == base.notes):
            return base
        if base is None:
            columns = new.select(
                *names, *measures, *(F.current_timestamp().alias(c) for c in ("created_at", "updated_at")),
                part.alias(partition),
            )
            existing = spark.createDataFrame([], columns.schema)
        else:
            existing = snapshots.read_parts(spark, path, base, touched)
        merged = merge_rows(existing.drop(partition), new, key, measures, as_of)
        merged = merged.withColumn(partition, part).to(_nullable(existing.schema))
        return snapshots.commit(merged, path, partition, touched, base, notes)


def _nullable(schema: StructType) -> StructType:
    """The columns as files have them."""
    return StructType([StructField(f.name, f.dataType) for f in schema])

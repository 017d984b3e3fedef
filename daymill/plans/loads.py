"""Whole jobs: summaries into tables, tables into the lake, feed into files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.functions import clock
from daymill.operators.coverage import not_covered, uncovered_ranges
from daymill.operators.market import build_coin_frame
from daymill.operators.summaries import INTERVAL, interval_summary, last_interval_wins
from daymill.operators.upsert import MEASURES, upsert_snapshot, upsert_table
from daymill.plans.calendars import missing_intervals
from daymill.plans.sql_files import holds_instants, run_file
from daymill.plans.tables import create_intervals, create_summary
from daymill.session import staged
from daymill.sinks import snapshots
from daymill.sinks.files import publish, write_by_run_date


def load_summary(
    facts: DataFrame,
    calendar: DataFrame,
    table: str,
    ts: str = "order_dt",
    amount: str = "amount",
    zone: str | None = None,
    as_of: datetime | None = None,
) -> None:
    """Bring a summary table up to date for every run of a calendar.

    One run, a backfill of years and a catch-up are the same job.
    """
    create_summary(facts.sparkSession, table)
    summary = last_interval_wins(interval_summary(facts, calendar, ts, amount, zone))
    upsert_table(summary, table, as_of=as_of)


def load_summary_from_file(
    spark: SparkSession,
    src_schema: str,
    table: str,
    start: datetime,
    end: datetime,
    zone: str | None = None,
    as_of: datetime | None = None,
    *,
    name: str = "daily_summary",
    search_path: Sequence[str | Path] = (),
    key: str = "summary_date",
    measures: Sequence[str] = MEASURES,
    **params,
) -> None:
    """The same for one interval, with the summary taken from a SQL file.

    The file may be any that returns ``key``, a date, and ``measures``; it takes
    ``:src_schema``, ``:start``, ``:end``, ``:zone`` and ``params``. A table of
    other columns than the daily summary's must be there already.
    """
    if (key, *measures) == ("summary_date", *MEASURES):
        create_summary(spark, table)
    summary = run_file(
        spark, name, search_path, zone, holds_instants(spark, f"{src_schema}.orders", "order_dt"),
        src_schema=src_schema, start=start, end=end, **params,
    )
    upsert_table(summary, table, key, measures, as_of)


def catch_up(
    facts: DataFrame,
    calendar: DataFrame,
    table: str,
    processed: str,
    ts: str = "order_dt",
    amount: str = "amount",
    zone: str | None = None,
    as_of: datetime | None = None,
) -> None:
    """Load every interval of a calendar that the table ``processed`` does not list yet.

    Intervals are listed there after their rows are in the summary, those
    without rows too, so an empty one is not taken up again. A run that stops
    between the two is repeated without harm, as totals are replaced. Intervals
    are told apart by their start and must not overlap.
    """
    spark = facts.sparkSession
    create_intervals(spark, processed)
    spark.catalog.refreshTable(processed)
    missing = missing_intervals(calendar, spark.table(processed))
    with staged(missing.select("interval_start", "interval_end"), "missing") as todo:
        load_summary(facts, todo, table, ts, amount, zone, as_of)
        todo.write.insertInto(processed)


def catch_up_snapshot(
    facts: DataFrame,
    calendar: DataFrame,
    path: str,
    ts: str = "order_dt",
    amount: str = "amount",
    zone: str | None = None,
    as_of: datetime | None = None,
) -> snapshots.Manifest | None:
    """Load every interval of a calendar that is not processed as a whole, in one commit.

    What has been processed is kept as ranges with the rows, so intervals may be
    cut otherwise than in earlier runs, overlap, and nest: one of which any time
    is missing is loaded again as a whole, all others are left alone. Rows and
    ranges are published together; a run that stops changes neither, and of two
    at once the later fails with ``CommitConflict``. The ranges of a manifest
    are merged, so there are as many as there are holes between them.
    """
    spark = facts.sparkSession
    base = snapshots.manifest(spark, path)
    known = [tuple(map(datetime.fromisoformat, r)) for r in (base.notes.get("processed", []) if base else [])]
    processed = spark.createDataFrame(known, "interval_start TIMESTAMP_NTZ, interval_end TIMESTAMP_NTZ")
    with staged(not_covered(calendar, processed).select(*INTERVAL), "missing") as todo:
        if todo.isEmpty():
            return base
        ranges = uncovered_ranges(processed.unionByName(todo), processed.limit(0)).collect()
        summary = last_interval_wins(interval_summary(facts, todo, ts, amount, zone))
        notes = {"processed": [[m.isoformat() for m in r] for r in sorted(map(tuple, ranges))]}
        return upsert_snapshot(summary, path, as_of=as_of, notes=notes, base=base)


def table_to_lake(
    rows: DataFrame, uri: str, file_format: str = "parquet", replace: bool = True
) -> str:
    """A table, as any reader gives it, straight into the object store."""
    return publish(rows, uri, file_format, replace)


def load_market_feed(payloads: DataFrame, path: str, keys: tuple[str, ...] = ()) -> str:
    """Payloads into CSV, one folder per UTC date."""
    frame = build_coin_frame(payloads, keys)
    day = clock.dashed_day(clock.instant_to_wall("datetime"))
    return write_by_run_date(frame.withColumn("run_date", F.to_date(day)), path, file_format="csv")

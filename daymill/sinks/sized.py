"""Folders by run date with files of about one size.

Bytes per row are learned from a sample of each date written in the wanted
format. Large dates are then cut into as many files as their bytes ask for, and
small ones packed into tasks, so neither one heavy date nor many light ones
decide how long a write takes.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.session import scratch_path
from daymill.sinks import files, storage

TARGET_BYTES = 128 << 20
# Rows of each date that are written to see how large they get, about.
SAMPLE_ROWS = 2_000


def text_bytes(df: DataFrame, columns: list[str]) -> Column:
    """What a row takes as text, which tells wide rows from narrow ones."""
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(len(columns)))


def bytes_by_date(df: DataFrame, run_date: str, file_format: str) -> list[tuple]:
    """``(date, bytes, rows)`` of each date, bytes as estimated for files of a format.

    One pass counts rows and their length as text by date. A sample of each
    date, some thousand rows chosen by their hash, is then written, and the
    bytes of its files for each byte of text are taken for the whole date.
    """
    columns = [c for c in df.columns if c != run_date]
    sized = df.withColumn("_text", text_bytes(df, columns).cast("bigint"))
    whole = sized.groupBy(run_date).agg(F.count("*").alias("_rows"), F.sum("_text").alias("_bytes"))
    counted = whole.collect()  # a row for each folder that is written
    if not counted:
        return []
    every = whole.select(F.col(run_date).alias("_date"), F.greatest(F.lit(1), (F.col("_rows") / SAMPLE_ROWS).cast("bigint")).alias("_every"))
    chosen = sized.join(every, F.col(run_date).eqNullSafe(F.col("_date"))).where(
        F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), F.col("_every")) == 0
    )
    path = scratch_path(df.sparkSession, "sample")
    spark, sample = df.sparkSession, chosen.select(*columns, "_text", F.col(run_date).alias("_of"))
    files.write_by_run_date(sample, path, "_of", file_format)
    found = {n: storage.bytes_in(spark, f"{path}/{n}") for n in storage.names_in(spark, path) if "=" in n}
    texts = spark.read.format(file_format).options(**files.CSV_OPTIONS if file_format == "csv" else {})
    sampled = texts.load(path).groupBy("_of").agg(F.sum(F.col("_text").cast("bigint")).alias("_text")).collect()
    storage.remove(spark, path)
    in_text = {storage.partition_folder(spark, "_of", str(r["_of"])): r["_text"] for r in sampled if r["_of"] is not None}
    dense = {n: found[n] / in_text[n] for n in found if in_text.get(n)}
    usual = sum(found.values()) / max(1, sum(in_text.values()))
    dates = []
    for r in counted:
        name = storage.partition_folder(spark, "_of", str(r[run_date])) if r[run_date] is not None else None
        dates.append((r[run_date], r["_bytes"] * dense.get(name, usual), r["_rows"]))
    return dates


def planned(dates: list[tuple], target: int) -> tuple[list[tuple], int]:
    """``(date, first task, tasks)`` of each date, and the number of tasks.

    A date of more than a file and a half has tasks of its own; the others are
    packed, each into the task with the fewest bytes so far.
    """
    plan, alone = [], 0
    small = []
    for date, size, _ in sorted(dates, key=lambda d: (-d[1], str(d[0]))):
        files_of = max(1, round(size / target))
        if size >= target / 2:
            plan.append((date, alone, files_of))
            alone += files_of
        else:
            small.append((date, size))
    shared = max(1, -(-int(sum(s for _, s in small)) // target)) if small else 0
    loads = [(0.0, alone + i) for i in range(shared)]
    for date, size in small:
        load, task = loads[0]
        plan.append((date, task, 1))
        heapq.heapreplace(loads, (load + size, task))
    return plan, alone + shared


def write_sized(
    df: DataFrame, path: str, run_date: str = "run_date", file_format: str = "parquet", target_bytes: int = TARGET_BYTES
) -> str:
    """One folder per run date as ``write_by_run_date``, in files of about ``target_bytes``.

    A rerun replaces only the dates it writes. Rows of a large date are dealt
    out by their hash, so a task that runs again gets the same; a task with many
    copies of a row begins a new file from time to time. A date smaller than
    half a file is one file. What comes to the driver is a row for each date.
    """
    dates = bytes_by_date(df, run_date, file_format)
    plan, tasks = planned(dates, target_bytes)
    if not plan:
        files.write_by_run_date(df, path, run_date, file_format)
        return path
    kind = df.schema[run_date].dataType.simpleString()
    table = df.sparkSession.createDataFrame(plan, f"_date {kind}, _first INT, _files INT")
    columns = [c for c in df.columns if c != run_date]
    share = F.pmod(F.xxhash64(*columns), F.col("_files"))
    dealt = df.join(table, F.col(run_date).eqNullSafe(F.col("_date"))).withColumn("_task", (F.col("_first") + share).cast("int"))
    dealt = dealt.repartitionById(tasks, "_task").select(*df.columns)
    writer = files._writer(dealt, file_format, "overwrite").option("partitionOverwriteMode", "dynamic")
    rows_of_a_file = max(rows / size for _, size, rows in dates) * 1.6 * target_bytes
    writer.option("maxRecordsPerFile", int(rows_of_a_file) + 1).partitionBy(run_date).save(path)
    return path

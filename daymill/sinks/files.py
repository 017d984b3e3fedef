"""Writing datasets.

A dataset is a folder of part files, one per task. No writer gathers rows
into a single file.
"""

from __future__ import annotations

import hashlib
import heapq
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

# Quotes are doubled and blanks kept, as other CSV readers expect.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]xxx",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}
FORMATS = ("csv", "parquet")

# A CSV file is read by one task, as its values may hold line breaks.
CSV_FILE_ROWS = 1_000_000
COPY_BYTES = 8 << 20
# Bytes that a task copies, and what opening an object costs, in bytes.
TASK_BYTES, OBJECT_BYTES = 1 << 30, 1 << 20


def _writer(df: DataFrame, file_format: str, mode: str) -> DataFrameWriter:
    if file_format not in FORMATS:
        raise ValueError(f"file_format must be one of {FORMATS}, not {file_format!r}")
    options = CSV_OPTIONS | {"maxRecordsPerFile": CSV_FILE_ROWS} if file_format == "csv" else {}
    return df.write.format(file_format).options(**options).mode(mode)


def write_files(df: DataFrame, path: str, file_format: str) -> str:
    """Write CSV or Parquet, replacing what is there. Any other format is an error."""
    _writer(df, file_format, "overwrite").save(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header and no index column."""
    return write_files(df, path, "csv")


def write_parquet(df: DataFrame, path: str) -> str:
    return write_files(df, path, "parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What ``write_csv`` wrote. CSV cannot tell empty text from null, so it reads as null.

    Values may hold line breaks. A row that does not fit the schema is an error.
    """
    options = CSV_OPTIONS | {"multiLine": "true", "mode": "FAILFAST"}
    return spark.read.schema(schema).options(**options).csv(path)


def publish(df: DataFrame, uri: str, file_format: str = "parquet", replace: bool = True) -> str:
    """Write straight to an object store; without ``replace``, what exists is an error."""
    _writer(df, file_format, "overwrite" if replace else "errorifexists").save(uri)
    return uri


def _overlap(store: fs.FileSystem, one: str, there: fs.FileSystem, other: str) -> bool:
    """Whether two paths are the same or one lies in the other."""
    if store != there:
        return False
    a, b = (f"{posixpath.normpath(p).rstrip('/')}/" for p in (one, other))
    return a.startswith(b) or b.startswith(a)


def _packed(objects: list[tuple[str, int]], tasks: int) -> list[list[str]]:
    """Names shared out so that tasks have about equal bytes, the largest objects first."""
    loads = [(0, i) for i in range(tasks)]
    packed: list[list[str]] = [[] for _ in range(tasks)]
    for name, size in sorted(objects, key=lambda o: (-o[1], o[0])):
        load, task = loads[0]
        packed[task].append(name)
        # An object costs some time however small it is.
        heapq.heapreplace(loads, (load + size + OBJECT_BYTES, task))
    return packed


def _digest(stream, sink=None) -> bytes:
    """The hash of a stream, which is written to ``sink`` as well if there is one."""
    found = hashlib.blake2b(digest_size=16)
    while part := stream.read(COPY_BYTES):
        found.update(part)
        if sink is not None:
            sink.write(part)
    return found.digest()


def _copy_object(store: fs.FileSystem, source: str, there: fs.FileSystem, target: str) -> None:
    """Copy an object under its name once the copy is complete; one that is there and equal stays."""
    there.create_dir(posixpath.dirname(target), recursive=True)
    if there.get_file_info(target).type == fs.FileType.File:
        with store.open_input_stream(source) as read, there.open_input_stream(target) as made:
            if _digest(read) == _digest(made):
                return
    beside = f"{target}.{uuid.uuid4().hex}"
    with store.open_input_stream(source) as read, there.open_output_stream(beside) as write:
        wanted = _digest(read, write)
    with there.open_input_stream(beside) as made:
        if _digest(made) != wanted:
            raise OSError(f"the copy of {source} does not equal it")
    there.move(beside, target)


def copy_dataset(spark: SparkSession, source: str, target: str) -> str:
    """Copy an object, or a folder's objects, byte for byte into a folder in place of what it holds.

    Folders within are kept, and any format will do. Objects are packed into
    tasks by their bytes, streamed, and compared with their source. They are
    copied to ``<target>.copying`` first, which takes the target's place by
    renames when it is whole, so a copy that is stopped leaves the target as it
    was, and the next goes on from what is there. A source and target that are
    the same or lie in each other are refused. The store must rename folders.
    """
    (store, top), (there, goal) = (fs.FileSystem.from_uri(u) for u in (source, target))
    goal = goal.rstrip("/")
    if _overlap(store, top, there, goal):
        raise ValueError(f"{source} and {target} overlap")
    found = [store.get_file_info(top)]
    if found[0].type == fs.FileType.NotFound:
        raise FileNotFoundError(source)
    if found[0].type == fs.FileType.Directory:
        found = store.get_file_info(fs.FileSelector(top, recursive=True))
    else:
        top = posixpath.dirname(top)
    objects = [(posixpath.relpath(f.path, top), f.size) for f in found if f.type == fs.FileType.File]
    staging = f"{goal}.copying"
    there.create_dir(staging, recursive=True)
    if objects:
        total = sum(size + OBJECT_BYTES for _, size in objects)
        tasks = min(len(objects), max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))
        packed = spark.sparkContext.broadcast(_packed(objects, tasks))

        def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (store, _), (there, _) = (fs.FileSystem.from_uri(u) for u in (source, target))
            for batch in batches:
                for task in batch.column(0).to_pylist():
                    for name in packed.value[task]:
                        _copy_object(store, posixpath.join(top, name), there, posixpath.join(staging, name))
                yield batch

        numbers = spark.range(0, tasks, 1, tasks)
        numbers.mapInArrow(copy, "id BIGINT").write.format("noop").mode("overwrite").save()
    _replace_folder(there, staging, goal, {name for name, _ in objects})
    return target


def _replace_folder(there: fs.FileSystem, staging: str, goal: str, names: set[str]) -> None:
    """Put a folder in place of another, without what an earlier, stopped copy left in it."""
    for left in there.get_file_info(fs.FileSelector(staging, recursive=True)):
        if left.type == fs.FileType.File and posixpath.relpath(left.path, staging) not in names:
            there.delete_file(left.path)
    old = None
    if there.get_file_info(goal).type != fs.FileType.NotFound:
        old = f"{goal}.{uuid.uuid4().hex}"
        there.move(goal, old)
    there.move(staging, goal)
    if old is not None:
        (there.delete_dir if there.get_file_info(old).type == fs.FileType.Directory else there.delete_file)(old)


def write_by_run_date(
    df: DataFrame, path: str, run_date: str = "run_date", file_format: str = "parquet"
) -> str:
    """One folder per run date; a rerun replaces only the dates it writes.

    Rows are gathered by date so that a date has few files, and a date too
    large for one task is split over several.
    """
    (
        _writer(df.hint("rebalance", run_date), file_format, "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_date)
        .save(path)
    )
    return path

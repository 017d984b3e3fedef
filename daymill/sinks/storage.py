"""Names, small texts and renames in whatever file system Spark reaches, from the driver."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of what lies in a folder; none if there is no such folder."""
    store, at = _at(spark, folder)
    if not store.exists(at):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(at))


def bytes_in(spark: SparkSession, folder: str) -> int:
    """The bytes of all files below a folder."""
    store, at = _at(spark, folder)
    return store.getContentSummary(at).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    store, at = _at(spark, path)
    stream = store.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, text: str, path: str) -> bool:
    """Put a text under a name of its own by one rename; false if the name is taken.

    Readers see the whole text or none. The rename is as atomic as the store's.
    """
    files = spark._jvm.org.apache.hadoop.fs
    store, at = _at(spark, path)
    beside = files.Path(at.getParent(), f".{uuid.uuid4().hex}")
    stream = store.create(beside)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    context = files.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(files, "Options$Rename")
    ways = spark.sparkContext._gateway.new_array(kind, 1)
    ways[0] = kind.NONE
    try:
        context.rename(store.makeQualified(beside), store.makeQualified(at), ways)
    except Py4JJavaError as refused:
        store.delete(beside, False)
        if "FileAlreadyExistsException" in refused.java_exception.getClass().getName():
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it."""
    store, at = _at(spark, path)
    store.delete(at, True)


def partition_folder(spark: SparkSession, column: str, value: str) -> str:
    """The name Spark gives the folder of a partition."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, value)

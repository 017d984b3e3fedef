"""Listing stored objects."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_GLOB_SIGNS = re.compile(r"([\\*?\[\]{}])")


def list_objects(spark: SparkSession, folder: str, name_filter: str | None = None) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of the objects below a folder.

    The contents are not read. As in all of Spark's listings, names that begin
    with ``_`` or ``.`` are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(folder).select("path", "length", "modificationTime")


def list_keys(
    spark: SparkSession, folder: str, beginning: str, name_filter: str | None = None
) -> DataFrame:
    """As ``list_objects``, of the keys below a folder that begin with ``beginning``.

    The beginning may end within a name. Where no key fits, no row is returned.
    """
    fitting = _GLOB_SIGNS.sub(r"\\\1", beginning) + "*"
    try:
        return list_objects(spark, f"{folder.rstrip('/')}/{fitting}", name_filter)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], "path STRING, length BIGINT, modificationTime TIMESTAMP")

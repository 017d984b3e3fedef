"""Queries on other databases, through Spark's JDBC source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How a read is divided: ranges of a column, one task and connection each."""

    column: str
    lower: int | str
    upper: int | str
    parts: int


def clean_url(url: str) -> str:
    """A database URL without its query string."""
    return url.split("?", 1)[0]


def jdbc_options(
    url: str,
    query: str,
    *,
    split: Split | None = None,
    on_connect: str | None = None,
    fetch_size: int = 10_000,
    drop_url_query: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Reader options for a SELECT.

    ``on_connect`` runs once per connection, before reading. Spark splits only
    tables, so a split query is given as a derived table. The URL's own
    properties are kept unless ``drop_url_query``.
    """
    query = query.strip().rstrip(";")
    options = {"url": clean_url(url) if drop_url_query else url, "fetchsize": str(fetch_size), **extra}
    if on_connect:
        options["sessionInitStatement"] = on_connect
    if split is None:
        return options | {"query": query}
    return options | {
        "dbtable": f"({query}) split_source",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }


def split_evenly(
    spark: SparkSession, url: str, query: str, column: str, parts: int, **options
) -> Split:
    """Ranges of ``column`` from its lowest to its highest value, as the database knows them."""
    query = query.strip().rstrip(";")
    ends = f"SELECT min({column}) AS low, max({column}) AS high FROM ({query}) q"
    low, high = read_query(spark, url, ends, **options).first()
    return Split(column, 0 if low is None else low, 0 if high is None else high, parts)


def read_query(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """The rows of a SELECT. Without a ``split`` one task reads them all."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()

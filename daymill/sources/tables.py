"""Tables, datasets and literal rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def full_scan(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Every column of a dataset; a later ``select`` still prunes the scan."""
    return spark.read.format(file_format).load(path)


def scan_orders(spark: SparkSession, schema: str = "stage") -> DataFrame:
    """The orders table of a schema, by its qualified name."""
    return spark.table(f"{schema}.orders")


def register_orders(
    spark: SparkSession, schema: str, path: str, ts: str, amount: str
) -> None:
    """Offer a Parquet dataset as ``<schema>.orders``, its columns named for orders."""
    ensure_schema(spark, schema)
    spark.sql(
        f"CREATE OR REPLACE VIEW {schema}.orders AS "
        f"SELECT {ts} AS order_dt, {amount} AS amount FROM parquet.`{path}`"
    )


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")


@contextmanager
def current_schema(spark: SparkSession, name: str) -> Iterator[None]:
    """Resolve unqualified table names in ``name``, within the block."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def literal_rows(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """A ``VALUES`` list, kept in the plan itself. ``schema`` is a DDL string."""
    fields = StructType.fromDDL(schema).fields

    def struct(row: Sequence) -> Column:
        pairs = zip(row, fields, strict=True)
        return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in pairs))

    structs = [struct(row) for row in rows]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def first_row(df: DataFrame, *order_by: Column | str) -> DataFrame:
    """The first row in a total order. Each task passes on one row."""
    return df.orderBy(*order_by).limit(1)


def session_zone() -> Column:
    return F.current_timezone().alias("session_tz")

"""Creating and filling the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.ids import numbered, with_dense_ids
from daymill.operators.upsert import PARTITION
from daymill.plans.sql_files import run_file
from daymill.sources.tables import literal_rows

# The sample users, name and age.
SAMPLE_USERS = (
    ("Alice", 30),
    ("Bob", 25),
    ("Charlie", 40),
    ("Min", 50),
    ("Jane", 28),
    ("John", 20),
)


def recreate_users(spark: SparkSession, table: str) -> None:
    """An empty users table in place of any earlier one."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:table)", args={"table": table})
    run_file(spark, "create_users", table=table)


def sample_users(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, "name STRING, age INT", SAMPLE_USERS)


def insert_users(users: DataFrame, table: str, order_by: Sequence[str] = ()) -> None:
    """Append ``name`` and ``age`` with ids after the highest so far.

    Ids follow ``order_by``, columns of ``users``, or else the rows as they
    come. Both clocks take one reading. One writer at a time.
    """
    spark = users.sparkSession
    spark.catalog.refreshTable(table)
    highest = spark.table(table).agg(F.max("id").alias("id")).first()["id"] or 0
    needed = users.select(*dict.fromkeys(("name", "age", *order_by)))

    def insert(rows: DataFrame) -> None:
        now = F.current_timestamp()
        rows.select(
            "id", "name", "age", now.alias("created_at"), now.alias("updated_at")
        ).write.insertInto(table)

    if order_by:
        insert(numbered(needed, order_by, after=highest))
        return
    with with_dense_ids(needed, after=highest) as rows:
        insert(rows)


def create_summary(spark: SparkSession, table: str) -> None:
    """The daily summary table, unless it exists; kept in one folder per month."""
    run_file(spark, "create_summary", table=table)


def create_intervals(spark: SparkSession, table: str) -> None:
    """The table of intervals processed so far, unless it exists."""
    run_file(spark, "create_intervals", table=table)


def read_summary(spark: SparkSession, table: str) -> DataFrame:
    """A summary table, as last written, without the column it is partitioned by."""
    spark.catalog.refreshTable(table)
    return spark.table(table).drop(PARTITION)

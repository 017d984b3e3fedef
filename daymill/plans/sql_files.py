"""SQL text with bound parameters.

Values are bound as typed literals, never pasted into the text, so they can
neither change the statement nor lose their zone. A statement compares moments
with a column as it is, so they are bound in that column's type: wall-clock time,
or instants if asked. ``:zone`` is bound as well, for statements that show
instants as dates or hours.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from importlib.resources import files
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from daymill.functions import clock
from daymill.sinks.files import write_files


def sql_text(name: str, search_path: Sequence[str | Path] = ()) -> str:
    """The statement in ``<name>.sql``, from the search path or else this package."""
    for folder in [*map(Path, search_path), files("daymill.plans") / "sql"]:
        candidate = folder / f"{name}.sql"
        if candidate.is_file():
            return candidate.read_text(encoding="utf-8")
    raise FileNotFoundError(f"{name}.sql is not on the search path")


def bind(zone: str | None = None, instants: bool = False, **params):
    """Parameters for ``spark.sql``; moments become wall-clock time in ``zone``, or instants."""
    literal = clock.instant_literal if instants else clock.wall_literal
    bound = {
        name: literal(value, zone) if isinstance(value, (date, datetime)) else value
        for name, value in params.items()
    }
    return {"zone": zone or "UTC", **bound}


def holds_instants(spark: SparkSession, table: str, column: str) -> bool:
    """Whether moments compared with this column must be bound as instants."""
    return spark.table(table).schema[column].dataType.typeName() == "timestamp"


def run_query(
    spark: SparkSession, sql: str, zone: str | None = None, instants: bool = False, **params
) -> DataFrame:
    """The rows of a statement whose ``:name`` markers take ``params``."""
    return spark.sql(sql, args=bind(zone, instants, **params))


def run_file(
    spark: SparkSession,
    name: str,
    search_path: Sequence[str | Path] = (),
    zone: str | None = None,
    instants: bool = False,
    **params,
) -> DataFrame:
    return run_query(spark, sql_text(name, search_path), zone, instants, **params)


def query_to_files(
    spark: SparkSession,
    sql: str,
    path: str,
    file_format: str,
    zone: str | None = None,
    instants: bool = False,
    **params,
) -> str:
    """Run a query and write its rows as CSV or Parquet."""
    return write_files(run_query(spark, sql, zone, instants, **params), path, file_format)

"""Landed price-feed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.operators.market import SERIES

PAYLOAD = ", ".join(f"{name} ARRAY<ARRAY<DOUBLE>>" for name in SERIES)

# A payload that cannot be parsed is an error, never a row of nulls.
STRICT = {"mode": "FAILFAST"}


def read_payloads(
    spark: SparkSession, path: str, keys: str = "", one_per_file: bool = False
) -> DataFrame:
    """Payloads with their three arrays of ``[ms, value]`` pairs.

    A text that is no such document fails the read; what uses an array fails if
    a document lacks it. ``keys`` is the DDL of further fields. Files of one document per line are
    split over tasks; with ``one_per_file`` a file may be written over several
    lines and is read whole.
    """
    schema = f"{keys}, {PAYLOAD}" if keys else PAYLOAD
    return spark.read.schema(schema).options(**STRICT).json(path, multiLine=one_per_file)


def parse_payload(text: Column | str) -> Column:
    """A payload from its text; fields can then be taken from the struct."""
    return F.from_json(text, PAYLOAD, STRICT)

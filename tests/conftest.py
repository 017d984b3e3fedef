from __future__ import annotations

import sys
import uuid
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daymill.session import build_session  # noqa: E402
from daymill.sources.tables import ensure_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("daymill-tests", **{
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": "1000",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """A database of the test's own."""
    name = f"t_{uuid.uuid4().hex}"
    ensure_schema(spark, name, str(tmp_path / "db"))
    return name


@pytest.fixture(params=["UTC", "America/New_York"])
def any_session_zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture
def orders(spark):
    """Build orders from ``(time, amount)`` pairs."""

    def build(*rows):
        typed = [
            (datetime.fromisoformat(ts) if ts else None, None if amount is None else Decimal(amount))
            for ts, amount in rows
        ]
        return spark.createDataFrame(typed, "order_dt TIMESTAMP_NTZ, amount DECIMAL(18,2)")

    return build

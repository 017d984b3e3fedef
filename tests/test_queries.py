"""Every registered query against its SQL."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "tools"))
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry_points  # noqa: E402
from check_oracles import compare, connect  # noqa: E402

from daymill.catalogue import QUERIES  # noqa: E402
from daymill.oracles import ORACLES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

# What shows the session zone or file times has no SQL to compare with.
ROWS_ONLY = {"a8_list_objects", "a10_session_tz"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0

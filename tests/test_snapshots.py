import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from frames import tuples
from pyspark.sql import functions as F

from daymill.operators import upsert
from daymill.operators.constraints import ConstraintViolation
from daymill.sinks import snapshots, storage

T1, T2, T3 = (datetime(2024, 5, d, 12, tzinfo=timezone.utc) for d in (1, 2, 3))


def summary(spark, *rows):
    typed = [(date.fromisoformat(d), n, None if a is None else Decimal(a)) for d, n, a in rows]
    return spark.createDataFrame(typed, "summary_date DATE, order_cnt BIGINT, total_amount DECIMAL(18,2)")


def stored(spark, path, version=None):
    rows = snapshots.read_snapshot(spark, path, version).orderBy("summary_date").collect()
    return [(str(r.summary_date), r.order_cnt, r.created_at.day, r.updated_at.day) for r in rows]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


FIRST = (("2024-01-30", 1, 1), ("2024-02-01", 2, 2), ("2024-03-01", 3, 3))
SECOND = (("2024-01-31", 10, 10), ("2024-02-01", 20, 20), ("2024-04-01", 40, 40))
AFTER_FIRST = [("2024-01-30", 1, 1, 1), ("2024-02-01", 2, 1, 1), ("2024-03-01", 3, 1, 1)]
AFTER_SECOND = [
    ("2024-01-30", 1, 1, 1), ("2024-01-31", 10, 2, 2), ("2024-02-01", 20, 1, 2), ("2024-03-01", 3, 1, 1), ("2024-04-01", 40, 2, 2),
]


def test_versions_follow_each_other(spark, path):
    assert snapshots.manifest(spark, path) is None
    upsert.upsert_snapshot(summary(spark, *FIRST), path, as_of=T1)
    upsert.upsert_snapshot(summary(spark, *SECOND), path, as_of=T2)
    assert stored(spark, path) == AFTER_SECOND and stored(spark, path, 1) == AFTER_FIRST
    assert dict(snapshots.read_snapshot(spark, path).dtypes)["summary_month"] == "string"
    upsert.upsert_snapshot(summary(spark), path, as_of=T3)
    assert snapshots.versions(spark, path) == [1, 2]
    with pytest.raises(ValueError, match="version 7"):
        snapshots.read_snapshot(spark, path, 7)


def test_only_touched_months_are_read_and_written(spark, path):
    first = upsert.upsert_snapshot(summary(spark, *FIRST), path, as_of=T1)
    second = upsert.upsert_snapshot(summary(spark, *SECOND), path, as_of=T2)
    assert {m for m in second.parts if second.parts[m] == first.parts.get(m)} == {"2024-03"}
    files = snapshots.read_snapshot(spark, path).where("summary_month = '2024-03'").inputFiles()
    assert files and all("2024-03" in f for f in snapshots.read_parts(spark, path, second, ["2024-03"]).inputFiles())


def test_a_job_stopped_between_months_changes_nothing(spark, path):
    upsert.upsert_snapshot(summary(spark, *FIRST), path, as_of=T1)
    base = snapshots.manifest(spark, path)
    months = ["2024-01", "2024-02"]

    # January is written, and February fails.
    rows = snapshots.read_parts(spark, path, base, months).withColumn(
        "order_cnt", F.when(F.col("summary_month") == "2024-02", F.raise_error(F.lit("stop")).cast("bigint")).otherwise(7)
    )
    with pytest.raises(Exception, match="stop"):
        snapshots.commit(rows, path, "summary_month", months, base)
    assert stored(spark, path) == AFTER_FIRST
    upsert.upsert_snapshot(summary(spark, *SECOND), path, as_of=T2)
    assert stored(spark, path) == AFTER_SECOND


def test_a_job_stopped_before_it_publishes_changes_nothing(spark, path, monkeypatch):
    upsert.upsert_snapshot(summary(spark, *FIRST), path, as_of=T1)

    def stop(*_):
        raise OSError("stop")

    monkeypatch.setattr(storage, "publish_text", stop)
    with pytest.raises(OSError):
        upsert.upsert_snapshot(summary(spark, *SECOND), path, as_of=T2)
    monkeypatch.undo()
    assert stored(spark, path) == AFTER_FIRST
    upsert.upsert_snapshot(summary(spark, *SECOND), path, as_of=T2)
    assert stored(spark, path) == AFTER_SECOND


def test_two_writers_are_told_apart(spark, path):
    base = upsert.upsert_snapshot(summary(spark, *FIRST), path, as_of=T1)
    upsert.upsert_snapshot(summary(spark, *SECOND), path, as_of=T2)
    with pytest.raises(snapshots.CommitConflict, match="version 2"):
        upsert.upsert_snapshot(summary(spark, ("2024-01-30", 9, 9)), path, as_of=T3, base=base)
    assert stored(spark, path) == AFTER_SECOND


def test_bad_rows_publish_nothing(spark, path):
    for bad in ([("2024-01-31", 2, 2)] * 2, [("2024-01-31", 2, None)]):
        with pytest.raises(ConstraintViolation):
            upsert.upsert_snapshot(summary(spark, *bad), path, as_of=T1)
    assert snapshots.versions(spark, path) == []


def test_old_versions_can_be_removed(spark, path):
    for n in range(1, 5):
        upsert.upsert_snapshot(summary(spark, ("2024-01-30", n, n), (f"2024-0{n}-02", n, n)), path, as_of=T1)
    before = stored(spark, path), stored(spark, path, 3)
    snapshots.expire(spark, path, keep=2)
    assert (stored(spark, path), stored(spark, path, 3)) == before
    assert snapshots.versions(spark, path) == [3, 4]
    assert len(storage.names_in(spark, f"{path}/data/summary_month=2024-01")) == 2
    with pytest.raises(ValueError):
        snapshots.expire(spark, path, keep=0)


def test_a_text_is_published_once(spark, tmp_path):
    at = str(tmp_path / "x" / "1.json")
    assert storage.publish_text(spark, "één", at) and not storage.publish_text(spark, "two", at)
    assert storage.read_text(spark, at) == "één"
    assert [n for n in storage.names_in(spark, str(tmp_path / "x")) if not n.startswith(".")] == ["1.json"]
    assert storage.names_in(spark, str(tmp_path / "none")) == []


def test_notes_travel_with_the_rows(spark, path):
    made = upsert.upsert_snapshot(summary(spark, *FIRST), path, as_of=T1, notes={"covered": ["a"]})
    assert snapshots.manifest(spark, path).notes == made.notes == {"covered": ["a"]}
    assert json.loads(made.schema)["type"] == "struct"
    assert len(tuples(snapshots.read_snapshot(spark, path))) == 3


def test_merge_by_any_key(spark, path):
    schema = "region STRING, day DATE, n BIGINT"
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    first = spark.createDataFrame([("a", jan, 1), ("b", jan, 2), ("a", feb, 3)], schema)
    second = spark.createDataFrame([("a", jan, 10), ("c", jan, 4)], schema)
    key = ["region", "day"]
    upsert.merge_into(first, path, key, ["n"], T1, buckets=3)
    upsert.merge_into(second, path, key, ["n"], T2, buckets=3)
    rows = tuples(snapshots.read_snapshot(spark, path).select("region", "day", "n", F.dayofmonth("created_at"), F.dayofmonth("updated_at")))
    assert rows == [("a", jan, 10, 1, 2), ("a", feb, 3, 1, 1), ("b", jan, 2, 1, 1), ("c", jan, 4, 2, 2)]
    assert snapshots.read_snapshot(spark, path, 1).count() == 3
    for bad in ([("d", jan, 1), ("d", jan, 2)], [(None, jan, 1)], [("d", jan, None)]):
        with pytest.raises(ConstraintViolation):
            upsert.merge_into(spark.createDataFrame(bad, schema), path, key, ["n"], T3, buckets=3)
    with pytest.raises(ValueError, match="3 buckets"):
        upsert.merge_into(second, path, key, ["n"], T3, buckets=4)
    assert upsert.merge_into(second.limit(0), path, key, ["n"], T3, buckets=3).version == 2

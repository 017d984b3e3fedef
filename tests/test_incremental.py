from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from frames import tuples

from daymill.operators.summaries import daily_summary
from daymill.plans import tables
from daymill.streaming import incremental
from daymill.streaming.incremental import run_incremental_summary


@pytest.fixture
def arrivals(spark, tmp_path, orders):
    """A folder files arrive in, and a run over what is new."""
    source = tmp_path / "in"
    source.mkdir()

    class Arrivals:
        path = str(source)

        def add(self, *rows):
            orders(*rows).coalesce(1).write.mode("append").parquet(self.path)

        def run(self, table, **options):
            schema = orders().schema
            run_incremental_summary(spark, self.path, schema, table, str(tmp_path / "offsets"), **options)

    return Arrivals()


def totals(spark, table):
    return [r[:3] for r in tuples(tables.read_summary(spark, table))]


def test_late_rows_mend_their_day(spark, schema, arrivals):
    table = f"{schema}.s"
    arrivals.add(("2024-01-01 10:00:00", 1), ("2024-01-02 10:00:00", 2), (None, 9))
    arrivals.run(table)
    assert totals(spark, table) == [(date(2024, 1, 1), 1, Decimal(1)), (date(2024, 1, 2), 1, Decimal(2))]
    first = {r.summary_date: r for r in tables.read_summary(spark, table).collect()}
    arrivals.add(("2024-01-02 03:00:00", 4), ("2024-01-03 00:00:00", 8))
    arrivals.run(table)
    assert totals(spark, table) == tuples(daily_summary(spark.read.parquet(arrivals.path)))
    second = {r.summary_date: r for r in tables.read_summary(spark, table).collect()}
    mended, untouched = date(2024, 1, 2), date(2024, 1, 1)
    assert second[untouched] == first[untouched]
    assert second[mended].created_at == first[mended].created_at
    assert second[mended].updated_at > first[mended].updated_at


def test_a_run_without_news_changes_nothing(spark, schema, arrivals):
    table = f"{schema}.s"
    arrivals.add(("2024-01-01 10:00:00", 1))
    arrivals.run(table)
    before = tables.read_summary(spark, table).collect()
    arrivals.run(table)
    assert tables.read_summary(spark, table).collect() == before


def test_small_batches_give_the_same_table(spark, schema, arrivals):
    table = f"{schema}.s"
    for number in range(1, 5):
        arrivals.add((f"2024-01-0{number} 10:00:00", number), ("2024-01-01 11:00:00", number))
    arrivals.run(table, max_files=1)
    assert totals(spark, table) == tuples(daily_summary(spark.read.parquet(arrivals.path)))


def test_a_batch_reads_its_own_files_and_the_counts(spark, schema, arrivals, tmp_path):
    table = f"{schema}.s"
    for number in range(1, 4):
        arrivals.add((f"2024-01-0{number} 10:00:00", number), ("2024-01-01 11:00:00", number))
        arrivals.run(table)
    parts = spark.read.schema(f"{incremental.PARTS}, batch BIGINT").parquet(str(tmp_path / "offsets" / "daily_parts"))
    assert tuples(parts.groupBy("batch").count()) == [(0, 1), (1, 2), (2, 2)]
    day = tuples(incremental.touched_totals(parts, 1))
    assert day == tuples(daily_summary(spark.read.parquet(arrivals.path)).where("summary_date < '2024-01-03'"))


def test_a_repeated_batch_changes_nothing(spark, schema, arrivals, tmp_path):
    table = f"{schema}.s"
    arrivals.add(("2024-01-01 10:00:00", 1))
    arrivals.run(table)
    arrivals.add(("2024-01-01 11:00:00", 2))
    arrivals.run(table)
    before = totals(spark, table)
    for mark in (tmp_path / "offsets" / "commits").glob("*1*"):
        mark.unlink()
    arrivals.run(table)
    assert totals(spark, table) == before == [(date(2024, 1, 1), 2, Decimal(3))]


def test_instants_go_to_their_local_day(spark, schema, tmp_path):
    source, table = str(tmp_path / "in"), f"{schema}.s"
    instants = [datetime(2024, 1, 1, h, tzinfo=timezone.utc) for h in (14, 15, 16)]
    facts = spark.createDataFrame([(i, Decimal(1)) for i in instants], "order_dt TIMESTAMP, amount DECIMAL(18,2)")
    facts.coalesce(1).write.parquet(source)
    run_incremental_summary(
        spark, source, facts.schema, table, str(tmp_path / "offsets"), zone="Asia/Seoul"
    )
    assert totals(spark, table) == [(date(2024, 1, 1), 1, Decimal(1)), (date(2024, 1, 2), 2, Decimal(2))]


def written_batches(spark, root, numbers):
    """Batches of counts as the stream leaves them, counted in one after the other."""
    levels = incremental.Levels(spark, root)
    for n in numbers:
        day = date(2024, 1, 1 + n % 5)
        rows = [(day, 1, Decimal(n)), (date(2024, 2, 1), 2, None)]
        spark.createDataFrame(rows, incremental.PARTS).coalesce(1).write.mode("overwrite").parquet(f"{root}/{levels.own(n)}")
        levels.add(n)
    return levels


def sums(levels, batches):
    return tuples(incremental.added_up(levels.read(levels.before(batches))))


def plain_sums(batches):
    days = {date(2024, 1, 1 + d): [n for n in range(batches) if n % 5 == d] for d in range(5)}
    return [(d, len(ns), Decimal(sum(ns))) for d, ns in sorted(days.items()) if ns] + [(date(2024, 2, 1), 2 * batches, None)]


def test_few_folders_hold_many_batches(spark, tmp_path):
    levels = written_batches(spark, str(tmp_path), range(37))
    found = levels.before(37)
    assert [x.batches for x in found] == [32, 4, 1]
    assert sums(levels, 37) == plain_sums(37)
    # What is no longer named is gone, but for the last batches.
    kept = {p.name for p in (tmp_path / "daily_parts").iterdir()} | {p.name for p in (tmp_path / "daily_levels").glob("sum-*")}
    assert len(kept) <= 9 and len(list((tmp_path / "daily_levels").glob("*.json"))) == incremental.KEPT


def test_a_failure_while_merging_changes_nothing(spark, tmp_path, monkeypatch):
    levels = written_batches(spark, str(tmp_path), range(7))
    with monkeypatch.context() as patched:
        def stop(*_):
            raise OSError("stop")

        patched.setattr(incremental.storage, "publish_text", stop)
        with pytest.raises(OSError):
            written_batches(spark, str(tmp_path), [7])
    assert sums(levels, 7) == plain_sums(7) and [x.batches for x in levels.before(7)] == [4, 2, 1]
    for _ in range(2):
        written_batches(spark, str(tmp_path), [7])
    assert sums(levels, 8) == plain_sums(8) and [x.batches for x in levels.before(8)] == [8]


def test_batches_from_before_there_were_levels_are_taken_up(spark, tmp_path):
    levels = incremental.Levels(spark, str(tmp_path))
    for n in range(3):
        written = spark.createDataFrame([(date(2024, 1, 1), 1, Decimal(n))], incremental.PARTS)
        written.write.parquet(f"{tmp_path}/{levels.own(n)}")
    assert levels.before(2) == [incremental.Level(levels.own(n), 1) for n in range(2)]
    assert [x.batches for x in levels.add(2)] == [3]
    assert sums(levels, 3) == [(date(2024, 1, 1), 3, Decimal(3))]

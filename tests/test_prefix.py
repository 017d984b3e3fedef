import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from frames import plan_of, tuples
from pyspark.sql import functions as F

from daymill.operators import coverage, intervals, prefix, summaries
from daymill.operators.prefix import running_sums, totals_between
from daymill.plans import calendars as C
from daymill.plans import cron

START = datetime(2024, 1, 1)
INTERVALS = "interval_start TIMESTAMP_NTZ, interval_end TIMESTAMP_NTZ"


def moments(seed, n, days=3):
    """Moments of all distances, a third of them within one second."""
    rng = random.Random(seed)
    hot = START + timedelta(hours=30, seconds=7)
    return [
        hot + timedelta(microseconds=rng.randrange(1_000_000)) if rng.random() < 0.33
        else START + timedelta(microseconds=rng.randrange(days * 86_400_000_000))
        for _ in range(n)
    ]


def random_spans(seed, n, longest_hours=30):
    rng = random.Random(seed)
    spots = moments(seed, n)
    spans = [(a, a + timedelta(seconds=rng.randrange(longest_hours * 3_600))) for a in spots]
    spans += [(a, a) for a in spots[:2]] + [spans[0]] * 3 + [(spans[0][1], spans[0][1] + timedelta(hours=1))]
    return [*spans, (None, START), (START, None), (START + timedelta(1), START)]


@pytest.fixture(params=[prefix.ONE_TASK, 0])
def one_task(request, monkeypatch):
    """Few moments, and so many that they are summed up by second and day."""
    monkeypatch.setattr(prefix, "ONE_TASK", request.param)


def test_running_sums(spark, one_task):
    spots = sorted(set(moments(1, 500)))
    rows = spark.createDataFrame([(m, i, -i) for i, m in enumerate(spots)], "moment TIMESTAMP_NTZ, a BIGINT, b BIGINT")
    got = running_sums(rows.repartition(5), ("a", "b")).collect()
    assert len(got) == len(spots)
    for r in got:
        assert r.a_before == sum(range(r.a)) == -r.b_before


def test_totals_between_equal_brute_force(spark, one_task):
    rows = [(m, Decimal(i % 7)) for i, m in enumerate(moments(2, 400))] + [(None, Decimal(9))]
    spans = [s for s in random_spans(3, 40) if None not in s and s[0] < s[1]]
    facts = spark.createDataFrame(rows, "at TIMESTAMP_NTZ, v DECIMAL(18,2)")
    got = totals_between(facts, spark.createDataFrame(spans, INTERVALS), {"n": F.lit(1), "v": F.col("v")}, F.col("at"))
    inside = [[v for m, v in rows if m is not None and s <= m < e] for s, e in spans]
    assert sorted(map(tuple, got.collect())) == sorted((s, e, len(x), sum(x)) for (s, e), x in zip(spans, inside))


def test_interval_totals(spark, one_task):
    rows = [(m, None if i % 3 else Decimal(i)) for i, m in enumerate(moments(4, 300))] + [(None, Decimal(1))]
    facts = spark.createDataFrame(rows, "order_dt TIMESTAMP_NTZ, amount DECIMAL(18,2)")
    spans = random_spans(5, 30)
    lone = rows[1][0]
    spans += [(lone, lone + timedelta(microseconds=1)), (datetime(1990, 1, 1), datetime(1990, 1, 2))]
    calendar = spark.createDataFrame(spans, INTERVALS)
    wanted = []
    for s, e in {x for x in spans if None not in x and x[0] < x[1]}:
        found = [a for m, a in rows if m is not None and s <= m < e]
        given = [a for a in found if a is not None]
        if found:
            wanted.append((s, e, len(found), sum(given) if given else None))
    got = summaries.interval_totals(facts, calendar)
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    assert dict(got.dtypes)["total_amount"] == "decimal(18,2)"
    assert summaries.interval_totals(facts, calendar.where("false")).count() == 0


def test_nothing_grows_with_the_overlap(spark, monkeypatch):
    """Windows a hundred times as long: no step of the plan makes more rows."""
    monkeypatch.setattr(prefix, "ONE_TASK", 0)
    bounds = C.fixed_bounds(spark, START, START + timedelta(days=4))
    facts = spark.createDataFrame(
        [(START + timedelta(minutes=i), Decimal(1)) for i in range(5_000)], "order_dt TIMESTAMP_NTZ, amount DECIMAL(18,2)"
    )

    def most_rows(length):
        frame = summaries.interval_totals(facts, cron.cron_window_calendar(bounds, "@hourly", length))
        assert len(frame.collect()) > 80
        plan = plan_of(frame)
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        counts, todo = [], [frame._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            name = node.getClass().getSimpleName()
            if name == "AdaptiveSparkPlanExec":
                todo.append(node.executedPlan())
            elif name.endswith("QueryStageExec"):
                todo.append(node.plan())
            else:
                metric = node.metrics().get("numOutputRows")
                counts += [metric.get().value()] if metric.isDefined() else []
                todo += [node.children().apply(i) for i in range(node.children().size())]
        return max(counts)

    assert most_rows("100 HOUR") <= 1.1 * most_rows("1 HOUR")


def test_overlapping_intervals_are_not_joined_row_by_row(spark):
    facts = spark.createDataFrame([(m, 1.0) for m in moments(6, 200)], "order_dt TIMESTAMP_NTZ, amount DOUBLE")
    bounds = C.fixed_bounds(spark, START, START + timedelta(days=3))
    calendar = cron.cron_window_calendar(bounds, "15 * * * *", "20 HOUR")
    extent = intervals.calendar_extent(calendar)
    assert extent.overlap > summaries.MOST_OVERLAP and extent.pieces < intervals.BROADCAST_PIECES
    got = summaries.interval_summary(facts, calendar)
    joined = intervals.interval_join(facts, calendar, "order_dt")
    plain = joined.groupBy("interval_start", "interval_end", F.to_date("order_dt").alias("summary_date")).count()
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(map(tuple, plain.collect()))


# Coverage


def brute_uncovered(wanted, done):
    edges = sorted({m for s, e in [*wanted, *done] if s and e and s < e for m in (s, e)})
    inside = lambda a, spans: any(s and e and s <= a < e for s, e in spans)
    found = []
    for a, b in zip(edges, edges[1:]):
        if inside(a, wanted) and not inside(a, done):
            if found and found[-1][1] == a:
                found[-1] = (found[-1][0], b)
            else:
                found.append((a, b))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_uncovered_ranges_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix, "ONE_TASK", prefix.ONE_TASK if seed % 2 else 0)
    wanted, done = random_spans(seed, 12, 20), random_spans(seed + 50, 1 + 10 * seed, 9)
    frames = [spark.createDataFrame(x, INTERVALS) for x in (wanted, done)]
    assert tuples(coverage.uncovered_ranges(*frames)) == brute_uncovered(wanted, done)
    gaps = brute_uncovered(wanted, done)
    partly = [w for w in wanted if None not in w and w[0] < w[1] and any(a < w[1] and b > w[0] for a, b in gaps)]
    named = frames[0].withColumn("name", F.lit("x"))
    assert tuples(coverage.not_covered(named, frames[1])) == sorted((*w, "x") for w in partly)


def test_uncovered_ranges_of_nothing(spark):
    none, day = spark.createDataFrame([], INTERVALS), (START, START + timedelta(1))
    one = spark.createDataFrame([day], INTERVALS)
    assert tuples(coverage.uncovered_ranges(none, one)) == []
    assert tuples(coverage.uncovered_ranges(one, none)) == [day]
    assert tuples(coverage.uncovered_ranges(one, one)) == []
    halves = [(START, START + timedelta(hours=12)), (START + timedelta(hours=12), day[1])]
    assert tuples(coverage.not_covered(one, spark.createDataFrame(halves, INTERVALS))) == []


def test_long_calendars_leave_gaps_out(spark, monkeypatch):
    monkeypatch.setattr(intervals, "LISTED_INTERVALS", 3)
    at = lambda text: datetime.fromisoformat(text)
    spans = [(at("2024-01-02 03:00"), at("2024-01-02 04:00")), (at("2024-01-01 05:00"), at("2024-01-03 00:00")),
             (at("2024-05-01 22:00"), at("2024-05-02 01:00")), (at("2030-01-01"), at("2030-01-02 12:00"))]
    extent = intervals.calendar_extent(spark.createDataFrame(spans, INTERVALS))
    assert extent.ranges == (
        (at("2024-01-01 05:00"), at("2024-01-03")), (at("2024-05-01"), at("2024-05-03")), (at("2030-01-01"), at("2030-01-02 12:00")),
    )

import random
from collections import Counter, defaultdict
from datetime import date, datetime, time, timedelta, timezone
from decimal import Decimal

import pytest
from frames import plan_of, tuples
from pyspark.sql import functions as F

from daymill.operators import filters, intervals, summaries
from daymill.plans import calendars as C

JAN = (date(2024, 1, 1), date(2024, 1, 31))


def days(summary):
    return {r.summary_date: (r.order_cnt, r.total_amount) for r in summary.collect()}


def test_interval_is_half_open(orders):
    facts = orders(
        ("2024-01-01 23:59:59.999999", 1), ("2024-01-02 00:00:00", 2),
        ("2024-01-02 23:59:59.999999", 4), ("2024-01-03 00:00:00", 8),
    )
    got = days(summaries.daily_summary(facts, start=date(2024, 1, 2), end=date(2024, 1, 3)))
    assert got == {date(2024, 1, 2): (2, Decimal("6.00"))}


def test_empty_interval_gives_no_row(orders):
    facts = orders(("2024-01-01 10:00:00", 1))
    assert days(summaries.daily_summary(facts, start=date(2024, 1, 2), end=date(2024, 1, 3))) == {}


def test_nulls(orders):
    facts = orders(
        ("2024-01-01 01:00:00", 1.5), ("2024-01-01 02:00:00", None),
        ("2024-01-02 01:00:00", None), (None, 7),
    )
    assert days(summaries.daily_summary(facts)) == {
        date(2024, 1, 1): (2, Decimal("1.50")), date(2024, 1, 2): (1, None),
    }


def test_summary_types(orders):
    types = dict(summaries.daily_summary(orders(("2024-01-01 01:00:00", 1))).dtypes)
    assert types == {"summary_date": "date", "order_cnt": "bigint", "total_amount": "decimal(18,2)"}


def test_total_beyond_its_type_is_an_error(spark):
    facts = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01' AS order_dt, CAST('9999999999999999.99' AS DECIMAL(18,2)) AS amount "
        "FROM range(2)"
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        summaries.daily_summary(facts).collect()


def test_instants_are_summed_up_by_local_date(spark, any_session_zone):
    instants = [datetime(2024, 1, 1, h, tzinfo=timezone.utc) for h in (14, 15, 16)]
    facts = spark.createDataFrame([(i, 1.0) for i in instants], "order_dt TIMESTAMP, amount DOUBLE")
    assert days(summaries.daily_summary(facts, zone="Asia/Seoul")) == {
        date(2024, 1, 1): (1, Decimal("1.00")), date(2024, 1, 2): (2, Decimal("2.00")),
    }
    one_day = summaries.daily_summary(
        facts, start=date(2024, 1, 2), end=date(2024, 1, 3), zone="Asia/Seoul"
    )
    assert days(one_day) == {date(2024, 1, 2): (2, Decimal("2.00"))}
    with pytest.raises(ValueError, match="zone"):
        summaries.daily_summary(facts)


def test_hourly_count_is_in_order(orders, any_session_zone):
    facts = orders(
        ("2024-03-10 03:10:00", 1), ("2024-03-10 02:59:59", 1), ("2024-03-10 02:00:00", 1), ("2024-03-11 00:00:00", 1)
    )
    got = summaries.hourly_count(facts, start=date(2024, 3, 10), end=date(2024, 3, 11)).collect()
    assert [tuple(r) for r in got] == [(datetime(2024, 3, 10, 2), 2), (datetime(2024, 3, 10, 3), 1)]


def test_point_window_is_the_day_before(orders):
    facts = orders(("2024-01-14 23:59:59", 1), ("2024-01-15 00:00:00", 2), ("2024-01-16 00:00:00", 4))
    assert tuples(filters.point_window(facts, "order_dt", date(2024, 1, 16))) == [
        (datetime(2024, 1, 15), Decimal("2.00"))
    ]
    late = datetime(2024, 1, 15, 15, tzinfo=timezone.utc)  # midnight in Seoul
    assert filters.point_window(facts, "order_dt", late, "Asia/Seoul").count() == 1


@pytest.mark.parametrize("end_of_day, kept", [(time(23, 59), 3), (time(23, 0), 2)])
def test_request_range_loses_the_end_of_the_day(orders, end_of_day, kept):
    facts = orders(
        ("2024-01-01 00:00:00", 1), ("2024-01-01 23:00:00", 1), ("2024-01-01 23:59:00", 1),
        ("2024-01-01 23:59:00.000001", 1), ("2023-12-31 12:00:00", 1), ("2024-01-02 00:00:00", 1),
    )
    one_day = filters.request_range(facts, "order_dt", JAN[0], JAN[0], end_of_day)
    assert one_day.count() == kept


def test_weekdays(orders):
    facts = orders(*((f"2024-01-0{d} 12:00:00", d) for d in range(1, 8)))
    got = filters.on_weekdays(facts, "order_dt", [5, 6])
    assert [r[0].day for r in tuples(got)] == [6, 7]


def random_facts(spark, n=3000, hot_share=0.4, seed=7):
    """A third and more of the rows are copies of one moment."""
    rng = random.Random(seed)
    hot = datetime(2024, 1, 10, 13, 5)
    rows = []
    for _ in range(n):
        ts = hot if rng.random() < hot_share else datetime(2024, 1, 1) + timedelta(
            microseconds=rng.randrange(20 * 86_400_000_000)
        )
        rows.append((ts, None if rng.random() < 0.05 else Decimal(rng.randrange(-500, 10_000)) / 100))
    return rows, spark.createDataFrame(rows, "order_dt TIMESTAMP_NTZ, amount DECIMAL(18,2)")


def brute_force(rows, spans):
    out = defaultdict(lambda: [0, None])
    for start, end in spans:
        for ts, amount in rows:
            if start <= ts < end:
                cell = out[start, end, ts.date()]
                cell[0] += 1
                if amount is not None:
                    cell[1] = (cell[1] or 0) + amount
    return sorted((s, e, d, n, a) for (s, e, d), (n, a) in out.items())


@pytest.fixture
def overlapping(spark):
    """Intervals that overlap, span days, lie within one, and are empty."""
    at = datetime.fromisoformat
    rows = [
        (at("2024-01-02 00:00:00"), at("2024-01-03 00:00:00")),
        (at("2024-01-02 12:00:00"), at("2024-01-05 06:00:00")),
        (at("2024-01-10 13:05:00"), at("2024-01-10 13:05:00.000001")),
        (at("2024-01-09 13:00:00"), at("2024-01-11 00:00:00")),
        (at("2024-01-12 00:00:00"), at("2024-01-12 00:00:00")),
        (at("2030-01-01 00:00:00"), at("2030-01-02 00:00:00")),
    ]
    return rows, spark.createDataFrame(rows, "interval_start TIMESTAMP_NTZ, interval_end TIMESTAMP_NTZ")


SUMMARY_TYPES = {
    "interval_start": "timestamp_ntz",
    "interval_end": "timestamp_ntz",
    "summary_date": "date",
    "order_cnt": "bigint",
    "total_amount": "decimal(18,2)",
}


@pytest.mark.parametrize("limit", [intervals.BROADCAST_PIECES, 3])
def test_interval_summary_equals_brute_force(spark, overlapping, limit):
    rows, facts = random_facts(spark)
    spans, calendar = overlapping
    assert not intervals.calendar_extent(calendar).whole_days
    got = summaries.interval_summary(facts, calendar, broadcast_pieces=limit)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows, spans)
    assert dict(got.dtypes) == SUMMARY_TYPES


def test_whole_days_equal_brute_force(spark, overlapping):
    """Intervals that overlap, share their start, and are listed twice."""
    rows, facts = random_facts(spark)
    spans = [(s, e) for s, e in (
        (datetime(2024, 1, a), datetime(2024, 1, b)) for a in range(1, 21) for b in range(a, 22, 3)
    )]
    calendar = spark.createDataFrame(spans * 2, overlapping[1].schema)
    assert intervals.calendar_extent(calendar).whole_days
    got = summaries.interval_summary(facts, calendar)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows, spans)
    assert dict(got.dtypes) == SUMMARY_TYPES


@pytest.mark.parametrize("limit", [intervals.BROADCAST_PIECES, 3])
def test_interval_join_equals_brute_force(spark, overlapping, limit):
    rows, facts = random_facts(spark, n=500)
    spans, calendar = overlapping
    got = intervals.interval_join(facts, calendar, "order_dt", broadcast_pieces=limit)
    wanted = [(ts, a, s, e) for ts, a in rows for s, e in spans if s <= ts < e]
    assert Counter(tuple(r) for r in got.collect()) == Counter(wanted)


@pytest.mark.parametrize("limit", [intervals.BROADCAST_PIECES, 3])
@pytest.mark.parametrize("seconds, width", [(5, 60), (60, 60), (2_700, 3_600), (90_000, 86_400)])
def test_buckets_follow_the_calendar(spark, seconds, width, limit):
    first = datetime(2024, 1, 1, 22, 30)
    spans = [
        (first + timedelta(seconds=n * seconds), first + timedelta(seconds=(n + 1) * seconds))
        for n in range(1_200 if seconds < 60 else 150)
    ]
    schema = "interval_start TIMESTAMP_NTZ, interval_end TIMESTAMP_NTZ"
    calendar = spark.createDataFrame(spans, schema)
    assert intervals.calendar_extent(calendar).width == width
    length = (spans[-1][1] - first) / timedelta(seconds=1)
    rows = [(first + timedelta(seconds=length * n / 400 - 3), 1.0) for n in range(410)]
    facts = spark.createDataFrame(rows, "order_dt TIMESTAMP_NTZ, amount DOUBLE")
    got = intervals.interval_join(facts, calendar, "order_dt", broadcast_pieces=limit)
    wanted = [(ts, a, s, e) for ts, a in rows for s, e in spans if s <= ts < e]
    assert Counter(tuple(r) for r in got.collect()) == Counter(wanted)
    summary = summaries.interval_summary(facts, calendar, broadcast_pieces=limit)
    counts = Counter((s, e, ts.date()) for ts, _, s, e in wanted)
    assert {tuple(r)[:4] for r in summary.collect()} == {(*k, n) for k, n in counts.items()}


def test_covering_ranges():
    def day(n):
        return datetime(2024, 1, 1) + timedelta(days=n)

    spans = [(day(30), day(31)), (day(0), day(1)), (day(1), day(3)), (day(0), day(2)), (day(6), day(7))]
    assert intervals.covering_ranges(spans) == ((day(0), day(7)), (day(30), day(31)))
    many = [(day(n), day(n + 1)) for k in range(40) for n in (k * 100 + k,)]
    ranges = intervals.covering_ranges(many)
    assert len(ranges) == intervals.MAX_RANGES
    assert all(any(a <= s and e <= b for a, b in ranges) for s, e in many)
    assert ranges[0][0] == day(0) and ranges[-1][1] == many[-1][1]


def test_long_gaps_are_not_scanned(spark, stored):
    rows = [(datetime(2024, 1, 2), datetime(2024, 1, 3)), (datetime(2024, 1, 15), datetime(2024, 1, 16))]
    calendar = spark.createDataFrame(rows, "interval_start TIMESTAMP_NTZ, interval_end TIMESTAMP_NTZ")
    summary = summaries.interval_summary(stored, calendar)
    assert (
        "Or(And(GreaterThanOrEqual(order_dt,2024-01-02T00:00),LessThan(order_dt,2024-01-03T00:00)),"
        "And(GreaterThanOrEqual(order_dt,2024-01-15T00:00),LessThan(order_dt,2024-01-16T00:00)))"
    ) in plan_of(summary)
    wanted = {
        r.summary_date: (r.order_cnt, r.total_amount)
        for r in summaries.daily_summary(stored).collect() if r.summary_date.day in (2, 15)
    }
    assert days(summary) == wanted and len(wanted) == 2


def test_calendars_too_long_to_list(spark, overlapping, monkeypatch):
    listed = intervals.calendar_extent(overlapping[1])
    monkeypatch.setattr(intervals, "LISTED_INTERVALS", 2)
    measured = intervals.calendar_extent(overlapping[1])
    assert (measured.pieces, measured.whole_days) == (listed.pieces, listed.whole_days)
    assert measured.width == listed.width
    assert measured.ranges == listed.ranges == (
        (datetime(2024, 1, 2), datetime(2024, 1, 11)), (datetime(2030, 1, 1), datetime(2030, 1, 2)),
    )


def test_interval_join_of_an_empty_calendar(spark, orders, overlapping):
    facts = orders(("2024-01-02 01:00:00", 1))
    nothing = overlapping[1].where("false")
    assert intervals.calendar_extent(nothing) is None
    assert intervals.interval_join(facts, nothing, "order_dt").count() == 0
    assert summaries.interval_summary(facts, nothing).count() == 0


def test_intervals_over_instants(spark, any_session_zone):
    instants = [datetime(2024, 1, 1, h, tzinfo=timezone.utc) for h in (14, 15, 16)]
    facts = spark.createDataFrame([(i, 1.0) for i in instants], "order_dt TIMESTAMP, amount DOUBLE")
    day = C.daily_calendar(C.fixed_bounds(spark, date(2024, 1, 2), date(2024, 1, 2)))
    longer = day.withColumn("interval_end", F.expr("interval_end + INTERVAL 1 HOUR"))
    for calendar in (day, longer):
        for limit in (10, 0):
            got = summaries.interval_summary(facts, calendar, zone="Asia/Seoul", broadcast_pieces=limit)
            assert tuples(got.drop("interval_end")) == [
                (datetime(2024, 1, 2), date(2024, 1, 2), 2, Decimal("2.00"))
            ]


def test_backfill_equals_its_daily_runs(spark):
    _, facts = random_facts(spark, n=800)
    calendar = C.daily_calendar(C.fixed_bounds(spark, date(2024, 1, 3), date(2024, 1, 12)))
    backfill = days(summaries.last_interval_wins(summaries.interval_summary(facts, calendar)))
    single = {}
    for number in range(3, 13):
        start = date(2024, 1, number)
        single |= days(summaries.daily_summary(facts, start=start, end=start + timedelta(days=1)))
    assert backfill == single


def test_last_interval_wins(spark):
    first, second, third = (datetime(2024, 1, d) for d in (1, 2, 3))
    rows = [
        (first, third, second.date(), 5, Decimal("5.00")),
        (second, third, second.date(), 1, None),
        (first, second, first.date(), 2, Decimal("9.00")),
        (first, third, first.date(), 3, Decimal("1.00")),
    ]
    summary = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in SUMMARY_TYPES.items()))
    assert days(summaries.last_interval_wins(summary)) == {
        date(2024, 1, 1): (3, Decimal("1.00")), date(2024, 1, 2): (1, None),
    }


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "facts")
    _, facts = random_facts(spark, n=200)
    facts.withColumn("other", F.lit("x")).write.parquet(path)
    return spark.read.parquet(path)


def test_bounds_reach_the_scan(stored):
    plan = plan_of(summaries.daily_summary(stored, start=JAN[0], end=JAN[1]))
    assert "GreaterThanOrEqual(order_dt,2024-01-01T00:00)" in plan
    assert "LessThan(order_dt,2024-01-31T00:00)" in plan
    assert "ReadSchema: struct<order_dt:timestamp_ntz,amount:decimal(18,2)>" in plan


@pytest.fixture
def no_automatic_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def half_days(spark):
    """The weekday calendar, moved to noon."""
    calendar = C.cron_interval_calendar(C.fixed_bounds(spark, *JAN), range(2, 7))
    return calendar.select(*((F.col(c) + F.expr("INTERVAL 12 HOUR")).alias(c) for c in C.COLUMNS))


def test_whole_days_are_counted_before_the_join(spark, stored, no_automatic_broadcast):
    calendar = C.cron_interval_calendar(C.fixed_bounds(spark, *JAN), range(2, 7))
    plan = plan_of(summaries.interval_summary(stored, calendar))
    join, counted = plan.index("SortMergeJoin"), plan.index("partial_count")
    assert join < counted and "NestedLoop" not in plan
    assert "GreaterThanOrEqual(order_dt,2024-01-02T00:00)" in plan


def test_small_calendars_are_broadcast(spark, stored, no_automatic_broadcast):
    plan = plan_of(summaries.interval_summary(stored, half_days(spark)))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan
    assert plan.index("partial_count") < plan.index("BroadcastHashJoin")
    assert "GreaterThanOrEqual(order_dt,2024-01-02T12:00)" in plan


def test_large_calendars_are_not(spark, stored, no_automatic_broadcast):
    for beyond in (
        summaries.interval_summary(stored, half_days(spark), broadcast_pieces=5),
        intervals.interval_join(stored, half_days(spark), "order_dt", broadcast_pieces=5),
    ):
        plan = plan_of(beyond)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan and "NestedLoop" not in plan


def test_heavy_days_of_a_large_calendar_are_split(spark, no_automatic_broadcast):
    """Copies of one moment make up a third of the rows of the shuffled join."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(60_000, numPartitions=8).selectExpr(
            "id",
            "TIMESTAMP_NTZ '2024-01-10 13:00:00' + make_dt_interval(IF(id % 3 = 0, 0, CAST(id % 15 AS INT))) AS order_dt",
        )
        joined = intervals.interval_join(facts, half_days(spark), "order_dt", broadcast_pieces=5)
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan_of(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_an_interval_has_both_ends_or_none(orders):
    with pytest.raises(ValueError, match="both ends"):
        summaries.daily_summary(orders(("2024-01-01T00:00:00", "1")), start="2024-01-01")

from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from frames import tuples
from pyspark.sql import functions as F

from daymill.functions import clock, text

SEOUL = "Asia/Seoul"
# New York had no 02:30 on 10 March 2024.
GAP = datetime(2024, 3, 10, 2, 30, 15, 123456)


def frame(spark, *times):
    return spark.createDataFrame([(t,) for t in times], "ts TIMESTAMP_NTZ")


def test_wall_time_moves_aware_values():
    utc = datetime(2024, 1, 1, 15, tzinfo=timezone.utc)
    assert clock.wall_time(utc, SEOUL) == datetime(2024, 1, 2)
    assert clock.wall_time(date(2024, 1, 2)) == datetime(2024, 1, 2)
    assert clock.wall_time("2024-01-02 03:00:00") == datetime(2024, 1, 2, 3)
    assert clock.wall_time("2024-01-02 00:00:00+09:00", SEOUL) == datetime(2024, 1, 2)


def test_aware_bound_without_zone_is_refused():
    with pytest.raises(ValueError, match="zone"):
        clock.wall_time(datetime(2024, 1, 1, tzinfo=timezone.utc))


def test_epoch_ms_round_trip(spark, any_session_zone):
    times = (GAP, datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2600, 5, 6, 7, 8, 9, 1000))
    ms = clock.epoch_ms("ts")
    back = clock.instant_to_wall(clock.epoch_ms_to_instant(ms))
    got = frame(spark, *times).select("ts", ms, back).collect()
    for ts, value, again in got:
        exact = (ts - datetime(1970, 1, 1)).total_seconds() * 1000
        assert value == int(exact // 1)
        assert again == ts.replace(microsecond=ts.microsecond // 1000 * 1000)


def test_instant_to_wall_keeps_microseconds(spark, any_session_zone):
    micros = [1704067207179575, 19895792889001001, -1]
    df = spark.createDataFrame([(m,) for m in micros], "us BIGINT").select(
        "us", clock.instant_to_wall(F.timestamp_micros("us")).alias("wall")
    )
    for us, wall in df.collect():
        delta = wall - datetime(1970, 1, 1)
        assert (delta.days * 86400 + delta.seconds) * 10**6 + delta.microseconds == us


def test_instant_to_wall_in_a_zone_with_summer_time(spark, any_session_zone):
    instants = [datetime(2024, 3, 10, 6, 59, tzinfo=timezone.utc), datetime(2024, 3, 10, 7, tzinfo=timezone.utc)]
    df = spark.createDataFrame([(i,) for i in instants], "at TIMESTAMP")
    got = [r[0] for r in df.select(clock.instant_to_wall("at", "America/New_York")).collect()]
    assert got == [datetime(2024, 3, 10, 1, 59), datetime(2024, 3, 10, 3)]


def test_hour_start_stays_on_the_wall_clock(spark, any_session_zone):
    df = frame(spark, GAP).select(clock.hour_start(F.col("ts")).alias("h"))
    assert df.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert df.first()["h"] == datetime(2024, 3, 10, 2)


def test_shift_zone(spark, any_session_zone):
    df = frame(spark, datetime(2024, 1, 1, 15)).select(clock.shift_zone("ts", "UTC", SEOUL))
    assert df.first()[0] == datetime(2024, 1, 2)


def test_run_date_strings(spark, any_session_zone):
    times = [GAP, datetime(2024, 3, 10, 0, 0, 0), datetime(2024, 3, 10, 0, 0, 0, 500)]
    for row, ts in zip(frame(spark, *times).select(*clock.run_date_strings("ts")).collect(), times):
        utc = ts.replace(tzinfo=timezone.utc)
        assert tuple(row) == (
            f"{utc:%Y-%m-%d}", f"{utc:%Y%m%d}", utc.isoformat(), f"{utc:%Y%m%dT%H%M%S}",
        )


def test_run_date_strings_show_utc(spark):
    row = frame(spark, datetime(2024, 1, 2)).select(*clock.run_date_strings("ts", SEOUL)).first()
    assert tuple(row) == ("2024-01-01", "20240101", "2024-01-01T15:00:00+00:00", "20240101T150000")


def test_days_of_the_week(spark, any_session_zone):
    days = [datetime(2024, 1, d) for d in range(1, 8)]  # Monday to Sunday
    got = frame(spark, *days).select(
        "ts", clock.cron_day("ts"), clock.is_weekend("ts"), clock.falls_on("ts", [clock.SUNDAY, clock.MONDAY])
    ).orderBy("ts").collect()
    assert [r[1] for r in got] == [1, 2, 3, 4, 5, 6, 0]
    assert [r[2] for r in got] == [False] * 5 + [True] * 2
    assert [r[3] for r in got] == [True] + [False] * 5 + [True]


def test_bound_literal_follows_the_column(spark):
    instants = spark.createDataFrame([(datetime(2024, 1, 1, tzinfo=timezone.utc),)], "at TIMESTAMP")
    inside = instants.where(F.col("at") >= clock.bound_literal(instants, "at", "2024-01-01 09:00:00", SEOUL))
    assert inside.count() == 1
    after = datetime(2024, 1, 1, 9, 0, 1, tzinfo=ZoneInfo(SEOUL))
    assert instants.where(F.col("at") >= clock.bound_literal(instants, "at", after)).count() == 0
    with pytest.raises(ValueError, match="zone"):
        clock.bound_literal(instants, "at", "2024-01-01")


def test_object_key_and_strip_query(spark):
    df = spark.createDataFrame([("/data/in/a.txt",), ("a.txt",), ("x/y.csv?v=1/2",)], "path STRING")
    keys = tuples(df.select(text.object_key("raw", text.strip_query("path")).alias("k")))
    assert keys == [("raw/a.txt",), ("raw/a.txt",), ("raw/y.csv",)]

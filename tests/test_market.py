import json
from datetime import datetime

import pytest
from frames import plan_of, tuples
from pyspark.sql import functions as F

from daymill.functions import clock
from daymill.operators.market import build_coin_frame, explode_series
from daymill.plans import loads
from daymill.sinks import files
from daymill.sources import market_json

MS = 1768780800123  # 2026-01-19 00:00:00.123 UTC


def payload(prices, volumes, caps, **keys):
    return json.dumps({**keys, "prices": prices, "total_volumes": volumes, "market_caps": caps, "other": 1})


@pytest.fixture
def feed(spark, tmp_path):
    """Land payloads as lines and read them."""

    def land(*texts, keys=""):
        path = tmp_path / f"feed{len(list(tmp_path.iterdir()))}"
        path.mkdir()
        (path / "p.json").write_text("\n".join(texts))
        return market_json.read_payloads(spark, str(path), keys)

    return land


def wall(frame):
    return tuples(frame.withColumn("datetime", clock.instant_to_wall("datetime")))


def test_moments_in_all_series_only(feed, any_session_zone):
    frame = build_coin_frame(feed(payload(
        [[MS, 1.5], [MS + 1000, 2.5], [MS + 2000, 3]],
        [[MS + 2000, 30], [MS, 10], [MS + 1000, 20]],
        [[MS, 100], [MS + 2000, 300]],
    )))
    assert frame.columns == ["datetime", "price", "volume", "market_cap"]
    assert wall(frame) == [
        (datetime(2026, 1, 19, 0, 0, 0, 123000), 1.5, 10.0, 100.0),
        (datetime(2026, 1, 19, 0, 0, 2, 123000), 3.0, 30.0, 300.0),
    ]


def test_repeated_moments_multiply(feed):
    frame = build_coin_frame(feed(payload([[MS, 1], [MS, 2]], [[MS, 10], [MS, 20]], [[MS, 100]])))
    assert sorted(r[1:3] for r in wall(frame)) == [(1.0, 10.0), (1.0, 20.0), (2.0, 10.0), (2.0, 20.0)]


def test_empty_series(feed):
    assert build_coin_frame(feed(payload([], [[MS, 1]], [[MS, 1]]))).count() == 0


def test_payloads_are_kept_apart_by_key(feed):
    texts = [payload([[MS, i]], [[MS, i]], [[MS, i]], coin=f"c{i}") for i in range(3)]
    frame = build_coin_frame(feed(*texts, keys="coin STRING"), keys=["coin"])
    assert sorted((r.coin, r.price, r.volume) for r in frame.collect()) == [
        (f"c{i}", float(i), float(i)) for i in range(3)
    ]
    apart = build_coin_frame(feed(*texts))
    assert sorted((r.price, r.volume, r.market_cap) for r in apart.collect()) == [(float(i),) * 3 for i in range(3)]


@pytest.mark.parametrize("text", [
    '{"prices": [[1, 2]], "total_volumes": [[1', '{"prices": [[1, 2]], "market_caps": [[1, 2]]}',
    '{"status": {"error_code": 429}}',
])
def test_bad_payloads_are_errors(spark, feed, text):
    sound = payload([[MS, 1]], [[MS, 2]], [[MS, 3]])
    with pytest.raises(Exception, match="MALFORMED|Malformed|payload without"):
        build_coin_frame(feed(sound, text)).collect()
    body = spark.createDataFrame([(sound,), (text,)], "body STRING")
    with pytest.raises(Exception, match="MALFORMED|Malformed|payload without"):
        build_coin_frame(body.select(market_json.parse_payload("body").alias("p")).select("p.*")).collect()


def test_join_needs_one_scan_and_no_shuffle(feed):
    plan = plan_of(build_coin_frame(feed(payload([[MS, 1]], [[MS, 2]], [[MS, 3]]))))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def test_long_payloads_in_any_order(feed):
    points = [[MS + 1000 * i, i] for i in range(3000)]
    frame = build_coin_frame(feed(payload(points[::-1], points[::2], points[::3])))
    assert sorted(r.price for r in frame.collect()) == [float(i) for i in range(0, 3000, 6)]


def test_one_payload_per_file(spark, tmp_path):
    text = payload([[MS, 1]], [[MS, 2]], [[MS, 3]])
    (tmp_path / "a.json").write_text(json.dumps(json.loads(text), indent=2))
    payloads = market_json.read_payloads(spark, str(tmp_path), one_per_file=True)
    assert build_coin_frame(payloads).count() == 1


def test_payload_from_a_text_column(spark):
    texts = spark.createDataFrame([(payload([[MS, 1]], [[MS, 2]], [[MS, 3]]),)], "body STRING")
    parsed = texts.select(market_json.parse_payload("body").alias("p")).select("p.*")
    assert build_coin_frame(parsed).count() == 1


def test_only_the_needed_array_is_read(feed):
    series = explode_series(feed(payload([], [], [])), "prices", "price")
    assert "ReadSchema: struct<prices:array<array<double>>>" in series._jdf.queryExecution().toString()


def test_feed_into_files_by_date(spark, feed, tmp_path):
    day = 86_400_000
    points = [[MS, 1], [MS + day, 2]]
    path = str(tmp_path / "out")
    loads.load_market_feed(feed(payload(points, points, points)), path)
    (part,) = (tmp_path / "out" / "run_date=2026-01-19").glob("*.csv")
    assert part.read_text().splitlines() == [
        "datetime,price,volume,market_cap", "2026-01-19 00:00:00.123000+00:00,1.0,1.0,1.0",
    ]
    back = files.read_csv(spark, path, "datetime TIMESTAMP, price DOUBLE, volume DOUBLE, market_cap DOUBLE, run_date DATE")
    assert [(str(r.run_date), r.price) for r in back.orderBy("price").collect()] == [("2026-01-19", 1.0), ("2026-01-20", 2.0)]
    assert back.select(F.min(clock.instant_to_wall("datetime"))).first()[0] == datetime(2026, 1, 19, 0, 0, 0, 123000)

"""Time the headline queries and print one line of JSON.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. All queries
run twice to warm up, then each five times for its median.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import timedelta

from daymill import catalogue
from daymill.operators.summaries import daily_summary
from daymill.plans import calendars
from daymill.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UPS, RUNS = 2, 5

HEADLINES = (
    "e1_daily_summary",
    "e2_hourly_count",
    "e4_backfill_summary",
    "d1_market_three_way_join",
    "d2_interval_join",
    "b7_partitioned_by_run_date",
    "b9_insert_with_ids",
    "b11_upsert_summary",
    "b13_constraint_violations",
    "h6_summary_business_interval",
    "j3_sql_file_summary",
    "k1_incremental_daily_summary",
)


def run(frame) -> None:
    """Compute every row and column, keeping none."""
    frame.write.format("noop").mode("overwrite").save()


def one_run_per_day(spark, sf_dir) -> None:
    """The shape a backfill replaces: a job of its own for each interval."""
    facts = catalogue.event_orders(spark, sf_dir)
    bounds = calendars.data_bounds(facts, "order_dt").first()
    day = bounds["first"]
    while day <= bounds["last"]:
        run(daily_summary(facts, start=day, end=day + timedelta(days=1)))
        day += timedelta(days=1)


def median_seconds(action, runs: int = RUNS) -> float:
    taken = []
    for _ in range(runs):
        began = time.perf_counter()
        action()
        taken.append(time.perf_counter() - began)
    return round(statistics.median(taken), 4)


def main() -> None:
    spark = build_session("daymill-bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str):
        return lambda: run(catalogue.QUERIES[name](spark, SF_DIR))

    for _ in range(WARM_UPS):
        for name in HEADLINES:
            timed(name)()
    seconds = {name: median_seconds(timed(name)) for name in HEADLINES}
    report = {
        "metric": "sum of the median seconds of the headline queries",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "comparison": {
            "one_run_per_day": median_seconds(lambda: one_run_per_day(spark, SF_DIR), 3)
        },
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()

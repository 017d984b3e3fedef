"""Run every registered query and its SQL side by side and compare their rows.

    python tools/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daymill.catalogue import QUERIES  # noqa: E402
from daymill.oracles import ORACLES  # noqa: E402
from daymill.session import build_session  # noqa: E402


# Steps that compare every pair of rows, or leave the JVM.
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def sorted_rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty if equal, else what differs, or what the plan should not have."""
    frame = QUERIES[name](spark, sf_dir)
    got = frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for step in UNWANTED:
        if step in plan:
            return f"plan has {step}"
    if name not in ORACLES:
        return "" if got else "no rows"
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    wanted = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {frame.columns} for {columns}"
    if len(got) != len(wanted):
        return f"{len(got)} rows for {len(wanted)}"
    left, right = sorted_rows(frame.columns, got), sorted_rows(columns, wanted)
    for a, b in zip(left, right):
        if a != b:
            return f"{a} for {b}"
    return ""


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("check_oracles", **{
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        began = time.perf_counter()
        try:
            fault = compare(spark, con, name, sf_dir)
        except Exception as error:
            fault = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(fault)
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'FAIL' if fault else 'ok':4} {kind:6} {time.perf_counter() - began:6.2f}s {name} {fault}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

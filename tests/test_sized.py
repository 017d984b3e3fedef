import random

import pytest
from frames import tuples

from daymill.sinks import files, sized


def sizes_by_date(path):
    found = {}
    for folder in path.iterdir():
        if folder.is_dir():
            found[folder.name] = sorted(f.stat().st_size for f in folder.iterdir() if f.name.startswith("part-"))
    return found


@pytest.mark.parametrize("file_format", files.FORMATS)
def test_files_are_of_one_size_on_skewed_dates(spark, tmp_path, file_format):
    """A date of wide rows, one of many narrow ones, a large one of few, and many small ones."""
    rng = random.Random(1)
    wide = [(f"2024-01-{1 + (i > 200):02}", rng.randbytes(400).hex(), i) for i in range(1_200)]
    narrow = [("2024-02-01", rng.randbytes(4).hex(), i) for i in range(40_000)]
    few = [(f"2024-03-{1 + i % 28:02}", rng.randbytes(20).hex(), i) for i in range(400)]
    df = spark.createDataFrame(wide + narrow + few + [(None, "x", 1)], "run_date STRING, t STRING, v INT")
    df = df.selectExpr("CAST(run_date AS DATE) AS run_date", "t", "v").repartition(6)
    path, target = tmp_path / "sized", 100_000
    sized.write_sized(df, str(path), file_format=file_format, target_bytes=target)
    schema = df.select("t", "v", "run_date").schema
    back = files.read_csv(spark, str(path), schema) if file_format == "csv" else spark.read.parquet(str(path))
    assert tuples(back.select("run_date", "t", "v")) == tuples(df)
    found = sizes_by_date(path)
    large = {d: s for d, s in found.items() if sum(s) > target}
    assert len(large) in (2, 3) and all(target / 2 <= x <= 2 * target for s in large.values() for x in s)
    assert all(len(s) == 1 for d, s in found.items() if sum(s) < target / 2)


def test_copies_of_a_row_are_not_one_large_file(spark, tmp_path):
    rows = [("2024-01-01", "x" * 50 + str(i), i) for i in range(3_000)] + [("2024-01-01", "y" * 50, -1)] * 6_000
    df = spark.createDataFrame(rows, "run_date STRING, t STRING, v INT")
    sized.write_sized(df, str(tmp_path / "s"), file_format="csv", target_bytes=50_000)
    (found,) = sizes_by_date(tmp_path / "s").values()
    assert max(found) <= 100_000 and len(found) >= 6
    assert files.read_csv(spark, str(tmp_path / "s"), "t STRING, v INT, run_date STRING").count() == 9_000


def test_a_rerun_replaces_its_dates_only(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "run_date STRING, v INT")
    path = str(tmp_path / "s")
    sized.write_sized(one, path)
    sized.write_sized(spark.createDataFrame([("b", 3), ("b", 4)], one.schema), path)
    sized.write_sized(one.limit(0), path)
    assert tuples(spark.read.parquet(path).select("run_date", "v")) == [("a", 1), ("b", 3), ("b", 4)]


def test_small_dates_are_packed():
    plan, tasks = sized.planned([("big", 1_000, 1), ("half", 60, 1), *((f"d{i}", 5, 1) for i in range(60))], 100)
    assert tasks == 10 + 1 + 3
    shared = [task for date, task, n in plan if date.startswith("d")]
    assert sorted(shared.count(t) for t in set(shared)) == [20, 20, 20]
    assert sized.planned([], 100) == ([], 0)

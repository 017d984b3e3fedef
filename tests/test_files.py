from datetime import date, datetime

import pytest
from frames import tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daymill.plans import loads
from daymill.sinks import files

SCHEMA = "id BIGINT, name STRING, at TIMESTAMP_NTZ, v DOUBLE"


@pytest.fixture
def rows(spark):
    data = [
        (1, 'say "hi", there', datetime(2024, 3, 10, 2, 30), 1.5),
        (2, "  padded ", datetime(2024, 1, 1, 0, 0, 0, 123456), None),
        (3, "", None, -0.1), (4, None, datetime(1999, 12, 31), 1e300), (5, "back\\slash", None, 0.1),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("file_format", files.FORMATS)
def test_round_trip(spark, rows, tmp_path, file_format, any_session_zone):
    path = files.write_files(rows, str(tmp_path / "x"), file_format)
    back = files.read_csv(spark, path, SCHEMA) if file_format == "csv" else spark.read.parquet(path)
    wanted = rows.withColumn("name", F.expr("nullif(name, '')")) if file_format == "csv" else rows
    assert tuples(back, "id") == tuples(wanted, "id")
    assert back.dtypes == rows.dtypes


def test_csv_has_a_header_and_no_index(rows, tmp_path):
    path = files.write_csv(rows.where("id = 1").coalesce(1), str(tmp_path / "x"))
    (part,) = (tmp_path / "x").glob("*.csv")
    assert path and part.read_text().splitlines() == [
        "id,name,at,v", '1,"say ""hi"", there",2024-03-10 02:30:00.000000,1.5',
    ]


def test_unknown_format_is_an_error_and_writes_nothing(rows, tmp_path):
    with pytest.raises(ValueError, match="file_format"):
        files.write_files(rows, str(tmp_path / "x"), "xlsx")
    assert not (tmp_path / "x").exists()


def test_publish(spark, rows, tmp_path):
    uri = str(tmp_path / "x")
    files.publish(rows, uri, replace=False)
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS|already exists"):
        files.publish(rows, uri, replace=False)
    files.publish(rows.where("id = 1"), uri, replace=True)
    assert spark.read.parquet(uri).count() == 1


def test_csv_keeps_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a\nb"), (2, 'x "y"\n\n,z'), (3, "c")], "id BIGINT, t STRING")
    path = files.write_csv(rows, str(tmp_path / "x"))
    assert tuples(files.read_csv(spark, path, rows.schema), "id") == tuples(rows, "id")


def test_csv_that_does_not_fit_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,n\n1,2\n2,many\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_csv(spark, str(tmp_path / "x.csv"), "id BIGINT, n INT").collect()


def test_copy_is_byte_for_byte(spark, tmp_path):
    raw = tmp_path / "raw"
    contents = {
        "a.csv": b'id,t\n1,"say ""hi"", x"\n2,  padded \n', "code=001/part-0.bin": bytes(range(256)),
        "code=001/_SUCCESS": b"", "sample.txt": b"one\r\n\n two", ".hidden": b"h",
    }
    for name, content in contents.items():
        (raw / name).parent.mkdir(parents=True, exist_ok=True)
        (raw / name).write_bytes(content)
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "old.txt").write_text("old")
    target = files.copy_dataset(spark, str(raw), str(tmp_path / "done"))
    found = {str(p.relative_to(target)): p.read_bytes() for p in (tmp_path / "done").rglob("*") if p.is_file()}
    assert found == contents


def test_run_dates_are_replaced_one_by_one(spark, tmp_path):
    df = spark.range(300).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS run_date")
    path = files.write_by_run_date(df.repartition(8), str(tmp_path / "x"))
    folders = sorted(p.name for p in (tmp_path / "x").iterdir() if p.is_dir())
    assert folders == [f"run_date=2024-01-0{d}" for d in (1, 2, 3)]
    assert len(list((tmp_path / "x").glob("run_date=*/*.parquet"))) == 3
    files.write_by_run_date(df.where("id = 1"), path)
    counts = spark.read.parquet(path).groupBy("run_date").count()
    assert tuples(counts) == [(date(2024, 1, 1), 100), (date(2024, 1, 2), 1), (date(2024, 1, 3), 100)]


def test_a_heavy_run_date_is_split(spark, tmp_path):
    """Nine of ten rows fall on one date; it is written by several tasks."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64KB")
    try:
        df = spark.range(400_000).select(
            F.rand(1).alias("v"),
            F.expr("date_add(DATE '2024-01-01', IF(id % 10 > 0, 0, CAST(id % 7 AS INT)))").alias("run_date"),
        )
        files.write_by_run_date(df.repartition(8), str(tmp_path / "x"))
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "x" / "run_date=2024-01-01").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "x")).count() == 400_000


def test_table_to_lake(spark, schema, rows, tmp_path):
    rows.write.saveAsTable(f"{schema}.users")
    uri = loads.table_to_lake(spark.table(f"{schema}.users"), str(tmp_path / "lake"))
    assert tuples(spark.read.parquet(uri), "id") == tuples(rows, "id")


def names_below(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


@pytest.mark.parametrize("source,target", [
    ("raw", "raw"), ("raw", "raw/"), ("raw", "raw/in"), ("raw/sub", "raw"), ("raw/one.txt", "raw"), ("raw/../raw", "raw"),
])
def test_overlapping_copies_are_refused(spark, tmp_path, source, target):
    (tmp_path / "raw" / "sub").mkdir(parents=True)
    for name in ("one.txt", "sub/two.txt"):
        (tmp_path / "raw" / name).write_text(name)
    before = names_below(tmp_path)
    with pytest.raises(ValueError, match="overlap"):
        files.copy_dataset(spark, f"{tmp_path}/{source}", f"{tmp_path}/{target}")
    assert names_below(tmp_path) == before


def test_the_target_is_replaced_only_by_a_whole_copy(spark, tmp_path, monkeypatch):
    raw, done = tmp_path / "raw", tmp_path / "done"
    for folder, name, content in ((raw, "a", "1"), (raw, "sub/b", "2"), (done, "old", "3")):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(content)
    with monkeypatch.context() as patched:
        def stop(*_):
            raise OSError("stop")

        patched.setattr(files, "_replace_folder", stop)
        with pytest.raises(OSError):
            files.copy_dataset(spark, str(raw), str(done))
    assert names_below(done) == ["old"]
    # The next copy goes on: equal objects stay, changed and vanished ones do not.
    staging = tmp_path / "done.copying"
    assert names_below(staging) == ["a", "sub/b"]
    kept = (staging / "a").stat().st_ino
    (staging / "sub" / "b").write_text("x")
    (staging / "gone").write_text("x")
    files.copy_dataset(spark, str(raw), str(done))
    assert names_below(done) == ["a", "sub/b"] and (done / "sub" / "b").read_text() == "2"
    assert (done / "a").stat().st_ino == kept
    assert sorted(p.name for p in tmp_path.iterdir()) == ["done", "raw"]


def test_a_missing_source_leaves_the_target(spark, tmp_path):
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "old").write_text("old")
    with pytest.raises(FileNotFoundError):
        files.copy_dataset(spark, str(tmp_path / "none"), str(tmp_path / "done"))
    assert names_below(tmp_path / "done") == ["old"]


def test_many_small_objects_are_few_tasks(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(300):
        (raw / f"{i}").write_text(str(i))
    files.copy_dataset(spark, str(raw), str(tmp_path / "done"))
    assert len(names_below(tmp_path / "done")) == 300
    sizes = [("big", 5 << 30), *((f"s{i}", 10) for i in range(1_000))]
    packed = files._packed(sizes, 4)
    assert sorted(n for names in packed for n in names) == sorted(n for n, _ in sizes)
    assert [len(names) for names in packed if "big" in names] == [1]
    empty = tmp_path / "empty"
    empty.mkdir()
    files.copy_dataset(spark, str(empty), str(tmp_path / "done"))
    assert names_below(tmp_path / "done") == []

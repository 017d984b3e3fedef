from datetime import date, datetime, timezone

import pytest
from frames import plan_of, tuples

from daymill.operators.summaries import daily_summary, hourly_count
from daymill.plans import loads, parameters, sql_files, tables
from daymill.plans.parameters import Param
from daymill.sinks import files
from daymill.sources import jdbc

SEOUL = "Asia/Seoul"
# Midnights in Seoul, as instants.
START, END = (datetime(2024, 1, d, 15, tzinfo=timezone.utc) for d in (1, 3))


@pytest.fixture
def stage(spark, schema, orders):
    orders(
        ("2024-01-01 23:59:59", 1), ("2024-01-02 00:00:00", 2), ("2024-01-02 00:59:59", 4),
        ("2024-01-03 23:00:00", 8), ("2024-01-04 00:00:00", 16),
    ).write.saveAsTable(f"{schema}.orders")
    return schema


def test_file_equals_operator(spark, stage):
    facts = spark.table(f"{stage}.orders")
    params = {"src_schema": stage, "start": START, "end": END, "zone": SEOUL}
    assert tuples(sql_files.run_file(spark, "daily_summary", **params)) == tuples(
        daily_summary(facts, start=START, end=END, zone=SEOUL)
    )
    hourly = sql_files.run_file(spark, "hourly_count", **params)
    assert hourly.collect() == hourly_count(facts, start=START, end=END, zone=SEOUL).collect()
    assert hourly.schema == hourly_count(facts).schema


def test_bound_times_reach_the_scan(spark, stage):
    plan = plan_of(sql_files.run_file(spark, "hourly_count", src_schema=stage, start=date(2024, 1, 2), end=date(2024, 1, 3)))
    assert "GreaterThanOrEqual(order_dt,2024-01-02T00:00)" in plan


@pytest.fixture
def instants(spark, schema):
    """Orders at instants: the second is still the day before in UTC and New York."""
    at = [datetime(2024, 1, 5, 16, tzinfo=timezone.utc), datetime(2024, 1, 4, 20, tzinfo=timezone.utc),
          datetime(2024, 1, 6, 15, tzinfo=timezone.utc)]
    rows = spark.createDataFrame([(t, n) for n, t in enumerate(at, 1)], "order_dt TIMESTAMP, amount INT")
    rows.write.saveAsTable(f"{schema}.orders")
    return schema


SPAN = {"start": datetime(2024, 1, 4, 15, tzinfo=timezone.utc), "end": datetime(2024, 1, 6, 15, tzinfo=timezone.utc)}


def test_files_over_instants(spark, instants, any_session_zone):
    got = sql_files.run_file(spark, "daily_summary", zone=SEOUL, instants=True, src_schema=instants, **SPAN)
    assert tuples(got) == [(date(2024, 1, 5), 1, 2), (date(2024, 1, 6), 1, 1)]
    assert tuples(got) == tuples(daily_summary(spark.table(f"{instants}.orders"), zone=SEOUL, **SPAN))
    hourly = sql_files.run_file(spark, "hourly_count", zone=SEOUL, instants=True, src_schema=instants, **SPAN)
    assert tuples(hourly) == [(datetime(2024, 1, 5, 5), 1), (datetime(2024, 1, 6, 1), 1)]


def test_bound_instants_reach_the_scan(spark, instants):
    got = sql_files.run_file(spark, "daily_summary", zone=SEOUL, instants=True, src_schema=instants, **SPAN)
    assert "GreaterThanOrEqual(order_dt," in plan_of(got)


def test_load_from_any_file_over_instants(spark, instants, tmp_path):
    (tmp_path / "large_orders.sql").write_text(
        "SELECT to_date(convert_timezone('UTC', :zone, TIMESTAMP_NTZ '1970-01-01'"
        " + INTERVAL '0.000001' SECOND * unix_micros(order_dt))) AS day, count(*) AS n"
        " FROM IDENTIFIER(:src_schema || '.orders')"
        " WHERE order_dt >= :start AND order_dt < :end AND amount >= :least GROUP BY ALL",
        encoding="utf-8",
    )
    target = f"{instants}.large"
    spark.sql(
        f"CREATE TABLE {target} (day DATE, n BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP,"
        " summary_month STRING) USING PARQUET OPTIONS ('partitionOverwriteMode' = 'dynamic')"
        " PARTITIONED BY (summary_month)"
    )
    loads.load_summary_from_file(
        spark, instants, target, SPAN["start"], SPAN["end"], SEOUL, name="large_orders",
        search_path=[tmp_path], key="day", measures=["n"], least=2,
    )
    assert [r[:2] for r in tuples(spark.table(target))] == [(date(2024, 1, 5), 1)]


def test_values_are_not_pasted(spark, stage):
    query = "SELECT count(*) AS n FROM IDENTIFIER(:s || '.orders') WHERE CAST(amount AS STRING) = :x"
    assert sql_files.run_query(spark, query, s=stage, x="' OR '1'='1").first()["n"] == 0


def test_search_path_comes_first(tmp_path):
    (tmp_path / "hourly_count.sql").write_text("SELECT 1", encoding="utf-8")
    assert sql_files.sql_text("hourly_count", [tmp_path]) == "SELECT 1"
    assert "order_hour" in sql_files.sql_text("hourly_count")
    with pytest.raises(FileNotFoundError):
        sql_files.sql_text("absent", [tmp_path])


@pytest.mark.parametrize("file_format", files.FORMATS)
def test_query_to_files(spark, stage, tmp_path, file_format):
    path = sql_files.query_to_files(
        spark, sql_files.sql_text("hourly_count"), str(tmp_path / "20240102"), file_format,
        zone=SEOUL, src_schema=stage, start=START, end=END,
    )
    back = (
        files.read_csv(spark, path, "order_hour TIMESTAMP_NTZ, cnt BIGINT")
        if file_format == "csv" else spark.read.parquet(path)
    )
    assert tuples(back) == [(datetime(2024, 1, 2), 2), (datetime(2024, 1, 3, 23), 1)]


def test_load_from_file(spark, stage):
    target = f"{stage}.for_template"
    for _ in range(2):
        loads.load_summary_from_file(spark, stage, target, START, END, zone=SEOUL)
    assert [r[:2] for r in tuples(tables.read_summary(spark, target))] == [(date(2024, 1, 2), 2), (date(2024, 1, 3), 1)]


def test_jdbc_options_of_a_query():
    got = jdbc.jdbc_options(
        "jdbc:mysql://host/ecom?charset=utf8mb4", "SELECT * FROM users;", drop_url_query=True,
        on_connect="SET NAMES utf8mb4", user="u",
    )
    assert got == {
        "url": "jdbc:mysql://host/ecom", "query": "SELECT * FROM users", "user": "u",
        "sessionInitStatement": "SET NAMES utf8mb4", "fetchsize": "10000",
    }


def test_jdbc_keeps_the_properties_of_the_url():
    url = "jdbc:postgresql://h/d?sslmode=require&currentSchema=s"
    assert jdbc.jdbc_options(url, "SELECT 1")["url"] == url


def test_jdbc_options_of_a_split_query():
    got = jdbc.jdbc_options("jdbc:postgresql://h/d", "SELECT id, name FROM users", split=jdbc.Split("id", 1, 1000, 8))
    assert got == {
        "url": "jdbc:postgresql://h/d", "dbtable": "(SELECT id, name FROM users) split_source", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "8",
    }


def test_jdbc_split_is_taken_from_the_data(spark, monkeypatch):
    asked = []

    def answer(spark, url, query, **options):
        asked.append((query, options))
        return spark.createDataFrame([(3, 900)], "low INT, high INT")

    monkeypatch.setattr(jdbc, "read_query", answer)
    split = jdbc.split_evenly(spark, "jdbc:x:y", "SELECT * FROM users;", "id", 4, user="u")
    assert split == jdbc.Split("id", 3, 900, 4)
    assert asked == [("SELECT min(id) AS low, max(id) AS high FROM (SELECT * FROM users) q", {"user": "u"})]


def test_jdbc_reads_through_spark(spark):
    """There is no such driver: Spark's JDBC source is asked, and says so."""
    with pytest.raises(Exception, match="No suitable driver"):
        jdbc.read_query(spark, "jdbc:none://h/d", "SELECT 1 AS a")


DECLARED = {
    "src_schema": Param("string"), "zone": Param("string", default=SEOUL, choices=(SEOUL, "UTC")),
    "start": Param("moment"), "end": Param("moment", minimum=START),
}


def test_declared_parameters(spark, stage):
    given = {"src_schema": stage, "start": START, "end": END}
    got = parameters.run_declared_file(spark, "daily_summary", DECLARED, **given)
    assert tuples(got) == tuples(sql_files.run_file(spark, "daily_summary", zone=SEOUL, **given))
    one = parameters.run_declared(spark, "SELECT :n + 1 AS n", {"n": Param("integer", default=4, nullable=True)})
    assert tuples(one) == [(5,)]


@pytest.mark.parametrize("change,message", [
    ({"start": "2024-01-01"}, "start is to be a moment"), ({"zone": "Mars"}, "one of"), ({"zone": 7}, "string"),
    ({"src_schema": None}, "null"), ({"other": 1}, "not declared: other"), ({"end": datetime(2020, 1, 1, tzinfo=timezone.utc)}, "bounds"),
    ({"end": datetime(2030, 1, 1)}, "compared"),
])
def test_a_wrong_parameter_is_refused_before_the_statement_runs(spark, change, message):
    given = {"src_schema": "no_such_schema", "start": START, "end": END} | change
    with pytest.raises(parameters.ParameterError, match=message):
        parameters.run_declared(spark, "SELECT no_such_function(:start)", DECLARED, **given)


def test_declarations_are_checked():
    for kind, value in (("integer", True), ("integer", 1.5), ("date", START), ("boolean", 1), ("number", "1"), ("string", b"x")):
        with pytest.raises(parameters.ParameterError):
            Param(kind, default=value)
    with pytest.raises(parameters.ParameterError, match="none of"):
        Param("text")
    with pytest.raises(parameters.ParameterError, match="left out: start"):
        parameters.resolved({"start": Param("moment"), "n": Param("number", default=1)}, {})

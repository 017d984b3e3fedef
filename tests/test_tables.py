from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from frames import plan_of, tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daymill.operators import ids, keys
from daymill.operators.constraints import (
    ConstraintViolation,
    constraint_report,
    require_constraints,
)
from daymill.operators.ids import numbered, with_dense_ids
from daymill.plans import tables
from daymill.sources import listings, objects
from daymill.sources.tables import (
    current_schema,
    first_row,
    literal_rows,
    register_orders,
    scan_orders,
    session_zone,
)


def test_recreate_users_drops_earlier_rows(spark, schema):
    name = f"{schema}.users"
    tables.recreate_users(spark, name)
    tables.insert_users(tables.sample_users(spark), name)
    tables.recreate_users(spark, name)
    assert spark.table(name).count() == 0


def test_ids_follow_the_rows_as_they_come(spark, schema):
    name = f"{schema}.users"
    tables.recreate_users(spark, name)
    tables.insert_users(tables.sample_users(spark), name)
    got = tuples(spark.table(name).select("id", "name", "age"))
    assert got == [(i, *user) for i, user in enumerate(tables.SAMPLE_USERS, 1)]


def test_inserts_continue_the_ids(spark, schema):
    name = f"{schema}.users"
    tables.recreate_users(spark, name)
    tables.insert_users(tables.sample_users(spark).where("age >= 30"), name, ["name"])
    tables.insert_users(tables.sample_users(spark).where("age < 30"), name, ["name"])
    assert tuples(spark.table(name).select("id", "name", "age")) == [
        (1, "Alice", 30), (2, "Charlie", 40), (3, "Min", 50), (4, "Bob", 25), (5, "Jane", 28), (6, "John", 20),
    ]
    rows = spark.table(name).collect()
    assert all(r.created_at == r.updated_at is not None for r in rows)
    assert len({r.created_at for r in rows}) == 2


def test_defaults_fill_columns_left_out(spark, schema):
    name = f"{schema}.users"
    tables.recreate_users(spark, name)
    spark.sql(f"INSERT INTO {name} (id, name, age) VALUES (1, 'Alice', 30)")
    row = spark.table(name).first()
    assert row.created_at is not None and row.updated_at is not None


def test_names_too_long_are_refused(spark, schema):
    name = f"{schema}.users"
    tables.recreate_users(spark, name)
    longer = literal_rows(spark, "name STRING, age INT", [("x" * 256, 1)])
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        tables.insert_users(longer, name)


def test_create_summary_keeps_an_existing_table(spark, schema):
    name = f"{schema}.s"
    tables.create_summary(spark, name)
    spark.sql(f"INSERT INTO {name} VALUES (DATE '2024-01-01', 1, 1, now(), now(), '2024-01')")
    tables.create_summary(spark, name)
    assert spark.table(name).count() == 1
    with pytest.raises(AnalysisException):
        spark.sql(f"CREATE TABLE {name} (a INT) USING PARQUET")


def test_dense_ids_over_many_tasks(spark):
    """Most rows share the value they are ordered by, and are still spread."""
    df = spark.range(20_000).selectExpr("IF(id % 3 = 0, id, 7) AS a", "id AS b").repartition(13)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        with with_dense_ids(df, ["a"], after=100) as rows:
            assert rows.columns == ["id", "a", "b"]
            got = rows.orderBy("id").collect()
            sizes = [spark.read.parquet(f).count() for f in rows.inputFiles()]
    finally:
        spark.conf.unset(setting)
    assert [r.id for r in got] == list(range(101, 20_101))
    assert [r.a for r in got] == sorted(r.a for r in got)
    assert sorted(r.b for r in got) == list(range(20_000))
    assert max(sizes) < 4_000


def test_dense_ids_as_rows_come(spark):
    df = spark.range(1000, numPartitions=7).selectExpr("id * 2 AS k")
    with with_dense_ids(df) as rows:
        got = rows.orderBy("id").collect()
    assert [tuple(r) for r in got] == [(i + 1, 2 * i) for i in range(1000)]


def test_dense_ids_of_nothing(spark):
    with with_dense_ids(spark.range(0).withColumnRenamed("id", "k"), ["k"]) as rows:
        assert rows.count() == 0


def test_constraint_report(spark):
    rows = [
        ("a", "x", Decimal("1.005")), ("a", None, Decimal("99.994")), ("a", "xxxx", Decimal("99.995")),
        (None, "x", Decimal("-100")), (None, "x", None), ("b", "x", Decimal("0")),
    ]
    df = spark.createDataFrame(rows, "k STRING, t STRING, v DECIMAL(20,3)")
    report = constraint_report(
        df, key="k", not_null=["k", "t"], max_length={"t": 3}, numeric={"v": (4, 2)}
    )
    assert plan_of(report).count("Exchange hashpartitioning") == 1
    assert {(r, c): n for r, c, n in report.collect()} == {
        ("unique", "k"): 2, ("not_null", "k"): 2, ("not_null", "t"): 1, ("max_length", "t"): 1, ("numeric", "v"): 2,
    }


def test_constraints_of_no_rows(spark):
    df = spark.createDataFrame([], "k STRING, v INT")
    for key in ("k", None):
        report = constraint_report(df, key=key, not_null=["v"])
        assert {r.violations for r in report.collect()} == {0}
    require_constraints(df, key="k", not_null=["v"])


def test_require_constraints_names_what_is_broken(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k INT, v INT")
    with pytest.raises(ConstraintViolation, match=r"unique\(k\): 1, not_null\(v\): 2"):
        require_constraints(df, key="k", not_null=["k", "v"])


def test_literal_rows(spark):
    rows = literal_rows(spark, "n STRING, d DATE, a DECIMAL(5,2)", [("x", date(2024, 1, 1), "1.5"), (None, None, None)])
    assert dict(rows.dtypes) == {"n": "string", "d": "date", "a": "decimal(5,2)"}
    assert [tuple(r) for r in rows.collect()] == [("x", date(2024, 1, 1), Decimal("1.50")), (None, None, None)]
    assert literal_rows(spark, "n STRING", []).count() == 0
    with pytest.raises(ValueError):
        literal_rows(spark, "n STRING, m INT", [("x",)])


def test_qualified_and_current_schema(spark, schema, orders, tmp_path):
    path = str(tmp_path / "o")
    orders(("2024-01-01 00:00:00", 5)).selectExpr("order_dt AS t", "amount AS v", "1 AS w").write.parquet(path)
    register_orders(spark, schema, path, "t", "v")
    assert scan_orders(spark, schema).columns == ["order_dt", "amount"]
    before = spark.catalog.currentDatabase()
    with current_schema(spark, schema):
        assert spark.table("orders").count() == 1
    assert spark.catalog.currentDatabase() == before
    filtered = scan_orders(spark, schema).where("order_dt > TIMESTAMP_NTZ '2023-01-01'")
    assert "GreaterThan(t,2023-01-01T00:00)" in plan_of(filtered)


def test_first_row_and_session_zone(spark, any_session_zone):
    df = spark.range(100).withColumn("z", session_zone())
    first = first_row(df, "id")
    assert tuple(first.first()) == (0, any_session_zone)
    assert "TakeOrderedAndProject" in plan_of(first)


def test_list_objects_reads_no_contents(spark, tmp_path):
    (tmp_path / "raw" / "deep").mkdir(parents=True)
    (tmp_path / "raw" / "a.txt").write_text("abc")
    (tmp_path / "raw" / "deep" / "b.csv").write_text("x")
    listed = objects.list_objects(spark, str(tmp_path / "raw"))
    assert sorted((r.path.rsplit("/", 1)[-1], r.length) for r in listed.collect()) == [("a.txt", 3), ("b.csv", 1)]
    assert "content" not in plan_of(listed)
    assert objects.list_objects(spark, str(tmp_path / "raw"), "*.txt").count() == 1


@pytest.mark.parametrize(
    "beginning, names",
    [
        ("event", ["event_a.csv", "deep.csv"]), ("event_", ["event_a.csv"]), ("events/", ["deep.csv"]),
        ("[x]*", ["[x]*y.csv"]), ("", ["event_a.csv", "deep.csv", "[x]*y.csv", "other.csv"]), ("none", []),
    ],
)
def test_list_keys_by_their_beginning(spark, tmp_path, beginning, names):
    (tmp_path / "events").mkdir()
    for key in ("event_a.csv", "events/deep.csv", "[x]*y.csv", "other.csv", "_SUCCESS"):
        (tmp_path / key).write_text("x")
    listed = objects.list_keys(spark, str(tmp_path), beginning)
    assert sorted(r.path.rsplit("/", 1)[-1] for r in listed.collect()) == sorted(names)
    assert listed.columns == ["path", "length", "modificationTime"]


def test_numbered_rows_need_no_write(spark):
    """Ties, copies of one row beyond a part, nulls, and parts cut at samples."""
    rows = [(None if i % 11 == 0 else i % 50, i, "x") for i in range(600)] + [(7, -1, None)] * 900
    df = spark.createDataFrame(rows, "a INT, b INT, c STRING")
    wanted = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for part_rows in (10_000, 40):
        for shuffled in (df.repartition(9, "b"), df.orderBy("b").coalesce(2)):
            got = numbered(shuffled, ["a"], after=50, part_rows=part_rows)
            assert got.columns == ["id", "a", "b", "c"]
            found = sorted(map(tuple, got.collect()))
            assert [r[0] for r in found] == list(range(51, 51 + len(rows)))
            assert [r[1] for r in found] == [w[0] for w in wanted]
            assert Counter(r[1:] for r in found) == Counter(rows)
            if part_rows == 40:
                first = found
    # Whatever tasks the rows come from, they get equal ids.
    assert sorted(map(tuple, numbered(df.repartition(3), ["a"], after=50, part_rows=40).collect())) == first


def test_numbered_parts_are_alike_in_size(spark):
    df = spark.range(5_000).selectExpr("IF(id % 3 = 0, 7, id) AS a", "id AS b")
    keyed = df.withColumn("_tie", F.xxhash64("a", "b"))
    order = ["a", "_tie"]
    cuts = ids._cuts(keyed, order, 5_000, 10)
    sizes = [r["count"] for r in keyed.groupBy(ids._part(keyed, order, cuts)).count().collect()]
    assert len(sizes) >= 9 and max(sizes) < 900
    plan = plan_of(numbered(df, ["a"], part_rows=500))
    assert "Python" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        numbered(df, [])
    assert numbered(df.limit(0), ["a"]).count() == 0


@pytest.fixture
def keyed_table(spark, schema):
    name = f"{schema}.keyed"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, v STRING) USING PARQUET")
    return name


def keyed_rows(spark, *numbers):
    return spark.createDataFrame([(n, f"v{n}") for n in numbers], "id BIGINT, v STRING")


def test_appended_keys_are_checked_against_the_table(spark, keyed_table, tmp_path):
    index = str(tmp_path / "index")
    keys.append_with_key(keyed_rows(spark, 1, 32_768, 32_769, 10**12, 0, -1), keyed_table, "id", index)
    keys.append_with_key(keyed_rows(spark, 2, -2, 32_770), keyed_table, "id", index)
    stored = lambda: (spark.catalog.refreshTable(keyed_table), sorted(r.id for r in spark.table(keyed_table).collect()))[1]
    before = stored()
    assert before == [-2, -1, 0, 1, 2, 32_768, 32_769, 32_770, 10**12]
    for bad in ((5, 1), (10**12,), (5, -2), (0,), (6, 6), (None, 9)):
        with pytest.raises(ConstraintViolation):
            keys.append_with_key(keyed_rows(spark, *bad), keyed_table, "id", index)
    assert stored() == before
    # A table that someone else wrote to is indexed anew.
    keyed_rows(spark, 77).write.insertInto(keyed_table)
    with pytest.raises(ConstraintViolation):
        keys.append_with_key(keyed_rows(spark, 77), keyed_table, "id", index)
    spark.sql(f"INSERT OVERWRITE {keyed_table} VALUES (500, 'x')")
    keys.append_with_key(keyed_rows(spark, 1), keyed_table, "id", index)
    assert stored() == [1, 500]
    keys.append_with_key(keyed_rows(spark), keyed_table, "id", index)
    assert stored() == [1, 500]


def test_present_keys_equal_a_join(spark):
    held, asked = range(-70_000, 70_000, 3), range(-70_001, 70_001, 7)
    bitmaps = keys.key_bitmaps(spark.createDataFrame([(i,) for i in held] + [(None,)], "id BIGINT"), "id")
    rows = spark.createDataFrame([(i,) for i in asked] + [(None,)], "id BIGINT")
    got = keys.present_keys(rows, "id", bitmaps)
    assert sorted(r.id for r in got.collect()) == sorted(set(held) & set(asked))
    assert bitmaps.count() == 6 and got.columns == ["id"]


def test_listings(spark, tmp_path):
    rows = [("a/b/1", 1, "x"), ("a/b/2", 2, "x"), ("a/c", 3, "x"), ("ab/1", 4, None), ("b", 5, None), ("a/é/1", 6, "y")]
    listing = spark.createDataFrame(rows, "key STRING, size BIGINT, tag STRING")
    kept = listings.read_listing(spark, listings.write_listing(listing, str(tmp_path / "l")))
    found = listings.keys_by_prefix(kept, "a/")
    assert sorted(r.key for r in found.collect()) == ["a/b/1", "a/b/2", "a/c", "a/é/1"]
    assert "StringStartsWith(key,a/)" in plan_of(found)
    assert tuples(listings.rolled_up(kept, "a/")) == [("a/b/", True, 2, 3), ("a/c", False, 1, 3), ("a/é/", True, 1, 6)]
    assert tuples(listings.rolled_up(kept)) == [("a/", True, 4, 12), ("ab/", True, 1, 4), ("b", False, 1, 5)]
    later = [("a/b/1", 1, "z"), ("a/b/2", 9, "x"), ("a/c", 3, "x"), ("ab/1", 4, "t"), ("n", None, None)]
    after = spark.createDataFrame(later, listing.schema)
    assert tuples(listings.listing_changes(listing, after)) == [
        ("a/b/2", "changed", 9), ("a/é/1", "gone", 6), ("b", "gone", 5), ("n", "added", None),
    ]
    by_tag = tuples(listings.listing_changes(listing, after, ("size", "tag")))
    assert [r[:2] for r in by_tag if r[1] == "changed"] == [("a/b/1", "changed"), ("a/b/2", "changed"), ("ab/1", "changed")]

"""Tables that know their keys, the page index, and keys that no plan holds."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from redactory import Policy, anonymize, upsert
from redactory.functions import masks
from redactory.policy import EntityPolicy, Pattern
from redactory.sources.catalog import materialize, save_table, table_keys, upsert_table
from redactory.sources.paging import PageIndex


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_upsert_without_naming_keys(spark, tmp_path, name):
    first = spark.createDataFrame([(1, "a", 5), (2, "b", 1), (None, "n", 1)], "k int, `v 1` string, t int")
    late = spark.createDataFrame([(1, "late", 2), (3, "c", 1), (None, "m", 1)], "k int, `v 1` string, t int")
    save_table(first, name, ["k"], location=str(tmp_path / "a"))
    assert table_keys(spark, name) == ["k"] and rows(spark.table(name)) == rows(first)
    upsert_table(late, name, ["t"], "order", location=str(tmp_path / "b"))
    assert rows(spark.table(name)) == rows(upsert(first, late, ["k"], ["t"], "order")) and table_keys(spark, name) == ["k"]
    upsert_table(late, name, ["t"], location=str(tmp_path / "c"))
    assert (1, "late", 2) in rows(spark.table(name))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(name) and t.name != name]


def test_tables_without_keys_and_refusals(spark, tmp_path, name):
    df = spark.range(3).selectExpr("id", "id * 2 AS v")
    save_table(df, name, location=str(tmp_path / "a"))
    upsert_table(df.select("v", "id"), name)
    assert table_keys(spark, name) == [] and rows(spark.table(name)) == rows(df.union(df))
    with pytest.raises(ValueError):
        upsert_table(df.select("id"), name)
    with pytest.raises(ValueError):
        save_table(df, f"{name}_x", ["nope"])


def test_clustered_tables_join_without_a_shuffle(spark, tmp_path):
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    for n in names:
        save_table(spark.range(1000).selectExpr("id AS k", "id % 7 AS v"), n, ["k"], location=str(tmp_path / n))
    left, right = (spark.table(n).hint("merge") for n in names)
    plan = left.join(right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_a_query_runs_once(spark, tmp_path, name):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        calls.add(1)
        return x

    spark.udf.register("counted_rows", counted)
    table = materialize(spark, "SELECT counted_rows(id) AS id FROM range(20) WHERE id >= ?", name, [5], location=str(tmp_path / "m"))
    assert table.count() == 15 and table.agg(F.sum("id")).first()[0] == sum(range(5, 20)) and calls.value == 15


def test_pages_read_only_their_ranges(spark, tmp_path):
    df = spark.range(5_000).selectExpr("CASE WHEN id % 50 = 0 THEN NULL ELSE id * 3 END AS k", "id AS v", "'x' AS page")
    index = PageIndex.build(df.repartition(4), "k", str(tmp_path / "p"), 8)
    assert index.count() == 5_000 and index.index().count() == 8
    keys = sorted((r["k"] for r in df.collect()), key=lambda k: (k is not None, k or 0))
    for page in (0, 1, 17, 49):
        got = index.page_at(page, 101)
        assert [r["k"] for r in got.collect()] == keys[page * 101 : (page + 1) * 101] and got.columns == df.columns
    scan = index.page_at(17, 101)._jdf.queryExecution().executedPlan().toString()
    held = re.search(r"PartitionFilters: \[([^\]]*)\]", scan).group(1)
    assert "__range" in held and len(re.findall(r"\b[0-7]\b", held.split("AND")[0])) <= 2  # a range or two of eight
    assert "__row" in re.search(r"PushedFilters: \[([^\]]*)\]", scan).group(1)
    assert index.page_at(60, 101).count() == 0
    paged = index.with_pages(1000).drop("page").columns
    assert "row_in_page" in paged
    empty = PageIndex.build(df.where("v < 0"), "k", str(tmp_path / "e"), 3)
    assert empty.count() == 0 and empty.page_at(0, 10).count() == 0


def test_no_plan_holds_a_named_key(spark):
    keys = {"k1": "0123456789abcdef", "k2": "fedcba9876543210fedcba9876543210"}
    for i, key in keys.items():
        spark._jvm.java.lang.System.setProperty(f"test.secret.{i}", key)
    entity = lambda i: EntityPolicy("E", patterns=(Pattern("d", "[0-9]{3}"),), strategy="encrypt", params={"key_name": "test.secret", "key_id": i})
    df = spark.createDataFrame([("call 123 or 456",)], "t string")
    hidden = anonymize(df, "t", Policy(entities=(entity("k1"),)))
    assert not any(key in hidden._jdf.queryExecution().toString() for key in keys.values())
    first, second = hidden.first()["t"].removeprefix("call ").split(" or ")
    values = spark.createDataFrame([(first,), (second,), (anonymize(df, "t", Policy(entities=(entity("k2"),))).first()["t"][5:].split(" or ")[0],)], "e string")
    opened = [r["d"] for r in values.select(F.expr(masks.decrypt_by_name("test.secret")("e")).alias("d")).collect()]
    assert opened == ["123", "456", "123"] and first.startswith("k1:")
    with pytest.raises(Exception, match="(?i)key"):
        anonymize(df, "t", Policy(entities=(entity("unknown"),))).collect()
    with pytest.raises(ValueError):
        masks.encrypt_by_name("a", "b:c")


def test_named_keys_reach_executors_without_properties(spark):
    rows = [("test.held.a", "0123456789abcdef"), ("test.held.b", "fedcba9876543210"), (None, "x")]
    keys = spark.createDataFrame(rows, "name string, key string")
    df = masks.with_keys(spark.createDataFrame([(1, "one"), (2, "two"), (3, None)], "id int, t string"), keys)
    first, second = (masks.encrypt_by_name("test.held", i, keys=masks.KEYS)("t") for i in "ab")
    df = df.withColumn("e", F.expr(f"CASE WHEN id % 2 = 1 THEN {first} ELSE {second} END"))
    opened = df.select("id", F.expr(masks.decrypt_by_name("test.held", keys=masks.KEYS)("e")).alias("t"), "e")
    assert all(key not in opened._jdf.queryExecution().toString() for _, key in rows[:2])
    got = {r["id"]: (r["t"], r["e"] and r["e"][:2]) for r in opened.collect()}
    assert got == {1: ("one", "a:"), 2: ("two", "b:"), 3: (None, None)}
    with pytest.raises(Exception, match="no key named"):
        df.select(F.expr(masks.encrypt_by_name("test.held", "c", keys=masks.KEYS)("t"))).collect()


def test_the_query_on_named_keys_sets_no_property_of_the_driver(spark):
    from checks.jobs import encrypt_named_key

    encrypt_named_key(spark, "/root/testdata/sf0.001").collect()
    assert spark._jvm.java.lang.System.getProperty("redactory.check.v1") is None

import random

import pytest
from pyspark.sql import functions as F

from redactory import ColumnPolicy, EntityPolicy, Pattern, Policy, TablePolicy, TableSet, database_report, lexicon_findings, query_results, upsert, write_anonymized
from redactory.operators.upsert import latest
from redactory.operators.validate import policy_violations, schema_differences
from redactory.sources.paging import page, page_after, with_pages
from redactory.sources.tables import append


def user_rows():
    for i in range(10):
        mail, phone, ssn = f"person.n{i}@example.org", f"555-{200 + i}-{4000 + i}", f"{400 + i}-7{i}-610{i}"
        extra = {4: f" SSN {ssn}.", 8: " IP address: 10.1.2.3.", 9: " See https://n9.example.org for more."}.get(i, "")
        yield (
            f"u{i:03}", mail, f"Pat Doe{i}", phone, f"{100 + i} Main St, Oslo, Norway", ssn,
            f"{3 + i % 4}5{i}2-1234-5678-901{i}", f"Reach Pat at {mail} or {phone}.{extra}", "en_US",
        )


@pytest.fixture(scope="module")
def users(spark):
    df = spark.createDataFrame(
        list(user_rows()),
        "user_id string, email string, name string, phone_number string, address string, ssn string, credit_card string, "
        "bio string, locale string",
    )
    return df.withColumn("date_of_birth", F.lit("1990-01-02").cast("date")).withColumn("created_at", F.current_timestamp())


def test_report_of_two_equal_tables(spark, users, tmp_path):
    tables = TableSet(spark, {"users": users, "results": users}, {"users": ["user_id"]})
    lazy = database_report(tables, Policy.default()).first()
    written = write_anonymized(tables, str(tmp_path / "out"), Policy.default()).first()
    for report in (lazy, written):
        stats, found = report["processing_stats"], report["anonymization_stats"]
        assert (stats["total_tables"], stats["total_rows"], stats["anonymized_rows"]) == (2, 20, 20)
        assert found["total_values_processed"] == 200
        assert found["tables_processed"] == {"results": 10, "users": 10}
        counts = found["entities_found"]
        assert (counts["EMAIL_ADDRESS"], counts["US_SSN"], counts["CREDIT_CARD"], counts["IP_ADDRESS"]) == (40, 22, 20, 2)
        assert found["columns_processed"]["users.bio"] == 10 and "users.user_id" not in found["columns_processed"]
        assert report["policy"]["enabled_entities"][0] == "PERSON"
    assert lazy["anonymization_stats"] == written["anonymization_stats"]
    assert written["processing_stats"]["elapsed_time"] > 0
    back = TableSet.from_directory(spark, str(tmp_path / "out"))
    assert sorted(back.frames) == ["results", "users"]
    assert schema_differences(tables.metadata(), back.metadata()).count() == 0
    leaked = back.frames["users"].filter("bio rlike '@example|[0-9]{3}-[0-9]{2}-[0-9]{4}|10\\\\.1\\\\.2\\\\.3'")
    assert leaked.count() == 0 and back.frames["users"].filter("ssn <> ''").count() == 0


def test_switched_off_pipeline_copies_everything(spark, users, tmp_path):
    tables = TableSet(spark, {"users": users})
    report = write_anonymized(tables, str(tmp_path / "off"), Policy(enabled=False)).first()
    assert report["anonymization_stats"]["total_values_processed"] == 0
    assert report["anonymization_stats"]["anonymization_rate"] == 0.0
    assert report["processing_stats"]["total_rows"] == 10
    assert spark.read.parquet(str(tmp_path / "off/users.parquet")).select(users.columns[:9]).exceptAll(users.select(users.columns[:9])).count() == 0


def test_unchanged_text_still_counts_as_anonymized(spark):
    df = spark.createDataFrame([("Al",), (None,), ("x",)], "name string")
    policy = {"t": TablePolicy(columns={"name": ColumnPolicy(holds="PERSON")})}
    report = database_report(TableSet(spark, {"t": df}), Policy.default(), policy).first()["anonymization_stats"]
    assert (report["total_values_processed"], report["total_values_anonymized"]) == (3, 1)


def test_append_checks_columns(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    df.write.parquet(path)
    append(df.select("v", "k"), path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="2 columns"):
        append(df.withColumn("w", F.lit(1)), path)


def test_catalog_tables_and_empty_copies(spark, tmp_path):
    spark.sql(f"CREATE DATABASE redactory_test LOCATION '{tmp_path / 'db'}'")
    try:
        spark.range(3).write.saveAsTable("redactory_test.numbers")
        spark.sql("CREATE VIEW redactory_test.seen AS SELECT * FROM redactory_test.numbers")
        tables = TableSet.from_catalog(spark, "redactory_test")
        assert list(tables.frames) == ["numbers"]
        assert tables.row_counts().first()["n_rows"] == 3
        copy = tables.empty_copy()
        assert copy.frames["numbers"].schema.names == ["id"] and copy.row_counts().first()["n_rows"] == 0
    finally:
        spark.sql("DROP DATABASE redactory_test CASCADE")


def test_validation(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    left = TableSet(spark, {"a": df, "b": df, "c": df}).metadata()
    right = TableSet(spark, {"a": df, "b": df.select("v", "k"), "d": df}).metadata()
    problems = {(r["table"], r["expected"], r["actual"]) for r in schema_differences(left, right).collect()}
    assert problems == {("c", None, None), ("b", "k", "v"), ("b", "v", "k")}
    bad = {"a": TablePolicy(columns={"v": ColumnPolicy(), "w": ColumnPolicy()}), "z": TablePolicy(columns={"q": ColumnPolicy()})}
    rows = {(r["table"], r["column"], r["problem"]) for r in policy_violations(left, bad).collect()}
    assert rows == {("a", "w", "column not found"), ("z", "", "table not found")}


def test_upsert_composite_keys_and_ties(spark):
    old = spark.createDataFrame([(1, 1, "a", 5), (1, 2, "b", 5), (None, 1, "n", 1)], "x int, y int, v string, seq int")
    new = spark.createDataFrame([(1, 2, "B", 1), (1, 2, "C", 2), (2, 2, "d", 1), (None, 1, "N", 0)], old.schema)
    got = {tuple(r)[:3] for r in upsert(old, new, ["x", "y"], ["seq"]).collect()}
    # A NULL in a key is equal to nothing, as in SQL: both such rows stay.
    assert got == {(1, 1, "a"), (1, 2, "C"), (2, 2, "d"), (None, 1, "n"), (None, 1, "N")}
    assert upsert(old, new, []).count() == 7
    with pytest.raises(ValueError):
        upsert(old, new.drop("v"), ["x"])


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id AS seq")
    reduced = latest(df, ["k"], ["seq"])
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(k") < plan.rindex("WindowGroupLimit") and plan.count("WindowGroupLimit") == 2
    assert {tuple(r) for r in reduced.collect()} == {(0, 998), (1, 999)}


@pytest.mark.parametrize("kind", ["bigint", "string", "timestamp"])
def test_pages(spark, kind):
    keys = random.Random(1).sample(range(100000), 1234)
    df = spark.createDataFrame([(k,) for k in keys], "n bigint")
    df = df.select((F.lpad(F.col("n").cast("string"), 6, "0") if kind == "string" else F.col("n").cast(kind)).alias("k"), "n")
    rows = with_pages(df, "k", 100, slices=7).collect()
    rank = {k: i for i, k in enumerate(sorted(keys))}
    assert all((r["page"], r["row_in_page"]) == divmod(rank[r["n"]], 100) for r in rows) and len(rows) == 1234
    assert [r["n"] for r in page(df, ["k"], 200, 3).collect()] == sorted(keys)[200:203]


def test_page_after_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    following = page_after(df, "o_orderkey", 99, 10)
    assert "GreaterThan(o_orderkey,99)" in following._jdf.queryExecution().executedPlan().toString()
    assert [r["o_orderkey"] for r in following.collect()] == list(range(100, 110))


def test_lexicon_join_agrees_with_brute_force(spark):
    draw = random.Random(9)
    words = ["new", "york", "newer", "é", "lake", "a", "b-c", "New York"]
    texts = [(i, draw.choice([" ", ", "]).join(draw.choices(words, k=draw.choice([0, 3, 40, 300])))) for i in range(60)]
    terms = ["new york", "new", "lake", "New York", "york, new", "é"]
    df = spark.createDataFrame(texts, "id int, t string")
    lexicon = spark.createDataFrame([(t, "PLACE", 0.9) for t in terms], "term string, entity string, score double")
    word = lambda c: c.isalnum() or c == "_"
    want = set()
    for i, text in texts:
        for term in terms:
            at = text.find(term)
            while at >= 0:
                end = at + len(term)
                if not (at and word(text[at - 1])) and not (end < len(text) and word(text[end])):
                    want.add((i, at, end, term))
                at = text.find(term, at + 1)
    for limit in (1 << 20, 0):
        rows = lexicon_findings(df, ["id"], "t", lexicon, broadcast_limit=limit).collect()
        assert {(r["id"], r["start"], r["end"], r["value"]) for r in rows} == want and len(rows) == len(want)


def test_parameterised_queries(spark):
    spark.range(10).createOrReplaceTempView("ten")
    assert query_results(spark, "SELECT * FROM ten WHERE id >= ? AND id < ?", [3, 5]).count() == 2
    assert spark.table("results").count() == 2
    assert query_results(spark, "SELECT * FROM ten WHERE id = :x", {"x": 3}, name=None).count() == 1


def test_anonymizing_is_one_scan_without_shuffle(spark):
    from redactory import anonymize_table

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plan = anonymize_table(df, Policy.default())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and plan.count("FileScan") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_columns_with_other_policies_keep_their_order(spark):
    from redactory import anonymize_table

    df = spark.createDataFrame([("a@b.com", "c@d.com 123-45-6789", "e@f.com", "Eve")], "p string, q string, r string, s string")
    policy = TablePolicy(columns={"q": ColumnPolicy(entities=("US_SSN",)), "s": ColumnPolicy(holds="CODE")})
    code = EntityPolicy("CODE", patterns=(Pattern("c", "c@[a-z]"),))
    out = anonymize_table(df, Policy.default().with_entity(code), policy).first()
    assert tuple(out) == ("a@b.com", "c@d.com ", "e@f.com", "<CODE>")


def test_selected_outputs_prune_the_scan(spark):
    from redactory import anonymize_table

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = anonymize_table(df, Policy.default())
    plan = lambda *names: out.select(*names)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string>" in plan("lang") and "ReadSchema: struct<text:string>" in plan("text")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan("doc_id", "text")
    assert out.columns == df.columns

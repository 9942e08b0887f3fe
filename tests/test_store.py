"""The upsert store: the same winners as batch upserts, compaction, failures."""

import pytest
from pyspark.sql import functions as F

from redactory import upsert
from redactory.sources import store as S
from redactory.sources.store import StoreError, UpsertStore
from redactory.streaming.jobs import file_stream, read_upserted, upsert_stream


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, *values):
    return spark.createDataFrame(list(values), "k string, t int, batch string")


FIRST = [("a", 5, "new"), ("b", 1, "x"), (None, 1, "n1")]
LATE = [("a", 2, "late"), ("a", 1, "later"), ("b", 1, "tie"), ("c", 1, "y"), (None, 1, "n2")]


@pytest.mark.parametrize("by, winner", [("arrival", "late"), ("order", "new")])
@pytest.mark.parametrize("compact", [False, True])
def test_late_rows_like_batch_upserts(spark, tmp_path, by, winner, compact):
    first, late = frame(spark, *FIRST), frame(spark, *LATE)
    store = UpsertStore.create(spark, str(tmp_path / "s"), ["k"], ["t"], by)
    for batch in (first, late):
        store.write(batch)
        if compact:
            store.compact()
    merged = rows(upsert(first, late, ["k"], ["t"], by))
    assert rows(store.read()) == merged and ("a", 5 if winner == "new" else 2, winner) in merged
    assert ("b", 1, "tie") in merged and len(merged) == 5
    assert store.read().columns == ["k", "t", "batch"]
    assert rows(store.find(k="a")) == [r for r in merged if r[0] == "a"]
    with pytest.raises(StoreError):
        store.find(t=1)


def test_stream_and_batch_agree_on_a_late_row(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    frames = [frame(spark, *FIRST), frame(spark, *LATE)]
    for i, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(source)
        upsert_stream(file_stream(spark, source, "*.parquet"), ["k"], ["t"], out, state, compact_every=2).awaitTermination()
    assert rows(read_upserted(spark, out)) == rows(upsert(*frames, ["k"], ["t"], "order"))
    with pytest.raises(StoreError):
        read_upserted(spark, out, ["t"])


def test_reading_costs_no_more_after_many_batches(spark, tmp_path):
    store = UpsertStore.create(spark, str(tmp_path / "s"), ["k"], buckets=4)
    for i in range(12):
        store.write(spark.range(40).selectExpr("id % 20 AS k", f"{i} AS v"))
        if store.batches() >= 3:
            store.compact()
    assert store.batches() == 0 and rows(store.read()) == sorted([(k, 11) for k in range(20)], key=repr)
    assert len(S._folders(spark, f"{store.path}/snapshot")) == 2 and not S._folders(spark, f"{store.path}/log")
    assert len(store.read().inputFiles()) <= 4
    plan = store.find(k=3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan and rows(store.find(k=3)) == [(3, 11)]


def test_batches_are_written_once(spark, tmp_path):
    store = UpsertStore.create(spark, str(tmp_path / "s"), ["k"])
    store.write(spark.range(3).selectExpr("id AS k", "'old' AS v"), 0)
    store.write(spark.range(3).selectExpr("id AS k", "'new' AS v"), 0)  # the attempt before failed
    assert {r["v"] for r in store.read().collect()} == {"new"}
    store.compact()
    store.write(spark.range(3).selectExpr("id AS k", "'again' AS v"), 0)  # part of the snapshot already
    assert {r["v"] for r in store.read().collect()} == {"new"} and store.batches() == 0


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    store = UpsertStore.create(spark, str(tmp_path / "s"), ["k"])
    store.write(spark.range(5).selectExpr("id AS k", "1 AS v"))

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(UpsertStore, "_publish", die)
    with pytest.raises(RuntimeError):
        store.compact()
    monkeypatch.undo()
    store.write(spark.range(2).selectExpr("id AS k", "2 AS v"))
    assert rows(store.read()) == [(0, 2), (1, 2), (2, 1), (3, 1), (4, 1)]
    store.compact()
    assert rows(store.read()) == [(0, 2), (1, 2), (2, 1), (3, 1), (4, 1)]


def test_new_columns_and_rules(spark, tmp_path):
    path = str(tmp_path / "s")
    store = UpsertStore.create(spark, path, ["k"])
    store.write(spark.range(2).selectExpr("id AS k", "'a' AS v"))
    store.compact()
    store.write(spark.range(1, 3).selectExpr("id AS k", "'b' AS v", "true AS w"))
    assert rows(store.read()) == [(0, "a", None), (1, "b", True), (2, "b", True)]
    assert UpsertStore.create(spark, path, ["k"]).keys == ("k",)
    for keys, order, by in ((["v"], [], "arrival"), (["k"], ["v"], "order"), (["k"], [], "order"), ([], [], "arrival")):
        with pytest.raises(StoreError):
            UpsertStore.create(spark, path, keys, order, by)
    with pytest.raises(StoreError):
        UpsertStore.open(spark, str(tmp_path / "none"))
    with pytest.raises(StoreError):
        UpsertStore.create(spark, str(tmp_path / "empty"), ["k"]).read()


def test_hot_keys_and_rows_without_a_key(spark, tmp_path):
    store = UpsertStore.create(spark, str(tmp_path / "s"), ["k"], ["t"], "order")
    hot = spark.range(3_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    store.write(hot)
    store.compact()
    assert store.read().where("k IS NULL").count() == 1_000 and store.read().where("k IS NOT NULL").count() == 2

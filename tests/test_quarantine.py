"""Rows whose masks or models fail are put aside with the reason; all others are written."""

from dataclasses import replace

import pandas as pd
import pytest

from redactory import EntityPolicy, Pattern, Policy, TablePolicy, anonymize_table, register_python_mask
from redactory.operators.anonymize import anonymize_separated, guarded_by
from redactory.operators.model import with_model_spans
from redactory.policy import PolicyError


def picky(values: pd.Series) -> pd.Series:
    if values.str.contains("13").any():
        raise ValueError("unlucky")
    return values.str.replace("[0-9]", "#", regex=True)


register_python_mask("picky", picky)
NUMBER = EntityPolicy("NUMBER", patterns=(Pattern("n", "[0-9]{2}"),), strategy="custom", params={"lambda": "picky"})
OTHER = EntityPolicy("OTHER", patterns=(Pattern("o", "other"),), strategy="redact")
POLICY = Policy(entities=(NUMBER, OTHER), on_error="quarantine")


def frame(spark):
    rows = [(1, "a 12 b 14 other", None), (2, "x 13 y 12 z 13", "q 13"), (3, None, "other"), (4, "plain", "77"), (4, "plain", "77")]
    return spark.createDataFrame(rows, "row int, errors string, `failed.x` string")


def test_failed_rows_are_put_aside_whole(spark):
    clean, failed = anonymize_separated(frame(spark).withColumnRenamed("errors", "t"), POLICY)
    rows = sorted(map(tuple, clean.collect()), key=repr)
    assert rows == [("1", "a ## b ## ", None), ("3", None, ""), ("4", "plain", "##"), ("4", "plain", "##")]
    (row,) = failed.collect()
    assert (row["row"], row["t"], row["failed.x"]) == (2, "x 13 y 12 z 13", "q 13")
    assert {(e["column"], e["entity"], e["error"]) for e in row["errors"]} == {
        ("t", "NUMBER", "ValueError: unlucky"), ("failed.x", "NUMBER", "ValueError: unlucky"),
    }
    assert len(row["errors"]) == 3


def test_nothing_to_put_aside(spark):
    df = frame(spark).withColumnRenamed("errors", "t")
    native = replace(POLICY, entities=(OTHER,))
    clean, failed = anonymize_separated(df, native)
    assert clean.count() == 5 and failed.count() == 0 and "errors" in failed.columns
    clean, failed = anonymize_separated(df.limit(0), POLICY)
    assert clean.count() == failed.count() == 0
    clean, failed = anonymize_separated(df, POLICY, TablePolicy(enabled=False))
    assert clean.count() == 5 and failed.count() == 0
    with pytest.raises(PolicyError):
        anonymize_separated(df, replace(POLICY, on_error="fail"))


def test_other_error_rules_stay(spark):
    df = frame(spark).withColumnRenamed("errors", "t").where("row = 2")
    texts = lambda rule: anonymize_table(df, replace(POLICY, on_error=rule)).first()["t"]
    assert texts("redact") == "x <ERROR> y ## z <ERROR>" and texts("keep") == "x 13 y ## z 13"
    assert "13" not in texts("quarantine")  # without a place for such rows their values are still hidden
    with pytest.raises(Exception, match="unlucky"):
        texts("fail")


def test_model_errors(spark):
    def load():
        def predict(batch):
            if batch.str.contains("bad").any():
                raise RuntimeError("model failed")
            return [[("X", 0, 1, 0.9)] if text else [] for text in batch]

        return predict

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["good", "bad", None, "fine", "bad too"])], "id int, `my text` string")
    rows = {r["id"]: r for r in with_model_spans(df, "my text", load, errors="why").collect()}
    assert [len(rows[i]["model_spans"]) for i in range(5)] == [1, 0, 0, 1, 0]
    assert [rows[i]["why"] for i in range(5)] == [None, "RuntimeError: model failed", None, None, "RuntimeError: model failed"]
    with pytest.raises(Exception, match="model failed"):
        with_model_spans(df, "my text", load).collect()


def test_values_that_fail_are_found_by_few_calls():
    calls = []

    def body(values: pd.Series) -> pd.Series:
        calls.append(len(values))
        return picky(values)

    for every in (1, 2, 3, 10, 100, 5000):
        calls.clear()
        texts = ["n13" if i % every == 0 else f"n{i % 10}" for i in range(2000)]
        found = guarded_by("quarantine")(body, pd.Series(texts, index=range(7, 2007)))
        assert list(found.index) == list(range(7, 2007))
        assert list(found) == [(None, "ValueError: unlucky") if t == "n13" else ("n#", None) for t in texts]
        assert len(calls) <= (2100 if every < 10 else 1500 if every == 10 else 400)


def test_masks_that_number_their_results_anew_are_not_mixed_up():
    def again(values: pd.Series) -> pd.Series:
        if len(values) > 1 and (values == "x").any():
            raise ValueError("together")
        return pd.Series([v.upper() for v in values])

    found = guarded_by("keep")(again, pd.Series(list("abcxef"), index=[9, 8, 7, 6, 5, 4]))
    assert list(found) == [(c, None) for c in "ABCXEF"]

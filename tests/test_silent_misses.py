"""Inputs on which something used to be missed without a word."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from redactory import ColumnPolicy, EntityPolicy, Pattern, Policy, TablePolicy, TableSet, anonymize, anonymize_table, findings, lexicon_findings, register_python_mask, upsert, write_anonymized
from redactory.operators.detect import deny_recognizer
from redactory.policy import PolicyError


def found(frame):
    return sorted((r["id"], r["value"]) for r in frame.collect())


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def test_addresses_of_any_length(spark):
    parts = "12 Main St, Alpha, Beta, Gamma, Delta, Epsilon, Zeta, Eta"
    words = "7 a b c d e f g h i j Street, London"
    long = f"5 Oak Ave, {'x' * 60}, Rome"
    policy = Policy(entities=(EntityPolicy("LOCATION"),))
    got = findings(texts(spark, parts, words, long, "é9 Elm Rd, Oslo"), ["id"], "text", policy).collect()
    longest = {}
    for row in got:
        longest[row["id"]] = max(longest.get(row["id"], ""), row["value"], key=len)
    assert longest == {0: parts, 1: words, 2: long, 3: "9 Elm Rd, Oslo"}


def test_flags_of_a_group(spark):
    policy = Policy(entities=(EntityPolicy("SSN", patterns=(Pattern("p", r"(?i:ssn)\d{3}"), Pattern("q", r"(?i:ab)-\d"))),))
    got = findings(texts(spark, "SSN123 then ssn456, AB-1 aB-2"), ["id"], "text", policy)
    assert found(got) == [(0, "AB-1"), (0, "SSN123"), (0, "aB-2"), (0, "ssn456")]


def test_terms_with_marks_and_repeated_terms(spark):
    terms = [("'s-Hertogenbosch", 0.5), ("#tag", 0.5), ("(ISC)2", 0.5), ("New York", 0.2), ("New York", 0.9)]
    lexicon = spark.createDataFrame([(t, "PLACE", s) for t, s in terms], "term string, entity string, score double")
    got = lexicon_findings(texts(spark, "in 's-Hertogenbosch, #tag; (ISC)2 New York", "tag ISC)2"), ["id"], "text", lexicon)
    rows = got.collect()
    assert found(got) == [(0, "#tag"), (0, "'s-Hertogenbosch"), (0, "(ISC)2"), (0, "New York")]
    assert {r["value"]: (r["start"], r["end"]) for r in rows}["#tag"] == (21, 25)
    assert {r["value"]: r["score"] for r in rows}["New York"] == 0.9
    with pytest.raises(ValueError, match="no letter"):
        lexicon_findings(texts(spark, "x"), ["id"], "text", lexicon.select(F.lit("--").alias("term"), "entity", "score"))


def test_refused_entries():
    with pytest.raises(PolicyError):
        deny_recognizer("X", ["a", ""])
    for regex in ("(ab)+", "a*"):
        with pytest.raises(PolicyError):
            Pattern("p", regex)
    Pattern("p", "x(?:ab)*+")


def test_one_path_for_masks_and_switch(spark):
    register_python_mask("shout", lambda values: values.str.upper() + "!")
    entity = EntityPolicy("CODE", patterns=(Pattern("code", r"code\d+", 0.9),), strategy="custom", params={"lambda": "shout"})
    frame = texts(spark, "see code12 and code3", "none", None)
    for policy in (Policy(entities=(entity,)), Policy(entities=(replace(entity, strategy="redact", params={}),))):
        assert anonymize(frame, "text", policy).collect() == anonymize_table(frame, policy).collect()
    off = Policy(entities=(entity,), enabled=False)
    assert anonymize(frame, "text", off).collect() == frame.collect()
    assert findings(frame, ["id"], "text", off).count() == 0


def test_rows_without_a_key_stay(spark):
    old = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    new = spark.createDataFrame([(None, 4), (1, 5)], "k int, v int")
    got = upsert(old, new, ["k"]).collect()
    assert sorted((r.k is not None, r.v) for r in got) == [(False, 1), (False, 2), (False, 4), (True, 5)]


def test_policies_for_unknown_names_are_refused(spark, tmp_path):
    tables = TableSet(spark, {"t": texts(spark, "a")})
    for policies in ({"u": TablePolicy()}, {"t": TablePolicy(columns={"txt": ColumnPolicy()})}):
        with pytest.raises(PolicyError, match="unknown"):
            write_anonymized(tables, f"{tmp_path}/out", Policy.default(), policies)

"""What a cell costs: bound values are not copied, patterns without a match build nothing, counters need no Python."""

import re

from pyspark.sql import functions as F

from redactory import Pattern, Policy
from redactory.functions.regexes import required_shape
from redactory.functions.spans import regex_spans, resolve_spans
from redactory.functions.text import each, let
from redactory.operators import detect as D
from redactory.operators.anonymize import prepare_table
from redactory.operators.report import profile_from_metrics


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bound_values_are_not_elements_of_an_array(spark):
    nested = let("length(t)", lambda n: let(f"{n} + 1", lambda m: f"{n} * {m}"))
    out = spark.createDataFrame([("abc",), (None,)], "t string").select(F.expr(nested).alias("x"))
    assert "transform(" not in plan(out)
    assert [r.x for r in out.collect()] == [12, None]
    inner = each("sequence(1, 3)", lambda i: let(f"{i} * 2", lambda d: let(f"{d} + {i}", lambda e: f"{d} * {e}")))
    assert spark.range(1).select(F.expr(inner).alias("x")).first().x == [6, 24, 54]


def test_settings_of_patterns_are_constants(spark):
    frame = spark.createDataFrame([("call 555-123-4567 or 555-123-4567, SSN 123-45-6789",)], "t string")
    out = frame.select(F.expr(D.detect("t", D.compile_recognizers(Policy.default()))).alias("s"))
    assert "named_struct(entity, US_SSN" not in plan(out)
    found = [(s.entity, s.start, s.value) for s in out.first().s]
    assert found == [
        ("PHONE_NUMBER", 5, "555-123-4567"), ("PHONE_NUMBER", 21, "555-123-4567"), ("US_SSN", 39, "123-45-6789"),
    ]


def test_value_found_once_or_more_often_is_placed_alike(spark):
    texts = [
        "\u00e9\u20ac\U0001f600 12-34 end", "x12-34 12-34", "12-345 12-34", "12-34 12-34", "12-34", "9912-34", "", None,
    ]
    spans = regex_spans("t", "N", "(?<![0-9a-z])[0-9]{2}-[0-9]{2}(?![0-9])", 1.0)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr(spans).alias("s")).collect()
    assert [[(s.start, s.end) for s in r.s or []] for r in rows] == [
        [(4, 9)], [(7, 12)], [(7, 12)], [(0, 5), (6, 11)], [(0, 5)], [], [], [],
    ]
    assert all(r.t[s.start : s.end] == s.value for r in rows for s in r.s or [])


def test_single_spans_are_settled(spark):
    one = "array(named_struct('entity', 'A', 'start', 1, 'end', 3, 'score', 0.5D, 'value', 'bc'))"
    out = spark.range(1).select(F.expr(resolve_spans(one)).alias("s")).first().s
    assert [tuple(s) for s in out] == [("A", 1, 3, 0.5, "bc")]


def test_observed_counters_need_no_python(spark):
    prepared = prepare_table(spark.createDataFrame([("a@b.example",)], "t string"), Policy.default())
    values = prepared.frame.agg(*prepared.metrics()).first().asDict()
    profile = profile_from_metrics(spark, "t", prepared, values)
    assert "LogicalRDD" not in plan(profile)
    assert [(r["column"], r.n_rows, r.values_anonymized, r.entities) for r in profile.collect()] == [("t", 1, 1, {"EMAIL_ADDRESS": 1})]


def test_texts_without_the_shape_of_a_pattern_are_not_searched(spark):
    assert [required_shape(r) for r in (r"\d{3}-\d{2}-\d{4}", r"\d+\s[A-Z]", r"\d{1,3}(?:\.\d{1,3}){3}", "[0-4][5-9]{2}")] == [
        "000-00-0000", "0 ", "0.0", "000",
    ]
    assert [required_shape(r) for r in (r"a\d?-\d?b", r"(?:12|3)4", r"[0-9&&[^3]]--", r"(?U)\d\d", r"\p{Nd}--", r"[\s.-]\d")] == [None] * 6
    assert "contains(" in plan(spark.createDataFrame([("1",)], "t string").select(F.expr(D.detect("t", D.compile_recognizers(Policy.default())))))
    rx = (r"\d{3}-\d{2}-\d{4}", r"\d+\s[A-Z]", r"\d{1,3}(?:\.\d{1,3}){2}", r"[0-9]{2}(?:ab)?[0-9]", r"\d(?:-\d){2,9}", r"\d{2,}?-[\t ]x")
    group = [D.Recognizer(f"E{i}", (Pattern("p", r, 0.9),)) for i, r in enumerate(rx)]
    texts = ["123-45-6789", "7\tX 7\nY 7\u00a0Z", "1.2.3 10.20.30", "12ab3 123", "1-2-3-4", "99-\tx 1- x", "\u0661\u0662-3", "", None, "1 2 3"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = frame.select("i", F.expr(f"inline({D.detect('t', group)})")).collect()
    want = {
        (i, f"E{n}", m.start(), m.end())
        for i, t in enumerate(texts) for n, r in enumerate(rx) for m in re.finditer(r, t or "", re.ASCII)
    }
    assert {(r.i, r.entity, r.start, r.end) for r in found} == want and want

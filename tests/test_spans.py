import random
import re

from pyspark.sql import functions as F

from redactory.functions.regexes import first_class, min_width
from redactory.functions.spans import (
    SPANS_TYPE,
    at_least,
    distinct_spans,
    only_entities,
    regex_spans,
    resolve_spans,
    rewrite,
)


def test_offsets_agree_with_python_for_any_number_of_hits(spark):
    draw = random.Random(3)
    texts = ["", "x", "a1", "é1é22é", "1", "12 " * 500, None]
    texts += ["".join(draw.choice("ab é1234 ") for _ in range(draw.choice([5, 40, 900]))) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", F.expr(regex_spans("t", "N", "[0-9]+", 0.5)).alias("s")).collect():
        want = [(m.start(), m.end(), m.group()) for m in re.finditer("[0-9]+", row["t"] or "")]
        assert [(s["start"], s["end"], s["value"]) for s in row["s"]] == want


def brute_force(spans):
    """Owner of every character, from the definition: hulls per entity, then the strongest span."""
    hulls = []
    for entity in {s[0] for s in spans}:
        own = sorted(s for s in spans if s[0] == entity)
        own.sort(key=lambda s: (s[1], s[2]))
        current = list(own[0])
        for s in own[1:]:
            if s[1] < current[2]:
                current[2], current[3] = max(current[2], s[2]), max(current[3], s[3])
            else:
                hulls.append(tuple(current))
                current = list(s)
        hulls.append(tuple(current))
    ranked = sorted(hulls, key=lambda h: (-h[3], h[1] - h[2], h[1], h[0]))
    owner = {}
    for h in ranked:
        for at in range(h[1], h[2]):
            owner.setdefault(at, h)
    out = []
    for at in sorted(owner):
        h = owner[at]
        if out and out[-1][2] == at and out[-1][4] == h:
            out[-1][2] = at + 1
        else:
            out.append([h[0], at, at + 1, h[3], h])
    return [tuple(o[:4]) for o in out]


def random_cases(draw, n):
    for _ in range(n):
        size = draw.choice([10, 60, 400])
        text = "".join(draw.choice("abcdefgé ") for _ in range(size))
        spans = set()
        for _ in range(draw.choice([0, 1, 2, 4, 9, 150])):
            a = draw.randrange(size - 1)
            b = min(size, a + draw.randint(1, 8))
            spans.add((draw.choice("XYZ"), a, b, draw.choice([0.3, 0.5, 0.9])))
        yield text, sorted(spans)


def test_resolution_and_rewriting_agree_with_brute_force(spark):
    cases = list(random_cases(random.Random(5), 150))
    # A > B > C with A and C apart: C must not be lost with B.
    cases.append(("abcdefghij", [("X", 0, 4, 0.9), ("Y", 3, 8, 0.5), ("Z", 7, 10, 0.3)]))
    rows = [(t, [(e, a, b, p, t[a:b]) for e, a, b, p in s]) for t, s in cases]
    df = spark.createDataFrame(rows, f"t string, s {SPANS_TYPE}")
    df = df.withColumn("s", F.expr(distinct_spans("s")))
    out = df.select(
        "t", "s", F.expr(resolve_spans("s")).alias("r"),
        F.expr(rewrite("t", resolve_spans("s"), lambda s, i: f"concat('<', {s}.entity, {s}.value, '>')")).alias("w"),
    )
    for row in out.collect():
        text = row["t"]
        want = brute_force([tuple(s)[:4] for s in row["s"]])
        got = [tuple(s) for s in row["r"]]
        assert [g[:4] for g in got] == want
        assert all(g[4] == text[g[1]:g[2]] for g in got)
        covered = {i for s in row["s"] for i in range(s["start"], s["end"])}
        assert covered == {i for g in got for i in range(g[1], g[2])}
        rebuilt, at = "", 0
        for e, a, b, _ in want:
            rebuilt += text[at:a] + f"<{e}{text[a:b]}>"
            at = b
        assert row["w"] == rebuilt + text[at:]


def test_filters_and_duplicates(spark):
    spans = [("A", 0, 2, 0.5, "xx"), ("A", 0, 2, 0.9, "xx"), ("B", 0, 2, 0.4, "xx")]
    df = spark.createDataFrame([(spans,)], f"s {SPANS_TYPE}")
    pick = lambda e: [tuple(s)[:4] for s in df.select(F.expr(e)).first()[0]]
    assert pick(distinct_spans("s")) == [("A", 0, 2, 0.9), ("B", 0, 2, 0.4)]
    assert pick(at_least("s", 0.5)) == [("A", 0, 2, 0.5), ("A", 0, 2, 0.9)]
    assert len(pick(at_least("s", 0.0))) == 3 and len(pick(only_entities("s", []))) == 3
    assert pick(only_entities("s", ["B"])) == [("B", 0, 2, 0.4)]


def test_pattern_facts():
    assert (min_width(r"\b4\d{3}-\d{4}"), first_class(r"\b4\d{3}-\d{4}")) == (9, "4")
    assert first_class(r"(?:\+\d )?\(?\d{3}") == r"0-9\(\+"
    assert first_class("[A-Z]x") is None and first_class("(?i)1a") is None and first_class(".1") is None
    assert (min_width(r"\p{L}+"), first_class(r"\p{L}+")) == (1, None)
    assert first_class("a?") is None


def test_long_chains_of_overlaps(spark):
    """100,000 spans of three entities, each overlapping the next: linear, and every character goes to its strongest span."""
    import time

    n = 100_000
    span = (
        "named_struct('entity', concat('E', cast(i % 3 AS string)), 'start', cast(2 * i AS int), 'end', cast(2 * i + 3 AS int), "
        "'score', 0.5D + (i * 7 % 10) / 20D, 'value', repeat(cast(i % 10 AS string), 3))"
    )
    df = spark.range(1).selectExpr(f"transform(sequence(0, id + {n - 1}), i -> {span}) AS s")
    small = df.selectExpr(resolve_spans("slice(s, 1, 50)") + " AS r").first()["r"]
    spans = df.selectExpr("slice(s, 1, 50) AS s").first()["s"]
    for place in range(101):
        own = [s for s in spans if s["start"] <= place < s["end"]]
        best = min(own, key=lambda s: (-s["score"], s["start"] - s["end"], s["start"], s["entity"]))
        got = next(r for r in small if r["start"] <= place < r["end"])
        assert (got["entity"], got["score"]) == (best["entity"], best["score"])
    started = time.time()
    found = df.selectExpr(f"size({resolve_spans('s')}) AS n").first()["n"]
    assert found >= n // 2 and time.time() - started < 180  # a filter per edge takes hours

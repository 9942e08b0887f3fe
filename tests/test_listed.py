"""Listed terms looked up inside a row, against plain Python and against the alternation of short lists."""

import random
import re

import pytest

from redactory import EntityPolicy, Policy, anonymize_table, findings
from redactory.operators import detect
from redactory.operators.detect import compile_recognizers, deny_recognizer
from redactory.operators.lexicon import lexicon_findings
from redactory.policy import PolicyError

ALPHABET = ["Al", "al", "Ann", "Lee", "C++", "é", "@", " ", "  ", "-", "1", "_", ".", "\n", "Al Lee", "日本", "\\", "'", '"']


def found(spark, texts, recognizers):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = findings(df, ["id"], "text", recognizers).collect()
    return sorted((r["id"], r["entity"], r["start"], r["end"], r["score"], r["value"]) for r in rows)


def expected(texts, terms, entity):
    """Leftmost, then longest; whole words; none inside another."""
    inside = lambda text, i: 0 <= i < len(text) and re.match(r"\w", text[i])
    result = []
    for number, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            fits = [
                t for t in terms
                if text.startswith(t, at) and not inside(text, at - 1) and not inside(text, at + len(t))
            ]
            if fits:
                best = max(fits, key=len)
                result.append((number, entity, at, at + len(best), terms[best], best))
                at += len(best)
            else:
                at += 1
    return sorted(result)


def texts_of(seed, n=150):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(2, 40))) for _ in range(n)]


def test_terms_in_random_texts(spark):
    terms = {"Al": 0.9, "Al Lee": 0.8, "Lee": 0.7, "C++": 0.6, "@Ann": 0.9, "Ann -": 0.5, "1": 1.0, "é é": 0.8, "Lee  Al": 1.0,
             "日本": 1.0, "\\Al'": 0.9, '"1"': 0.9, "Al_": 0.4}
    texts = [t for t in texts_of(1) if len(t.strip()) > 1]
    recognizer = detect.Recognizer("X", terms=tuple(terms.items()))
    assert found(spark, texts, [recognizer]) == expected(texts, terms, "X")


def test_short_and_long_deny_lists_agree(spark, monkeypatch):
    words = ["Al", "Al Lee", "Lee", "C++", "@Ann", "++", "-", "1", "Ann", "é", "\\"]
    texts = [t for t in texts_of(2) if len(t.strip()) > 1]
    short = found(spark, texts, [deny_recognizer("X", words)])
    monkeypatch.setattr(detect, "LOOK_UP_FROM", 1)
    looked_up = deny_recognizer("X", words)
    assert len(looked_up.terms) == 8 and len(looked_up.patterns) == 1
    # Entries without a letter are a search of their own there, so one may lie inside a phrase.
    inner = {"++", "-", "\\"}
    assert [s for s in found(spark, texts, [looked_up]) if s[5] not in inner] == [s for s in short if s[5] not in inner]


def test_long_texts_and_lists(spark):
    names = [f"First{i % 90} Last{i}" for i in range(20_000)]
    lexicon = spark.createDataFrame([(n, "PERSON", 0.9) for n in names], "term string, entity string, score double")
    policy = Policy.default().only().with_listed(lexicon)
    text = "x First7 Last7 and First8 Last7, First8 Last98. " * 4_000 + "no one " * 20_000
    rows = found(spark, [text, "nobody here"], compile_recognizers(policy))
    assert len(rows) == 8_000 and rows[0][2:] == (2, 14, 0.9, "First7 Last7") and rows[1][5] == "First8 Last98"


def test_listed_terms_in_table_jobs(spark):
    lexicon = spark.createDataFrame(
        [("Ann Lee", "PERSON", 0.9), ("Ann Lee", "PERSON", 0.2), ("Oslo", "LOCATION", 0.85), ("Acme & Co", "ORG", None),
         (None, "ORG", 1.0), (" ", "ORG", 1.0), ("Low", "PERSON", 0.1)],
        "term string, entity string, score double",
    )
    policy = Policy.default().with_listed(lexicon)
    df = spark.createDataFrame(
        [("Ann Lee of Acme & Co, Oslo", "Low", 1), ("Ann  Lee", None, 2), (None, "Ann Leeds in Oslo2", 3)],
        "a string, b string, n int",
    )
    got = [tuple(r) for r in anonymize_table(df, policy).orderBy("n").collect()]
    assert got == [("An* Le* of Acm******, O***", "Low", "1"), ("Ann  Lee", None, "2"), (None, "Ann Leeds in Oslo2", "3")]


def test_lists_that_are_refused(spark):
    frame = lambda *terms: spark.createDataFrame([(t, "X", 1.0) for t in terms], "term string, entity string, score double")
    with pytest.raises(PolicyError, match="too large"):
        Policy().with_listed(frame("abc", "def"), limit=10)
    with pytest.raises(PolicyError, match="letter or digit"):
        Policy().with_listed(frame("+++"))
    assert Policy().with_listed(frame()).entities == ()


def test_look_up_agrees_with_the_join(spark):
    terms = [("Al", "PERSON", 0.9), ("Lee", "PERSON", 0.7), ("C++", "ORG", 0.8), ("日本", "LOCATION", 1.0)]
    lexicon = spark.createDataFrame(terms, "term string, entity string, score double")
    texts = [t for t in texts_of(3) if len(t.strip()) > 1]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    policy = Policy(entities=(EntityPolicy("PERSON", threshold=0.0),)).with_listed(lexicon)
    joined = lexicon_findings(df, ["id"], "text", lexicon).collect()
    expect = sorted((r["id"], r["entity"], r["start"], r["end"], r["score"], r["value"]) for r in joined)
    assert found(spark, texts, compile_recognizers(policy)) == expect


def test_lists_share_the_located_words(spark):
    lists = {"A": {"Al": 0.9, "Ann": 0.8, "Al Lee": 0.7}, "B": {"Lee": 0.6, "Al": 0.5}, "C": {"1": 1.0}, "D": {"nobody": 0.4}}
    recognizers = [detect.Recognizer(name, terms=tuple(terms.items())) for name, terms in lists.items()]
    texts = [t for t in texts_of(3, 80) if len(t.strip()) > 1]
    assert found(spark, texts, recognizers) == sorted(s for name, terms in lists.items() for s in expected(texts, terms, name))
    searches = lambda group: detect._listed("t", group).count("split(")
    assert searches(recognizers) == searches(recognizers[:1])

"""Street addresses: linear search, same matches as the patterns as they are usually written."""

import random
import re
import time

import pytest

from redactory import Policy, findings
from redactory.policy_defaults import ADDRESS_PATTERNS, STREET_WORDS

# The patterns with nested loops; in Python's dialect, on texts too short for them to hurt.
PLAIN = {
    "full_address": rf"\b\d+(?:\s+[A-Za-z]+)+\s+(?:{STREET_WORDS})\b(?:,\s*[A-Za-z\s]+)*",
    "street_address": rf"\b\d+\s+[A-Za-z\s]+(?:{STREET_WORDS})\b",
    "address_with_city": r"\b\d+\s+[A-Za-z\s]+,\s*[A-Za-z\s]+,\s*[A-Za-z\s]+",
}
PIECES = ["1", "22", " ", "  ", "\n", "a", "St", "Ave", "Main", "Street", "Stan", ",", ", ", "-", "Rd", "_", "."]


def test_same_matches_as_plain_patterns():
    r = random.Random(5)
    for _ in range(20_000):
        text = "".join(r.choice(PIECES) for _ in range(r.randrange(1, 16)))
        for name, regex, _score in ADDRESS_PATTERNS:
            spans = [m.span() for m in re.finditer(regex, text)]
            assert spans == [m.span() for m in re.finditer(PLAIN[name], text, re.ASCII)], (name, text)


@pytest.mark.parametrize(
    "piece", [" ", "word ", "1 a ", "1 a, ", "1 " + " " * 997 + ",", "1 a, b ", "1\n", "12 Main St, ", "1", "1 a St"]
)
def test_a_megabyte_takes_seconds(spark, piece):
    policy = Policy.default().only("LOCATION")
    text = "1 " + piece * (1_000_000 // len(piece)) + " x"
    df = spark.createDataFrame([(1, text), (2, text + ","), (3, "1" + " " * 1_000_000 + "x")], "id long, text string")
    findings(df.limit(1), ["id"], "text", policy).count()
    started = time.time()
    findings(df, ["id"], "text", policy).count()
    assert time.time() - started < 15  # a quadratic search of one of these texts takes hours

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from redactory import EntityPolicy, Pattern, Policy, anonymize, anonymize_table, register_mask, register_python_mask
from redactory.functions import masks


def expected_email(v):
    if "@" not in v:
        return v
    user, domain = v.split("@", 1)
    first, dot, _ = domain.partition(".")
    shown = user if len(user) <= 2 else user[:2].ljust(len(user), "*")
    if not dot:
        return f"{shown}@{domain}"
    return f"{shown}@{first if len(first) <= 2 else first[0].ljust(len(first), '*')}.{domain.rsplit('.', 1)[1]}"


def expected_person(v):
    return " ".join(w if len(w) <= 2 else w[:2].ljust(len(w), "*") for w in re.split(r"[ \t\n\x0b\f\r]+", v) if w)


def expected_location(v):
    def word(w):
        if re.fullmatch("[0-9]+", w):
            return w[0].ljust(len(w), "*")
        if len(w) <= 2 or w.lower() in {"st", "ave", "rd", "dr", "ln", "blvd", "way", "ct", "pl"}:
            return w
        return w[0].ljust(len(w), "*")

    space = " \t\n\x0b\f\r"
    parts = [p.strip(space) for p in v.split(",")]
    return ", ".join(" ".join(word(w) for w in re.split(f"[{space}]+", p)) for p in parts if p)


CASES = {
    masks.mask_email: expected_email,
    masks.mask_person: expected_person,
    masks.mask_location: expected_location,
}
ALPHABET = st.text(st.sampled_from("abcdéAB019@@..,, \t-"), max_size=24)


@settings(max_examples=3, deadline=None)
@given(st.lists(ALPHABET, min_size=150, max_size=150))
def test_named_masks_agree_with_plain_python(spark, values):
    values += ["user@example.com", "hein.19@mail5.example.com", "a@b", "x@y@z.com", "@", "Al", "Jo Do", "123 Main St, New York"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", *[F.expr(m("v")).alias(f"c{i}") for i, m in enumerate(CASES)]).collect()
    for row in rows:
        for i, want in enumerate(CASES.values()):
            assert row[f"c{i}"] == want(row["v"]), (row["v"], want.__name__)


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "v string").select(F.expr(expression)).first()[0]


def test_documented_examples(spark):
    assert one(spark, masks.mask_email("v"), "user@example.com") == "us**@e******.com"
    assert one(spark, masks.mask_chars(7)("v"), "(555) 123-4567") == "(555) 1*******"
    assert one(spark, masks.mask_chars(8)("v"), "192.168.1.1") == "192********"
    assert one(spark, masks.mask_chars(12)("v"), "4532-1234-5678-9012") == "4532-12************"
    assert one(spark, masks.mask_chars(9)("v"), "short") == "*****"
    assert one(spark, masks.mask_chars(2, from_end=False, char="#")("v"), "short") == "##ort"
    assert one(spark, masks.mask_location("v"), "123 Main St, New York") == "1** M*** St, N** Y***"


def test_hash_and_encryption(spark):
    import hashlib

    assert one(spark, masks.hash_with()("v"), "x") == hashlib.sha256(b"x").hexdigest()
    assert one(spark, masks.hash_with("sha512")("v"), "x") == hashlib.sha512(b"x").hexdigest()
    key = "k" * 16
    assert one(spark, masks.decrypt_with(key)(masks.encrypt_with(key)("v")), "é secret") == "é secret"
    with pytest.raises(ValueError):
        masks.encrypt_with("short")
    with pytest.raises(ValueError):
        masks.hash_with("crc")


@pytest.mark.parametrize(
    "strategy, params, message",
    [("custom", {"lambda": "nope"}, "unknown custom"), ("shuffle", {}, "unknown strategy"), ("mask", {}, "chars_to_mask"),
     ("encrypt", {}, "key")],
)
def test_unusable_strategies_are_refused_when_the_plan_is_built(strategy, params, message):
    with pytest.raises(ValueError, match=message):
        masks.build_mask(strategy, "X", params, {})


def policy_with(strategy, on_error="fail", **params):
    entity = EntityPolicy("CODE", patterns=(Pattern("code", "C[0-9]+"),), strategy=strategy, params=params)
    return Policy(entities=(entity,), on_error=on_error)


def test_custom_masks(spark):
    register_mask("ends", "concat(left({value}, 1), '-', right({value}, 1))")
    df = spark.createDataFrame([("x C123 y C45",)], "t string")
    assert anonymize(df, "t", policy_with("custom", **{"lambda": "ends"})).first()[0] == "x C-3 y C-5"
    assert anonymize(df, "t", policy_with("replace")).first()[0] == "x <CODE> y <CODE>"
    assert anonymize(df, "t", policy_with("redact")).first()[0] == "x  y "


def test_python_masks_and_their_error_policy(spark):
    def fragile(values):
        return values.map(lambda v: v[::-1] if v != "C13" else 1 / 0)

    register_python_mask("fragile", fragile)
    df = spark.createDataFrame([("a C12 b C13",), ("none",), (None,), ("C7",)], "t string")
    policy = lambda e: policy_with("custom", on_error=e, **{"lambda": "fragile"})
    out = lambda e: [r[0] for r in anonymize_table(df, policy(e)).collect()]
    assert out("redact") == ["a 21C b <ERROR>", "none", None, "7C"]
    assert out("keep") == ["a 21C b C13", "none", None, "7C"]
    with pytest.raises(Exception, match="ZeroDivisionError|division"):
        out("fail")

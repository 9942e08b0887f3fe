import pytest
from pyspark.sql import functions as F

from redactory import ColumnPolicy, EntityPolicy, Pattern, Policy, PolicyError, TablePolicy, anonymize, anonymize_table, findings
from redactory.operators.detect import compile_recognizers, detect
from redactory.operators.model import with_model_spans


def found(spark, text, policy=None, **column):
    compiled = compile_recognizers(policy or Policy.default(), ColumnPolicy(**column))
    row = spark.createDataFrame([(text,)], "t string").select(F.expr(detect("t", compiled)).alias("s")).first()
    return [(s["entity"], s["value"], round(s["score"], 2)) for s in row["s"]]


@pytest.mark.parametrize("text", [None, "", "7", "   ", " \n\t", "plain words only", "..."])
def test_nothing_to_find(spark, text):
    assert found(spark, text) == []


@pytest.mark.parametrize(
    "text, want",
    [
        ("see a.b@mail.example.com.", [("EMAIL_ADDRESS", "a.b@mail.example.com", 1.0)]),
        ("two a@b.co,c@d.eu", [("EMAIL_ADDRESS", "a@b.co", 1.0), ("EMAIL_ADDRESS", "c@d.eu", 1.0)]),
        ("user@localhost", []),
        ("x (555) 123-4567 y", [("PHONE_NUMBER", "(555) 123-4567", 0.7)]),
        ("x +1-555-987-6543", [("PHONE_NUMBER", "+1-555-987-6543", 0.7)]),
        ("x 123-45-6789", [("US_SSN", "123-45-6789", 0.9)]),
        ("x 4532-1234-5678-9012", [("CREDIT_CARD", "4532-1234-5678-9012", 0.9)]),
        ("x 6532-1234-5678-9012", [("CREDIT_CARD", "6532-1234-5678-9012", 0.8)]),
        ("é4111111111111111", [("CREDIT_CARD", "4111111111111111", 1.0)]),
        ("x 4111111111111112", []),
        ("x 10.0.0.255 256.1.1.1", [("IP_ADDRESS", "10.0.0.255", 0.95)]),
        ("go https://x.io/a?b='c'", [("URL", "https://x.io/a?b=", 0.7)]),
    ],
)
def test_built_in_patterns(spark, text, want):
    assert found(spark, text) == want


def test_context_words_raise_scores(spark):
    assert found(spark, "his ssn is 123-45-6789") == [("US_SSN", "123-45-6789", 1.0)]
    far = "ssn " + "x" * 70 + " 123-45-6789"
    assert found(spark, far) == [("US_SSN", "123-45-6789", 0.9)]


def test_thresholds(spark):
    bad_card = "x 4111111111111112"
    assert found(spark, bad_card, Policy.default(legacy_thresholds=True)) == [("CREDIT_CARD", bad_card[2:], 0.3)]
    assert found(spark, bad_card, threshold=0.2) == [("CREDIT_CARD", bad_card[2:], 0.3)]
    assert found(spark, "123-45-6789", threshold=0.95) == []
    assert found(spark, "123-45-6789", threshold=0.0) == [("US_SSN", "123-45-6789", 0.9)]


def test_allow_list_language_and_declared_columns(spark):
    text = "a@b.com 123-45-6789"
    assert found(spark, text, entities=("US_SSN",)) == [("US_SSN", "123-45-6789", 0.9)]
    assert found(spark, text, language="fr") == [("EMAIL_ADDRESS", "a@b.com", 1.0)]
    assert found(spark, "Eve Li", holds="PERSON") == [("PERSON", "Eve Li", 1.0)]


def test_no_enabled_entity_means_all(spark):
    every = Policy.default().only()
    assert every.enabled_entities() == []
    assert {f[0] for f in found(spark, "a@b.com on 2024-01-02", every)} == {"EMAIL_ADDRESS", "DATE_TIME"}


def test_long_texts_do_not_exhaust_the_regex_stack(spark):
    text = "12 " + "word " * 20000 + "a@b.com"
    assert [f[:2] for f in found(spark, text)] == [("EMAIL_ADDRESS", "a@b.com")]


def test_deny_lists(spark):
    few = Policy(entities=(EntityPolicy("BAD", deny=("new york", "c++", "Li")),))
    assert [f[1] for f in found(spark, "Li in new york, c++; Lisa, newyork", few)] == ["Li", "new york", "c++"]
    many = Policy(entities=(EntityPolicy("BAD", deny=tuple(f"w{i}" for i in range(400))),))
    assert [f[1] for f in found(spark, "w1 w399 w400 éw2 w3", many)] == ["w1", "w399", "w3"]


def test_rows_are_routed_by_language(spark):
    df = spark.createDataFrame([(1, "en", "123-45-6789 a@b.com"), (2, "fr", "123-45-6789 a@b.com")], "id int, lang string, t string")
    rows = findings(df, ["id"], "t", Policy.default(), language="lang").collect()
    assert sorted((r["id"], r["entity"]) for r in rows) == [(1, "EMAIL_ADDRESS"), (1, "US_SSN"), (2, "EMAIL_ADDRESS")]


def test_tables_are_routed_by_language(spark):
    df = spark.createDataFrame([("en", "123-45-6789"), ("fr", "123-45-6789"), (None, "a@b.com")], "lang string, t string")
    out = anonymize_table(df, Policy.default(), language_column="lang").collect()
    assert [r["t"] for r in out] == ["", "123-45-6789", "a@b.com"]
    masked = anonymize_table(df, Policy.default(), TablePolicy(columns={"t": ColumnPolicy(language="fr")})).collect()
    assert [r["t"] for r in masked] == ["123-45-6789", "123-45-6789", "a@b.com"]


@pytest.mark.parametrize("regex", [r"(?:a b)*c", r"(ab)+", r"x(y){2,}", "a*", ""])
def test_unsafe_patterns_are_refused(regex):
    with pytest.raises(PolicyError):
        Policy.from_dict({"entities": {"x": {"entity_type": "X", "regex_patterns": [regex]}}})


def test_policy_defaults_and_file(spark, tmp_path):
    data = '{"entities": {"x": {"entity_type": "X", "regex_patterns": ["q[0-9]", {"name": "n", "regex": "(?P<a>z)", "score": 0.6}]}}}'
    path = tmp_path / "policy.json"
    path.write_text(data)
    policy = Policy.load(spark, str(path))
    entity = policy.entity("X")
    assert (entity.enabled, entity.threshold, entity.strategy, dict(entity.params)) == (True, 0.5, "replace", {})
    assert entity.patterns == (Pattern("x_0", "q[0-9]", 0.8), Pattern("n", "(?<a>z)", 0.6))
    assert found(spark, "q1 z", policy) == [("X", "q1", 0.8), ("X", "z", 0.6)]
    assert policy.frame(spark).count() == 1 and len(Policy.default().entities) == 12


def test_adjacent_overlapping_and_default_masks(spark):
    host = EntityPolicy("HOST", patterns=(Pattern("h", r"[a-z]+\.example\.com", 0.75),))
    df = spark.createDataFrame([("https://p.example.com/home a@x.example.com",)], "t string")
    out = anonymize(df, "t", Policy.default().with_entity(host)).first()[0]
    assert out == "********<HOST>***** a@x.com"


def test_types(spark):
    row = spark.sql(
        "SELECT 4111111111111111L AS a, 5 AS b, true AS c, array('a@b.com') AS d, DATE'2024-01-02' AS e, 1.5D AS f, 'x' AS user_id,"
        " CAST(4111111111111111.00 AS DECIMAL(20,2)) AS g"
    )
    out = anonymize_table(row, Policy.default())
    assert [f.dataType.simpleString() for f in out.schema] == [
        "string", "string", "boolean", "array<string>", "string", "string", "string", "string",
    ]
    assert tuple(out.first()) == ("4111************", "5", True, ["a@b.com"], "2024-01-02", "1.5", "x", "4111************.00")


def test_switches(spark):
    df = spark.createDataFrame([("a@b.com", "c@d.com")], "x string, y string")
    off = TablePolicy(columns={"x": ColumnPolicy(enabled=False)})
    assert tuple(anonymize_table(df, Policy.default(), off).first()) == ("a@b.com", "c@d.com")
    assert anonymize_table(df, Policy.default(), TablePolicy(enabled=False)).first()[1] == "c@d.com"
    assert anonymize_table(df, Policy(enabled=False)).collect() == df.collect()


def test_model_hook(spark):
    def load():
        return lambda texts: [[("PERSON", 0, 3, 0.9)] if t.startswith("Eve") else [] for t in texts]

    df = spark.createDataFrame([("Eve met a@b.com",), (None,), ("Bob",)], "t string")
    out = anonymize(with_model_spans(df, "t", load), "t", Policy.default(), "model_spans").drop("model_spans")
    assert [r[0] for r in out.collect()] == ["Ev* met a@b.com", None, "Bob"]

from redactory import ColumnPolicy, EntityPolicy, Pattern, Policy, TablePolicy, anonymize_table

POLICY = {
    "entities": {
        "word": {
            "entity_type": "WORD",
            "regex_patterns": [
                {"name": "german", "regex": "nein", "languages": ["de"]},
                {"name": "any", "regex": "x+"},
                "zz",
            ],
            "anonymization_strategy": "redact",
        }
    }
}


def masked(spark, table_policy=None):
    df = spark.createDataFrame([("nein xx zz", "de"), ("nein xx", "en"), ("nein", None)], "t string, lang string")
    return [r["t"] for r in anonymize_table(df, Policy.from_dict(POLICY), table_policy).collect()]


def test_languages_of_patterns(spark):
    assert masked(spark, TablePolicy(language_column="lang")) == ["  ", "nein ", "nein"]
    assert masked(spark) == ["nein  ", "nein ", "nein"]
    german = TablePolicy(columns={"t": ColumnPolicy(language="de")})
    assert masked(spark, german) == ["  ", " ", ""]
    policy = Policy(entities=(EntityPolicy("W", patterns=(Pattern("p", "ab", 0.9, ("fr",)), Pattern("q", "cd", 0.9)),),))
    df = spark.createDataFrame([("ab cd", "fr")], "t string, l string")
    assert anonymize_table(df, policy, TablePolicy(language_column="l")).first()["t"] == "<W> <W>"

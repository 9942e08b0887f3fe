"""The list of ``names_policy`` holds the cities of the addresses too."""

import duckdb

from checks import jobs
from checks.compare import compare
from checks.oracles import oracle_sql
from checks.people import CITIES
from redactory import anonymize_table


def tables(spark, tmp_path):
    """Customers of all cities, a null key, and a company whose name holds a city: followed by a digit, only the city is found."""
    rows = {
        "customer": ([(k, k % 2) for k in range(1, 43)] + [(None, 0)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, "PERU"), (1, "CHAD"), (2, "Oslo")], "n_nationkey int, n_name string"),
        "supplier": ([(k, f"Shop {k} at Rome /") for k in range(1, 11)], "s_suppkey long, s_name string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_cities_of_the_addresses_are_listed(spark, tmp_path):
    policy = jobs.names_policy(spark, tables(spark, tmp_path))
    assert [t for t, _ in policy.entity("LOCATION").listed] == sorted([*CITIES, "PERU", "CHAD"])
    texts = spark.createDataFrame([("He left Tokyo for Tokyoto.",)], "t string")
    assert anonymize_table(texts, policy).first().t == "He left T**** for Tokyoto."


def test_cities_in_contacts_are_masked(spark, tmp_path):
    folder, duck = tables(spark, tmp_path), duckdb.connect()
    for name in ("customer", "nation", "supplier"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    notes = [r.note for r in jobs.anonymize_table_names(spark, folder).select("note").collect()]
    assert len(notes) == 42 and not any("Rome" in n for n in notes) and all(" /0 is another firm" in n for n in notes)
    good, note = compare(spark, duck, folder, "anonymize_table_names", oracle_sql()["anonymize_table_names"])
    assert good, note

import pytest
from pyspark.sql import types as T

#: Columns that have the names of columns which operators add, and one with a blank.
CLASHING = ("_text", "_key", "size", "score", "fp", "kind", "Start", "_row", "doc", "some name")


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table like ``documents`` from (doc_id, text, source), with further columns of clashing names."""
    names = ("doc_id", "text", "source", "lang", "n_chars", *CLASHING)
    kinds = (T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.LongType(), *[T.StringType()] * len(CLASHING))
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in rows]
        full = [(i, t, s, "en" if t else None, len(t or ""), *["x"] * len(CLASHING)) for i, t, s in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make

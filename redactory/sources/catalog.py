"""Tables of the catalog that know their key columns."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.upsert import ARRIVAL, upsert
from .query import query_results

#: The table properties that hold the key columns, and how many buckets a table has.
KEYS, BUCKETS = "redactory.keys", 32


def save_table(
    df: DataFrame, name: str, keys: Sequence[str] = (), mode: str = "errorifexists", location: str | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Write ``df`` as table ``name``. Key columns cluster and sort it (joins and upserts on them find their rows side by
    side) and are kept as a property of the table."""
    missing = set(keys) - set(df.columns)
    if missing:
        raise ValueError(f"no such key columns: {sorted(missing)}")
    writer = df.write.mode(mode).format("parquet")
    if keys:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    if keys:
        value = json.dumps(list(keys)).replace("'", "\\'")
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{KEYS}' = '{value}')")


def table_keys(spark: SparkSession, name: str) -> list[str]:
    """The key columns of a table that ``save_table`` wrote; none for other tables."""
    found = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return json.loads(found.get(KEYS, "[]"))


def upsert_table(
    incoming: DataFrame, name: str, order: Sequence[str] = (), by: str = ARRIVAL, location: str | None = None
) -> None:
    """Replace or add the rows of ``incoming`` by the keys that the table knows; a table without keys is appended to.

    The merged rows are written as a table of their own, which then takes over the name; until then the table is as it
    was, and a run that dies leaves it under its name or under ``<name>__old``. One writer at a time.
    """
    spark = incoming.sparkSession
    keys = table_keys(spark, name)
    current = spark.table(name)
    if not keys:
        if set(incoming.columns) != set(current.columns):
            raise ValueError(f"columns differ: {current.columns} and {incoming.columns}")
        incoming.select(*current.columns).write.mode("append").insertInto(name)
        return
    fresh = f"{name}__{uuid.uuid4().hex[:12]}"
    save_table(upsert(current, incoming, keys, order, by), fresh, keys, location=location)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE {name}__old")


def materialize(
    spark: SparkSession, sql: str, name: str, params: Sequence | Mapping | None = None, keys: Sequence[str] = (),
    mode: str = "errorifexists", location: str | None = None,
) -> DataFrame:
    """Run a parameterised query once, keep its rows as table ``name``, and return the table."""
    save_table(query_results(spark, sql, params, name=None), name, keys, mode, location)
    return spark.table(name)

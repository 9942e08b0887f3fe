"""Schema and policy checks as joins over table metadata. An empty result means "valid"."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..policy import TablePolicy, policies_of


def schema_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables missing from ``actual``, and columns whose name at a position differs.

    Both inputs are metadata rows (table, ordinal, column, ...). Types are not compared: the
    anonymized form of a column is a string. Tables only present in ``actual`` are accepted.
    """
    left = expected.select("table", "ordinal", F.col("column").alias("expected"))
    right = actual.select("table", "ordinal", F.col("column").alias("actual"))
    known = right.select("table").distinct()
    missing = left.join(known, "table", "left_anti").select("table").distinct()
    shared = left.join(known, "table", "left_semi").join(
        right.join(left.select("table").distinct(), "table", "left_semi"), ["table", "ordinal"], "full"
    )
    changed = shared.filter(~F.col("expected").eqNullSafe(F.col("actual")))
    return missing.select(
        "table",
        F.lit(None).cast("int").alias("ordinal"),
        F.lit(None).cast("string").alias("expected"),
        F.lit(None).cast("string").alias("actual"),
        F.lit("missing table").alias("problem"),
    ).unionByName(changed.withColumn("problem", F.lit("column differs")))


def policy_violations(metadata: DataFrame, tables: Mapping[str, TablePolicy]) -> DataFrame:
    """Policy entries that name a table or a column that does not exist."""
    named = metadata.sparkSession.createDataFrame(list(policies_of(tables)), "table string, column string")
    known = metadata.select("table").distinct()
    no_table = named.filter("column = ''").join(known, "table", "left_anti").withColumn(
        "problem", F.lit("table not found")
    )
    no_column = (
        named.filter("column <> ''")
        .join(known, "table", "left_semi")
        .join(metadata.select("table", "column"), ["table", "column"], "left_anti")
        .withColumn("problem", F.lit("column not found"))
    )
    return no_table.unionByName(no_column)

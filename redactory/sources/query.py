"""The rows of a parameterised SQL query as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def query_results(
    spark: SparkSession, sql: str, params: Sequence | Mapping | None = None, name: str | None = "results"
) -> DataFrame:
    """Run ``sql`` with positional (``?``) or named (``:name``) parameters and register the rows.

    The result stays a plan: anonymizing ``results`` pushes its filters and columns to the scan.
    """
    args = dict(params) if isinstance(params, Mapping) else list(params or [])
    result = spark.sql(sql, args=args) if args else spark.sql(sql)
    if name:
        result.createOrReplaceTempView(name)
    return result

"""Findings as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import Sql, column
from ..policy import Policy
from .detect import Recognizer, compile_recognizers, detect


def findings(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    recognizers: Policy | Sequence[Recognizer],
    language: str | None = None,
) -> DataFrame:
    """One row per span found in column ``name``: the key columns, entity, start, end, score, value.

    ``language`` names a column by which recognizers are routed row by row."""
    if isinstance(recognizers, Policy):
        enabled = recognizers.enabled
        recognizers = compile_recognizers(recognizers, by_language=language is not None) if enabled else []
    routed = column(language) if language else None
    return explode_spans(df, keys, detect(f"cast({column(name)} AS string)", recognizers, routed))


def explode_spans(df: DataFrame, keys: Sequence[str], spans: Sql) -> DataFrame:
    return df.select(*keys, F.expr(f"inline({spans})"))


def collect_spans(found: DataFrame, keys: Sequence[str], into: str = "spans") -> DataFrame:
    """The inverse: one row per key with its spans. A group holds the findings of one cell."""
    return found.groupBy(*keys).agg(
        F.sort_array(
            F.collect_list(F.struct("entity", "start", "end", "score", "value"))
        ).alias(into)
    )


def with_policy(found: DataFrame, policy: Policy) -> DataFrame:
    """Findings with the threshold and strategy of their entity.

    The policy has one row per entity and is compiled into the plan as a driver-side value, so
    broadcasting it is bounded by the policy itself.
    """
    rows = policy.frame(found.sparkSession).select("entity", "threshold", "strategy")
    return found.join(F.broadcast(rows), "entity", "left")


def count_by_entity(found: DataFrame, *by: str) -> DataFrame:
    """Findings per entity; partial aggregation leaves a few rows per task to shuffle."""
    return found.groupBy(*by, "entity").agg(F.count(F.lit(1)).alias("n_found"))


def cube_counts(found: DataFrame, *dims: str) -> DataFrame:
    """Counts for every combination of dimensions; NULL with its ``g_`` flag set means "all".

    The findings are counted at the finest level first: a cube multiplies its input by 2^dims.
    """
    finest = found.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    return finest.cube(*dims).agg(
        F.sum("n").alias("n_found"), *[F.grouping(d).cast("int").alias(f"g_{d}") for d in dims]
    )

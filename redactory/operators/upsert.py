"""Keyed upsert: the latest version of every key wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Which row of a key counts: the one that came last, or the one that is last in an order.
ARRIVAL, ORDER = "arrival", "order"


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the one that is last in ``order``; ``order`` should leave no ties.

    ``row_number() = 1`` is reduced to one row per key inside every map task before the shuffle
    (WindowGroupLimit), so a key that owns a third of the rows sends one row per task. A NULL in a
    key is equal to nothing: such rows all stay.
    """
    anonymous = reduce(or_, [F.col(k).isNull() for k in keys])
    df = df.withColumn("__row", F.when(anonymous, F.monotonically_increasing_id()))
    descending = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    rank = F.row_number().over(Window.partitionBy(*keys, "__row").orderBy(*descending))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank", "__row")


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = (), by: str = ARRIVAL
) -> DataFrame:
    """``existing`` with the rows of ``incoming`` replaced or added. By ``"arrival"``, incoming rows win over existing
    ones, and ``order`` decides between incoming rows of one key; by ``"order"``, the last row in ``order`` wins
    wherever it comes from, so a late row does not replace a newer one, and incoming rows win ties. Without ``keys``
    rows are appended. ``UpsertStore`` has the same two rules."""
    if set(existing.columns) != set(incoming.columns):
        raise ValueError(f"columns differ: {existing.columns} and {incoming.columns}")
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    ranking = ["__new", *order] if by == ARRIVAL else [*order, "__new"]
    merged = latest(both, keys, ranking) if keys else both
    return merged.select(*existing.columns)


def appendable(df: DataFrame, target: Sequence[str]) -> DataFrame:
    """The columns of ``df`` in the order of the target table; refuses any other set of columns."""
    if len(df.columns) != len(target) or set(df.columns) != set(target):
        raise ValueError(f"the table has {len(target)} columns {list(target)}, but got {df.columns}")
    return df.select(*target)

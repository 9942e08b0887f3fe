"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt out to shards and queries to blocks, both of bounded size; every shard meets every block
in one group. Inside a group the shard has one list per dimension, sorted by component. A query reads its lists
from their best ends in growing steps, scores every vector it meets by random access, and stops when the sum of
the components it has reached, weighted by the query, is below its k-th score: no vector that it has not met
can then take part, not even by a tie. The k best of all shards are merged per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import unique_ids

SHARD_ROWS = 4_096
BLOCK_ROWS = 1_024
#: Entries read from each list in the first step; doubled at every further one.
FIRST_DEPTH = 32
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def integer_matrix(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) as whole numbers; absent components count as 0. Python integers where doubles are not exact."""
    rows = np.zeros((len(vectors), width))
    for row, vector in zip(rows, vectors):
        row[: len(vector)] = np.floor(scale * np.asarray(vector, np.float64))
    return rows


def exact_in_doubles(a: np.ndarray, b: np.ndarray) -> bool:
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**52


class Lists:
    """One list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable")

    def search(self, query: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and places of the k best rows; ``own`` marks rows that take no part."""
        n = len(self.ids)
        used = np.flatnonzero(query != 0)
        met = own.copy()
        scores, places = self.rows[:0, 0], np.array([], np.int64)
        down = query[used] > 0
        at, step = 0, FIRST_DEPTH
        while at < n:
            to = min(at + step, n) if len(used) else n
            reach = np.concatenate(
                [self.order[n - to : n - at, used[down]].ravel(), self.order[at:to, used[~down]].ravel()]
            )
            new = np.unique(reach) if len(used) else np.arange(n)
            new = new[~met[new]]
            met[new] = True
            scores = np.concatenate([scores, self.rows[new] @ query])
            places = np.concatenate([places, new])
            best = np.lexsort((self.ids[places], -scores))[:k]
            scores, places = scores[best], places[best]
            deepest = np.where(down, n - to, to - 1)
            bound = (query[used] * self.rows[self.order[deepest, used], used]).sum()
            if len(scores) == k and bound < scores[-1]:
                break
            at, step = to, step * 2
        return scores, places


def search_group(candidates: pd.DataFrame, queries: pd.DataFrame, k: int, scale: int) -> Iterator[tuple]:
    width = int(max(candidates["vector"].map(len).max(), queries["vector"].map(len).max(), 1))
    rows = integer_matrix(candidates["vector"], width, scale)
    wanted = integer_matrix(queries["vector"], width, scale)
    if not exact_in_doubles(rows, wanted):
        rows, wanted = (np.array([[int(x) for x in row] for row in m], object) for m in (rows, wanted))
    lists = Lists(candidates["id"].to_numpy(), rows)
    marks = candidates["mark"].to_numpy()
    for query_id, mark, query in zip(queries["id"], queries["mark"], wanted):
        own = (lists.ids == query_id) & (marks == mark)
        scores, places = lists.search(query, own, k)
        for score, place in zip(scores, places):
            yield query_id, mark, lists.ids[place], min(max(int(score), LONG_MIN), LONG_MAX)


def top_k(
    df: DataFrame, k: int, is_query: str, vector: str = "embedding", key: str = "vec_id", scale: int = 1024
) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each row that fulfils ``is_query`` (SQL).

    Components become floor(scale * x). Gives ``query_id, rank (from 1), <key>, score``, ties to the smaller
    key; fewer rows if there are fewer candidates. Rows whose vector is null or holds null or non-finite
    components take no part, nor do rows with a null key. Rows that repeat key and vector count once; rows that
    repeat a key with another vector are candidates and queries of their own. Vectors of unequal lengths are
    compared as if filled up with zeros; an empty vector scores 0. Scores beyond a long are set to its limits.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.expr(is_query).alias("asked")).where(
        F.col("id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    rows = rows.withColumn("mark", F.xxhash64("vector"))
    if not unique_ids(df, key):
        rows = rows.dropDuplicates(["id", "mark"])
    n, asked = rows.agg(F.count("*"), F.count_if("asked")).first()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(asked / BLOCK_ROWS))
    number = F.xxhash64("id", "mark")
    candidates = rows.select("id", "mark", "vector", F.pmod(number, F.lit(shards)).alias("shard")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    queries = (
        rows.where("asked")
        .select("id", "mark", "vector", F.pmod(number, F.lit(blocks)).alias("block"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = search_group(left, right, k, scale) if len(left) and len(right) else []
        return pd.DataFrame(found, columns=["query_id", "mark", "id", "score"])

    on = [F.col("shard").cast("long"), F.col("block").cast("long")]
    found = (
        candidates.groupBy(*on)
        .cogroup(queries.groupBy(*on))
        .applyInPandas(run, "query_id long, mark long, id long, score long")
    )
    best = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")

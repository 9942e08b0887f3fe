"""Exact ranked search of terms by presence masks.

Every document becomes the terms of the query set that it holds, with their frequencies; a first pass counts how many
documents hold a term. In the second pass a task takes its documents in batches. For each item, a bitmap over the
documents of every term gives each document its mask of matched terms; documents of one mask form a group. A mask
cannot score more than the sum of what its terms contribute at most in the batch, so distinct masks are taken by
descending maximum, and the item is finished with the batch as soon as no mask left can reach its k-th score so far.
Each task sends k documents per item; the best of all tasks are ranked per item.

The query set is dealt out to blocks of bounded size by a hash; a block meets all documents in a pass of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunked import to_arrow
from .common import map_texts, text_or_empty, written

#: Bytes of different terms of the items that are searched together; an item is never divided.
BLOCK_BYTES = 4 << 20
#: Documents whose masks are grouped together.
BATCH = 2_048
#: The largest product of counts that 64 bits hold.
LARGEST = 2**63 - 1
#: Separators become blanks, A-Z lower case; digits, letters and all bytes of other characters stay.
SPLIT = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if chr(b).isalnum() and b < 0x80 or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII digits and letters and of all other characters beyond ASCII, A-Z lowered."""
    return text.encode().translate(SPLIT).split()


class Item:
    """One query: its number and its different terms as places in the vocabulary, heaviest first."""

    def __init__(self, number: int, terms: Sequence[int]) -> None:
        self.number, self.terms = number, np.array(terms, np.int64)
        self.best: list[tuple[int, tuple, object]] = []  # (-score, sortable id, id), ascending, k at most

    def least(self, k: int) -> int:
        """The score that a document must reach to matter."""
        return -self.best[-1][0] if len(self.best) == k else 1

    def search(self, contributions: np.ndarray, bounds: np.ndarray, ids: list, k: int) -> None:
        """Take over the best of a batch. ``contributions`` has a row per term of the vocabulary and a column per
        document, 0 where a term is absent; ``bounds`` is the maximum of each row."""
        own = contributions[self.terms]
        masks = np.packbits(own > 0, axis=0)  # a column per document
        order = np.lexsort(masks)
        opens = np.ones(len(order), bool)
        opens[1:] = (masks[:, order[1:]] != masks[:, order[:-1]]).any(axis=0)
        firsts = np.flatnonzero(opens)
        most = bounds[self.terms] @ (own[:, order[firsts]] > 0)  # per distinct mask
        ends = np.append(firsts[1:], len(order))
        for group in np.argsort(-most, kind="stable"):
            if most[group] < self.least(k):
                break
            members = order[firsts[group] : ends[group]]
            scores = own[:, members].sum(axis=0)
            for at in np.flatnonzero(scores >= self.least(k)):
                self.take(int(scores[at]), ids[members[at]], k)

    def take(self, score: int, key: object, k: int) -> None:
        entry = (-score, (key is not None, key), key)
        if len(self.best) == k:
            if entry[:2] >= self.best[-1][:2]:
                return
            self.best.pop()
        self.best.append(entry)
        self.best.sort(key=lambda e: e[:2])


def contributions_of(
    batch: pa.RecordBatch, weights: np.ndarray, documents: int, length: int
) -> np.ndarray:
    """What every term adds to the score of every document of the batch: terms in rows, documents in columns."""
    terms, counts, n = batch.column("terms"), batch.column("counts"), batch.column("n").to_numpy().astype(object)
    norm = np.array([10 + 90 * x * documents // max(length, 1) for x in n], object)
    owner = np.repeat(np.arange(len(n)), np.diff(terms.offsets.to_numpy()))
    place, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
    small = max(int(tf.max(initial=0)) * 10**9, int(norm.max(initial=0)) * 8 + int(tf.max(initial=0)) * 1000) <= LARGEST
    tf, norm = (tf, norm.astype(np.int64)) if small else (tf.astype(object), norm)
    added = weights[place] * ((10**9 * tf) // (1000 * tf + 8 * norm[owner]))
    found = np.zeros((len(weights), len(n)), np.int64)
    found[place, owner] = added.astype(np.int64)
    return found


def matched(df: DataFrame, vocabulary: Sequence[bytes], text: str, key: str) -> DataFrame:
    """``_key, n, terms, counts``: all terms of a document counted, those of the vocabulary listed by their place."""

    def run(texts: Iterator[list[str]]) -> Iterator[list]:
        place = {term: i for i, term in enumerate(vocabulary)}
        for batch in texts:
            sizes, owners, places = [], [], []
            for i, value in enumerate(batch):
                split = terms_of(value)
                sizes.append(len(split))
                own = np.array([p for p in map(place.get, split) if p is not None], np.int64)
                places.append(own)
                owners.append(np.full(len(own), i))
            both = np.concatenate(owners) * len(vocabulary) + np.concatenate(places)
            pairs, counts = np.unique(both, return_counts=True)
            ends = np.searchsorted(pairs // max(len(vocabulary), 1), np.arange(len(batch) + 1))
            lists = lambda values: pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(values.astype(np.int64))
            )
            yield [sizes, lists(pairs % max(len(vocabulary), 1)), lists(counts)]

    rows = df.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text"))
    return map_texts(rows, ["_key"], "_text", run, "n long, terms array<long>, counts array<long>")


def search_block(
    df: DataFrame, queries: Sequence[tuple[int, Sequence[bytes]]], k: int, text: str, key: str
) -> DataFrame:
    """``_item, _key, score``: per task that has any, the k best documents of each query (number, different terms)."""
    vocabulary = sorted({term for _, terms in queries for term in terms})
    place = {term: i for i, term in enumerate(vocabulary)}
    found = written(matched(df, vocabulary, text, key), "matched")
    documents, length = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term
    frequency = {row["term"]: row["count"] for row in counted}
    weights = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(i, 0) + 1))) for i in range(len(vocabulary))],
        np.int64,
    )
    asked = [(number, [place[term] for term in terms]) for number, terms in queries]
    schema = T.StructType().add("_item", "long").add("_key", found.schema["_key"].dataType).add("score", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [Item(number, terms) for number, terms in asked]
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH):
                part = batch.slice(first, BATCH)
                contributions = contributions_of(part, weights, documents, length)
                bounds, ids = contributions.max(axis=1, initial=0), part.column("_key").to_pylist()
                for item in items:
                    item.search(contributions, bounds, ids, k)
        best = [(item.number, key, -score) for item in items for score, _, key in item.best]
        columns = list(zip(*best)) or [[], [], []]
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns)), schema=to_arrow(schema))

    return found.where("n > 0 AND size(terms) > 0").mapInArrow(run, schema)


def ranked_search(
    df: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item_key: str = "item_id",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_key, rank, key, score``: the k best documents of every row of ``items``, of those that score above 0.

    Terms are maximal runs of ASCII digits and letters and of all characters beyond ASCII, A-Z lowered; null texts have
    none. With N documents that have a term, L terms of theirs and df documents that hold a term, it weighs
    ``floor(1000 ln((2 N + 2) / (2 df + 1)))``; in a document of n terms that holds it tf times it adds its weight times
    ``10^9 tf div (1000 tf + 8 (10 + 90 n N div L))``. Equal scores go by ascending key, null first. Keys must sort in
    Python as in Spark (whole and decimal numbers, strings, dates); they may be null or repeated, and repeated rows
    are documents of their own. So are repeated rows of ``items`` queries of their own, with the same item key. Items
    without terms or hits give no row; other columns are not looked at; a text may be of any length; an empty table on
    either side gives an empty result.

    Items are collected block by block, ``block_bytes`` of different terms together at most, or one longer item.
    """
    wanted = items.select(F.col(item_key).alias("_id"), text_or_empty(text).alias("_text"))

    def split(texts: Iterator[list[str]]) -> Iterator[list]:
        for batch in texts:
            yield [[sorted(set(terms_of(value))) for value in batch]]

    wanted = map_texts(wanted, ["_id"], "_text", split, "terms array<binary>").where("size(terms) > 0")
    weight = F.aggregate("terms", F.lit(16).cast("long"), lambda total, term: total + 16 + F.octet_length(term))
    wanted = written(wanted.withColumn("bytes", weight), "items").withColumn("_item", F.monotonically_increasing_id())
    wanted = written(wanted, "numbered-items")
    whole, rows = wanted.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    n_blocks = max(1, math.ceil(2 * whole / block_bytes)) if whole > block_bytes else 1
    block = F.pmod(F.xxhash64("_item"), F.lit(n_blocks))
    best = None
    for number in range(n_blocks):
        own = wanted.where(block == number).select("_item", "terms").collect()
        if own or best is None:
            found = search_block(df, [(row["_item"], list(map(bytes, row["terms"]))) for row in own], k, text, key)
            found = written(found, "best") if n_blocks > 1 else found
            best = found if best is None else best.unionByName(found)
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("_key").asc_nulls_first())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = ranked.join(wanted.select("_item", "_id"), "_item")
    return named.select(F.col("_id").alias(item_key), "rank", F.col("_key").alias(key), "score")

"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions. A decision has one node per context length, from no byte to ``depth`` bytes
before; a node counts its zeros and ones over all training texts. Its own estimate is the one of Krichevsky and
Trofimov; the weighted probability of a node is half its own estimate and half the product of its children, so all
depths are mixed by how well they have coded the corpus. What a text costs is the sum of its decisions under the
finished tree, which does not change while texts are scored.

The tree grows with the corpus. Its leaves are the strings of ``depth + 1`` bytes that occur, counted by Spark. Strings
whose contexts end in the same ``TOP`` bytes, at most 256 ** (depth + 1 - TOP) whatever the corpus, meet in one group,
which finds all levels below; the levels above have at most 256 ** (TOP - 1) contexts, of UTF-8 a small part of
that, and are finished on the driver. Texts are scored chunk by chunk from the strings that occur in them (see
``chunked``), so no task holds the tree.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunked import answer, by_chunk, in_chunks, lowered
from .common import chunks, text_or_empty, written

#: Bytes of context.
DEPTH = 5
#: Levels of the tree above the groups: what shares a context of so many bytes stays together.
TOP = 3
#: Strings in a group, about.
GROUP = 50_000
#: Bytes of text that ask for their values together.
CHUNK = 32 << 20
#: Bytes of text of a chunk that are scored together.
PIECE = 4 << 20
#: No byte of UTF-8: stands before and after every text, so that the end of a text is predicted as well.
EDGE = 0xFF
#: Places of text that are looked at together.
BLOCK = 1 << 20
log_gamma = np.frompyfunc(math.lgamma, 1, 1)


def joined(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with ``depth`` edges before, between and after them, and where each starts and ends (its end is the
    first edge after it, which is predicted too)."""
    edge = bytes([EDGE]) * depth
    data = np.frombuffer(edge + edge.join(texts) + edge, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = depth + np.cumsum(sizes + depth) - (sizes + depth)
    return data, starts, starts + sizes


def strings(data: np.ndarray, first: int, last: int, depth: int) -> np.ndarray:
    """For places ``first`` to ``last``, excluded: the byte there after its context, the nearest byte highest."""
    found = data[first:last].astype(np.int64)
    for back in range(1, depth + 1):
        found |= data[first - back : last - back].astype(np.int64) << (8 * (depth + 1 - back))
    return found


def blocks(texts: list[bytes], depth: int, limit: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings of all places of the texts, block by block, with the number of the text of each place."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        held.append((i, text))
        size += len(text) + depth
        if size >= limit or i == len(texts) - 1:
            data, starts, ends = joined([t for _, t in held], depth)
            for first in range(depth, len(data), limit):
                last = min(first + limit, len(data))
                owner = np.searchsorted(starts, np.arange(first, last), "right") - 1
                inside = np.arange(first, last) <= ends[owner]
                yield strings(data, first, last, depth)[inside], owner[inside] + held[0][0]
            held, size = [], 0


def uses(texts: DataFrame, depth: int) -> DataFrame:
    """Per chunk, each string and each word once, with its occurrences in texts that are learned from: ``_chunk,
    string, word, n``. The end of a text is the empty word."""
    schema = "_chunk long, string long, word binary, n long"
    names = ["_chunk", "string", "word", "n"]

    def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        values, at = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
        weights = np.concatenate([w for _, w in found])
        return [(values, np.bincount(at, weights, len(values)).astype(np.int64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, own in by_chunk(batches):
            found: list[tuple[np.ndarray, np.ndarray]] = []
            words: Counter[bytes] = Counter()
            asked: set[bytes] = set()
            for batch in own:
                held = np.array(batch.column("_held").to_pylist(), bool)
                whole = [t.encode() for t in batch.column("_text").to_pylist()]
                for places, owner in blocks(whole, depth):
                    learned = ~held[owner]
                    found.append(np.unique(places[learned], return_counts=True))
                    rest = np.unique(places[~learned])
                    found.append((rest, np.zeros(len(rest), np.int64)))
                    if len(found) > 12:
                        found = merged(found)
                for text, out in zip(whole, held):
                    split = text.split()
                    (asked if out else words).update(split)
                    (asked if out else words).update([b""])
            for values, counts in merged(found):
                of = pa.array(np.full(len(values), number))
                yield pa.RecordBatch.from_arrays(
                    [of, pa.array(values), pa.nulls(len(values), pa.binary()), pa.array(counts)], names=names
                )
            listed = [*words, *(asked - words.keys())]
            counts = [words[w] for w in listed]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(listed), number)),
                    pa.nulls(len(listed), pa.int64()),
                    pa.array(listed, pa.binary()),
                    pa.array(counts, pa.int64()),
                ],
                names=names,
            )

    return texts.select("_chunk", "_held", "_text").mapInArrow(run, schema)


@dataclass
class Level:
    """Nodes of one context length: their numbers (context << 8 | bits of the byte so far, with a leading 1), zeros
    and ones, and the logarithms of the product of the children and of the own estimate."""

    ids: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    below: np.ndarray | None

    def __post_init__(self) -> None:
        self.own = (
            log_gamma(self.zeros + 0.5) + log_gamma(self.ones + 0.5) - log_gamma(self.zeros + self.ones + 1.0)
        ).astype(float) - 2 * math.lgamma(0.5)

    def weighted(self) -> np.ndarray:
        if self.below is None:
            return self.own
        return math.log(0.5) + np.logaddexp(self.own, self.below)

    def mixed(self, at: np.ndarray, bit: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """The probability of ``bit`` at the nodes ``at``, from that of the node one byte deeper."""
        own = (np.where(bit, self.ones[at], self.zeros[at]) + 0.5) / (self.zeros[at] + self.ones[at] + 1.0)
        if deeper is None:
            return own
        share = 1 / (1 + np.exp(np.clip(self.below[at] - self.own[at], -700, 700)))
        return share * own + (1 - share) * deeper

    def parent(self) -> Level:
        """The level of one byte less. The nearest byte is highest in a context, so the farthest is cut off."""
        ids, at = np.unique(self.ids >> 16 << 8 | self.ids & 0xFF, return_inverse=True)
        total = lambda values: np.bincount(at, values, len(ids))
        return Level(ids, total(self.zeros), total(self.ones), total(self.weighted()))


def decisions(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The eight decisions of the last byte of each string: context, node in the byte, bit; a row per decision."""
    byte = values & 0xFF
    steps = np.arange(8)[:, None]
    return values >> 8, 1 << steps | byte >> (8 - steps), byte >> (7 - steps) & 1


def deepest(values: np.ndarray, counts: np.ndarray) -> Level:
    context, node, bit = decisions(values)
    ids, at = np.unique((context << 8 | node).ravel(), return_inverse=True)
    weight = np.tile(counts.astype(float), 8)
    ones = np.bincount(at, weight * bit.ravel(), len(ids))
    return Level(ids, np.bincount(at, weight, len(ids)) - ones, ones, None)


def levels(values: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[Level]:
    """Levels ``depth`` to ``top`` of the part of the tree that these strings make up."""
    found = [deepest(values, counts)]
    for _ in range(depth - top):
        found.append(found[-1].parent())
    return found


def log_probabilities(values: np.ndarray, found: list[Level], depth: int) -> np.ndarray:
    """log10 of the probability of the last byte of each string after its context, from all ``depth + 1`` levels."""
    context, node, bit = decisions(values)
    chance = None
    for back, level in enumerate(found):
        ids = (context >> (8 * back)) << 8 | node
        chance = level.mixed(np.searchsorted(level.ids, ids), bit, chance)
    return np.log10(chance).sum(axis=0)


def model(counts: DataFrame, depth: int) -> DataFrame:
    """``string, value``: log10 of the probability of every string's last byte, from ``string, n``.

    ``counts`` is read three times. Strings that were never learned, with ``n`` 0, get what their context gives them.
    """
    top = min(TOP, depth)
    n_groups = math.ceil(counts.count() / GROUP) + 1
    group = F.pmod(F.xxhash64(F.shiftright("string", 8 * (depth - top) + 8)), F.lit(n_groups))
    grouped = counts.withColumn("_group", group).groupBy("_group")

    def part(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values = table.column("string").to_numpy()
        order = np.argsort(values)
        return values[order], table.column("n").to_numpy()[order]

    def summed(key: tuple, table: pa.Table) -> pa.Table:
        level = levels(*part(table), depth, top)[-1].parent()
        return pa.table([level.ids, level.zeros, level.ones, level.below], names=["id", "zeros", "ones", "below"])

    sums = grouped.applyInArrow(summed, "id long, zeros double, ones double, below double")
    sums = sums.groupBy("id").agg(*[F.sum(name).alias(name) for name in ("zeros", "ones", "below")])
    rows = sums.toArrow().sort_by("id")  # 256 ** (top - 1) contexts at most
    above = [Level(*[rows.column(name).to_numpy() for name in rows.column_names])]
    for _ in range(top - 1):
        above.append(above[-1].parent())

    def predicted(key: tuple, table: pa.Table) -> pa.Table:
        values, n = part(table)
        found = levels(values, n, depth, top)
        return pa.table([values, log_probabilities(values, found + above, depth)], names=["string", "value"])

    return grouped.applyInArrow(predicted, "string long, value double")


def score_texts(
    df: DataFrame, held_out: Column, depth: int = DEPTH, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``df``: ``key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Texts in which ``held_out`` is not true are learned from, all of them; every text is scored as a whole, with A-Z
    lowered and with its end. ``score`` is log10 of its probability under the context tree, ``bits_per_byte`` its code
    length over its bytes and its end. ``base_score`` is that of a model of single words (``n_tokens`` with the end,
    ``n_known`` of them learned). Null texts are empty and cost their end. Keys may be null or repeated, other columns
    are not looked at; a text may be of any length, and is then a chunk of its own. Repeated texts count as often as
    they occur. Without training texts every decision is even. An empty table gives an empty one.
    """
    if not 1 <= depth <= 6:
        raise ValueError("a context has one to six bytes")
    held = F.coalesce(held_out, F.lit(False)).alias("_held")
    rows = df.select(F.col(key).alias("_key"), held, lowered(text_or_empty(text)).alias("_text"))
    texts = in_chunks(rows, "_text", CHUNK)
    asked = written(uses(texts, depth), "uses")
    words = asked.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    total, different = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    counts = written(asked.where("string IS NOT NULL").groupBy("string").agg(F.sum("n").alias("n")), "strings")
    known = asked.where("word IS NOT NULL").select("_chunk", "word").join(words, "word")
    costs = asked.where("string IS NOT NULL").select("_chunk", "string").join(model(counts, depth), "string")
    answers = known.unionByName(costs, allowMissingColumns=True)
    field = texts.schema["_key"].dataType
    schema = T.StructType().add("_key", field).add("held_out", "boolean")
    for name, kind in {
        "n_tokens": "long", "n_known": "long", "train_tokens": "long",
        "base_score": "double", "score": "double", "bits_per_byte": "double",
    }.items():
        schema = schema.add(name, kind)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        of_word = right.filter(pc.is_valid(right.column("word"))).select(["word", "n"]).combine_chunks()
        words, seen = pc.unique(of_word.column("word")), of_word.column("n").to_numpy()  # a cut chunk asks twice
        seen = seen[pc.index_in(words, value_set=of_word.column("word")).to_numpy()]
        of_string = right.filter(pc.is_valid(right.column("string")))
        values, at = np.unique(of_string.column("string").to_numpy(), return_index=True)
        place, cost = pd.Index(values), of_string.column("value").to_numpy()[at]
        log_chance = lambda n: np.log10((n + 0.1) / (total + 0.1 * (different + 1)))
        parts = []
        for batch in chunks(iter(left.to_batches()), "_text", PIECE):
            whole = [t.encode() for t in batch.column("_text").to_pylist()]
            score = np.zeros(len(whole))
            for places, owner in blocks(whole, depth):
                score += np.bincount(owner, cost[place.get_indexer(places)], len(whole))
            split = [[*text.split(), b""] for text in whole]
            tokens = np.array([len(own) for own in split], np.int64)
            listed = pa.array([word for own in split for word in own], pa.binary())
            n, of = seen[pc.index_in(listed, value_set=words).to_numpy()], np.repeat(np.arange(len(whole)), tokens)
            size = np.array([len(t) + 1 for t in whole])
            columns = {
                "n_tokens": tokens,
                "n_known": np.bincount(of, n > 0, len(whole)).astype(np.int64),
                "train_tokens": np.full(len(whole), total),
                "base_score": np.bincount(of, log_chance(n), len(whole)),
                "score": score,
                "bits_per_byte": -score / math.log10(2) / size,
            }
            kept = [batch.column("_key"), batch.column("_held")]
            parts.append(pa.RecordBatch.from_arrays([*kept, *map(pa.array, columns.values())], names=schema.names))
        return pa.Table.from_batches(parts)

    return answer(texts, answers, scored, schema).withColumnRenamed("_key", key)

"""Near-duplicates by SimHash, linked by the generalised pigeonhole principle.

Bits of the fingerprints are grouped into parts so that correlated bits lie together. If parts have thresholds
t_i that add up to (radius - parts + 1), two fingerprints within the radius agree in some part up to t_i bits;
the thresholds are chosen, unequal and down to -1 (part not used), by dynamic programming over the candidates
that they would give on the counts of the whole table. A part that may differ in t bits is probed by leaving
out every choice of t of its bits. Rows that share a probe form a bucket, and a bucket is verified in numpy. A
bucket of more than ``BUCKET`` different fingerprints is not: its rows are probed again by parts of the
bits that they do not share yet, until buckets are small or all that is left to differ is within the radius.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, text_or_empty, written
from .components import components

BITS = 64
SEED = 42
#: Different fingerprints that are compared with each other in one place.
BUCKET = 512
PARTS = 3


def fingerprint(text: str, words_each: int) -> int:
    """64 bits as a signed number: bit b is set if it is set in over half of the hashes of the shingles.

    Words are what lies between ASCII white space, A-Z lower-cased; a shingle are ``words_each`` words joined by
    blanks, repeats included; fewer words are one shingle, no word gives 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = (ends - [len(word) for word in words]).tolist()
    ends = ends.tolist()[words_each - 1 :] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, words_each: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, fp``: one row per row of ``df``; null texts count as empty. No shuffle."""

    def run(texts: Iterator[list[str]]) -> Iterator[list[list[int]]]:
        for batch in texts:
            yield [[fingerprint(text, words_each) for text in batch]]

    return map_texts(df, [key], text, run, "fp long")


# --- parts and thresholds ---


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bits of each pair set: 64 x 64 sums over the whole table."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS))
        for frame in frames:
            bits = as_bits(frame["fp"].to_numpy()).astype(np.float32)
            total += bits.T @ bits
            yield pd.DataFrame({"i": [-1], "j": [-1], "n": [len(bits)]})
        i, j = np.triu_indices(BITS)
        yield pd.DataFrame({"i": i, "j": j, "n": total[i, j].astype(np.int64)})

    sums = distinct.select("fp").mapInPandas(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both, n = np.zeros((BITS, BITS)), 0
    for i, j, value in sums.collect():  # 2,081 rows, whatever the table
        if i < 0:
            n = value
        else:
            both[i, j] = both[j, i] = value
    return n, both


def as_bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(n: int, both: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Bits in parts of nearly equal size; each part grows by the bit most correlated with it."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(share * (1 - share), share * (1 - share)))
    related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.where(spread > 0, spread, 1)
    np.fill_diagonal(related, 0)
    left, found = set(range(BITS)), []
    for number in range(parts):
        size = (BITS - sum(map(len, found))) // (parts - number)
        part = [max(left, key=lambda b: (related[b, sorted(left)].sum(), -b))]
        left -= {part[0]}
        while len(part) < size:
            part.append(max(left, key=lambda b: (related[b, part].sum(), -b)))
            left.remove(part[-1])
        found.append(sorted(part))
    return found


def candidate_costs(distinct: DataFrame, n: int, both: np.ndarray, parts: list[list[int]], radius: int) -> list[list[float]]:
    """For each part, the cost of thresholds -1, 0 .. radius: estimated candidates, and rows that are probed.

    Pairs that agree in a part are counted over the whole table; pairs that differ there in t bits follow from
    them by the shares of each bit.
    """
    counts = [
        distinct.select(F.lit(i).alias("part"), F.col("fp").bitwiseAND(signed(mask_of(part))).alias("value"))
        for i, part in enumerate(parts)
    ]
    every = counts[0]
    for more in counts[1:]:
        every = every.union(more)
    sizes = every.groupBy("part", "value").agg(F.count("*").alias("n")).groupBy("part")
    pairs = {r["part"]: r["pairs"] for r in sizes.agg(F.sum(F.expr("n * (n - 1.0D) / 2")).alias("pairs")).collect()}
    share = np.diag(both) / max(n, 1)
    agree = np.clip(share**2 + (1 - share) ** 2, 1e-9, 1)
    costs = []
    for i, part in enumerate(parts):
        odds = ((1 - agree) / agree)[part]
        within, ways = 1.0, 1
        cost = [0.0]
        for t in range(radius + 1):
            if t:
                within += sum(np.prod(odds[list(c)]) for c in itertools.combinations(range(len(part)), t))
                ways = len(list(itertools.combinations(part, t)))
            cost.append(float(pairs.get(i, 0) or 0) * within + n * ways)
        costs.append(cost)
    return costs


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds of least cost that add up to ``total``, by dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for index, price in enumerate(cost):
                state = (spent + price, [*chosen, index - 1])
                if used + index - 1 not in following or state < following[used + index - 1]:
                    following[used + index - 1] = state
        best = following
    return best[total][1]


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def probes(parts: list[list[int]], thresholds: list[int]) -> list[int]:
    """Masks of the bits that must agree."""
    return [
        mask_of(part) & ~mask_of(list(out))
        for part, t in zip(parts, thresholds)
        if t >= 0
        for out in itertools.combinations(part, t)
    ]


def refined(mask: int, radius: int, order: list[int]) -> list[int]:
    """Masks for a bucket that agrees in ``mask``: of (radius + 1) groups of the other bits one must agree too."""
    rest = [b for b in order if not mask >> b & 1]
    return [mask | mask_of(rest[i :: radius + 1]) for i in range(radius + 1)]


# --- links ---


def probe_rows(df: DataFrame, masks: list[int]) -> DataFrame:
    every = F.array(*[F.lit(signed(m)) for m in masks])
    return df.select("fp", F.explode(every).alias("mask")).withColumn("value", F.expr("fp & mask"))


def verified(rows: DataFrame, radius: int) -> DataFrame:
    """``u, v``: links of buckets (``mask, value``) of bounded size, reduced to stars within each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                table = [batch.column(c).to_numpy() for c in ("mask", "value", "fp")]
                held = table if held is None else [np.concatenate(x) for x in zip(held, table)]
                last = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) if len(held[0]) else np.zeros(0, bool)
                whole, held = [x[~last] for x in held], [x[last] for x in held]
            else:
                whole = held if held is not None else [np.zeros(0, np.int64)] * 3
            u, v = stars(*whole, radius)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    dealt = rows.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return dealt.select("mask", "value", "fp").mapInArrow(run, "u long, v long")


def stars(mask: np.ndarray, value: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Compares rows of one bucket; of each set of rows that hang together all but the smallest link to it."""
    nodes, at = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    for step in range(1, len(fp)):
        same = np.flatnonzero((mask[step:] == mask[:-step]) & (value[step:] == value[:-step]))
        if not len(same):
            break
        near = same[np.bitwise_count((fp[same] ^ fp[same + step]).view(np.uint64)) <= radius]
        a, b = at[near], at[near + step]
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(la[apart], lb[apart]), np.minimum(la[apart], lb[apart]))
            while not np.array_equal(label, label[label]):
                label = label[label]
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """``u, v``: links that connect exactly the different fingerprints that chains of links connect."""
    n, both = bit_statistics(distinct)
    parts = correlated_parts(n, both)
    thresholds = allocate(candidate_costs(distinct, n, both, parts, radius), radius - len(parts) + 1)
    order = [b for part in parts for b in part]
    rows = probe_rows(distinct, probes(parts, thresholds))
    found = None
    while True:
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("n"), F.min("fp").alias("first")).where("n > 1")
        sizes = written(sizes, "buckets")
        hot = {r["mask"] % (1 << BITS) for r in sizes.where(F.col("n") > BUCKET).select("mask").distinct().collect()}
        new = verified(rows.join(sizes.where(F.col("n") <= BUCKET), ["mask", "value"]), radius)
        open_ = sorted(m for m in hot if BITS - m.bit_count() > radius)
        if len(open_) < len(hot):  # whatever differs in these buckets is within the radius
            done = [signed(m) for m in hot.difference(open_)]
            near = rows.join(sizes.where((F.col("n") > BUCKET) & F.col("mask").isin(done)), ["mask", "value"])
            new = new.union(near.where("fp <> first").select(F.col("fp").alias("u"), F.col("first").alias("v")))
        found = new if found is None else found.union(new)
        if not open_:
            return found
        large = rows.join(sizes.where(F.col("n") > BUCKET).select("mask", "value"), ["mask", "value"], "left_semi")
        again = [probe_rows(large.where(F.col("mask") == signed(m)), refined(m, radius, order)) for m in open_]
        rows = again[0]
        for more in again[1:]:
            rows = rows.union(more)
        rows = written(rows.distinct(), "probes")


def near_duplicates(
    df: DataFrame, radius: int = 2, words_each: int = 5, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key, fp, fingerprint (16 hex digits), component_id`` for every row of ``df``.

    Fingerprints link if ``radius`` bits or fewer differ; ``component_id`` is the smallest key of all rows that
    links reach, the row itself included. Null texts count as empty: fingerprint 0, linked like any other. Rows
    may repeat keys; null keys are passed over as component ids unless a component has no other. Equal
    fingerprints are one node, so copies are never paired. An empty table gives no rows.
    """
    prints = written(fingerprints(df, words_each, text, key), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    roots = components(links(distinct, radius))
    nodes = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    nodes = written(nodes.select("fp", "first", F.coalesce("root", "fp").alias("root")), "nodes")
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = nodes.join(smallest, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(labels, "fp").select(key, "fp", digits, "component_id")

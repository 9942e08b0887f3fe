"""Token counts by rank-synchronous merging of ragged arrays.

Pre-tokens of a batch lie one after the other in one numpy array of symbols. In every round each pre-token
finds the lowest rank among its neighbouring pairs and merges all places where that pair occurs, all
pre-tokens at once; a pre-token without a known pair is finished and counts its surviving symbols. Merging
all places of a pair at once equals merging them one by one, because a rank file in which every merge comes
after the merges of its parts (checked when it is read) cannot make a new pair of lower rank.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator, Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Words of which a worker keeps the counts; beyond, it starts anew.
CACHE = 400_000
#: Pre-tokens longer than this (bytes) are merged alone, by places grouped by rank.
LONG = 512
NONE = np.iinfo(np.int64).max
#: Code points for which the classes of the two regex libraries were compared and are equal; a text with any
#: other is split by the tokenizer's own splitter.
UNUSUAL = regex.compile(
    r"[^\u0000-\u052f\u2000-\u206f\u20a0-\u22ff\u3000-\u4dbf\u4e00-\u9fef\uac00-\ud7a3]"
)


class MergeTable:
    """Pairs of symbols, their ranks and what they merge into, as sorted arrays."""

    def __init__(self, path: str, pattern: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE file without normalizer is needed")
        if spec["pre_tokenizer"]["add_prefix_space"] or model["dropout"] or model["ignore_merges"]:
            raise ValueError("prefix spaces, dropout and ignored merges are not supported")
        self.shift = max(vocab.values()).bit_length()
        made = dict.fromkeys(byte_symbols(), -1)
        keys, into = [], []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if left not in made or right not in made or left + right in made:
                raise ValueError("merges must follow the merges of their parts")
            made[left + right] = rank
            keys.append(vocab[left] << self.shift | vocab[right])
            into.append(vocab[left + right])
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = order.astype(np.int64)
        self.into = np.array(into, np.int64)  # by rank
        self.start = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        plain = [t for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if plain:
            raise ValueError("added tokens that strip or normalize are not supported")
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.pattern = regex.compile(pattern)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << self.shift | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if UNUSUAL.search(text):
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.pattern.findall(text)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def count_symbols(words: Sequence[bytes], table: MergeTable) -> np.ndarray:
    """Symbols that survive in each word; words must not be empty."""
    counts = np.zeros(len(words), np.int64)
    long = [i for i, word in enumerate(words) if len(word) > LONG]
    for i in long:
        counts[i] = count_long(words[i], table)
    rest = [i for i, word in enumerate(words) if len(word) <= LONG] if long else range(len(words))
    if not len(rest):
        return counts
    index = np.array(rest, np.int64)
    lengths = np.array([len(words[i]) for i in rest], np.int64)
    symbols = table.start[np.frombuffer(b"".join(words[i] for i in rest) if long else b"".join(words), np.uint8)]
    while len(index):
        starts = np.cumsum(lengths) - lengths
        ranks = np.full(len(symbols), NONE)
        ranks[:-1] = table.pair_ranks(symbols[:-1], symbols[1:])
        ranks[starts + lengths - 1] = NONE
        lowest = np.minimum.reduceat(ranks, starts)
        open_ = lowest < NONE
        counts[index[~open_]] = lengths[~open_]
        inside = np.repeat(open_, lengths)
        symbols, ranks, lowest = symbols[inside], ranks[inside], lowest[open_]
        index, lengths = index[open_], lengths[open_]
        if not len(index):
            break
        here = first_of_overlaps(ranks == np.repeat(lowest, lengths))
        symbols[here] = table.into[ranks[here]]
        stay = np.ones(len(symbols), bool)
        stay[here + 1] = False
        starts = np.cumsum(lengths) - lengths
        lengths = np.add.reduceat(stay.astype(np.int64), starts)
        symbols = symbols[stay]
    return counts


def first_of_overlaps(hit: np.ndarray) -> np.ndarray:
    """Places of the hits; of pairs that overlap (a a a), every second counts, from the left."""
    at = np.flatnonzero(hit)
    if len(at) < 2:
        return at
    fresh = np.ones(len(at), bool)
    fresh[1:] = at[1:] != at[:-1] + 1
    run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - run) % 2 == 0]


def count_long(word: bytes, table: MergeTable) -> int:
    """The same rounds for one long word: places wait in a list for their rank, so a round touches only its own."""
    symbols = table.start[np.frombuffer(word, np.uint8)].copy()
    n = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    waiting: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def wait(places: np.ndarray) -> None:
        found = table.pair_ranks(symbols[places], symbols[after[places]])
        known = found < NONE
        places, found = places[known], found[known]
        order = np.argsort(found, kind="stable")
        places, found = places[order], found[order]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1 if len(found) else []
        for part, rank in zip(np.split(places, cuts), found[np.r_[0, cuts].astype(int)] if len(found) else []):
            if rank not in waiting:
                heapq.heappush(ranks, int(rank))
                waiting[int(rank)] = []
            waiting[int(rank)].append(part)

    wait(np.arange(n - 1))
    alive = n
    gone = np.zeros(n, bool)
    while ranks:
        rank = heapq.heappop(ranks)
        places = np.unique(np.concatenate(waiting.pop(rank)))
        places = places[~gone[places]]
        places = places[after[places] < n]
        places = places[table.pair_ranks(symbols[places], symbols[after[places]]) == rank]
        if len(places) > 1:  # of overlapping pairs every second one counts
            chained = np.zeros(len(places), bool)
            chained[1:] = after[places[:-1]] == places[1:]
            run = np.maximum.accumulate(np.where(~chained, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run) % 2 == 0]
        if not len(places):
            continue
        taken = after[places]
        symbols[places] = table.into[rank]
        gone[taken] = True
        after[places] = after[taken]
        follows = after[places] < n
        before[after[places][follows]] = places[follows]
        alive -= len(places)
        changed = np.concatenate([places[follows], before[places][before[places] >= 0]])
        wait(np.unique(changed))
    return alive


@functools.lru_cache(maxsize=2)
def merge_table(path: str, pattern: str) -> MergeTable:
    return MergeTable(path, pattern)


_cache: dict[tuple[str, str], dict[str, int]] = {}


def token_counts(texts: Iterator[list[str]], path: str, pattern: str) -> Iterator[list[list[int]]]:
    """For each list of texts, their bytes and their tokens."""
    table = merge_table(path, pattern)
    known = _cache.setdefault((path, pattern), {})
    for batch in texts:
        words: list[list[str]] = []
        special = []
        for text in batch:
            parts = table.cut.split(text) if table.cut else [text]
            special.append(len(parts) - 1)
            words.append(table.split(text) if len(parts) == 1 else [w for part in parts for w in table.split(part)])
        fresh = set().union(*words).difference(known)
        if len(known) + len(fresh) > CACHE:
            known.clear()
            fresh = set().union(*words)
        new = list(fresh)
        known.update(zip(new, count_symbols([w.encode() for w in new], table).tolist()))
        yield [
            [len(text.encode()) for text in batch],
            [sum(map(known.__getitem__, own)) + extra for own, extra in zip(words, special)],
        ]


def count_tokens(
    df: DataFrame, path: str, pattern: str, limit: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``df``: ``key, n_bytes, n_tokens, over_limit``.

    Counts are those of the ``tokenizers`` library for the byte-level BPE file at ``path`` without added begin
    and end tokens; strings of special tokens inside a text count as that token. A null text counts as empty
    (0 bytes, 0 tokens). Keys may be null or repeated; other columns are not looked at. No shuffle. The file
    must lie at ``path`` on every executor.
    """

    def count(texts: Iterator[list[str]]) -> Iterator[list[list[int]]]:
        return token_counts(texts, path, pattern)

    counted = map_texts(df, [key], text, count, "n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

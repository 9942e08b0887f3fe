"""Byte-level BPE by recursive queries, run by DuckDB inside the tasks.

A task collects the distinct pre-tokens of its texts. Those that it has not met yet become rows with the list of
their bytes' tokens; a recursive query contracts each word's leftmost pair of minimum rank and joins the pairs of the
new token with the merge table, until no word has a known pair. Decoding joins the tokens with the vocabulary and
puts their bytes together in the order of positions.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import map_texts
from .token_counts import UNUSUAL

#: Pre-tokens of which a worker keeps tokens and decoded text. Beyond, those that were not used since the last time are
#: forgotten.
CACHE = 250_000
#: Bytes of text that are encoded together.
TEXT_BYTES = 2 << 20
#: Words that one recursive query contracts together.
WORDS_AT_ONCE = 20_000
#: A contraction per step takes as many steps as a word has bytes. Words beyond this length are contracted in
#: the same order (minimum rank, then leftmost) on a heap.
LONG = 200

LETTER_OR_NUMBER = regex.compile(r"[\p{L}\p{N}]")

#: A rank that no pair has: of pairs that are no token, and of the edges of a word. Like every rank it takes 21 bits of a pair.
NONE = 1 << 20

#: Every row is a word: its tokens, with NONE before and behind, and the ranks of its pairs. A step contracts the leftmost
#: pair of minimum rank, the first place of the minimum, and looks up the two pairs that the new token forms.
ENCODE = f"""
WITH RECURSIVE step(word, toks, ranks, best) AS (
    SELECT word, toks, ranks, list_min(ranks) FROM starts
  UNION ALL
    SELECT word, toks, ranks, list_min(ranks)
    FROM (
        SELECT word,
               list_concat(list_slice(toks, 1, spot - 1), [best], list_slice(toks, spot + 2, len(toks))) AS toks,
               list_concat(list_slice(ranks, 1, spot - 2), [coalesce(l.rank, {NONE}), coalesce(r.rank, {NONE})],
                           list_slice(ranks, spot + 2, len(ranks))) AS ranks,
               best
        FROM (SELECT word, toks, ranks, best, list_position(ranks, best) AS spot FROM step WHERE best < {NONE})
        LEFT JOIN merges l ON l.pair = (toks[spot - 1]::BIGINT << 21 | best)
        LEFT JOIN merges r ON r.pair = (best::BIGINT << 21 | toks[spot + 2])
    )
)
SELECT word, list_slice(toks, 2, len(toks) - 1) AS toks FROM step WHERE best = {NONE}
"""

DECODE = """
SELECT word, pos, tok, bytes
FROM (SELECT word, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM tokens) JOIN vocabulary ON id = tok
ORDER BY word, pos
"""


class Codec:
    """A rank file in DuckDB tables, private to one Python worker."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            pairs = (line.split() for line in file)
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if max(self.ranks.values()) >= 1 << 20 or any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("ranks below 2^20 and all single bytes are needed")
        self.start = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [self.ranks.get(bytes([a, b]), NONE) for a in range(256) for b in range(256)]
        self.start_ranks = np.array(pairs, np.int32).reshape(256, 256)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        splits = [
            (self.ranks[token[:i]] << 21 | self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self._table("merges", pair=pa.array([p for p, _ in splits], pa.int64()), rank=pa.array([r for _, r in splits], pa.int32()))
        self._table("vocabulary", id=pa.array(self.ranks.values(), pa.int32()), bytes=pa.array(self.ranks, pa.binary()))

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.duck.register("incoming", pa.table(columns))
        self.duck.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.duck.unregister("incoming")

    def learn(self, words: list[str]) -> None:
        """Encode and decode words that are not known yet."""
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE]
            encoded = [word.encode() for word in part]
            direct, rest = [], []
            for i, b in enumerate(encoded):
                if b in self.ranks:
                    direct.append((i, [self.ranks[b]]))
                elif len(b) > LONG:
                    direct.append((i, contract_long(b, self.ranks)))
                else:
                    rest.append(i)
            others = pa.table(
                {"word": pa.array([i for i, _ in direct], pa.int32()), "toks": pa.array([t for _, t in direct], pa.list_(pa.int32()))}
            )
            if rest:
                self.duck.register("starts", self.starts(rest, [encoded[i] for i in rest]))
                others = pa.concat_tables([others, self.duck.sql(ENCODE).to_arrow_table().cast(others.schema)])
                self.duck.unregister("starts")
            self.duck.register("tokens", others)
            found = self.duck.sql(DECODE).to_arrow_table().combine_chunks()
            self.duck.unregister("tokens")
            # Rows come word by word, so a word's tokens begin where its first position is.
            first = np.flatnonzero(found["pos"].to_numpy() == 1)
            ends = pa.array(np.append(first, found.num_rows).astype(np.int32))
            texts = [found["tok"].cast(pa.string()).chunk(0), found["bytes"].chunk(0)]
            ids, decoded = (pa.ListArray.from_arrays(ends, values) for values in texts)
            joined = pc.binary_join(ids, ",").to_pylist(), pc.binary_join(decoded, b"").to_pylist()
            for number, own, back in zip(found["word"].to_numpy()[first].tolist(), *joined):
                word = part[number]  # one string instead of two equal ones
                self.known[word] = (own, word if back == encoded[number] else back.decode())

    def starts(self, numbers: list[int], words: list[bytes]) -> pa.Table:
        """Words as tokens of one byte each, with the ranks of their pairs."""
        lengths = np.array([len(word) for word in words], np.int64)
        ends = np.cumsum(lengths)
        joined = np.frombuffer(b"".join(words), np.uint8)
        before = np.repeat(np.arange(len(words)), lengths)  # how many words are complete before each byte
        at = np.arange(len(joined))
        toks = np.full(len(joined) + 2 * len(words), NONE, np.int32)
        toks[at + 2 * before + 1] = self.start[joined]
        pairs = self.start_ranks[joined[:-1], joined[1:]]
        pairs[ends[:-1] - 1] = NONE
        ranks = np.full(len(joined) + len(words), NONE, np.int32)
        ranks[(at + before + 1)[:-1]] = pairs
        lists = {"toks": (toks, 2), "ranks": (ranks, 1)}
        columns = {
            name: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths + more)).astype(np.int32)), pa.array(values))
            for name, (values, more) in lists.items()
        }
        return pa.table({"word": pa.array(numbers, pa.int32()), **columns})

    def read(self, texts: list[str]) -> list[list[tuple[str, str]]]:
        """For each text, ids (joined by commas) and decoded text of its pre-tokens, in order."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        cut = [self.words(text) for text in texts]
        self.learn(sorted(self.recall(set().union(*cut))))
        return [list(map(self.known.__getitem__, words)) for words in cut]

    def forget(self) -> None:
        """Let go of the tokens that are kept, so that a worker that waits for its next task does not hold them."""
        self.known, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def recall(self, parts: set[str]) -> set[str]:
        """Make parts known that were known before; returns the others."""
        new = parts.difference(self.known)
        again = new.intersection(self.older)
        self.known.update((part, self.older[part]) for part in again)
        return new.difference(again)

    def words(self, text: str) -> list[str]:
        """Pre-tokens. A code point that the library's Unicode tables do not know as letter or number counts as
        a symbol: the pattern then runs over a copy that has a symbol in its place."""
        strange = {c for c in UNUSUAL.findall(text) if LETTER_OR_NUMBER.match(c) and not self.knows(c)}
        if not strange:
            return self.pattern.findall(text)
        copy = text.translate({ord(c): "\u00a7" for c in strange})
        return [text[m.start() : m.end()] for m in self.pattern.finditer(copy)]

    @functools.cached_property
    def library(self):
        import tiktoken

        return tiktoken.Encoding(
            "ranks", pat_str=self.pattern.pattern, mergeable_ranks=self.ranks, special_tokens={}
        )

    @functools.lru_cache(maxsize=20_000)
    def knows(self, letter: str) -> bool:
        """Whether the library splits before and after the code point as it does around letters and numbers."""
        parts = ("'", letter, "'t")
        whole = self.library.encode_ordinary("".join(parts))
        return whole == [token for part in parts for token in self.library.encode_ordinary(part)]


def contract_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Contract the leftmost pair of minimum rank until none is left; pairs wait on a heap."""
    ends = list(range(1, len(word) + 1))  # by start of a token
    before = list(range(-1, len(word) - 1))

    def pair(start: int) -> int | None:
        middle = ends[start]
        return ranks.get(word[start : ends[middle]]) if middle < len(word) else None

    heap = [(rank, i) for i in range(len(word) - 1) if (rank := pair(i)) is not None]
    heapq.heapify(heap)
    gone = bytearray(len(word))
    while heap:
        rank, i = heapq.heappop(heap)
        if gone[i] or pair(i) != rank:
            continue
        middle = ends[i]
        gone[middle] = 1
        ends[i] = ends[middle]
        if ends[i] < len(word):
            before[ends[i]] = i
        for start in (before[i], i):
            if start >= 0 and (again := pair(start)) is not None:
                heapq.heappush(heap, (again, start))
    return [ranks[word[i : ends[i]]] for i in range(len(word)) if not gone[i]]


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encoded_texts(texts: Iterator[list[str]], path: str, pattern: str) -> Iterator[list[list]]:
    """For each list of texts: the ids of each text joined by commas, their number, the decoded bytes."""
    code = codec(path, pattern)
    for batch in texts:
        found = code.read(batch)
        joined = [",".join([ids for ids, _ in parts]) for parts in found]
        decoded = ["".join([text for _, text in parts]).encode() for parts in found]
        yield [joined, [own.count(",") + 1 if own else 0 for own in joined], decoded]


def encode_bytes(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: ``key, token_ids (array<int>), n_tokens, decoded (binary)``.

    Ids are those of the ``tiktoken`` library for the rank file at ``path`` without special tokens; ``decoded``
    are the bytes of those ids. A null or empty text has no ids and no bytes. Keys may be null or repeated;
    other columns are not looked at. No shuffle. The file must lie at ``path`` on every executor. What a worker remembers of
    words ends with its task: in a job of several stages the others need that memory.
    """

    def run(texts: Iterator[list[str]]) -> Iterator[list[list]]:
        try:
            for ids, n, decoded in encoded_texts(texts, path, pattern):
                yield [[np.array(i.split(","), np.int32) if i else [] for i in ids], n, decoded]
        finally:
            codec(path, pattern).forget()

    return map_texts(df, [key], text, run, "token_ids array<int>, n_tokens long, decoded binary", TEXT_BYTES)


def encode_digests(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As :func:`encode_bytes`, with SHA-256 digests in place of ids (decimal, joined by commas) and bytes."""

    def run(texts: Iterator[list[str]]) -> Iterator[list[list]]:
        for ids, n, decoded in encoded_texts(texts, path, pattern):
            digests = [[hashlib.sha256(value).hexdigest() for value in values] for values in (map(str.encode, ids), decoded)]
            yield [n, *digests]

    return map_texts(df, [key], text, run, "n_tokens long, ids_sha256 string, decoded_sha256 string", TEXT_BYTES)

"""Alignment of two tokenizers over a corpus, every distinct text once.

Texts are shuffled as they are; a group counts its copies and is tokenized by both tokenizers and aligned once. The
places where tokens of both end cut a text into groups; within a group every token of one is linked to every token of the
other. A chunk of texts numbers its different groups, so a text is a list of such numbers with their frequencies, and
asks once for every pair of ids. Both tokenizers end a token before a blank that follows a visible character, so a chunk
tokenizes and aligns every stretch between such places once. The pairs, weighted by the copies of the texts that hold them, are counted over the
corpus, and the counts come back to the chunk. Measures are then joined with the documents by a digest of their text.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunked import CHUNK_BYTES, answer, to_arrow
from .common import chunks, text_or_empty, written
from .token_counts import byte_symbols

#: Bytes of text that are tokenized together.
BATCH_BYTES = 2 << 20
#: Links that are looked up together.
BLOCK = 4 << 20
#: A blank before which a text is not cut: it follows white space, or a character that might be some, or ends the text.
ODD_BLANK = re.compile(r"(?:^|[^!-~\u00a1-\u024f]) | $")
#: Where a text is cut, before a blank.
CUT = re.compile(r"(?<=[!-~\u00a1-\u024f])(?= )")
ALIGNED = (
    "_chunk long, digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "kinds array<int>, times array<long>, kind int, a array<int>, b array<int>, id_a int, id_b int, n long"
)
MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Ragged:
    """Lists of ids one after the other."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values, self.sizes = values, sizes
        self.starts = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(values)) - self.starts[self.owner]

    @classmethod
    def of(cls, lists: Sequence[Sequence[int]]) -> Ragged:
        return cls(np.fromiter(chain.from_iterable(lists), np.int64), np.array([len(own) for own in lists], np.int64))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of ``values``, one per id, of each list."""
        ends = np.append(0, np.cumsum(values))
        return ends[self.starts + self.sizes] - ends[self.starts]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each list, none of which is empty."""
        longest = int(self.sizes.max(initial=1))
        powers = np.multiply.accumulate(np.full(longest, 0x9E3779B97F4A7C15, np.uint64))
        mixed = (self.values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        return np.add.reduceat((mixed ^ mixed >> np.uint64(29)) * powers[self.place], self.starts)

    def equal(self, first: np.ndarray) -> bool:
        """Whether each list equals the list ``first`` names for it."""
        if (self.sizes != self.sizes[first]).any():
            return False
        return bool((self.values == self.values[self.starts[first[self.owner]] + self.place]).all())

    def at(self, i: int) -> np.ndarray:
        return self.values[self.starts[i] : self.starts[i] + self.sizes[i]]


class Tokenizers:
    """Both tokenizers with the bytes of each of their ids."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.a.no_truncation()
        self.a.no_padding()
        byte_of = {symbol: i for i, symbol in enumerate(byte_symbols())}
        self.bytes_a = {}
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(map(byte_of.__getitem__, token))
        for i, token in self.a.get_added_tokens_decoder().items():
            self.bytes_a[i] = token.content.encode()
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_b = {i: self.piece(i) for i in range(self.b.get_piece_size())}
        # No piece goes on into a blank, so a blank after something else starts a piece.
        self.parts = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in self.bytes_b)
        self.size_a, self.size_b = (self.sizes(table) for table in (self.bytes_a, self.bytes_b))

    def piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def sizes(table: dict[int, bytes]) -> np.ndarray:
        sizes = np.zeros(max(table) + 1, np.int64)
        for i, value in table.items():
            sizes[i] = len(value)
        return sizes

    def encode(self, texts: Sequence[str]) -> tuple[Ragged, Ragged]:
        """Ids of both for each text; none where the text is empty or a tokenizer does not give its bytes back."""
        led = [f" {text}" for text in texts]
        ids_a = [found.ids for found in self.a.encode_batch_fast(led, add_special_tokens=False)]
        ids_b = self.b.encode(list(texts), num_threads=1)
        a, b, data = Ragged.of(ids_a), Ragged.of(ids_b), [text.encode() for text in led]
        ends = np.cumsum([len(own) for own in data])
        if not (
            self.joined(self.bytes_a, ids_a) == self.joined(self.bytes_b, ids_b) == b"".join(data)
            and (a.sums(self.size_a[a.values]).cumsum() == ends).all()
            and (b.sums(self.size_b[b.values]).cumsum() == ends).all()
            and all(texts)
        ):
            for i, (text, own) in enumerate(zip(texts, data)):
                back = [self.joined(*side) for side in ((self.bytes_a, [ids_a[i]]), (self.bytes_b, [ids_b[i]]))]
                if not text or back != [own, own]:
                    ids_a[i], ids_b[i] = [], []
            a, b = Ragged.of(ids_a), Ragged.of(ids_b)
        return a, b

    @staticmethod
    def joined(table: dict[int, bytes], ids: Sequence[Sequence[int]]) -> bytes:
        return b"".join(map(table.__getitem__, chain.from_iterable(ids)))


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def distinct_groups(a: Ragged, b: Ragged) -> tuple[np.ndarray, np.ndarray]:
    """The first of equal groups, for each different group, and for each group its place among these."""
    mixed = a.hashes() * np.uint64(0xC2B2AE3D27D4EB4F) ^ b.hashes()
    _, first, label = np.unique(mixed, return_index=True, return_inverse=True)
    if a.equal(first[label]) and b.equal(first[label]):
        return first, label
    seen: dict[tuple[bytes, bytes], int] = {}  # two different groups have one hash
    label = np.array([seen.setdefault((a.at(i).tobytes(), b.at(i).tobytes()), len(seen)) for i in range(len(a.sizes))])
    return np.unique(label, return_index=True)[1], label


def align(a: Ragged, b: Ragged, size_a: np.ndarray, size_b: np.ndarray) -> tuple[Ragged, Ragged, np.ndarray]:
    """Groups of all texts: their ids of both kinds, and the number of groups of each text."""
    ends_a, ends_b = np.cumsum(size_a[a.values]), np.cumsum(size_b[b.values])
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    groups = [
        Ragged(own.values, np.bincount(np.searchsorted(cuts, ends), minlength=len(cuts)))
        for own, ends in ((a, ends_a), (b, ends_b))
    ]
    last = np.searchsorted(cuts, a.sums(size_a[a.values]).cumsum(), "right")
    return *groups, np.diff(last, prepend=0)


def stretches(text: str) -> list[str]:
    """A text cut before blanks, each stretch without the blank that leads it, as the text itself is led by one."""
    if not ODD_BLANK.search(text):
        return text.split(" ")
    return [stretch[1:] for stretch in CUT.split(f" {text}")]


class Chunk:
    """The different stretches and groups of a chunk, numbered, and in how many documents each pair of ids is linked."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}  # stretches; -1: not given back byte by byte
        self.named: list[str] = []  # their groups as text
        self.sizes = np.zeros((0, 4), np.int64)  # their ids of both kinds, links and groups
        self.groups = np.zeros(0, np.int64)  # numbers of their groups, one stretch after the other
        self.kinds: dict[tuple[bytes, bytes], int] = {}
        self.names: list[str] = []
        self.pairs: list[np.ndarray] = []  # the different pairs of each kind
        self.number: dict[int, int] = {}  # of each pair
        self.documents = np.zeros(0, np.int64)

    def kind(self, a: np.ndarray, b: np.ndarray) -> int:
        key = (a.tobytes(), b.tobytes())
        found = self.kinds.get(key)
        if found is None:
            found = self.kinds[key] = len(self.kinds)
            left, right = a.tolist(), b.tolist()
            self.names.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            keys = [x << 32 | y for x in set(left) for y in set(right)]
            self.pairs.append(np.array([self.number.setdefault(k, len(self.number)) for k in keys], np.int64))
        return found

    def learn(self, texts: Sequence[str], code: Tokenizers) -> list[int]:
        """Align stretches or whole texts; their numbers, -1 where a tokenizer does not give them back."""
        a, b = code.encode(texts)
        whole = a.sizes > 0
        if not whole.any():
            return [-1] * len(texts)
        groups_a, groups_b, n_groups = align(a, b, code.size_a, code.size_b)
        first, label = distinct_groups(groups_a, groups_b)
        kind = np.array([self.kind(groups_a.at(i), groups_b.at(i)) for i in first.tolist()])[label]
        names = list(map(self.names.__getitem__, kind.tolist()))
        own, ends = n_groups[whole], np.cumsum(n_groups[whole])
        links = np.add.reduceat(groups_a.sizes * groups_b.sizes, ends - own)
        numbers = np.where(whole, len(self.named) + np.cumsum(whole) - 1, -1)
        self.named += [names[e - 1] if n == 1 else ";".join(names[e - n : e]) for n, e in zip(own.tolist(), ends.tolist())]
        self.sizes = np.concatenate([self.sizes, np.column_stack([a.sizes[whole], b.sizes[whole], links, own])])
        self.groups = np.concatenate([self.groups, kind])
        return numbers.tolist()

    def numbers(self, texts: Sequence[str], code: Tokenizers) -> list[list[int]]:
        """Each text as numbers of aligned stretches; none where it has no tokens."""
        split = [stretches(text) if code.parts else [text] for text in texts]
        new = list(set().union(*split).difference(self.known))
        self.known.update(zip(new, self.learn(new, code) if new else []))
        found = [list(map(self.known.__getitem__, own)) for own in split]
        odd = [i for i, own in enumerate(found) if -1 in own]  # a stretch by itself may differ, for example a blank at the end
        for i, number in zip(odd, self.learn([texts[i] for i in odd], code) if odd else []):
            found[i] = [] if number < 0 else [number]
        return found

    def add(self, texts: Sequence[str], copies: np.ndarray, code: Tokenizers) -> list:
        """Columns ``n_a .. times`` of the texts."""
        found = self.numbers(texts, code)
        names = [";".join(map(self.named.__getitem__, own)) for own in found]
        digests = [hashlib.sha256(name.encode()).hexdigest() if name else "" for name in names]
        held = Ragged.of(found)
        sizes = self.sizes[held.values]
        starts = (np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3])[held.values]
        own = Ragged(np.zeros(int(sizes[:, 3].sum())), sizes[:, 3])  # the groups of each stretch in turn
        kind = self.groups[starts[own.owner] + own.place]
        most = max(len(self.kinds), 1)
        both, times = np.unique(held.owner[own.owner] * most + kind, return_counts=True)
        text, kind = both // most, both % most
        if len(text):
            self.count(text, kind, copies)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
        n_a, n_b, n_links, n_groups = (held.sums(sizes[:, i]) for i in range(4))
        return [n_a, n_b, n_groups, n_links, digests, lists(kind, pa.int32()), lists(times, pa.int64())]

    def count(self, text: np.ndarray, kind: np.ndarray, copies: np.ndarray) -> None:
        """Count the texts' copies for every pair that a text holds, once for each text."""
        sizes = np.array([len(self.pairs[k]) for k in kind.tolist()])
        held = np.concatenate([self.pairs[k] for k in kind.tolist()])
        both = np.unique(np.repeat(text, sizes) * len(self.number) + held)
        more = np.bincount(both % len(self.number), copies[both // len(self.number)], len(self.number)).astype(np.int64)
        more[: len(self.documents)] += self.documents
        self.documents = more


def aligned(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """From different texts (``_text, digest, copies``) three sorts of rows: a row per text, a row per different group of a
    chunk (``kind, a, b``), and a row per pair of ids of a chunk (``id_a, id_b``) with the documents that hold it."""
    schema = to_arrow(T.StructType.fromDDL(ALIGNED))

    def rows(_rows: int, **columns) -> pa.RecordBatch:
        arrays = []
        for field in schema:
            value = columns.get(field.name)
            arrays.append(pa.nulls(_rows, field.type) if value is None else pa.array(value, field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def finished(number: int, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        kinds = [(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)) for a, b in chunk.kinds]
        n = len(kinds)
        a, b = [x for x, _ in kinds], [y for _, y in kinds]
        yield rows(n, _chunk=[number] * n, kind=range(n), a=a, b=b)
        keys = np.fromiter(chunk.number, np.int64, len(chunk.number))
        yield rows(len(keys), _chunk=[number] * len(keys), id_a=keys >> 32, id_b=keys & 0xFFFFFFFF, n=chunk.documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = tokenizers(path_a, path_b)
        number, size, chunk = TaskContext.get().partitionId() << 32, 0, Chunk()
        for batch in chunks(batches, "_text", BATCH_BYTES):
            own = batch.column("_text").to_pylist()
            copies = batch.column("copies").to_numpy()
            n_a, n_b, n_groups, n_links, digests, kinds, times = chunk.add(own, copies, code)
            yield rows(
                len(own), _chunk=[number] * len(own), digest=batch.column("digest"), copies=copies, n_a=n_a, n_b=n_b,
                n_groups=n_groups, n_links=n_links, groups_sha256=digests, kinds=kinds, times=times,
            )
            size += pc.sum(pc.binary_length(batch.column("_text"))).as_py()
            if size > CHUNK_BYTES:
                yield from finished(number, chunk)
                number, size, chunk = number + 1, 0, Chunk()
        if chunk.kinds:
            yield from finished(number, chunk)

    return texts.select("_text", "digest", "copies").mapInArrow(run, ALIGNED)


def links(a: Ragged, b: Ragged) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All links of all groups, ``BLOCK`` at a time: the group and the pair of ids of each."""
    many = a.sizes * b.sizes
    ends = np.cumsum(many)
    for first in range(0, int(ends[-1]) if len(ends) else 0, BLOCK):
        at = np.arange(first, min(first + BLOCK, int(ends[-1])))
        group = np.searchsorted(ends, at, "right")
        within = at - (ends - many)[group]
        x, y = within // b.sizes[group], within % b.sizes[group]
        yield group, a.values[a.starts[group] + x] << 32 | b.values[b.starts[group] + y]


def ragged(column: pa.ChunkedArray) -> Ragged:
    column = column.combine_chunks()
    return Ragged(column.flatten().to_numpy().astype(np.int64), np.diff(column.offsets.to_numpy()).astype(np.int64))


def measured(left: pa.Table, right: pa.Table) -> pa.Table:
    """Measures of the texts of a chunk from its groups and the counts of its pairs."""
    keys = right.column("id_a").to_numpy().astype(np.int64) << 32 | right.column("id_b").to_numpy()
    order = np.argsort(keys)
    keys, count, best = keys[order], right.column("count").to_numpy()[order], right.column("best").to_numpy()[order]
    kinds = left.filter(pc.is_valid(left.column("kind"))).sort_by("kind")
    total, highest = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
    for group, pair in links(ragged(kinds.column("a")), ragged(kinds.column("b"))):
        at = np.searchsorted(keys, pair)
        np.add.at(total, group, count[at])
        np.add.at(highest, group, best[at].astype(np.int64))
    texts = left.filter(pc.is_valid(left.column("digest")))
    own, times = ragged(texts.column("kinds")), ragged(texts.column("times")).values
    sums = {}
    for name, values in {"n_best": highest, "count_sum": total}.items():
        sums[name] = np.zeros(len(texts), np.int64)
        np.add.at(sums[name], own.owner, values[own.values] * times)
    columns = {name: texts.column(name) for name in ("digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    names = ["digest", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.table([(columns | sums)[name] for name in names], names=names)


def align_tokenizers(df: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``df``.

    ``path_a`` is a byte-level file of the ``tokenizers`` library, applied to a blank and the text, ``path_b`` one of
    ``sentencepiece``, applied to the text, before which it sets a blank itself; both lie there on every executor. Strings of
    special tokens are plain text. Texts that are null or empty, or that a tokenizer does not give back byte by byte, have no
    tokens: zeros and an empty digest. A pair of ids counts the documents that hold it linked, copies included; ``n_best``
    are the links whose count is the highest of their id of ``path_a``, ties included.

    Keys may be null or repeated (every row gets a row); other columns are not looked at. A text of any length is handled
    whole; a task holds the different pairs of its chunk. Copies meet after they were combined in their tasks, and the
    join with the documents is by digest, whose skew Spark splits. An empty table gives an empty one.
    """
    digest = F.unhex(F.sha2("_text", 256)).alias("digest")
    rows = df.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text"))
    texts = rows.groupBy("_text").agg(F.count("*").alias("copies")).select("_text", digest, "copies")
    found = written(aligned(texts, path_a, path_b), "aligned")
    pairs = found.where("id_a IS NOT NULL").select(F.col("_chunk").alias("_chunk"), "id_a", "id_b", "n")
    counts = pairs.groupBy("id_a", "id_b").agg(F.sum("n").alias("count"))
    highest = F.max("count").over(Window.partitionBy("id_a"))
    counts = written(counts.withColumn("best", F.col("count") == highest), "counts")
    answers = pairs.drop("n").join(counts, ["id_a", "id_b"])
    measures = answer(found.where("id_a IS NULL").drop("id_a", "id_b", "n"), answers, measured, f"digest binary, {MEASURES}")
    return rows.select("_key", digest).join(measures, "digest").drop("digest").withColumnRenamed("_key", key)

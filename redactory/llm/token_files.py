"""Token ids in ORC files, in the order of documents.

Documents are dealt out by ranges of their ids and sorted, so every file holds one stretch of the sequence and
the files follow each other. A row holds the ids of a document, the number of its file (``part``) and how many
ids lie before it in that file (``offset``). ORC writes the ids with its run-length encoding for integers and
keeps row indexes and Bloom filters on the document ids, so that stripes are read in parallel and a look-up by
document skips all stripes that cannot hold it.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, text_or_empty, written

#: Words of which a worker keeps the ids. Beyond, those that were not used since the last time are forgotten.
CACHE = 400_000
#: Bytes of ASCII letters, digits and white space, and of the code points U+00C0 to U+00FF, which are letters but
#: for two. In a text of these, commas and full stops only, a mark is a piece of its own unless marks meet.
LETTERS_AND_BLANKS = bytes(
    b for b in range(256) if chr(b).isalnum() and b < 128 or b in b" \t\n\v\f\r" or b == 0xC3 or 0x80 <= b < 0xC0
)
#: Such letters followed by marks that are neither letters, digits nor apostrophes: two pieces at most.
LETTERS_THEN_MARKS = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\xbf])+)([!-&(-/:-@\[-`{-~]*)")
MARKS_TOGETHER = re.compile(rb"[,.][,.]|\xc3[\x97\xb7]")
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1_000


class WordEncoder:
    """Ids of words between ASCII white space, remembered. The tokenizer drops white space and no normal form,
    piece or special token of it reaches over a blank, so a text has the ids of its words one after the other.
    In plain text commas and full stops are pieces of their own and become words too."""

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        from .token_counts import byte_symbols

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        apart = [i for text in ("the", "THE,") for i in self.tokenizer.encode(text, add_special_tokens=False).ids]
        if self.tokenizer.encode("the \n the ,", add_special_tokens=False).ids != apart:
            raise ValueError("the tokenizer must drop white space and lower the case")
        self.model = self.tokenizer.model
        self.symbols = dict(enumerate(byte_symbols()))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def words(self, text: str) -> list[bytes]:
        data = text.encode()
        if data.translate(None, LETTERS_AND_BLANKS).strip(b",.") or MARKS_TOGETHER.search(data):
            return data.split()
        return text.lower().encode().replace(b",", b" , ").replace(b".", b" . ").split()

    def learn(self, words: Sequence[bytes]) -> None:
        odd = []
        for word in words:
            if word.isalpha() and word.islower():  # ASCII letters
                self.piece(word)
            elif (found := LETTERS_THEN_MARKS.fullmatch(word)) and (letters := found[1].decode().lower()).isalpha():
                self.known[word] = self.piece(letters.encode()) + (self.piece(found[2]) if found[2] else b"")
            else:
                odd.append(word)
        if odd:
            found = self.tokenizer.encode_batch_fast([w.decode() for w in odd], add_special_tokens=False)
            self.known.update((w, np.array(e.ids, "<i4").tobytes()) for w, e in zip(odd, found))

    def piece(self, piece: bytes) -> bytes:
        """Ids of a run of lower-case letters or of marks, which normalizing and splitting leave whole."""
        ids = self.known.get(piece)
        if ids is None and (ids := self.older.get(piece)) is not None:
            self.known[piece] = ids
        if ids is None:
            symbols = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(self.symbols)
            ids = self.known[piece] = array("i", [token.id for token in self.model.tokenize(symbols)]).tobytes()
        return ids

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = [self.words(text) for text in texts]
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        new = set().union(*split).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((word, self.older[word]) for word in again)
        self.learn(list(new.difference(again)))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_tokens(
    df: DataFrame, tokenizer: str, folder: str, end_id: int, text: str = "text", key: str = "doc_id"
) -> None:
    """Write the ids of every text (null: empty), each followed by ``end_id``, to ORC files below ``folder``.

    Ids are those of the ``tokenizers`` library for the file ``tokenizer`` without special tokens. Rows are in
    ascending order of ``key``, nulls first, rows of one key in the order of a hash of their text; other columns
    are not written. One shuffle, of keys and texts. An empty table gives files without rows.
    """
    rows = df.select(F.col(key), text_or_empty(text).alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    order = [F.col(key).asc_nulls_first(), F.col("_tie").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(key, "_text")
    schema = df.select(key).schema.add("part", "integer").add("offset", "long").add("ids", T.ArrayType(T.IntegerType()))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, offset = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<i4").tobytes()
        for batch in chunks(batches, "_text"):
            ids = [i + end for i in code.encode(batch.column("_text").to_pylist())]
            bounds = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])])
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
            columns = [batch.column(key), pa.array([part] * len(ids), pa.int32()), pa.array(offset + bounds[:-1]), lists]
            offset += int(bounds[-1])
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows.mapInArrow(run, schema).write.options(
        **{
            "orc.bloom.filter.columns": key,
            "orc.row.index.stride": INDEX_STRIDE,
            "orc.stripe.size": STRIPE_BYTES,
        }
    ).orc(folder)


def read_tokens(spark: SparkSession, folder: str, keys: Sequence | None = None, key: str = "doc_id") -> DataFrame:
    """The rows of the files; with ``keys``, only those, found by row indexes and Bloom filters."""
    rows = spark.read.orc(folder)
    return rows if keys is None else rows.where(F.col(key).isin(list(keys)))


def token_index(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """From the files, per document: ``key``, ids of all documents before it (``start``), its ids (``n_tokens``)
    and the CRC-32 of those ids as little-endian unsigned 32-bit integers (``ids_crc32``)."""
    rows = read_tokens(spark, folder)
    schema = rows.select(key, "part", "offset").schema.add("n_tokens", "long").add("ids_crc32", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy()
            bounds = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].astype("<i4", copy=False)) for a, b in zip(bounds[:-1], bounds[1:])]
            kept = [batch.column(name) for name in (key, "part", "offset")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())], names=schema.names
            )

    digests = written(rows.mapInArrow(run, schema), "digests")  # so that the ids are read once
    parts = digests.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = parts.select("part", F.coalesce(before, F.lit(0)).alias("shift"))
    start = (F.col("offset") + F.col("shift")).alias("start")
    return digests.join(shifts, "part").select(key, start, "n_tokens", "ids_crc32")

"""Texts in chunks of bounded size, and values looked up for a whole chunk at once.

A table of values that grows with the corpus can neither be broadcast nor joined with every place of every text.
So each chunk of texts asks for every value that it needs once; the requests are joined with the table, and the
answers meet the texts of their chunk again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from redactory.session import scratch_path

#: Bytes of text in a chunk; a longer text is a chunk with what begins in it.
CHUNK_BYTES = 16 << 20
#: Buckets of a table of chunks at most, several chunks in a bucket beyond.
MAX_BUCKETS = 10_000


def in_chunks(df: DataFrame, text: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """``df`` with the number of its chunk, ``_chunk``, written once so that a repeated task cannot deal anew.

    Rows of one task whose texts begin within the same ``limit`` bytes share a chunk; small splits are read together, as
    far as the cores stay busy. The table has buckets by chunk: answers travel to the texts, not the other way round.
    """
    spark = df.sparkSession
    whole = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    number = whole // limit + 1
    df = df.coalesce(max(number, spark.sparkContext.defaultParallelism))
    schema = T.StructType([*df.schema, T.StructField("_chunk", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
            ends = seen + np.cumsum(sizes)
            chunk = pa.array(first + (ends - sizes) // limit)
            seen = int(ends[-1]) if len(ends) else seen
            yield pa.RecordBatch.from_arrays([*batch.columns, chunk], names=schema.names)

    name = f"chunks_{uuid.uuid4().hex}"
    buckets = min(4 * max(number, spark.sparkContext.defaultParallelism), MAX_BUCKETS)
    write = df.mapInArrow(run, schema).write.bucketBy(buckets, "_chunk").option("compression", "zstd")
    write.option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files belong to the scratch folder
    return found


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Consecutive rows of one chunk: its number and its batches. A chunk that was cut by the reader comes twice."""
    pieces = (piece for batch in batches for piece in cut_by_chunk(batch))
    held = next(pieces, None)

    def of(number: int) -> Iterator[pa.RecordBatch]:
        nonlocal held
        while held is not None and held[0] == number:
            yield held[1]
            held = next(pieces, None)

    while held is not None:
        number = held[0]
        own = of(number)
        yield number, own
        for _ in own:  # whatever the caller has left
            pass


def cut_by_chunk(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    chunk = batch.column("_chunk").to_numpy()
    if len(chunk):
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(chunk[a]), batch.slice(a, b - a)


def answer(
    texts: DataFrame, answers: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``function`` of the texts of each chunk and of the answers to its requests; both have the column ``_chunk``."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return function(left, right)

    return texts.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(run, schema)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def to_arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)

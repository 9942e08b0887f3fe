"""Helpers that several operators share: table access, Arrow batches of bounded size, row keys, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from redactory.session import scratch_path

#: Bytes of text that a Python task holds as objects at once.
CHUNK_BYTES = 8 << 20
#: A word: what lies between blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df``, written to the shared scratch folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def keyed(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "_key") -> DataFrame:
    """``df`` with a whole number per row, not null and not repeated: the key itself if it is such a number, else the
    rank of the row by key (nulls first) and text."""
    if whole_ids(df, key):
        return df.withColumn(name, F.col(key).cast("long"))
    return written(numbered(df, [F.col(key), F.xxhash64(text), F.col(text)], name), "keyed")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer name that no column of ``df`` has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in a text column, one row at least.

    A batch of Spark is bounded by rows only; long texts become Python objects slice by slice.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    function: Callable[[Iterator[list[str]]], Iterator[Sequence[Sequence]]],
    schema: str,
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """Columns ``keep`` of ``df`` followed by what ``function`` makes of the texts (null: empty), batch by batch.

    ``function`` gets an iterator of text lists (``limit`` bytes each, one text at least) and yields, for each, one
    sequence per new column of ``schema``.
    """
    source = text if text in keep else "_text"  # a text that is kept is not sent twice
    frame = df.select(*keep) if text in keep else df.select(*keep, text_or_empty(text).alias("_text"))
    new = T.StructType.fromDDL(schema)
    whole = df.select(*keep).schema
    for field in new:
        whole = whole.add(field)
    names = whole.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []

        def texts() -> Iterator[list[str]]:
            for part in chunks(batches, source, limit):
                pending.append(part)
                yield [value or "" for value in part.column(source).to_pylist()]

        for columns in function(texts()):
            part = pending.pop(0)
            arrays = [part.column(name) for name in names[: len(keep)]]
            arrays += [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return frame.mapInArrow(run, whole)


def numbered(df: DataFrame, order: Sequence[Column], name: str, first: int = 0) -> DataFrame:
    """``df`` with the rank of each row in a total order, without a window over all rows.

    Rows are dealt out by ranges of the order and written once, so that the ranges stay as they are if a
    task is repeated; ranks inside a range are shifted by the sizes of the ranges before it.
    """
    sort = [f"_sort{i}" for i in range(len(order))]
    dealt = df.withColumns(dict(zip(sort, order))).repartitionByRange(*[F.col(c).asc_nulls_first() for c in sort])
    part = written(dealt.withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = part.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in sort]))
    ranked = part.withColumn("_rank", rank).join(shifts, "_part")
    return ranked.withColumn(name, F.col("_rank") + F.col("_shift") + F.lit(first - 1)).drop(
        *sort, "_part", "_n", "_shift", "_rank"
    )


def whole_ids(df: DataFrame, column: str) -> bool:
    """Whether the ids are whole numbers of 64 bits at most by their type, none of them null or repeated."""
    return isinstance(df.schema[column].dataType, T.IntegralType) and unique_ids(df, column)


def unique_ids(df: DataFrame, column: str) -> bool:
    """Whether no id is null or repeated. Reads one column; counts are combined before they are shuffled."""
    seen = df.groupBy(column).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(column).isNull())
    return seen.limit(1).count() == 0

"""Reading a table page by page."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLE = 4096


def page(df: DataFrame, keys: Sequence[str], offset: int, size: int) -> DataFrame:
    """Rows ``offset .. offset+size`` in key order. Meant for early pages: Spark has to rank every
    row up to ``offset``; use ``page_after`` to walk on and ``with_pages`` to number all pages."""
    return df.orderBy(*keys).offset(offset).limit(size)


def page_after(df: DataFrame, key: str, last: object, size: int) -> DataFrame:
    """The page that follows key value ``last``; the condition reaches the Parquet scan."""
    return df.filter(F.col(key) > F.lit(last)).orderBy(key).limit(size)


def with_pages(df: DataFrame, key: str, size: int, slices: int | None = None) -> DataFrame:
    """Add ``page`` (0-based) and ``row_in_page``, in the order of the unique column ``key``.

    A plain ``row_number() over (order by key)`` would pull the table through one task. Here the
    key range is cut at values taken from a sample, rows are numbered inside each slice, and the
    counts of the preceding slices are added. The sample only balances the slices; any cuts
    give the same numbers. One shuffle of the table, no global sort.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Keys whose hash falls into one of ``rows / SAMPLE`` classes: about SAMPLE keys reach the driver.
    thin = max(1, df.count() // SAMPLE)
    sampled = df.select(key).filter(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(thin)) == 0)).distinct().collect()
    ordered = sorted(r[0] for r in sampled)
    cuts = sorted({ordered[len(ordered) * i // slices] for i in range(1, slices)}) if ordered else []
    if cuts:
        bounds = F.array(*[F.lit(c) for c in cuts])
        slice_of = F.size(F.filter(bounds, lambda c: c <= F.col(key)))
    else:
        slice_of = F.lit(0)
    # Rows without a key come first; they are spread by a hash of the row, so they do not meet in one task.
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
    keyless = -1 - F.pmod(hashed, F.lit(slices)).cast("int")
    sliced = df.withColumn("__slice", F.when(F.col(key).isNull(), keyless).otherwise(slice_of))
    # One row per slice: the unpartitioned window and the broadcast are bounded by ``slices``.
    before = F.sum("n").over(Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        sliced.groupBy("__slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("__slice", F.coalesce(before, F.lit(0)).alias("__before"))
    )
    number = F.row_number().over(Window.partitionBy("__slice").orderBy(key)) - 1
    numbered = sliced.withColumn("__n", number).join(F.broadcast(offsets), "__slice")
    position = F.col("__before") + F.col("__n")
    return numbered.select(
        *df.columns,
        F.floor(position / size).cast("bigint").alias("page"),
        (position % size).cast("int").alias("row_in_page"),
    )


@dataclass(frozen=True)
class PageIndex:
    """Rows in the order of a key, written once in ranges, with the number of rows before each range: a page is read from
    the one or two ranges that hold it, whatever its number.

    ``rows/__range=<n>`` holds a range with ``__row``, the place of a row in it; ``index`` has one row per range: first
    key, rows, rows before. Rows without a key come first; rows of one key are ordered by a hash of the row.
    """

    spark: SparkSession
    path: str
    key: str

    @classmethod
    def build(cls, df: DataFrame, key: str, path: str, ranges: int | None = None) -> PageIndex:
        hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])
        order = [F.col(key).asc_nulls_first(), F.col("__tie").asc()]
        rows = df.withColumn("__tie", hashed)
        rows = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        rows = rows.sortWithinPartitions(*order).withColumn("__row", place).withColumn("__range", F.spark_partition_id())
        rows.drop("__tie").write.partitionBy("__range").parquet(f"{path}/rows")
        rows.drop("__tie").limit(0).coalesce(1).write.parquet(f"{path}/schema")  # an empty table has no other file
        sizes = cls(df.sparkSession, path, key).rows().groupBy("__range")
        sizes = sizes.agg(F.min(key).alias("first_key"), F.count("*").alias("n_rows"))
        before = F.sum("n_rows").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
        index = sizes.select("*", F.coalesce(before, F.lit(0)).alias("rows_before"))  # one row per range
        index.coalesce(1).write.parquet(f"{path}/index")
        return cls(df.sparkSession, path, key)

    @classmethod
    def open(cls, spark: SparkSession, path: str, key: str) -> PageIndex:
        """An index that was built before."""
        return cls(spark, path, key)

    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/index")

    def rows(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def count(self) -> int:
        return self.index().agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]

    def page_at(self, page: int, size: int) -> DataFrame:
        """Rows ``page * size`` and following, ``size`` of them, in order; only the ranges that hold them are read."""
        first, last = page * size, (page + 1) * size
        held = self.index().where((F.col("rows_before") < last) & (F.col("rows_before") + F.col("n_rows") > first)).collect()
        within = F.lit(False)
        for row in held:
            a, b = first - row["rows_before"], last - row["rows_before"]
            within = within | ((F.col("__range") == row["__range"]) & (F.col("__row") >= a) & (F.col("__row") < b))
        return self.rows().where(within).orderBy("__range", "__row").drop("__range", "__row")

    def with_pages(self, size: int) -> DataFrame:
        """All rows with ``page`` and ``row_in_page``; the index, one row per range, is broadcast."""
        before = self.index().select("__range", "rows_before")
        position = F.col("rows_before") + F.col("__row")
        paged = self.rows().join(F.broadcast(before), "__range")
        paged = paged.withColumn("page", F.floor(position / size).cast("bigint"))
        return paged.withColumn("row_in_page", (position % size).cast("int")).drop("__range", "__row", "rows_before")

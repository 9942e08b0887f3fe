"""Sets of tables: discovery, metadata, counts, aligned writes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import appendable
from ..plans.eligibility import is_eligible
from ..policy import TablePolicy


@dataclass(frozen=True)
class TableSet:
    """Named DataFrames that are processed together; ``keys`` holds the key columns, if any."""

    spark: SparkSession
    frames: Mapping[str, DataFrame]
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @classmethod
    def from_directory(
        cls, spark: SparkSession, path: str, names: Sequence[str] | None = None, keys: Mapping | None = None
    ) -> TableSet:
        """Every ``{name}.parquet`` (file or folder) below ``path``."""
        found = names if names is not None else directory_tables(spark, path)
        return cls(spark, {n: spark.read.parquet(f"{path}/{n}.parquet") for n in found}, keys or {})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None, keys: Mapping | None = None) -> TableSet:
        """The tables, not the views, of a catalog database."""
        prefix = f"`{database}`." if database else ""
        names = [
            t.name for t in spark.catalog.listTables(database) if not t.isTemporary and (t.tableType or "") != "VIEW"
        ]
        return cls(spark, {n: spark.table(f"{prefix}`{n}`") for n in sorted(names)}, keys or {})

    def names(self) -> DataFrame:
        return self.spark.createDataFrame([(n,) for n in self.frames], "table string")

    def metadata(self, policies: Mapping[str, TablePolicy] | None = None) -> DataFrame:
        """One row per column: position, type, whether it would be inspected, whether it is a key."""
        rows = [
            (name, i, f.name, f.dataType.simpleString(), is_eligible(f, (policies or {}).get(name)),
             f.name in self.keys.get(name, ()))
            for name, frame in self.frames.items()
            for i, f in enumerate(frame.schema.fields)
        ]
        return self.spark.createDataFrame(
            rows, "table string, ordinal int, column string, type string, eligible boolean, is_key boolean"
        )

    def row_counts(self) -> DataFrame:
        """Rows per table, answered from Parquet footers."""
        parts = [
            frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
            for name, frame in self.frames.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def empty_copy(self) -> TableSet:
        """The same tables without rows."""
        return TableSet(
            self.spark, {n: self.spark.createDataFrame([], f.schema) for n, f in self.frames.items()}, self.keys
        )

    def write(self, path: str, mode: str = "errorifexists") -> None:
        for name, frame in self.frames.items():
            frame.write.mode(mode).parquet(f"{path}/{name}.parquet")


def directory_tables(spark: SparkSession, path: str) -> list[str]:
    """Names of the Parquet tables in a folder; only paths are listed, no file is opened."""
    files = spark.read.format("binaryFile").load(f"{path}/*.parquet").inputFiles()
    return sorted({re.search(r"/([^/]+)\.parquet(?:/[^/]*)?$", f).group(1) for f in files})


def append(df: DataFrame, path: str) -> None:
    """Append to a Parquet table after checking that the columns are those of the table."""
    target: T.StructType = df.sparkSession.read.parquet(path).schema
    appendable(df, target.fieldNames()).write.mode("append").parquet(path)

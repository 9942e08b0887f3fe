"""A table kept by key: a snapshot, a log of batches since then, and a manifest that says which of them count.

Batches, from a stream or from jobs, are reduced to one row per key and appended to the log; nothing that was written is
rewritten. Compaction folds snapshot and log into a new snapshot and then writes one manifest file, which is the
moment from which readers see it; folded batches and the snapshot before last are removed afterwards. So a reader meets
at most the batches since the last compaction, and a job that dies at any point leaves the table as it was.

One writer at a time. Folders below the path: ``manifest/<version>``, ``snapshot/<version>``, ``log/<batch>``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import ARRIVAL, ORDER, latest

BATCH, BUCKET = "__batch", "__bucket"
MANIFEST = "version long, through long, keys array<string>, `order` array<string>, by string, buckets int, filled boolean"
BUCKETS = 32


class StoreError(ValueError):
    """The store is not what it was asked to be."""


@dataclass(frozen=True)
class UpsertStore:
    """``by`` tells which row of a key counts: with ``"order"`` the one that is last in ``order``, and of equal ones the
    one that arrived last; with ``"arrival"`` the one of the latest batch, and within a batch the last in ``order``."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    by: str
    buckets: int

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (), by: str = ARRIVAL,
        buckets: int = BUCKETS,
    ) -> UpsertStore:
        """A new store, or the one that is there already if it has the same keys and rules."""
        if by not in (ARRIVAL, ORDER) or not keys or by == ORDER and not order:
            raise StoreError(f"a store needs keys, and an order if rows count by order: {keys}, {order}, {by}")
        store = cls(spark, path, tuple(keys), tuple(order), by, buckets)
        known = _manifest(spark, path)
        if known is None:
            store._publish(0, -1, filled=False)
        elif (tuple(known["keys"]), tuple(known["order"]), known["by"]) != (store.keys, store.order, by):
            raise StoreError(f"the store at {path} has keys {known['keys']}, order {known['order']}, by {known['by']}")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> UpsertStore:
        """An existing store; keys and rules come from its manifest."""
        known = _manifest(spark, path)
        if known is None:
            raise StoreError(f"no store at {path}")
        return cls(spark, path, tuple(known["keys"]), tuple(known["order"]), known["by"], known["buckets"])

    def write(self, rows: DataFrame, batch: int | None = None) -> None:
        """Append a batch. A batch number that was used replaces what an earlier attempt left, and does nothing if it is
        part of the snapshot; without a number the batch is the next one."""
        known, pending = _manifest(self.spark, self.path), self._pending()
        if batch is None:
            batch = max([known["through"], *pending]) + 1
        if batch > known["through"]:
            reduced = latest(rows, self.keys, self.order or [F.lit(0)])
            reduced.withColumn(BATCH, F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{self.path}/log/{batch}")

    def read(self) -> DataFrame:
        """One row per key; rows with a NULL in a key all count."""
        return self._merged().drop(BATCH)

    def find(self, **key: object) -> DataFrame:
        """The row of one key, from its bucket of the snapshot and from the log."""
        if set(key) != set(self.keys):
            raise StoreError(f"the keys are {self.keys}")
        return self._merged(key).drop(BATCH)

    def batches(self) -> int:
        """Batches that readers merge with the snapshot."""
        return len(self._pending())

    def compact(self) -> None:
        """Fold the log into a new snapshot, publish it, and remove what nobody needs any more."""
        known, pending = _manifest(self.spark, self.path), self._pending()
        if not pending:
            return
        version = known["version"] + 1
        rows = self._merged().withColumn(BUCKET, self._bucket())
        spread = rows.repartition(self.buckets, BUCKET)
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/snapshot/{version}")
        self._publish(version, max(pending), filled=True)
        self._clean()

    def _clean(self) -> None:
        """Remove folded batches and all snapshots and manifests but the last two (a reader may still be at work)."""
        known = _manifest(self.spark, self.path)
        for folder, least in (("log", known["through"] + 1), ("snapshot", known["version"] - 1), ("manifest", known["version"] - 1)):
            for number in _folders(self.spark, f"{self.path}/{folder}"):
                if number < least:
                    _remove(self.spark, f"{self.path}/{folder}/{number}")

    def _publish(self, version: int, through: int, filled: bool) -> None:
        row = (version, through, list(self.keys), list(self.order), self.by, self.buckets, filled)
        manifest = self.spark.createDataFrame([row], MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/{version}")

    def _pending(self) -> list[int]:
        through = _manifest(self.spark, self.path)["through"]
        return [n for n in _folders(self.spark, f"{self.path}/log") if n > through]

    def _bucket(self, values: Sequence[Column] | None = None) -> Column:
        """The bucket of a row by its keys. Rows with a NULL in a key belong to no key; they go by their batch."""
        hashed = F.pmod(F.xxhash64(*(values or [F.col(k) for k in self.keys])), F.lit(self.buckets)).cast("int")
        if values:
            return hashed
        no_key = reduce(or_, [F.col(k).isNull() for k in self.keys])
        return F.when(no_key, F.pmod(F.col(BATCH), F.lit(self.buckets)).cast("int")).otherwise(hashed)

    def _merged(self, key: Mapping[str, object] | None = None) -> DataFrame:
        known = _manifest(self.spark, self.path)
        frames = []
        if known["filled"]:
            snapshot = self.spark.read.parquet(f"{self.path}/snapshot/{known['version']}")
            if key is not None:
                kinds = {f.name: f.dataType for f in snapshot.schema}
                values = [F.lit(key[k]).cast(kinds[k]) for k in self.keys]
                snapshot = snapshot.where(F.col(BUCKET) == self.spark.range(1).select(self._bucket(values)).first()[0])
            frames.append(snapshot.drop(BUCKET))
        pending = [n for n in _folders(self.spark, f"{self.path}/log") if n > known["through"]]
        if pending:
            logs = [f"{self.path}/log/{n}" for n in pending]
            frames.append(self.spark.read.option("mergeSchema", "true").parquet(*logs))
        if not frames:
            raise StoreError(f"nothing was written to {self.path}")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        if key is not None:
            rows = rows.where(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in key.items()]))
        ranking = [*self.order, BATCH] if self.by == ORDER else [BATCH, *self.order]
        return latest(rows, self.keys, ranking)


def _manifest(spark: SparkSession, path: str):
    """The last manifest that was written to its end."""
    versions = _folders(spark, f"{path}/manifest")
    if not versions:
        return None
    return spark.read.schema(MANIFEST).json(f"{path}/manifest/{max(versions)}").first()


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders below ``path`` whose write was finished."""
    files, place = _file_system(spark, f"{path}/*/_SUCCESS")
    found = files.globStatus(place) or []
    return sorted(int(status.getPath().getParent().getName()) for status in found)


def _remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)

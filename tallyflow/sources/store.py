"""Keyed tables in Parquet: newest row per key, in buckets that split when they are full.

    rows/version=<v>/bucket=<depth>-<code>   rows whose key hash ends in the ``depth`` bits of ``code``
    directory/version=<v>                    one row per bucket: depth, code, the version that holds its files, its rows

A batch reads the buckets its keys fall into, merges, and writes them under its own version together with a new directory; buckets
it does not touch keep their files. A bucket that would pass ``capacity`` splits by further bits of the hash, so buckets stay small
however large the table grows, and readers open only the files the newest directory points to. Writing a version again replaces it, so a
repeated batch changes nothing. Files that neither the newest directory nor the one before it points to are removed.

Deleted keys stay as rows with op 'd', as an older change may still come, and are left out on reading.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.operators.upsert import latest_per_key

DIRECTORY = "depth int, code long, held_by long, n_rows long"
CAPACITY = 1_000_000


@dataclass(frozen=True)
class Bucket:
    depth: int
    code: int
    held_by: int
    n_rows: int

    @property
    def name(self) -> str:
        return f"{self.depth}-{self.code}"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], op: str | None = None, capacity: int = CAPACITY):
        self.spark, self.path, self.schema = spark, path, T.StructType(schema.fields)
        self.keys, self.order, self.op, self.capacity = list(keys), list(order), op, capacity

    # directory: one small row per ``capacity`` rows of the table, held on the driver like a list of files

    def versions(self) -> list[int]:
        fs, at = self._place(f"{self.path}/directory")
        return sorted(int(f.getPath().getName().removeprefix("version=")) for f in fs.listStatus(at)) if fs.exists(at) else []

    def directory(self, version: int | None) -> list[Bucket]:
        if version is None:
            return []
        return [Bucket(*r) for r in self.spark.read.schema(DIRECTORY).parquet(f"{self.path}/directory/version={version}").collect()]

    def newest(self, before: int | None = None) -> int | None:
        return max((v for v in self.versions() if before is None or v < before), default=None)

    def rows_of(self, buckets: Sequence[Bucket]) -> DataFrame:
        """Rows of the buckets, from their current files only."""
        if not buckets:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/version={b.held_by}/bucket={b.name}" for b in buckets])

    # routing

    def slot(self, depth: Column | int) -> Column:
        """The last ``depth`` bits of the hash of the key."""
        depth = F.lit(depth) if isinstance(depth, int) else depth
        return F.xxhash64(*self.keys).bitwiseAND((F.pow(F.lit(2.0), depth) - 1).cast("bigint"))

    def routed(self, rows: DataFrame, buckets: Sequence[Bucket]) -> DataFrame:
        """``rows`` with the ``bucket`` their key belongs to, by a directory as deep as its deepest bucket."""
        deepest = max(b.depth for b in buckets)
        if deepest == 0:
            return rows.withColumn("bucket", F.lit("0-0"))
        known = self.spark.createDataFrame([(b.depth, b.code, b.name) for b in buckets], "depth int, code long, bucket string")
        step = F.pow(F.lit(2.0), F.col("depth")).cast("bigint")
        slots = known.select("bucket", F.explode(F.sequence(F.col("code"), F.lit((1 << deepest) - 1).cast("bigint"), step)).alias("_slot"))
        return rows.withColumn("_slot", self.slot(deepest)).join(F.broadcast(slots), "_slot").drop("_slot")

    def split(self, bucket: Bucket, more: int) -> list[Bucket]:
        """The bucket itself, or the buckets it is split into so that each is about half full."""
        if bucket.n_rows + more <= self.capacity:
            return [bucket]
        bits = max(1, math.ceil(math.log2((bucket.n_rows + more) / (self.capacity / 2))))
        return [Bucket(bucket.depth + bits, bucket.code + (k << bucket.depth), bucket.held_by, 0) for k in range(1 << bits)]

    # batches

    def upsert(self, changes: DataFrame, version: int) -> None:
        """Merge a batch: newest row per key by ``order`` wins over what is stored."""
        before = self.newest(before=version)
        old = self.directory(before) or [Bucket(0, 0, version, 0)]
        staged = f"{self.path}/staged"
        latest_per_key(changes.select(*self.schema.names), self.keys, self.order).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
        new = self.spark.read.schema(self.schema).parquet(staged)
        counts = {r.bucket: r["count"] for r in self.routed(new.select(*self.keys), old).groupBy("bucket").count().collect()}
        touched = [b for b in old if b.name in counts]
        if not touched:
            return
        held = [b for b in touched if b.n_rows]
        target = [s for b in touched for s in self.split(b, counts[b.name])]
        folder = f"{self.path}/rows/version={version}"
        # rows are dealt once, by bucket, which brings those of a key together: at most a few buckets meet in one task
        place = lambda rows: self.routed(rows, target).repartition(2 * len(target), "bucket")
        merged = latest_per_key(place(self.rows_of(held).unionByName(new)), ["bucket", *self.keys], self.order) if held else place(new)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)
        wrote = {r.bucket: r["count"] for r in self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("bucket", T.StringType())])).parquet(folder).groupBy("bucket").count().collect()}
        kept = [b for b in old if b not in touched]
        now = kept + [Bucket(b.depth, b.code, version, wrote.get(b.name, 0)) for b in target]
        listed = self.spark.createDataFrame([(b.depth, b.code, b.held_by, b.n_rows) for b in now], DIRECTORY).coalesce(1)
        listed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/directory/version={version}")
        self.clear(version, before, now, old)
        self._remove(staged)

    def clear(self, version: int, before: int | None, now: Sequence[Bucket], old: Sequence[Bucket]) -> None:
        """Removes what neither this version's directory nor the one before it needs."""
        needed = {(b.held_by, b.name) for b in (*now, *old)}
        for v in [v for v in self.versions() if before is not None and v < before]:
            for b in self.directory(v):
                if (b.held_by, b.name) not in needed:
                    self._remove(f"{self.path}/rows/version={b.held_by}/bucket={b.name}")
            self._remove(f"{self.path}/directory/version={v}")

    def _place(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _remove(self, path: str) -> None:
        fs, at = self._place(path)
        fs.delete(at, True)

    def read(self) -> DataFrame:
        live = self.rows_of([b for b in self.directory(self.newest()) if b.n_rows])
        return live if self.op is None else live.where(F.coalesce(F.col(self.op), F.lit("r")) != "d")

"""State of a stream as tables: rows stay in folders, and a micro-batch works, as a plain batch job, on those the watermark can still reach."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.session import scratch_path
from tallyflow.streaming.run import each_batch, little_disk

#: Marks rows that take an earlier one back; they are counted, and not held.
BACK = "taken_back"


@dataclass(frozen=True)
class Past:
    """What a micro-batch knows of those before: rows still held, the watermark of the batch before it, which makes a row late, and its own."""

    held: DataFrame
    late: int
    watermark: int


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


class Tables:
    """Folders under ``path`` and marks that one micro-batch leaves for the next; for ``foreachBatch``.

        data/batch=<b>     the result of batch b
        marks/batch-<b>    a JSON text: among others ``seen``, ``watermark``, the folders still ``live`` and those ``gone``

    ``_take`` does a batch. Folders named gone go when the next batch has begun, as the batch is then committed; a repeated batch writes
    the same folders again.
    """

    spark: SparkSession
    stream: DataFrame
    schema: T.StructType
    path: str
    start: dict

    def _take(self, batch: DataFrame | None, number: int, name: str, was: dict) -> None:
        raise NotImplementedError

    def __call__(self, batch: DataFrame, number: int) -> None:
        self._take(batch, number, f"batch-{number}", self._before(number - 1))

    def close(self) -> None:
        """What a micro-batch without rows does at the end of the input: it brings the watermark to the newest time."""
        last = max((int(re.findall(r"\d+", n)[0]) for n in names_in(self.spark, f"{self.path}/marks")), default=None)
        if last is not None and not self._closed(last):
            self._take(None, -2 - last, f"batch-{last}-closed", self._marks(f"batch-{last}"))

    def _before(self, number: int) -> dict:
        if number < 0:
            return self.start
        return self._marks(f"batch-{number}-closed" if self._closed(number) else f"batch-{number}")

    def _closed(self, number: int) -> bool:
        return "_SUCCESS" in names_in(self.spark, f"{self.path}/marks/batch-{number}-closed")

    def _marks(self, name: str) -> dict:
        return json.loads(self.spark.read.schema("marks string").parquet(f"{self.path}/marks/{name}").first()[0])

    def _mark(self, name: str, was: dict, **marks) -> None:
        marks["gone"] = [*marks["gone"], *([f"marks/{was['name']}"] if "name" in was else [])]
        text = json.dumps(marks | {"name": name})
        self.spark.range(1).select(F.lit(text).alias("marks")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/{name}")

    def _sweep(self, was: dict) -> None:
        for folder in was["gone"]:
            delete(self.spark, f"{self.path}/{folder}")

    def _none(self, schema: T.StructType) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _read(self, folders: str | Sequence[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in ([folders] if isinstance(folders, str) else folders)])

    def run(self) -> None:
        """Everything available; a run after a stop goes on where it was."""
        with little_disk(self.spark):
            each_batch(self.stream, self.path, self).awaitTermination()
            self.close()

    def read(self) -> DataFrame:
        layout = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(layout).parquet(f"{self.path}/data").drop("batch")


class HeldWindows(Tables):
    """A step that holds rows for some time, and windows over what it lets pass, over the micro-batches of a stream.

        kept/batch-<b>     what ``step`` made of batch b, given what is held; with the column ``BACK``
        data/batch=<b>     what ``then`` made of the rows whose window batch b closed

    Results are those of a stateful step with event time followed by a window of ``width``: the watermark of a batch is the newest time
    seen before it, less ``lateness``, and starts at the epoch; a row is held until the watermark is ``keep_ms`` past it; a window closes
    once the watermark reaches its end, the last ones in ``close`` when the input is used up. No store is asked for single rows, and
    folders out of reach are removed.
    """

    start = {"seen": 0, "watermark": 0, "live": [], "gone": []}

    def __init__(self, stream: DataFrame, ts: str, width: str, step: Callable[[DataFrame, Past], DataFrame], then: Callable[[DataFrame], DataFrame], path: str, lateness: str, keep_ms: int):
        self.spark, self.stream, self.ts, self.step, self.then, self.path, self.keep_ms = stream.sparkSession, stream, ts, step, then, path, keep_ms
        self.width, self.lateness = (pd.Timedelta(t).value // 1000 for t in (width, lateness))
        none = self._none(stream.schema)
        kept = step(none, Past(none, 0, 0))
        self.layout = T.StructType(kept.schema.fields)
        out = then(kept).limit(0)
        out.write.mode("overwrite").parquet(f"{path}/data/batch=-1")
        self.schema = out.schema

    def _take(self, batch: DataFrame | None, number: int, name: str, was: dict) -> None:
        self._sweep(was)
        late, watermark = was["watermark"], max(0, was["watermark"], was["seen"] - self.lateness)
        live, seen = list(was["live"]), was["seen"]
        at = F.unix_micros(self.ts)
        if batch is not None:
            held = self._kept([f for f, _ in live]).where(~F.col(BACK) & (F.floor(at / 1000) + self.keep_ms >= late // 1000)).drop(BACK)
            folder = f"kept/{name}"
            self.step(batch.where(at > late), Past(held, late, watermark)).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            newest = self._kept([folder]).agg(F.max(at)).first()[0]
            if newest is not None:
                live.append([folder, newest])
                seen = max(seen, newest // 1000 * 1000)  # watermarks are whole milliseconds
        end = at - F.pmod(at, F.lit(self.width)) + self.width
        self.then(self._kept([f for f, _ in live]).where((end > late) & (end <= watermark))).write.mode("overwrite").parquet(f"{self.path}/data/batch={number}")
        reach = max(self.width, self.keep_ms * 1000 + 1000)
        stay = [x for x in live if x[1] + reach >= watermark]
        gone = [f for f, _ in live if f not in {s[0] for s in stay}]
        self._mark(name, was, seen=seen, watermark=watermark, live=stay, gone=gone)

    def _kept(self, folders: Sequence[str]) -> DataFrame:
        return self._read(folders, self.layout) if folders else self._none(self.layout)


def drain_windows(stream: DataFrame, ts: str, width: str, step: Callable[[DataFrame, Past], DataFrame], then: Callable[[DataFrame], DataFrame], name: str, keep_ms: int, lateness: str = "0 seconds") -> DataFrame:
    """Run ``step`` and the windows of ``then`` over everything available and read their output back."""
    windows = HeldWindows(stream, ts, width, step, then, scratch_path(stream.sparkSession, name), lateness, keep_ms)
    windows.run()
    return windows.read()

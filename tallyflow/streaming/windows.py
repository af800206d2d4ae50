"""Tumbling windows with the report fields of the window bounds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def tumble(stream: DataFrame, ts: str, width: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Keyed (or, without keys, global) event-time windows; emitted once the watermark passes their end.

    stt, edt and cur_date are texts of the window bounds.
    """
    out = stream.groupBy(F.window(ts, width), *keys).agg(*aggs)
    at = lambda bound, form: F.date_format(F.col(f"window.{bound}"), form)
    return out.select(
        at("start", "yyyy-MM-dd HH:mm:ss").alias("stt"), at("end", "yyyy-MM-dd HH:mm:ss").alias("edt"), at("start", "yyyy-MM-dd").alias("cur_date"), *[c for c in out.columns if c != "window"]
    )


def tumble_distinct(stream: DataFrame, ts: str, width: str, keys: Sequence[str], value: str, per_value: Sequence[Column], aggs: Sequence[Column]) -> DataFrame:
    """Windows over distinct values: rows are first collapsed to one per (window, keys, value) with ``per_value``, then
    aggregated per (window, keys). Both steps combine map-side and leave the state when the window closes; no set of values
    is carried in a row.
    """
    single = stream.groupBy(F.window(ts, width), *keys, value).agg(*per_value)
    return tumble(single.withColumn("window_ts", F.window_time("window")).drop("window"), "window_ts", width, keys, aggs)


class ClockWindows(StatefulProcessor):
    """Sums of one key per window of the clock; a timer at the end of each window sends it out and clears it."""

    def __init__(self, width_ms: int, keys: Sequence[str], sums: Sequence[str]):
        self.width_ms, self.keys, self.sums = width_ms, list(keys), list(sums)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", T.StructType().add("start", "long"), T.StructType().add("sums", T.ArrayType(T.LongType())))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.width_ms
        total = [sum(int(x) for x in parts) for parts in zip(*[[pdf[c].sum() for c in self.sums] for pdf in rows])]
        if self.open.containsKey((start,)):
            total = [a + b for a, b in zip(total, self.open.getValue((start,))[0])]
        else:
            self.handle.registerTimer(start + self.width_ms)
        self.open.updateValue((start,), (total,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.width_ms
        if self.open.containsKey((start,)):
            total = self.open.getValue((start,))[0]
            self.open.removeKey((start,))
            yield pd.DataFrame([(start, *key[: len(self.keys)], *total)], columns=["start_ms", *self.keys, *self.sums])

    def close(self) -> None:
        pass


def tumble_clock(stream: DataFrame, width_ms: int, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums of whole numbers per window of the clock (processing time) and key, or of all rows without keys.

    A row counts in the window in which its micro-batch runs; a window goes out with the first batch after its end, rows or none. Rows
    are summed inside the input partitions first, so a key with a third of all rows, or no key, is a few rows for its task. Run it
    with ``run.run_clock``: such a stream never ends by itself.
    """
    ks, names = list(keys) or ["clock_all"], list(sums)

    def reduce_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.Table.from_batches([batch]).group_by(ks).aggregate([(c, "sum") for c in names])
            yield from pa.table({**{k: got.column(k) for k in ks}, **{c: got.column(f"{c}_sum") for c in names}}).to_batches()

    given = stream if keys else stream.withColumn("clock_all", F.lit("all"))
    few = given.select(*[F.col(k).cast("string").alias(k) for k in ks], *[F.col(c).cast("bigint").alias(c) for c in names])
    few = few.mapInArrow(reduce_batches, few.schema)
    out = T.StructType([T.StructField("start_ms", T.LongType()), *[few.schema[k] for k in ks], *[few.schema[c] for c in names]])
    windows = few.groupBy(*ks).transformWithStateInPandas(ClockWindows(width_ms, ks, names), out, "Append", "ProcessingTime")
    at = lambda ms, form: F.date_format(F.timestamp_millis(ms), form)
    end = F.col("start_ms") + width_ms
    return windows.select(at(F.col("start_ms"), "yyyy-MM-dd HH:mm:ss").alias("stt"), at(end, "yyyy-MM-dd HH:mm:ss").alias("edt"), at(F.col("start_ms"), "yyyy-MM-dd").alias("cur_date"), *keys, *names)

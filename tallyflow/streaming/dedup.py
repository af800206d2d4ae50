"""Duplicates in streams: exact, newest only, retracting, held back, and probabilistic."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyflow.streaming.combine import keep_edge
from tallyflow.streaming.tables import BACK, Past

DAY_MS = 86_400_000


def exact(df: DataFrame, keys: Sequence[str], ts: str, horizon: str) -> DataFrame:
    """Each key once within ``horizon``, which must cover the longest repeat gap.

    First once per input partition, then over all: a record with very many copies shrinks before its final task.
    """
    marked = df.withColumn("_salt", F.spark_partition_id() % 32).withWatermark(ts, horizon)
    return marked.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(list(keys))


def read_state(names: Sequence[str], values: tuple) -> dict:
    """A state row as a dict. Its times come back without a zone, in the worker's local time; rows carry one."""
    return {n: v.astimezone() if isinstance(v, datetime) and v.tzinfo is None else v for n, v in zip(names, values)}


class NewestOnly(StatefulProcessor):
    """Passes every row of a key that is newer than the last one passed; the rows of a batch are taken in order."""

    def __init__(self, order: str, keep_ms: int | None):
        self.order, self.keep_ms = order, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", T.StructType().add("at", "long"), self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.last.get()
        last = held[0] if held else None
        for row in sorted(rows, key=lambda r: r[self.order]):
            if last is None or row[self.order] > last:
                last = row[self.order]
                yield row
        self.last.update((last,))

    def close(self) -> None:
        pass


def newest_only(df: DataFrame, key: str, order: str, keep_ms: int | None = None) -> DataFrame:
    """Rows newer than anything passed before for their key, however the input is cut into batches of ascending order.

    With ``keep_ms`` a key idle that long (wall clock) is forgotten. Such a stream runs on a clock, so it must be started with a
    processing-time trigger; with availableNow it would not end.
    """
    few = keep_edge(df, [key, order], [order])
    mode = "None" if keep_ms is None else "ProcessingTime"
    return few.groupBy(key).transformWithState(NewestOnly(order, keep_ms), few.schema, "Append", mode)


class Retract(StatefulProcessor):
    """On a new version of a key: the held row with negated amounts, then the new row.

    The negated row carries its own old time while windows of that time may still be open, and the new version's time afterwards.
    """

    def __init__(self, schema: T.StructType, order: str, amounts: Sequence[str], keep_ms: int):
        self.schema, self.order, self.amounts, self.keep_ms = schema, order, list(amounts), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.schema)

    def end(self, row) -> int:
        return int(row[self.order].timestamp() * 1000) + self.keep_ms

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = max(rows, key=lambda r: r[self.order])
        state = self.held.get()
        if state:
            old = read_state(self.schema.names, state)
            if best[self.order] <= old[self.order]:
                return
            for a in self.amounts:
                old[a] = -old[a] if old[a] is not None else None
            if old[self.order].timestamp() * 1000 <= timerValues.getCurrentWatermarkInMs():
                old[self.order] = best[self.order]
            yield Row(**old)
        self.held.update(tuple(best[n] for n in self.schema.names))
        self.handle.registerTimer(self.end(best))
        yield best

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.held.get()
        if state and self.end(read_state(self.schema.names, state)) <= expiredTimerInfo.getExpiryTimeInMs():
            self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def retract(df: DataFrame, key: str, ts: str, amounts: Sequence[str], lateness: str = "0 seconds", keep_ms: int = DAY_MS, past: Past | None = None) -> DataFrame:
    """Replaces earlier versions of a key in later sums. Versions inside one micro-batch cancel out, so only the last is kept there.

    A row is held until the watermark is ``keep_ms`` past it: the longest time after which a new version may still come. A
    correction reaches the window of the old version if it comes within ``lateness`` of the newest time; a later one is counted in
    the window of the new version, so sums over all windows are right in any case.

    With ``past``, ``df`` is a micro-batch and the held rows are a table (``tables.HeldWindows``): one aggregation per key over both in
    place of a state entry per key. Rows without a time are left out there; what is taken back carries the mark ``tables.BACK``.
    """
    if past is not None:
        return retract_held(df, key, ts, amounts, past)
    few = keep_edge(df, [key], [ts], last=True).withWatermark(ts, lateness)
    return few.groupBy(key).transformWithState(Retract(few.schema, ts, amounts, keep_ms), few.schema, "Append", "EventTime", eventTimeColumnName=ts)


def retract_held(rows: DataFrame, key: str, ts: str, amounts: Sequence[str], past: Past) -> DataFrame:
    """What ``Retract`` gives for a micro-batch: newest row of a key among those of the batch, before it the newest held one negated."""
    names, now, old = rows.columns, F.col("_now"), F.col("_old")
    both = rows.where(F.unix_micros(ts) > past.late).withColumn("_new", F.lit(True)).unionByName(past.held.withColumn("_new", F.lit(False)))
    newest = lambda flag: F.max_by(F.struct(*names), F.when(flag, F.col(ts)))
    pairs = both.groupBy(F.col(key).alias("_key")).agg(newest(F.col("_new")).alias("_now"), newest(~F.col("_new")).alias("_old"))
    fresh = pairs.where(now.isNotNull() & (old.isNull() | (now[ts] > old[ts])))
    passed = F.when(F.unix_micros(old[ts]) <= past.watermark, now[ts]).otherwise(old[ts])
    back = lambda c: (-old[c]).cast(rows.schema[c].dataType) if c in amounts else passed if c == ts else old[c]
    kept = F.struct(*[now[c].alias(c) for c in names], F.lit(False).alias(BACK))
    taken = F.struct(*[back(c).alias(c) for c in names], F.lit(True).alias(BACK))
    return fresh.select(F.inline(F.when(old.isNull(), F.array(kept)).otherwise(F.array(taken, kept))))


class HoldBack(StatefulProcessor):
    """Holds the latest version of a key and lets it go once no newer one has come for ``hold_ms`` of event time."""

    def __init__(self, schema: T.StructType, ts: str, hold_ms: int):
        self.schema, self.ts, self.hold_ms = schema, ts, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.schema)

    def due(self, row) -> int:
        return int(row[self.ts].timestamp() * 1000) + self.hold_ms

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.held.get()
        held = read_state(self.schema.names, state) if state else None
        for row in sorted(rows, key=lambda r: r[self.ts]):
            if held and row[self.ts] <= held[self.ts]:
                continue
            if held and self.due(held) <= int(row[self.ts].timestamp() * 1000):
                yield held if isinstance(held, Row) else Row(**held)
            held = row
        if held and isinstance(held, Row):
            self.held.update(tuple(held[n] for n in self.schema.names))
            self.handle.registerTimer(self.due(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.held.get()
        if state:
            row = read_state(self.schema.names, state)
            if self.due(row) <= expiredTimerInfo.getExpiryTimeInMs():
                self.held.clear()
                yield Row(**row)

    def close(self) -> None:
        pass


def hold_back(df: DataFrame, key: str, ts: str, hold_ms: int = 5000, lateness: str = "0 seconds") -> DataFrame:
    few = keep_edge(df, [key, ts], [ts]).withWatermark(ts, lateness)
    return few.groupBy(key).transformWithState(HoldBack(few.schema, ts, hold_ms), few.schema, "Append", "EventTime")


def bloom_size(expected: int, error: float) -> tuple[int, int]:
    """Bits and hash functions of a Bloom filter for ``expected`` keys at error rate ``error``."""
    bits = max(8, math.ceil(-expected * math.log(error) / math.log(2) ** 2))
    return bits, max(1, round(bits / expected * math.log(2)))


class Bloom(StatefulProcessor):
    """Blocks of bits per bucket of keys; a row passes when no block has all of its bits.

    A block takes the keys it was sized for; then one of twice the size and half the error is added, so that the errors of all
    blocks stay below ``error`` together, however many keys come. With ``confirmed``, the 128 bits of hashes of every key passed
    are kept too, and a row whose bits are all set is dropped only if its key is among them.
    """

    def __init__(self, expected: int, error: float, confirmed: bool = False):
        self.expected, self.error, self.confirmed = expected, error, confirmed

    def init(self, handle: StatefulProcessorHandle) -> None:
        block = T.StructType().add("used", "long").add("array", "binary")
        self.state = handle.getMapState("blocks", T.StructType().add("n", "long"), block)
        self.passed = handle.getListState("passed", T.StructType().add("keys", "binary"))

    def capacity(self, n: int) -> int:
        return self.expected << n

    def places(self, n: int, low: np.ndarray, high: np.ndarray) -> Iterator[np.ndarray]:
        """The bit of each key, for one hash function of block ``n`` after the other."""
        bits, hashes = bloom_size(self.capacity(n), self.error / 2 ** (n + 1))
        for i in range(hashes):
            yield (low + np.uint64(i) * high) % np.uint64(bits)

    def hit(self, n: int, array: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.ones(len(low), bool)
        for at in self.places(n, low, high):
            out &= (array[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out

    def put(self, blocks: list, low: np.ndarray, high: np.ndarray) -> None:
        """Sets the bits of new keys in the last block, and in further ones once it is full."""
        while len(low):
            if not blocks or blocks[-1][0] >= self.capacity(len(blocks) - 1):
                bits, _ = bloom_size(self.capacity(len(blocks)), self.error / 2 ** (len(blocks) + 1))
                blocks.append([0, np.zeros((bits + 7) // 8, np.uint8)])
            n, last = len(blocks) - 1, blocks[-1]
            take = min(len(low), self.capacity(n) - last[0])
            for at in self.places(n, low[:take], high[:take]):
                np.bitwise_or.at(last[1], at >> np.uint64(3), np.left_shift(1, at & np.uint64(7), dtype=np.uint64).astype(np.uint8))
            last[0] += take
            low, high = low[take:], high[take:]

    def known(self, added: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each key has been passed before, from the hashes kept."""
        seen: set = set()
        for part in [*(np.frombuffer(r[0], np.uint64).reshape(-1, 2) for r in self.passed.get()), *added]:
            seen.update(map(tuple, part[np.isin(part[:, 0], low)].tolist()))
        return np.array([k in seen for k in zip(low.tolist(), high.tolist())], bool)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        blocks: list = []
        while self.state.containsKey((len(blocks),)):
            used, array = self.state.getValue((len(blocks),))
            blocks.append([used, np.frombuffer(array, np.uint8).copy()])
        before, added = [b[0] for b in blocks], []
        for pdf in rows:
            pdf = pdf.drop_duplicates(["bloom_h1", "bloom_h2"])
            low, high = pdf["bloom_h1"].to_numpy().view(np.uint64), pdf["bloom_h2"].to_numpy().view(np.uint64)
            hit = np.zeros(len(pdf), bool)
            for n, (_, array) in enumerate(blocks):
                hit |= self.hit(n, array, low, high)
            if self.confirmed and hit.any():
                hit[hit] = self.known(added, low[hit], high[hit])
            fresh = ~hit
            if fresh.any():
                self.put(blocks, low[fresh], high[fresh])
                if self.confirmed:
                    added.append(np.stack([low[fresh], high[fresh]], axis=1))
                yield pdf[fresh]
        for n, (used, array) in enumerate(blocks):
            if n >= len(before) or used != before[n]:
                self.state.updateValue((n,), (used, array.tobytes()))
        if added:
            self.passed.appendValue((np.concatenate(added).tobytes(),))

    def close(self) -> None:
        pass


def bloom(df: DataFrame, keys: Sequence[str], expected_per_bucket: int = 100_000, error: float = 1e-9, buckets: int = 64, confirmed: bool = False) -> DataFrame:
    """Drops rows probably seen before; less than ``error`` of the new rows are dropped too, none with ``confirmed``.

    Buckets grow with their keys, by 6 bytes a key, with ``confirmed`` by 16 more; nothing expires, as a key may come again at any
    time. Raise ``buckets`` with the number of keys (``bloom_buckets``) to keep each of them small. Copies inside an input batch
    are dropped before the shuffle. Keys are told apart by 128 bits of hashes of their values and of which of them are null.
    """
    parts = [*keys, *[F.col(k).isNull() for k in keys]]
    marked = df.withColumn("bloom_h1", F.xxhash64(*parts)).withColumn("bloom_h2", F.xxhash64(F.lit("second"), *parts))
    few = keep_edge(marked.withColumn("bloom_bucket", F.pmod(F.col("bloom_h1"), F.lit(buckets))), list(keys), list(keys))
    out = few.groupBy("bloom_bucket").transformWithStateInPandas(Bloom(expected_per_bucket, error, confirmed), few.schema, "Append", "None")
    return out.drop("bloom_h1", "bloom_h2", "bloom_bucket")


def bloom_buckets(n_keys: int, expected_per_bucket: int = 100_000, least: int = 16) -> int:
    """Buckets in which ``n_keys`` keys fill about one block each."""
    return max(least, math.ceil(n_keys / expected_per_bucket))

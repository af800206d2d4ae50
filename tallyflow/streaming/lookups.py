"""Lookups on a dimension that changes while the stream runs."""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Whole microseconds survive the way through JSON.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


class VersionsAndFacts(StatefulProcessor):
    """Versions of the keys of one bucket, and its facts that wait until no earlier version can come any more.

    A fact leaves with the version that was valid at its own time once the watermark has passed it. Of the versions of a key the
    last one before the watermark and all later ones are kept.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        blob = T.StructType().add("blob", "binary")
        self.versions = handle.getValueState("versions", blob)
        self.waiting = handle.getValueState("waiting", blob)

    @staticmethod
    def load(state, empty):
        held = state.get()
        return pickle.loads(held[0]) if held else empty

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        versions: dict[str, list] = self.load(self.versions, {})
        waiting: list = self.load(self.waiting, [])
        for pdf in rows:
            for k, at, fact, dim in zip(pdf["lk_key"], pdf["lk_us"], pdf["lk_fact"], pdf["lk_dim"]):
                if fact is not None:
                    waiting.append((at, k, fact))
                elif k is not None:
                    versions.setdefault(k, []).append((at, dim))
        for v in versions.values():
            v.sort(key=lambda x: x[0])
        yield from self.release(versions, waiting, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.release(self.load(self.versions, {}), self.load(self.waiting, []), timerValues.getCurrentWatermarkInMs())

    def release(self, versions: dict[str, list], waiting: list, watermark: int) -> Iterator[pd.DataFrame]:
        out, kept = [], []
        for at, k, fact in waiting:
            if at // 1000 < watermark:
                known = versions.get(k, [])
                i = bisect_right(known, at, key=lambda v: v[0])
                out.append((fact, known[i - 1][1] if i else None))
            else:
                kept.append((at, k, fact))
        for k, known in versions.items():
            versions[k] = known[max(0, bisect_right(known, watermark * 1000 - 1, key=lambda v: v[0]) - 1) :]
        self.versions.update((pickle.dumps(versions),))
        self.waiting.update((pickle.dumps(kept),))
        if kept:
            self.handle.registerTimer(min(at for at, _, _ in kept) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=["fact", "dim"])

    def close(self) -> None:
        pass


def lookup_as_of(
    facts: DataFrame, changes: DataFrame, on: str, key: str, columns: Sequence[str], ts: str, changed_at: str,
    default: str | None = None, lateness: str = "0 seconds", buckets: int = 16, salts: int = 4,
) -> DataFrame:
    """Facts with the columns of the version of their key that was valid at the fact's time; ``default`` (texts) where there was none.

    ``changes`` are versions of dimension rows with the time from which each counts; a version with null columns ends the one before. Both
    streams share one watermark, the newest time seen less ``lateness``: a change may come that much after facts it applies to. The result
    does not depend on how the streams are cut into batches. Facts after the last watermark stay in the state.

    Keys are dealt to ``buckets``; each bucket is kept ``salts`` times, and facts are dealt over the copies, so a key that a third of all
    facts look up is several tasks' work. A bucket holds its versions in memory: raise ``buckets`` with the dimension.
    """
    named = facts.withColumn("lk_key", F.col(on).cast("string")).withColumn("lk_ts", F.col(ts))
    salt = F.pmod(F.xxhash64(F.col(ts)), F.lit(salts)).cast("int")
    mine = named.select("lk_key", "lk_ts", salt.alias("lk_salt"), F.to_json(F.struct(*facts.columns), JSON).alias("lk_fact"), F.lit(None).cast("string").alias("lk_dim"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    theirs = changes.select(
        F.col(key).cast("string").alias("lk_key"), F.col(changed_at).alias("lk_ts"), every.alias("lk_salt"), F.lit(None).cast("string").alias("lk_fact"), F.to_json(F.struct(*columns), JSON).alias("lk_dim")
    )
    both = mine.unionByName(theirs).withColumn("lk_us", F.unix_micros("lk_ts")).withColumn("lk_bucket", F.pmod(F.xxhash64("lk_key"), F.lit(buckets)) * salts + F.col("lk_salt"))
    both = both.where("lk_us is not null").withWatermark("lk_ts", lateness)
    joined = both.groupBy("lk_bucket").transformWithStateInPandas(VersionsAndFacts(), "fact string, dim string", "Append", "EventTime")
    dims = T.StructType([f for f in changes.schema.fields if f.name in columns])
    parsed = joined.select(F.from_json("fact", facts.schema, JSON).alias("f"), F.from_json("dim", dims, JSON).alias("d"))
    value = lambda c: F.col(f"d.{c}") if default is None else F.coalesce(F.col(f"d.{c}"), F.lit(default))
    return parsed.select("f.*", *[value(c).alias(c) for c in columns])

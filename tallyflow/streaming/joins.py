"""Stream-stream joins with bounded state, and stream-static lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.operators.dims import enrich
from tallyflow.session import scratch_path
from tallyflow.streaming.tables import Tables


def bounded(left: DataFrame, right: DataFrame, on: Mapping[str, str], left_ts: str, right_ts: str, before: str, after: str, how: str = "inner", lateness: str = "5 seconds") -> DataFrame:
    """Join where ``left_ts - before <= right_ts <= left_ts + after``. Both sides get a watermark, so old rows leave the state.

    Column names of the two sides must differ.
    """
    a, b = left.withWatermark(left_ts, lateness), right.withWatermark(right_ts, lateness)
    cond = None
    for x, y in on.items():
        cond = (a[x] == b[y]) if cond is None else cond & (a[x] == b[y])
    span = F.expr(f"{right_ts} >= {left_ts} - interval {before} and {right_ts} <= {left_ts} + interval {after}")
    return a.join(b, cond & span, how)


@dataclass(frozen=True)
class Near:
    """Rows of ``right`` with equal keys and ``left_ts - before <= right_ts <= left_ts + after``; column names of the two sides must differ."""

    right: DataFrame
    on: Mapping[str, str]
    left_ts: str
    right_ts: str
    before: str
    after: str
    how: str = "inner"  # or "left": a row of the left side that found no partner comes out once it can find none

    def pairs(self, left: DataFrame, right: DataFrame, *more) -> DataFrame:
        span = F.expr(f"{self.right_ts} >= {self.left_ts} - interval {self.before} and {self.right_ts} <= {self.left_ts} + interval {self.after}")
        return left.join(right, reduce(lambda a, b: a & b, [*[left[x] == right[y] for x, y in self.on.items()], span, *more]), self.how)

    def held(self, side: str) -> int:
        """Microseconds behind the watermark for which a row of a side may still find a partner."""
        return _micros(self.after if side == "left" else self.before)


def _micros(interval: str) -> int:
    return pd.Timedelta(interval).value // 1000


class NearJoins(Tables):
    """Joins by key and time range, inner or left, one after another, over the micro-batches of several streams.

        arrived/batch-<b>      rows of all streams that came with batch b: the side, its time, and one struct per side
        between/<k>/batch-<b>  what join k - 1 gave with batch b, the left side of join k
        marks/batch-<b>        newest time seen per stream, the watermark, and the batches whose rows may still find a partner

    State is the arrived rows themselves, as tables. A batch joins, with the plain joins of Spark, what came with it and what came before
    and lies within reach of the watermark, without the pairs of which both are old. So a row is written once and joined as often as
    batches pass until the watermark has left it behind; no store is asked for single rows. Batches out of reach are removed.

    Results are those of ``bounded``: the watermark of a batch is the least, over the streams, of the newest time seen before it, less
    ``lateness``, and starts at the epoch; rows not after the watermark of the batch before are late and left out; a later join of a
    chain lags by the reach of those before it. A left row of a left join that found no partner comes out, with nulls, in the batch whose
    watermark puts it out of reach, the last ones in ``close``; rows of the right side are kept as tables as long as such a left row may
    have met them.
    """

    def __init__(self, left: DataFrame, steps: Sequence[Near], path: str, lateness: str, then: Callable[[DataFrame], DataFrame]):
        self.spark, self.steps, self.path, self.lateness, self.then = left.sparkSession, list(steps), path, _micros(lateness), then
        self.schemas = [T.StructType(d.schema.fields) for d in (left, *[s.right for s in steps])]
        self.times = [steps[0].left_ts, *[s.right_ts for s in steps]]
        self.lags = [0]  # of each join behind the watermark
        for s in self.steps:
            self.lags.append(self.lags[-1] + max(s.held("left"), s.held("right")))
        self.stream = reduce(DataFrame.union, [self._sided(d.where(self._whole(d, i)), i) for i, d in enumerate((left, *[s.right for s in steps]))])
        shape = self._none(self.schemas[0])
        self.between = []  # schemas of what the joins give
        for s, schema in zip(self.steps, self.schemas[1:], strict=True):
            shape = s.pairs(shape, self._none(schema))
            self.between.append(T.StructType(shape.schema.fields))
        out = then(shape).limit(0)
        out.write.mode("overwrite").parquet(f"{path}/data/batch=-1")
        self.schema = out.schema

    def _whole(self, rows: DataFrame, side: int) -> Column:
        """Rows of a side with the keys without which they come to nothing; others do not move the watermark, as in joins of streams."""
        keys = list(self.steps[side - 1].on.values()) if side else []
        if side == 0 or self.steps[side - 1].how == "inner":
            keys += [x for s in self.steps if s.how == "inner" for x in s.on if x in rows.columns]
        return reduce(lambda c, k: c & F.col(k).isNotNull(), keys, F.lit(True))

    def _sided(self, rows: DataFrame, side: int) -> DataFrame:
        slot = lambda i: F.struct(*rows.columns) if i == side else F.lit(None)
        return rows.select(F.lit(side).alias("side"), F.col(self.times[side]).alias("at"), *[slot(i).cast(s).alias(f"s{i}") for i, s in enumerate(self.schemas)])

    @property
    def start(self) -> dict:
        return {"seen": [0] * len(self.times), "watermark": 0, "live": {}, "gone": []}

    def close(self) -> None:
        if any(s.how == "left" for s in self.steps):
            super().close()

    def _take(self, batch: DataFrame | None, number: int, name: str, was: dict) -> None:
        n, layout = len(self.steps), self.stream.schema
        self._sweep(was)
        watermark = max(0, was["watermark"], min(was["seen"]) - self.lateness)
        late = reduce(lambda c, i: c.when(F.col("side") == i, F.lit(was["watermark"] - self.lags[max(0, i - 1)])), range(1, n + 1), F.when(F.col("side") == 0, F.lit(was["watermark"])))
        arrived, newest = f"arrived/{name}", {}
        if batch is not None:
            batch.where(F.unix_micros("at") > late).write.mode("overwrite").parquet(f"{self.path}/{arrived}")
            found = self._read(arrived, layout).groupBy("side").agg(F.max(F.unix_micros("at"))).collect()
            newest = {f"s{side}": [arrived, at] for side, at in found}
        live: dict[str, list] = {}

        def side(part_of: str, schema: T.StructType, at: str, floor: int, keep: int, flag: str) -> DataFrame:
            """Rows of a side that are new or may still find a partner; notes which folders the next batch needs."""
            old, now = was["live"].get(part_of, []), [newest[part_of]] if part_of in newest else []
            live[part_of] = [x for x in (*old, *now) if x[1] > keep]
            part = lambda folders, new: self._side(part_of, [x[0] for x in folders], schema, layout).withColumn(flag, F.lit(new))
            return part(now, True) if not old else part(now, True).union(part(old, False).where(F.unix_micros(at) > floor))

        for k, step in enumerate(self.steps):
            left = "s0" if k == 0 else f"b{k}"
            schema = self.schemas[0] if k == 0 else self.between[k - 1]
            floor, keep, met = was["watermark"] - self.lags[k], watermark - self.lags[k], step.held("left") if step.how == "left" else 0
            a = side(left, schema, step.left_ts, floor - step.held("left"), keep - step.held("left"), "_left_new")
            b = side(f"s{k + 1}", self.schemas[k + 1], step.right_ts, floor - step.held("right") - met, keep - step.held("right") - met, "_right_new")
            if step.how == "left":
                lost = F.col("_right_new").isNull() & (F.unix_micros(step.left_ts) <= keep - step.held("left"))
                joined = step.pairs(a, b).where(lost | (F.col("_right_new").isNotNull() & (F.col("_left_new") | F.col("_right_new"))))
            else:
                joined = step.pairs(a, b, F.col("_left_new") | F.col("_right_new"))
            joined = joined.drop("_left_new", "_right_new")
            if k + 1 < n:
                folder = f"between/{k + 1}/{name}"
                joined.write.mode("overwrite").parquet(f"{self.path}/{folder}")
                last = self._read(folder, self.between[k]).agg(F.max(F.unix_micros(self.steps[k + 1].left_ts))).first()[0]
                if last is not None:
                    newest[f"b{k + 1}"] = [folder, last]
            else:
                self.then(joined).write.mode("overwrite").parquet(f"{self.path}/data/batch={number}")

        # watermarks are whole milliseconds
        seen = [max(s, newest[f"s{i}"][1] // 1000 * 1000) if f"s{i}" in newest else s for i, s in enumerate(was["seen"])]
        folders = lambda sides: {x[0] for rows in sides.values() for x in rows}
        gone = (folders(was["live"]) | folders({"": newest.values()}) | ({arrived} if batch is not None else set())) - folders(live)
        self._mark(name, was, seen=seen, watermark=watermark, live=live, gone=sorted(gone))

    def _side(self, name: str, folders: Sequence[str], schema: T.StructType, arrived: T.StructType) -> DataFrame:
        if not folders:
            return self._none(schema)
        if name[0] == "b":
            return self._read(folders, schema)
        return self._read(folders, arrived).where(F.col("side") == int(name[1:])).select(f"{name}.*")


def drain_near(left: DataFrame, steps: Sequence[Near], name: str, then: Callable[[DataFrame], DataFrame], lateness: str = "5 seconds") -> DataFrame:
    """Run a chain of joins over everything available; ``then`` makes the result of a batch from its joined rows."""
    joins = NearJoins(left, steps, scratch_path(left.sparkSession, name), lateness, then)
    joins.run()
    return joins.read()


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """All columns renamed with a prefix, except ``keep``."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def lookup(stream: DataFrame, dim: DataFrame, on: str, key: str, columns: Mapping[str, str], default: str | None = None) -> DataFrame:
    """Static dimension attached to a stream; the dimension is read again for every micro-batch."""
    return enrich(stream, dim, on, key, columns, default)


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    """Turn event-time columns into ordinary timestamps; a stream may carry only one event time into the next join."""
    return df.withColumns({c: F.timestamp_micros(F.unix_micros(F.col(c))) for c in columns})

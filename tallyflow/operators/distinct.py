"""Distinct counts over nested horizons, without copying log rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import days_before, within
from tallyflow.operators.horizons import HORIZONS


def horizon_profile(
    log: DataFrame, as_of: str, keys: Sequence[str], sums: Mapping[str, Column], distinct: Mapping[str, str], days: Sequence[int] = HORIZONS, dt: str = "dt"
) -> DataFrame:
    """Sums and distinct counts per key for every horizon that ends on ``as_of``, one row per key and horizon with rows.

    Horizons are nested, so a value counts in all of them that reach back to the last day it was seen: the log is collapsed once,
    map-side, to (key, values) with that day and the sums of each horizon. Only collapsed rows are copied, once per counted column; a key with
    a third of all rows spreads over its values until the last, combining, step. NULL values are not counted.
    """
    names, spans = list(distinct), sorted(days)
    inside = lambda n: F.col(dt) >= days_before(as_of, n - 1)
    measure = {f"_{c}_{n}": F.sum(F.when(inside(n), v)) for n in spans for c, v in {**sums, "_rows": F.lit(1)}.items()}
    wide = log.where(within(as_of, spans[-1], dt)).groupBy(*keys, *distinct.values()).agg(F.max(dt).alias("_last"), *[v.alias(c) for c, v in measure.items()])
    # the sums travel with the first counted column only
    copies = [
        F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v"), *[(F.col(m) if i == 0 else F.lit(None)).alias(m) for m in measure]) for i, c in enumerate(distinct.values())
    ]
    single = wide.select(*keys, "_last", F.explode(F.array(*copies)).alias("x")).groupBy(*keys, "x.i", "x.v").agg(F.max("_last").alias("_last"), *[F.sum(f"x.{m}").alias(m) for m in measure])
    seen = lambda i, n: F.count_if((F.col("i") == i) & F.col("v").isNotNull() & (F.col("_last") >= days_before(as_of, n - 1)))
    per_key = single.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measure], *[seen(i, n).alias(f"_{c}_{n}") for n in spans for i, c in enumerate(names)])
    rows = [F.struct(F.lit(n).alias("recent_days"), F.col(f"__rows_{n}").alias("_rows"), *[F.col(f"_{c}_{n}").alias(c) for c in (*sums, *names)]) for n in spans]
    return per_key.select(*keys, F.inline(F.array(*rows))).where("_rows > 0").drop("_rows")


def daily_bitmaps(log: DataFrame, keys: Sequence[str], number: str, dt: str = "dt") -> DataFrame:
    """The distinct whole numbers of each day and key as bitmaps, one per block of 32,768 numbers; for dense ids.

    Stored once per day; longer spans merge them and never read the log again.
    """
    block, bit = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    return log.where(F.col(number).isNotNull()).groupBy(dt, *keys, block.alias("block")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def bitmap_horizons(daily: DataFrame, as_of: str, keys: Sequence[str], name: str, days: Sequence[int] = HORIZONS, dt: str = "dt") -> DataFrame:
    """Exact distinct counts per key and horizon from daily bitmaps: the union of a block's days, then bits counted."""
    spans = sorted(days)
    merged = [F.bitmap_or_agg(F.when(F.col(dt) >= days_before(as_of, n - 1), F.col("bits"))).alias(f"_{n}") for n in spans]
    blocks = daily.where(within(as_of, spans[-1], dt)).groupBy(*keys, "block").agg(*merged)
    wide = blocks.groupBy(*keys).agg(*[F.sum(F.bitmap_count(f"_{n}")).alias(f"_{n}") for n in spans])
    return wide.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("recent_days"), F.col(f"_{n}").alias(name)) for n in spans]))).where(F.col(name) > 0)

"""Recent-days summaries: 1, 7 and 30 days up to a business date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import day, days_before, within

HORIZONS = (1, 7, 30)


def explode_horizons(df: DataFrame, as_of: str, days: Sequence[int] = HORIZONS, dt: str = "dt") -> DataFrame:
    """Each row once per horizon it falls in, as ``recent_days``.

    The widest horizon is a plain filter below the explode, so it prunes partitions and reaches the scan.
    """
    wide = df.where(within(as_of, max(days), dt))
    tagged = wide.withColumn("recent_days", F.explode(F.array(*[F.lit(d) for d in days])))
    return tagged.where(F.col(dt) >= F.date_sub(day(as_of), F.col("recent_days") - 1))


def horizon_sums(
    df: DataFrame, as_of: str, keys: Sequence[str], measures: Sequence[str], days: Sequence[int] = (7, 30), dt: str = "dt"
) -> DataFrame:
    """Wide sums per horizon, ``<measure>_<n>d``, in one pass without copying rows."""
    widest = max(days)
    aggs: list[Column] = []
    for n in days:
        for m in measures:
            value = F.col(m) if n == widest else F.when(F.col(dt) >= days_before(as_of, n - 1), F.col(m)).otherwise(0)
            aggs.append(F.sum(value).alias(f"{m}_{n}d"))
    return df.where(within(as_of, widest, dt)).groupBy(*keys).agg(*aggs)


def horizon_rows(wide: DataFrame, keys: Sequence[str], measures: Sequence[str], days: Sequence[int] = (7, 30)) -> DataFrame:
    """Wide horizon columns to one row per horizon."""
    rows = [
        F.struct(F.lit(n).alias("recent_days"), *[F.col(f"{m}_{n}d").alias(m) for m in measures]) for n in days
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def fixed_horizon(df: DataFrame, as_of: str, days: int, dt: str = "dt") -> DataFrame:
    return df.where(within(as_of, days, dt))


def horizon_agg(
    df: DataFrame, as_of: str, keys: Sequence[str], aggs: Sequence[Column], days: Sequence[int] = HORIZONS, dt: str = "dt"
) -> DataFrame:
    """Any aggregates per horizon, as rows; for measures that do not add up over days (distinct counts)."""
    return explode_horizons(df, as_of, days, dt).groupBy("recent_days", *keys).agg(*aggs)

"""To-date totals: rebuilt from history, or carried from yesterday plus today."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import day


def rebuild(daily: DataFrame, keys: Sequence[str], measures: Sequence[str], first: str, last: str, as_of: str) -> DataFrame:
    """First day, last day and totals over all days up to ``as_of``."""
    return (
        daily.where(F.col("dt") <= day(as_of))
        .groupBy(*keys)
        .agg(F.min("dt").alias(first), F.max("dt").alias(last), *[F.sum(m).alias(m) for m in measures])
    )


def carry_union(held: DataFrame, today: DataFrame, keys: Sequence[str], measures: Sequence[str], first: str, last: str) -> DataFrame:
    """Yesterday's totals and today's rows stacked, then summed: one shuffle on the keys."""
    new = today.select(*keys, F.col("dt").alias(first), F.col("dt").alias(last), *measures)
    return (
        held.select(*keys, first, last, *measures)
        .unionByName(new)
        .groupBy(*keys)
        .agg(F.min(first).alias(first), F.max(last).alias(last), *[F.sum(m).alias(m) for m in measures])
    )


def carry_full_join(held: DataFrame, today: DataFrame, keys: Sequence[str], measures: Sequence[str], first: str, last: str) -> DataFrame:
    """The same by full outer join; one row per key on both sides."""
    new = today.select(*keys, F.col("dt").alias("_dt"), *[F.col(m).alias(f"_{m}") for m in measures])
    both = held.select(*keys, first, last, *measures).join(new, list(keys), "full")
    return both.select(
        *keys,
        F.coalesce(first, "_dt").alias(first),
        F.coalesce("_dt", last).alias(last),
        *[(F.coalesce(m, F.lit(0)) + F.coalesce(f"_{m}", F.lit(0))).alias(m) for m in measures],
    )

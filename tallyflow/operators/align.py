"""Metric streams side by side on shared keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_union(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer alignment as one union and one aggregate; each part has one row per key."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])


def align_join(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The same by chained full outer joins; NULL keys meet each other, as they do in the union form."""

    def full(a: DataFrame, b: DataFrame) -> DataFrame:
        right = b.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        both = a.join(right, reduce(lambda x, y: x & y, same), "full")
        measures = [c for c in [*a.columns, *b.columns] if c not in keys]
        return both.select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], *measures)

    return reduce(full, parts)


def signed_balance(plus: DataFrame, minus: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """plus − minus per key, by UNION ALL of signed rows."""
    negative = minus.select(*keys, *[(-F.col(m)).alias(m) for m in measures])
    return plus.select(*keys, *measures).unionByName(negative).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])

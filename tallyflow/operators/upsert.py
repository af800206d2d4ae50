"""Keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Last version per key as an aggregate: combined map-side, a hot key is one row per task."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def merge_latest(stored: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str | None = None) -> DataFrame:
    """Stored rows ∪ changes, newest wins; with ``op`` a newest 'd' removes the key."""
    both = stored.unionByName(changes, allowMissingColumns=True)
    newest = latest_per_key(both, keys, order)
    return newest if op is None else newest.where(F.coalesce(F.col(op), F.lit("r")) != "d")

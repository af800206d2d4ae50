"""Next-row and row-number steps that stay whole when one key holds a large part of the rows.

A key's timeline is cut into slices (for example hours). Each (key, slice) is ordered in its own task;
one small row per slice then carries the row count and the first value over to the slice before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_and_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column, value: str, step: str = "rn", following: str = "next_value"
) -> DataFrame:
    """row_number() and lead(value) over (partition by keys order by order).

    ``slice_by`` must not decrease along ``order``. ``order`` should be unique per key. There may be as many slices as rows, and behind
    a parsed log their size is guessed far too small, so the join back is a sort merge by hint and never a broadcast.
    """
    sliced = df.withColumn("_slice", slice_by)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = sliced.withColumn("_rn", F.row_number().over(inside)).withColumn("_next", F.lead(value).over(inside))

    slices = sliced.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(value), F.struct(*order)).alias("_first")
    )
    along = Window.partitionBy(*keys).orderBy("_slice")
    edges = slices.select(
        *keys,
        "_slice",
        "_n",
        F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_first").over(along)[value].alias("_next_first"),
    )
    same = [local[k].eqNullSafe(edges[k]) for k in [*keys, "_slice"]]
    joined = local.join(edges.hint("merge"), same, "inner")
    return joined.select(
        *[local[c] for c in df.columns],
        (F.col("_rn") + F.col("_before")).alias(step),
        F.when(F.col("_rn") == F.col("_n"), F.col("_next_first")).otherwise(F.col("_next")).alias(following),
    )


def consecutive_by_lead(days: DataFrame, key: str, length: int, gap: int | None = None, dt: str = "dt") -> DataFrame:
    """Keys with ``length`` active days in a row: the day length-1 rows ahead is length-1 days later.

    ``days`` holds distinct (key, day) rows of a bounded horizon. With ``gap`` the distance may be up to ``gap``.
    """
    w = Window.partitionBy(key).orderBy(dt)
    ahead = F.datediff(F.lead(dt, length - 1, "9999-12-31").over(w), F.col(dt))
    spread = days.select(key, ahead.alias("diff"))
    hit = F.col("diff") == length - 1 if gap is None else F.col("diff") <= gap
    return spread.where(hit).select(key).distinct()


def consecutive_by_islands(days: DataFrame, key: str, length: int, dt: str = "dt") -> DataFrame:
    """Same keys by islands: day minus row number is constant along a run."""
    w = Window.partitionBy(key).orderBy(dt)
    runs = days.select(key, F.date_sub(F.col(dt), F.row_number().over(w)).alias("run"))
    return runs.groupBy(key, "run").count().where(F.col("count") >= length).select(key).distinct()


def consecutive_by_mask(days: DataFrame, key: str, length: int, as_of: Column, dt: str = "dt") -> DataFrame:
    """Same keys by a bit per day: one aggregate, no window and no sort."""
    bit = F.expr(f"shiftleft(1L, datediff(_as_of, {dt}))")
    masks = days.withColumn("_as_of", as_of).groupBy(key).agg(F.bit_or(bit).alias("mask"))
    return masks.where(F.bin("mask").contains("1" * length)).select(key)

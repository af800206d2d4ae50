"""Top lists and ranks, inside a group or over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_with_ties(df: DataFrame, group: Sequence[str], by: str, n: int, out: str = "rk") -> DataFrame:
    """rank() <= n: Spark cuts each task to the first n ranks before the shuffle, so a hot group stays small."""
    w = Window.partitionBy(*group).orderBy(F.desc(by))
    return df.withColumn(out, F.rank().over(w)).where(F.col(out) <= n)


def top_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, out: str = "rn") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def best_row(df: DataFrame, group: Sequence[str], by: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """The row with the greatest ``by`` per group, as an aggregate: combined map-side, no sort of the group."""
    key = F.struct(*by)
    picked = df.groupBy(*group).agg(F.max_by(F.struct(*keep), key).alias("_row"))
    return picked.select(*group, "_row.*")


def first_row(df: DataFrame, group: Sequence[str], by: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """The row with the least ``by`` per group."""
    key = F.struct(*by)
    picked = df.groupBy(*group).agg(F.min_by(F.struct(*keep), key).alias("_row"))
    return picked.select(*group, "_row.*")


def rank_whole(df: DataFrame, by: str, out: str = "rk", descending: bool = True, slices: int | None = None) -> DataFrame:
    """Exact rank() over the whole table without putting it in one task.

    Equal values are counted first (a hot value is one row), the distinct values are cut into ordered slices,
    ranked inside their slice, and shifted by the row count of the slices before. Unless given, there are two slices for each
    shuffle partition, so a task's share stays as large as elsewhere. Only the slice totals, ``slices`` + 2 rows, meet in one task. NULL ranks last. ``df`` is read four times: give a stored table, or
    materialise an expensive plan first.
    """
    slices = slices or max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = df.groupBy(F.col(by).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    cuts = counts.agg(F.percentile_approx("_value", [i / slices for i in range(1, slices)], 10000).alias("cuts"))
    position = F.size(F.filter("_cuts", lambda c: c < F.col("_value")))
    ordered = F.lit(slices) - position if descending else position
    last = F.col("_value").isNull() | F.col("_cuts").isNull()
    sliced = counts.withColumn("_cuts", cuts.scalar()).withColumn("_slice", F.when(last, slices + 1).otherwise(ordered)).drop("_cuts")

    totals = sliced.groupBy("_slice").agg(F.sum("_n").alias("_total"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_shift"))

    way = F.desc("_value") if descending else F.asc("_value")
    inside = Window.partitionBy("_slice").orderBy(way).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sliced.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(shifts, "_slice")
        .select("_value", (F.col("_before") + F.col("_shift") + 1).alias(out))
    )
    return df.join(ranked, F.col(by).eqNullSafe(F.col("_value")), "left").drop("_value")


def percent_rank_whole(df: DataFrame, by: str, out: str, descending: bool = True) -> DataFrame:
    """percent_rank() over the whole table: (rank - 1) / (rows - 1)."""
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    ranked = rank_whole(df, by, "_rk", descending)
    return ranked.withColumn(out, F.coalesce(F.try_divide((F.col("_rk") - 1).cast("double"), (rows - 1).cast("double")), F.lit(0.0))).drop("_rk")

"""Points linked to the intervals they fall in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Points that one slice may hold.
MOST = 4096
PARTS = 256


def link_points(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str, unit: str = "HOUR", most: int = MOST) -> DataFrame:
    """Inner join of points to intervals with start <= at <= end and equal keys.

    Both sides are cut into time slices and joined on (keys, slice): an interval is copied once per slice it spans, a point meets only
    intervals of its own slice. A point lies in one slice, so every pair comes out once.

    A slice is a ``unit``. One that holds more than ``most`` points of a key is cut at the quantiles of those points, and where many
    share one moment they are dealt over several copies of it; so a key with a third of all rows in one hour is many tasks' work, and an
    interval meets few points that lie outside it.
    """
    by = [*keys, "_slice"]
    p = points.withColumn("_slice", F.date_trunc(unit, F.col(at))).withColumn("_us", _micros(at))
    i = intervals.withColumn("_slice", F.explode(F.sequence(F.date_trunc(unit, F.col(start)), F.date_trunc(unit, F.col(end)), F.expr(f"interval 1 {unit}"))))
    cuts = crowded_slices(p, by, most)
    p, i = p.join(cuts, by, "left"), i.join(cuts, by, "left")
    below = lambda us: F.size(F.filter("_cuts", lambda c: c < us))
    p = p.withColumn("_part", F.when(F.col("_cuts").isNull(), 0).otherwise(below(F.col("_us"))))
    p = p.withColumn("_copy", F.when(F.col("_cuts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*points.columns), F.element_at("_copies", F.col("_part") + 1)).cast("int")))
    first, last = F.when(F.col("_cuts").isNull(), 0).otherwise(below(_micros(start))), F.when(F.col("_cuts").isNull(), 0).otherwise(below(_micros(end)))
    i = i.withColumn("_part", F.explode(F.sequence(first, last)))
    i = i.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.when(F.col("_cuts").isNull(), 0).otherwise(F.element_at("_copies", F.col("_part") + 1) - 1))))
    own = ["_slice", "_cuts", "_copies", "_us", "_part", "_copy"]
    joined = p.drop("_cuts", "_copies", "_us").join(i.drop("_cuts", "_copies"), [*by, "_part", "_copy"], "inner")
    return joined.where(F.col(at).between(F.col(start), F.col(end))).drop(*own)


def crowded_slices(points: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """For each group with more than ``most`` points: the moments that cut it, and into how many copies each part is dealt.

    Cuts are quantiles, at most ``PARTS`` parts; what a part holds beyond ``most`` (points of one moment, or a very large group) is dealt
    over copies. One row per crowded group.
    """
    full = points.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*by)
    inside = points.join(full, list(by), "left_semi")
    quantiles = F.percentile_approx("_us", [k / PARTS for k in range(1, PARTS)], 10 * PARTS)
    cuts = inside.groupBy(*by).agg(F.array_sort(F.array_distinct(quantiles)).alias("_cuts"))
    parts = inside.join(cuts, list(by)).groupBy(*by, "_cuts", F.size(F.filter("_cuts", lambda c: c < F.col("_us"))).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    held = parts.groupBy(*by, "_cuts").agg(F.map_from_entries(F.collect_list(F.struct("_part", "_n"))).alias("_held"))
    every = F.transform(F.sequence(F.lit(0), F.size("_cuts")), lambda k: F.greatest(F.lit(1), F.ceil(F.coalesce(F.try_element_at("_held", k), F.lit(0)) / most)).cast("int"))
    return held.select(*by, "_cuts", every.alias("_copies"))


def _micros(at: str):
    return F.unix_micros(F.col(at).cast("timestamp"))

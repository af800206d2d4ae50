"""Tables kept up by signed changes: inserted rows weigh +1, deleted rows -1, a corrected row is both.

Changes go through joins and sums, so a late or corrected row restates only its own keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.todate import rebuild

WEIGHT = "weight"


def signed(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Changes as one frame of weighted rows."""
    parts = [df.withColumn(WEIGHT, F.lit(w).cast("bigint")) for df, w in ((inserted, 1), (deleted, -1)) if df is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def changes_between(old: DataFrame, new: DataFrame) -> DataFrame:
    """What turns ``old`` into ``new``; rows both hold equally often cancel out."""
    both = signed(new.select(*old.columns), old)
    return both.groupBy(*old.columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)


def joined_changes(left: DataFrame, left_changes: DataFrame, right: DataFrame, right_changes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Changes of an inner join from the changes of its sides: new left rows with the old right, all left rows with the new right ones.

    ``left`` and ``right`` are the tables before the changes. Only changed rows are joined, so nothing but them is shuffled apart from
    the keys they meet.
    """
    on = list(on)
    a = left_changes.join(right, on)
    after = left.withColumn(WEIGHT, F.lit(1).cast("bigint")).unionByName(left_changes)
    b = after.join(right_changes.withColumnRenamed(WEIGHT, "_w"), on).withColumn(WEIGHT, F.col(WEIGHT) * F.col("_w")).drop("_w")
    return a.unionByName(b.select(*a.columns))


def summed_changes(changes: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str) -> DataFrame:
    """Changes of sums and row counts per key."""
    sums = [F.sum(F.col(m) * F.col(WEIGHT)).alias(m) for m in measures]
    return changes.groupBy(*keys).agg(F.sum(WEIGHT).alias(count), *sums)


def applied(held: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str) -> DataFrame:
    """Sums after their changes; a key without rows left is gone."""
    cols = [count, *measures]
    both = held.select(*keys, *cols).unionByName(delta.select(*keys, *cols))
    return both.groupBy(*keys).agg(*[F.sum(c).cast(held.schema[c].dataType).alias(c) for c in cols]).where(F.col(count) != 0)


def restated(to_date: DataFrame, daily: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str], first: str, last: str, as_of: str) -> DataFrame:
    """To-date rows after a change of ``daily``: only the keys in ``delta`` are built again, from their own days; the others stay as they are.

    First and last day cannot be taken back by subtraction, so they come from the days that are left.
    """
    touched = delta.select(*keys).distinct()
    again = rebuild(daily.join(touched, list(keys), "left_semi"), keys, measures, first, last, as_of)
    return to_date.join(touched, list(keys), "left_anti").unionByName(again.select(*to_date.columns))

"""Dimension history (validity ranges) and accumulating facts.

Every builder returns the new state; writing it over the table it was read from goes through
``sources.sinks.replace_partitions``, which materialises first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.times import OPEN_END, day, days_before


def history_init(rows: DataFrame, start: Column) -> DataFrame:
    """First load: every row valid from ``start`` with an open end."""
    return rows.withColumn("start_date", start).withColumn("end_date", day(OPEN_END))


def history_rank(held: DataFrame, changes: DataFrame, key: str, as_of: str) -> DataFrame:
    """Open rows ∪ today's changes: the newest version stays open, the older closes the day before.

    ``changes`` may hold several versions of a key; the last by ``operate_time`` counts. At most two rows
    meet per key afterwards, so the window never sorts a large group.
    """
    cols = [c for c in held.columns if c not in ("start_date", "end_date")]
    latest = changes.groupBy(key).agg(F.max_by(F.struct(*cols), F.col("operate_time")).alias("_r")).select("_r.*")
    new = latest.withColumn("start_date", day(as_of)).withColumn("end_date", day(OPEN_END))
    w = Window.partitionBy(key).orderBy(F.desc("start_date"))
    both = held.where(F.col("end_date") == day(OPEN_END)).unionByName(new).withColumn("_rn", F.row_number().over(w))
    return both.withColumn("end_date", F.when(F.col("_rn") == 1, F.col("end_date")).otherwise(days_before(as_of, 1))).drop("_rn")


def history_compare(held: DataFrame, current: DataFrame, key: str, tracked: Sequence[str], as_of: str) -> DataFrame:
    """All current rows ∪ old rows whose tracked columns differ, closed with is_current 0."""
    now = current.select(key, *[F.col(t).alias(f"_{t}") for t in tracked])
    differs = ~F.lit(True)
    for t in tracked:
        differs = differs | ~F.col(t).eqNullSafe(F.col(f"_{t}"))
    joined = held.where(F.col("is_current") == 1).join(now, key, "inner")
    closed = (
        joined.where(differs)
        .select(*held.columns)
        .withColumn("end_date", days_before(as_of, 1))
        .withColumn("is_current", F.lit(0))
    )
    opened = current.select(key, *tracked).withColumn("start_date", day(as_of)).withColumn("end_date", day(OPEN_END)).withColumn("is_current", F.lit(1))
    return opened.unionByName(closed.select(*opened.columns))


def history_lag(snapshots: DataFrame, key: str, tracked: Sequence[str], dt: str = "dt") -> DataFrame:
    """Ranges from daily snapshots: a row starts where a tracked column differs from the day before."""
    w = Window.partitionBy(key).orderBy(dt)
    changed = F.row_number().over(w) == 1
    for t in tracked:
        changed = changed | ~F.col(t).eqNullSafe(F.lag(t).over(w))
    starts = snapshots.withColumn("_changed", changed).where("_changed").select(key, *tracked, F.col(dt).alias("start_date"))
    ends = Window.partitionBy(key).orderBy("start_date")
    end = F.coalesce(F.date_sub(F.lead("start_date").over(ends), 1), day(OPEN_END))
    ranged = starts.withColumn("end_date", end)
    return ranged.withColumn("is_current", (F.col("end_date") == day(OPEN_END)).cast("int"))


def flow_first(orders: DataFrame, payments: DataFrame, finishes: DataFrame) -> DataFrame:
    """Order life cycle, first load: closed rows go to their finish date, open rows to the open end."""
    joined = orders.join(payments, "order_id", "left").join(finishes, "order_id", "left")
    return joined.withColumn("dt", F.coalesce(F.to_date("finish_time"), day(OPEN_END)))


def flow_daily(held_open: DataFrame, new_orders: DataFrame, payments: DataFrame, finishes: DataFrame) -> DataFrame:
    """Order life cycle, daily: open ∪ new, payment and finish filled once, then re-dated."""
    opened = held_open.drop("dt").unionByName(new_orders, allowMissingColumns=True)
    pay = payments.select("order_id", F.col("payment_time").alias("_pt"), F.col("payment_amount").alias("_pa"))
    fin = finishes.select("order_id", F.col("finish_time").alias("_ft"))
    joined = opened.join(pay, "order_id", "left").join(fin, "order_id", "left")
    filled = (
        joined.withColumn("payment_time", F.coalesce("payment_time", "_pt"))
        .withColumn("payment_amount", F.coalesce("payment_amount", "_pa"))
        .withColumn("finish_time", F.coalesce("finish_time", "_ft"))
        .drop("_pt", "_pa", "_ft")
    )
    return filled.withColumn("dt", F.coalesce(F.to_date("finish_time"), day(OPEN_END)))


def event_from_open(open_orders: DataFrame, new_orders: DataFrame, changes: DataFrame, from_status: Sequence[str], to_status: Sequence[str]) -> DataFrame:
    """Daily event: today's status change ⋈ (open orders in an earlier status ∪ today's new orders).

    Order attributes come from the order, status and time from the change.
    """
    pool = open_orders.where(F.col("status").isin(*from_status)).unionByName(new_orders)
    moved = changes.where(F.col("status").isin(*to_status)).select("order_id", F.col("status").alias("_status"), F.col("update_time").alias("event_time"))
    return pool.join(moved, "order_id", "inner").withColumn("status", F.col("_status")).drop("_status")

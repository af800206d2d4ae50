"""Parcel reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.ratios import ratio
from tallyflow.functions.times import day
from tallyflow.operators.align import align_join, align_union, signed_balance
from tallyflow.operators.dims import enrich, region_chain
from tallyflow.operators.horizons import explode_horizons
from tallyflow.plans.parcel_summaries import TRIP


def dated(df: DataFrame, as_of: str) -> DataFrame:
    return df.select(day(as_of).alias("dt"), "*")


def today(daily: DataFrame, as_of: str) -> DataFrame:
    return daily.where(F.col("dt") == day(as_of)).drop("dt").withColumn("recent_days", F.lit(1))


def horizons(daily: DataFrame, nd: DataFrame, as_of: str, keys: Sequence[str], measures: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """One-day and recent-days rows stacked, then summed on the report's keys."""
    cols = ["recent_days", *keys, *measures]
    both = today(daily, as_of).select(*cols).unionByName(nd.select(*cols))
    summed = both.groupBy("recent_days", *keys).agg(*[F.sum(m).alias(n) for m, n in zip(measures, names or measures)])
    if keys:
        return summed
    # a report without keys has a row for every horizon, NULL where nothing happened
    every = daily.sparkSession.range(1).select(F.explode(F.array(F.lit(1), F.lit(7), F.lit(30))).alias("recent_days"))
    return every.join(summed, "recent_days", "left")


def recent_rows(daily: DataFrame, as_of: str, keys: Sequence[str], measures: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Sums of the daily layer for 1, 7 and 30 days in one pass; a report without keys has a row for every horizon."""
    summed = explode_horizons(daily, as_of).groupBy("recent_days", *keys).agg(*[F.sum(m).alias(n) for m, n in zip(measures, names or measures)])
    if keys:
        return summed
    every = daily.sparkSession.range(1).select(F.explode(F.array(F.lit(1), F.lit(7), F.lit(30))).alias("recent_days"))
    return every.join(summed, "recent_days", "left")


def trip_means(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_trans_finish_distance", ratio(TRIP[1], TRIP[0], None)).withColumn("avg_trans_finish_dur_sec", ratio(TRIP[2], TRIP[0], None))


def place_of_trips(daily: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """City of a depot's trips: the hub's region, or the parent of the station's district."""
    named = enrich(daily, organs, "org_id", "id", ["org_level", "region_id"])
    up = region_chain(named, regions, "region_id", ["first", "second"])
    hub = F.col("org_level") == 1
    return up.withColumn("city_id", F.when(hub, F.col("first_id")).otherwise(F.col("second_id"))).withColumn(
        "city_name", F.when(hub, F.col("first_name")).otherwise(F.col("second_name"))
    )


def orders_and_trips(order_1d: DataFrame, order_nd: DataFrame, trip_1d: DataFrame, trip_nd: DataFrame, keys: Sequence[str], as_of: str, align=align_union) -> DataFrame:
    """Orders beside trips per city or depot for 1, 7 and 30 days (city and depot reports)."""
    orders = horizons(order_1d, order_nd, as_of, keys, ["order_count", "order_amount"])
    trips = trip_means(horizons(trip_1d, trip_nd, as_of, keys, TRIP))
    return dated(align([orders, trips], ["recent_days", *keys]), as_of)


def express(receive: DataFrame, deliver: DataFrame, sort: DataFrame, keys: Sequence[str], as_of: str, how: str = "union") -> DataFrame:
    """Received, delivered and sorted parcels side by side per city, depot, province or overall."""
    parts = [
        recent_rows(receive, as_of, keys, ["order_count", "order_amount"], ["receive_order_count", "receive_order_amount"]),
        recent_rows(deliver, as_of, keys, ["order_count"], ["deliver_suc_count"]),
        recent_rows(sort, as_of, keys, ["sort_count"]),
    ]
    align = align_union if how == "union" else align_join
    return dated(align(parts, ["recent_days", *keys]), as_of)


def drivers(shift_nd: DataFrame, as_of: str) -> DataFrame:
    """Trips per driver; a trip with two drivers counts half for each, in every measure."""
    measures = [*TRIP, "trans_finish_delay_count"]
    alone = F.col("driver2_emp_id").isNull()
    one = F.struct(F.col("driver1_emp_id").alias("driver_id"), F.col("driver1_name").alias("driver_name"))
    two = F.struct(F.col("driver2_emp_id").alias("driver_id"), F.col("driver2_name").alias("driver_name"))
    share = F.when(alone, F.lit(1)).otherwise(F.lit(0.5)).cast("decimal(2,1)")
    shared = shift_nd.select(
        "recent_days", F.explode(F.when(alone, F.array(one)).otherwise(F.array(one, two))).alias("d"), *[(F.col(m).cast("decimal(24,2)") * share).alias(m) for m in measures]
    )
    out = shared.groupBy("recent_days", "d.driver_id", "d.driver_name").agg(*[F.sum(m).alias(m) for m in measures])
    return dated(trip_means(out).withColumnRenamed("trans_finish_delay_count", "trans_finish_late_count"), as_of)


def by_keys(shift_nd: DataFrame, keys: Sequence[str], as_of: str, measures: Sequence[str] = (*TRIP, "trans_finish_order_count"), means: bool = False) -> DataFrame:
    """Trips per line, shift or truck model."""
    out = shift_nd.groupBy("recent_days", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    return dated(trip_means(out) if means else out, as_of)


def cargo_orders(order_1d: DataFrame, order_nd: DataFrame, keys: Sequence[str], as_of: str) -> DataFrame:
    """Orders per cargo type, or overall with no keys."""
    return dated(horizons(order_1d, order_nd, as_of, keys, ["order_count", "order_amount"]), as_of)


def trips_overall(trip_1d: DataFrame, shift_nd: DataFrame, as_of: str) -> DataFrame:
    return dated(horizons(trip_1d, shift_nd, as_of, [], TRIP), as_of)


def receive_and_dispatch(receive: DataFrame, dispatch: DataFrame, as_of: str) -> DataFrame:
    parts = [
        recent_rows(receive, as_of, [], ["order_count", "order_amount"], ["receive_order_count", "receive_order_amount"]),
        recent_rows(dispatch, as_of, [], ["order_count", "order_amount"], ["dispatch_order_count", "dispatch_order_amount"]),
    ]
    return dated(align_union(parts, ["recent_days"]), as_of)


def open_balance(dispatch_td: DataFrame, finish_td: DataFrame, as_of: str) -> DataFrame:
    """Parcels under way: dispatched minus finished."""
    measures = ["order_count", "order_amount"]
    out = signed_balance(dated(dispatch_td, as_of), dated(finish_td, as_of), ["dt"], measures)
    return out.withColumnsRenamed({"order_count": "bounding_order_count", "order_amount": "bounding_order_amount"})

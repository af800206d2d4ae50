"""Parcel summaries by depot, day, recent days and to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import day
from tallyflow.operators.dims import enrich, region_chain
from tallyflow.operators.horizons import explode_horizons

DEPOT = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name"]
TRIP = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]


def rows():
    return F.count(F.lit(1))


def recent(daily: DataFrame, as_of: str, keys: Sequence[str], measures: Sequence[str], days: Sequence[int] = (7, 30)) -> DataFrame:
    """Horizon rows of additive daily measures."""
    return explode_horizons(daily, as_of, days).groupBy("recent_days", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def org_cargo_type_order_1d(lines: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Orders per depot of the sender district and cargo type. Lines collapse to orders first; an order's amount counts once."""
    orders = lines.groupBy("order_id", "cargo_type", "cargo_type_name", "sender_district_id", "sender_city_id", "dt").agg(F.max("amount").alias("amount"))
    per_place = orders.groupBy("sender_district_id", "sender_city_id", "cargo_type", "cargo_type_name", "dt").agg(
        rows().alias("order_count"), F.sum("amount").alias("order_amount")
    )
    depots = organs.select(F.col("id").alias("org_id"), "org_name", F.col("region_id").alias("sender_district_id"))
    named = per_place.join(depots, "sender_district_id", "left").withColumnRenamed("sender_city_id", "city_id")
    out = named.groupBy("org_id", "org_name", "city_id", "cargo_type", "cargo_type_name", "dt").agg(
        F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount")
    )
    return enrich(out, regions, "city_id", "id", {"name": "city_name"})


def order_count_amount(orders: DataFrame) -> DataFrame:
    """Orders and amount per day."""
    return orders.groupBy("dt").agg(rows().alias("order_count"), F.sum("amount").alias("order_amount"))


def to_date(daily: DataFrame, as_of: str) -> DataFrame:
    """Totals of all days up to the report day."""
    return daily.where(F.col("dt") <= day(as_of)).agg(F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def to_date_carry(held: DataFrame, today: DataFrame) -> DataFrame:
    """Yesterday's totals plus today's, stacked with UNION ALL so that equal rows both count."""
    both = held.select("order_count", "order_amount").unionByName(today.select("order_count", "order_amount"))
    return both.agg(F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def station_orders_1d(orders: DataFrame, organs: DataFrame, regions: DataFrame, amount: bool) -> DataFrame:
    """Orders per station of the sender district with its city and province (received, delivered)."""
    sums = [rows().alias("order_count")] + ([F.sum("amount").alias("order_amount")] if amount else [])
    per_place = orders.groupBy("sender_district_id", "dt").agg(*sums)
    depots = organs.select(F.col("id").alias("org_id"), "org_name", F.col("region_id").alias("sender_district_id"))
    named = per_place.join(depots, "sender_district_id", "left").withColumn("region", F.when(F.col("org_id").isNotNull(), F.col("sender_district_id")))
    placed = region_chain(named, regions, "region", ["district", "city", "province"])
    measures = ["order_count"] + (["order_amount"] if amount else [])
    return placed.groupBy(*DEPOT, "dt").agg(*[F.sum(m).alias(m) for m in measures])


def org_sort_1d(sorts: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Sorted parcels per depot. A hub's region is its city; a station's region is a district, one level lower."""
    per_org = sorts.groupBy("org_id", "dt").agg(rows().alias("sort_count"))
    named = enrich(per_org, organs, "org_id", "id", ["org_name", "org_level", "region_id"])
    up = region_chain(named, regions, "region_id", ["first", "second", "third"])
    hub = F.col("org_level") == 1
    pick = lambda a, b: F.when(hub, F.col(a)).otherwise(F.col(b))
    return up.select(
        "org_id", "org_name", pick("first_id", "second_id").alias("city_id"), pick("first_name", "second_name").alias("city_name"),
        pick("second_id", "third_id").alias("province_id"), pick("second_name", "third_name").alias("province_name"), "sort_count", "dt",
    )


def truck_model_trips_1d(trips: DataFrame, trucks: DataFrame) -> DataFrame:
    """Trips per depot and truck model, summed per truck before the truck names are joined."""
    per_truck = trips.groupBy(F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "truck_id", "dt").agg(
        rows().alias("n"), F.sum("actual_distance").alias("d"), F.sum("finish_dur_sec").alias("s")
    )
    named = enrich(per_truck, trucks, "truck_id", "id", ["truck_model_type", "truck_model_type_name"])
    return named.groupBy("org_id", "org_name", "truck_model_type", "truck_model_type_name", "dt").agg(
        F.sum("n").alias(TRIP[0]), F.sum("d").alias(TRIP[1]), F.sum("s").alias(TRIP[2])
    )


def shift_trips_nd(trips: DataFrame, organs: DataFrame, regions: DataFrame, shifts: DataFrame, trucks: DataFrame, as_of: str, days: Sequence[int] = (7, 30)) -> DataFrame:
    """Trips per shift, line, depot, drivers and truck for recent days, with late trips."""
    agg = explode_horizons(trips, as_of, days).groupBy(
        "recent_days", "shift_id", "line_id", F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"),
        "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name", "truck_id",
    ).agg(
        rows().alias(TRIP[0]), F.sum("actual_distance").alias(TRIP[1]), F.sum("finish_dur_sec").alias(TRIP[2]),
        F.sum("order_num").alias("trans_finish_order_count"), F.sum("is_late").alias("trans_finish_delay_count"),
    )
    out = enrich(agg, organs, "org_id", "id", ["org_level", "region_id"])
    up = region_chain(out, regions, "region_id", ["first", "second"])
    hub = F.col("org_level") == 1
    placed = up.withColumn("city_id", F.when(hub, F.col("first_id")).otherwise(F.col("second_id"))).withColumn(
        "city_name", F.when(hub, F.col("first_name")).otherwise(F.col("second_name"))
    )
    named = enrich(placed.drop("org_level", "region_id", "first_id", "first_name", "second_id", "second_name"), shifts, "shift_id", "id", ["line_name"])
    return enrich(named, trucks, "truck_id", "id", ["truck_model_type", "truck_model_type_name"])

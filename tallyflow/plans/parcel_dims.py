"""Parcel dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.clean import hash_sensitive
from tallyflow.functions.times import OPEN_END, epoch_day, from_epoch_ms, iso_text
from tallyflow.operators.dims import dictionary_roles, enrich
from tallyflow.operators.history import history_init


def complexes(info: DataFrame, regions: DataFrame, couriers: DataFrame) -> DataFrame:
    """Housing complexes with their places and the set of couriers serving them."""
    served = couriers.groupBy("complex_id").agg(F.array_sort(F.collect_set(F.col("courier_emp_id").cast("string"))).alias("courier_emp_ids"))
    out = enrich(info, regions, "city_id", "id", {"name": "city_name", "parent_id": "province_id"})
    out = enrich(out, regions, "province_id", "id", {"name": "province_name"})
    return enrich(out, served, "id", "complex_id", ["courier_emp_ids"])


def couriers(info: DataFrame, organ: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = info.join(organ.select(F.col("id").alias("org_id"), "org_name"), "org_id")
    typed = dictionary_roles(named, dictionary, {"express_type": "express_type_name"}).where(F.col("express_type_name").isNotNull())
    return typed.withColumn("working_phone", hash_sensitive("working_phone"))


def organs(base: DataFrame, regions: DataFrame) -> DataFrame:
    out = enrich(base, regions, "region_id", "id", {"name": "region_name", "dict_code": "region_code"})
    return enrich(out, base, "org_parent_id", "id", {"org_name": "org_parent_name"})


def shifts(shift: DataFrame, line: DataFrame, dictionary: DataFrame) -> DataFrame:
    lines = line.select(F.col("id").alias("line_id"), F.col("name").alias("line_name"), "line_no", "transport_line_type_id", "distance", "estimated_time")
    return dictionary_roles(shift.join(lines, "line_id"), dictionary, {"transport_line_type_id": "transport_line_type_name"})


def drivers(driver: DataFrame, organ: DataFrame, team: DataFrame) -> DataFrame:
    """Missing licence dates get the ends of the calendar in use."""
    out = enrich(driver, organ, "org_id", "id", ["org_name"])
    out = enrich(out, team, "team_id", "id", {"name": "team_name"})
    return out.withColumns(
        {
            "init_license_date": F.coalesce("init_license_date", F.lit("1970-01-01 00:00:00")),
            "expire_date": F.coalesce("expire_date", F.lit("2099-12-31 23:59:59")),
        }
    )


def trucks(truck: DataFrame, team: DataFrame, model: DataFrame, organ: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Trucks with team, depot, model; type and brand names from one dictionary; plates hashed."""
    teams = team.select(F.col("id").alias("team_id"), F.col("name").alias("team_name"), "org_id")
    models = model.select(
        F.col("id").alias("truck_model_id"), F.col("model_name").alias("truck_model_name"), F.col("model_type").alias("truck_model_type"),
        F.col("brand").alias("truck_brand"), "load_weight",
    )
    out = truck.join(teams, "team_id").join(models, "truck_model_id")
    out = enrich(out, organ, "org_id", "id", ["org_name"])
    out = dictionary_roles(out, dictionary, {"truck_model_type": "truck_model_type_name", "truck_brand": "truck_brand_name"})
    return out.withColumn("truck_no", hash_sensitive("truck_no"))


def address_history(addresses: DataFrame) -> DataFrame:
    """First load: valid from the creation time, given as ISO text."""
    return addresses.withColumn("start_date", iso_text("create_time")).withColumn("end_date", F.lit(OPEN_END)).drop("create_time")


def user_history(users: DataFrame) -> DataFrame:
    """First load: birthdays given in days, creation in milliseconds."""
    rows = users.withColumn("birthday", epoch_day("birthday"))
    return history_init(rows, F.to_date(from_epoch_ms("create_time"))).drop("create_time")

"""Parcel source tables read from the given parquet tables: waybills, cargo, depots, trips."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.sources.standins import Tables, hours, money

# Status, collect, payment, cargo, model and line codes.
STATUS = ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080", "60999"]
CODES = [*STATUS, "70001", "70002", "80001", "80002", "80003", "81001", "81002", "81003", "90001", "90002", "90003", "91001", "91002"]


def number(col: Column, base: str) -> Column:
    return F.concat(F.lit(base), (col).cast("string"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def ms(ts: str) -> Column:
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def hub(nation: Column) -> Column:
    return (nation + 100).cast("bigint")


def district(nation: Column, key: Column) -> Column:
    return (nation * 10 + key % 4 + 1000).cast("bigint")


class Parcel(Tables):
    @cached_property
    def dictionary(self) -> DataFrame:
        return self.spark.createDataFrame([(c, f"name {c}") for c in CODES], "dic_code string, dic_name string")

    @cached_property
    def districts(self) -> DataFrame:
        return self.raw("supplier").select(
            district(F.col("s_nationkey"), F.col("s_suppkey")).alias("id"), hub(F.col("s_nationkey")).alias("parent_id")
        ).distinct().withColumn("name", F.concat(F.lit("district "), F.col("id").cast("string")))

    @cached_property
    def region_info(self) -> DataFrame:
        provinces = self.raw("region").select((F.col("r_regionkey") + 1).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("parent_id"), F.col("r_name").alias("name"))
        cities = self.raw("nation").select(hub(F.col("n_nationkey")).alias("id"), (F.col("n_regionkey") + 1).cast("bigint").alias("parent_id"), F.col("n_name").alias("name"))
        both = provinces.unionByName(cities).unionByName(self.districts)
        return both.withColumn("dict_code", F.concat(F.lit("R"), F.col("id").cast("string"))).withColumn("short_name", F.substring("name", 1, 8))

    @cached_property
    def organ_base(self) -> DataFrame:
        """One hub per city, one station per district."""
        hubs = self.raw("nation").select(
            hub(F.col("n_nationkey")).alias("id"), F.concat(F.lit("hub "), F.col("n_name")).alias("org_name"), F.lit(1).alias("org_level"),
            hub(F.col("n_nationkey")).alias("region_id"), F.lit(None).cast("bigint").alias("org_parent_id"),
        )
        stations = self.districts.select(
            "id", F.concat(F.lit("station "), F.col("id").cast("string")).alias("org_name"), F.lit(2).alias("org_level"),
            F.col("id").alias("region_id"), F.col("parent_id").alias("org_parent_id"),
        )
        return hubs.unionByName(stations)

    @cached_property
    def waybill(self) -> DataFrame:
        key, home = F.col("o_orderkey"), F.col("c_nationkey")
        far = (home + 7) % 25
        made = F.col("o_orderdate") + hours(key % 24)
        changed = made + hours(key % 72)
        return (
            self.raw("orders")
            .join(self.raw("customer").select("c_custkey", "c_nationkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey", "left")
            .select(
                key.alias("id"),
                F.concat(F.lit("W"), F.lpad(key.cast("string"), 10, "0")).alias("order_no"),
                F.element_at(F.array(*[F.lit(s) for s in STATUS]), (key % 9 + 1).cast("int")).alias("status"),
                number(key % 2 + 1, "7000").alias("collect_type"),
                F.col("o_custkey").alias("user_id"),
                district(far, key).alias("receiver_district_id"),
                hub(far).alias("receiver_city_id"),
                F.col("c_name").alias("receiver_name"),
                district(home, key).alias("sender_district_id"),
                hub(home).alias("sender_city_id"),
                (F.col("n_regionkey") + 1).cast("bigint").alias("sender_province_id"),
                F.reverse("c_name").alias("sender_name"),
                number(key % 3 + 1, "8000").alias("payment_type"),
                (key % 3 + 1).alias("cargo_num"),
                money("o_totalprice").alias("amount"),
                (ms("o_orderdate") + 259200000).alias("estimate_arrive_time"),
                (key % 1000).alias("distance"),
                iso(made).alias("create_time"),
                iso(changed).alias("update_time"),
                F.to_date("o_orderdate").alias("ds"),
                F.when(key % 50 == 0, "1").otherwise("0").alias("is_deleted"),
            )
        )

    @cached_property
    def cargo(self) -> DataFrame:
        kind = F.when(F.col("l_returnflag") == "A", "81001").when(F.col("l_returnflag") == "N", "81002").otherwise("81003")
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            kind.alias("cargo_type"),
            (F.col("l_linenumber") * 10).alias("volume_length"),
            (F.col("l_suppkey") % 50).alias("volume_width"),
            (F.col("l_partkey") % 40).alias("volume_height"),
            F.col("l_quantity").alias("weight"),
        )

    @cached_property
    def org_bound(self) -> DataFrame:
        at = F.col("l_shipdate") + hours(F.col("l_partkey") % 24)
        line = F.col("l_linenumber")
        place = F.when(line % 2 == 0, hub(F.col("l_suppkey") % 25)).otherwise(district(F.col("s_nationkey"), F.col("l_suppkey")))
        homes = self.raw("supplier").select("s_suppkey", "s_nationkey")
        return self.raw("lineitem").join(homes, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            place.alias("org_id"),
            F.to_date("l_shipdate").alias("ds"),
            at.alias("inbound_time"),
            F.col("l_suppkey").alias("inbound_emp_id"),
            F.when(line % 3 != 0, at + hours(F.lit(2))).alias("sort_time"),
            (F.col("l_suppkey") + 1).alias("sorter_emp_id"),
            F.when(line % 4 != 0, at + hours(F.lit(5))).alias("outbound_time"),
            (F.col("l_suppkey") + 2).alias("outbound_emp_id"),
        )

    @cached_property
    def transport_task(self) -> DataFrame:
        supp, part = F.col("l_suppkey"), F.col("l_partkey")
        start = ms("l_shipdate")
        name = lambda c: F.concat(F.lit("Driver "), c.cast("string"))
        second = F.when(part % 3 != 0, part % 100 + 10000)
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            supp.alias("shift_id"),
            (supp % 20).alias("line_id"),
            hub(supp % 25).alias("start_org_id"),
            hub((supp + 3) % 25).alias("end_org_id"),
            F.col("l_linenumber").alias("order_num"),
            supp.alias("driver1_emp_id"),
            name(supp).alias("driver1_name"),
            second.alias("driver2_emp_id"),
            name(second).alias("driver2_name"),
            (supp % 50).alias("truck_id"),
            F.concat(F.lit("T-"), (supp % 50).cast("string")).alias("truck_no"),
            start.alias("actual_start_time"),
            F.when(F.col("l_linenumber") != 7, start + F.col("l_quantity").cast("bigint") * 3600000).alias("actual_end_time"),
            money("l_extendedprice").alias("actual_distance"),
        )

    @cached_property
    def line_info(self) -> DataFrame:
        """Transport lines, one per last digits of a depot key."""
        key = F.col("s_suppkey") % 20
        return self.raw("supplier").select(key.alias("id")).distinct().select(
            "id",
            F.concat(F.lit("line "), F.col("id").cast("string")).alias("name"),
            F.concat(F.lit("L"), F.col("id").cast("string")).alias("line_no"),
            number(F.col("id") % 2 + 1, "9100").alias("transport_line_type_id"),
            (F.col("id") * 10 + 50).alias("distance"),
            (F.col("id") * 60 + 600).alias("estimated_time"),
        )

    @cached_property
    def shift_base(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            (F.col("s_suppkey") % 20).alias("line_id"),
            F.concat(F.lpad((F.col("s_suppkey") % 24).cast("string"), 2, "0"), F.lit(":00")).alias("start_time"),
            F.col("s_suppkey").alias("driver1_emp_id"),
            (F.col("s_suppkey") % 50).alias("truck_id"),
        )

    @cached_property
    def truck_team(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"), F.concat(F.lit("team "), F.col("n_name")).alias("name"), hub(F.col("n_nationkey")).alias("org_id")
        )

    @cached_property
    def truck_model(self) -> DataFrame:
        size = self.raw("part").select((F.col("p_size") % 7).cast("bigint").alias("id")).distinct()
        return size.select(
            "id",
            F.concat(F.lit("model "), F.col("id").cast("string")).alias("model_name"),
            number(F.col("id") % 3 + 1, "9000").alias("model_type"),
            number(F.col("id") % 2 + 1, "9100").alias("brand"),
            (F.col("id") * 1000 + 2000).alias("load_weight"),
        )

    @cached_property
    def truck_info(self) -> DataFrame:
        return self.raw("supplier").select((F.col("s_suppkey") % 50).alias("id")).distinct().select(
            "id",
            (F.col("id") % 25).alias("team_id"),
            F.concat(F.lit("T-"), F.col("id").cast("string")).alias("truck_no"),
            (F.col("id") % 7).alias("truck_model_id"),
        )

    @cached_property
    def truck_driver(self) -> DataFrame:
        key = F.col("s_suppkey")
        day = F.date_add(F.lit("2010-01-01").cast("date"), (key % 3000).cast("int"))
        return self.raw("supplier").select(
            key.alias("id"),
            (key + 500).alias("emp_id"),
            hub(F.col("s_nationkey")).alias("org_id"),
            (key % 30).alias("team_id"),
            F.when(key % 4 != 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 00:00:00"))).alias("init_license_date"),
            F.when(key % 5 != 0, F.concat(F.date_format(F.date_add(day, 3650), "yyyy-MM-dd"), F.lit(" 00:00:00"))).alias("expire_date"),
        )

    @cached_property
    def courier(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("id"), (key + 900).alias("emp_id"), hub(F.col("s_nationkey")).alias("org_id"),
            F.concat(F.lit("139"), F.lpad(key.cast("string"), 8, "0")).alias("working_phone"), number(key % 2 + 1, "7000").alias("express_type"),
        )

    @cached_property
    def complex_info(self) -> DataFrame:
        return self.districts.select(
            (F.col("id") + 5000).alias("id"), F.concat(F.lit("complex "), F.col("id").cast("string")).alias("complex_name"),
            F.col("parent_id").alias("city_id"), F.col("id").alias("district_id"), F.col("name").alias("district_name"),
        )

    @cached_property
    def courier_complex(self) -> DataFrame:
        return self.raw("supplier").select(
            (F.col("s_suppkey") + 900).alias("courier_emp_id"), (district(F.col("s_nationkey"), F.col("s_suppkey")) + 5000).alias("complex_id")
        )

    @cached_property
    def user_address(self) -> DataFrame:
        key = F.col("c_custkey")
        at = F.lit("2000-01-01 08:30:00").cast("timestamp_ntz") + hours(key % 500)
        return self.raw("customer").select(
            key.alias("id"), key.alias("user_id"), F.md5(F.concat(F.lit("138"), F.lpad(key.cast("string"), 8, "0"))).alias("phone"),
            hub(F.col("c_nationkey")).alias("city_id"), F.concat_ws(" ", F.lit("street"), key.cast("string")).alias("address"),
            (key % 2).alias("is_default"), iso(at).alias("create_time"),
        )

    @cached_property
    def user_info(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("id"), F.col("c_name").alias("login_name"), F.col("c_mktsegment").alias("user_level"), (key % 9000).cast("int").alias("birthday"),
            F.when(key % 2 == 0, F.lit("M")).otherwise("F").alias("gender"), (key * 86400000).alias("create_time"),
        )

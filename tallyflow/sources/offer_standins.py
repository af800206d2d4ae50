"""Special offers: activities, products, sent offers and redemptions, from the event and part tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.sources.standins import Retail, hours, money


class Offers(Retail):
    @cached_property
    def activity(self) -> DataFrame:
        i = F.col("activity_id")
        end = F.date_add(F.lit("2024-01-26").cast("date"), i)
        return self.events.select((F.col("k") % 10).alias("activity_id")).distinct().select(
            "activity_id", F.concat(F.lit("offer "), i.cast("string")).alias("activity_name"), (i % 3).alias("activity_level"), (i % 4).alias("offer_type"),
            F.lit("2024-01-01 00:00:00").alias("start_time"), F.concat(end.cast("string"), F.lit(" 23:59:59")).alias("end_time"),
            (i * 10).alias("max_custom_amount"), (i % 3).alias("shop_id"), F.when(i % 5 == 0, 0).otherwise(1).alias("status"),
        )

    @cached_property
    def offer_product(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("product_id"), (key % 10).alias("activity_id"), F.col("p_size").alias("fixed_offer_amount"), (F.col("p_size") * 2).alias("max_offer_amount"),
            (key % 5 + 1).alias("purchase_limit"), F.when(key % 7 == 0, 0).otherwise(1).alias("status"),
        )

    @cached_property
    def offer_sku(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").where("p_size > 10").select(
            (key * 10 + 1).alias("sku_id"), key.alias("product_id"), F.when(key % 3 != 0, F.col("p_size") + 1).alias("fixed_offer_amount"), F.lit(None).cast("int").alias("max_offer_amount")
        )

    @cached_property
    def send(self) -> DataFrame:
        k = F.col("k")
        return self.events.select(
            F.col("event_id").alias("record_id"), (k % 10).alias("activity_id"), k.alias("product_id"), (k * 10 + 1).alias("sku_id"),
            F.col("user_id").alias("customer_id"), (k % 25).alias("cs_id"), F.col("value").alias("offer_amount"), F.col("ts").alias("send_time"),
            (F.col("ts") + hours(F.lit(24))).alias("expire_time"), F.lit(24).alias("valid_hours"), F.when(F.col("event_type") == "error", 0).otherwise(1).alias("status"), "dt",
        )

    @cached_property
    def redemption(self) -> DataFrame:
        return self.events.where(F.col("event_type").isin("purchase", "signup")).select(
            F.col("event_id").alias("redemption_id"), F.col("event_id").alias("record_id"), F.col("event_id").alias("order_id"),
            F.when(F.col("value") >= 1, F.col("ts") + hours(F.lit(1))).alias("redemption_time"), money(F.col("value") / 2).alias("actual_offer_amount"),
            money(F.col("value") * 3).alias("payment_amount"), "dt",
        )

    @cached_property
    def service_staff(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.raw("nation").select(
            n.alias("cs_id"), F.concat(F.lit("agent "), "n_name").alias("cs_name"), F.when(n % 6 != 0, F.concat(F.lit("dept "), (n % 3).cast("string"))).alias("department"),
            F.when(n % 8 == 7, 2).otherwise(1).alias("status"),
        )

    @cached_property
    def staff_snapshots(self) -> DataFrame:
        """Daily snapshots of the agents who sent offers; department and state change over the month."""
        part = F.dayofmonth("dt")
        seen = self.events.select((F.col("k") % 25).alias("cs_id"), "dt").distinct()
        return seen.select(
            "cs_id", "dt", F.concat(F.lit("dept "), ((F.col("cs_id") + F.floor(part / 10)) % 3).cast("string")).alias("department"),
            ((F.col("cs_id") + F.floor(part / 15)) % 2).cast("int").alias("status"),
        )

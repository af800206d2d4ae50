"""Shop page logs for the page-path and page-analytics warehouses, from the event table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.sources.standins import Retail, hours


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


class PagePath(Retail):
    @cached_property
    def visit_log(self) -> DataFrame:
        k = F.col("k")
        return self.events.select(
            F.col("event_id").alias("log_id"), "user_id", F.concat_ws("_", "user_id", F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            F.concat_ws("-", "event_type", (k % 4).cast("string")).alias("page_id"), F.when(F.col("event_type") == "click", "product").otherwise("shop").alias("page_type"),
            F.when(k % 3 != 0, F.concat(F.lit("view-"), (k % 5).cast("string"))).alias("referer_page_id"), F.col("ts").alias("visit_time"),
            ((F.col("value") * 20).cast("int") - 100).alias("stay_duration"), pick(["PC", "Mobile", "TABLET"], (F.col("user_id") % 3).cast("int")).alias("device_type"),
            F.when(k % 6 != 0, F.concat(F.lit("province "), (k % 6).cast("string"))).alias("province"), F.when(k % 7 != 0, F.concat(F.lit("city "), (k % 7).cast("string"))).alias("city"),
            (k % 2).alias("is_new_visitor"), "dt",
        )

    @cached_property
    def page_info(self) -> DataFrame:
        kind = F.split_part("page_id", F.lit("-"), F.lit(1))
        seen = self.visit_log.select("page_id").distinct().where("page_id <> 'error-3'")
        names = F.when(kind == "view", "home").when(kind == "signup", "activity").when(kind == "click", "detail").when(kind == "purchase", "category").otherwise("other")
        return seen.select("page_id", F.concat(F.lit("page "), "page_id").alias("page_name"), names.alias("page_type"))

    @cached_property
    def shop_orders(self) -> DataFrame:
        k = F.col("k")
        return self.events.where("event_type = 'purchase'").select(
            F.col("event_id").alias("order_id"), "user_id", (F.col("ts") - hours(k % 3)).alias("order_time"),
            F.when(k % 5 != 0, F.col("ts") + hours(k % 12)).alias("payment_time"), F.col("value").alias("payment_amount"),
        )


class PageAnalytics(Retail):
    @cached_property
    def _base(self) -> DataFrame:
        return self.events.withColumn("page_id", F.concat(F.lit("p"), (F.col("k") % 20).cast("string"))).withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))

    @cached_property
    def visit_base(self) -> DataFrame:
        k, i = F.col("k"), F.col("event_id")
        return self._base.select(
            F.when(k % 33 != 0, F.col("page_id")).alias("page_id"), F.concat_ws(" ", F.lit("page"), "page_id", F.date_format("ts", "dd")).alias("page_name"),
            F.col("event_type").alias("page_type"), F.col("at").alias("visit_time"), (k % 3 + 1).alias("visitor_count"), (i % 7).alias("visit_pv"), (i % 5).alias("click_pv"), i.alias("log_id"), "dt",
        )

    @cached_property
    def block_click(self) -> DataFrame:
        k, i = F.col("k"), F.col("event_id")
        return self._base.select(
            "page_id", F.concat(F.lit("b"), (k % 12).cast("string")).alias("block_id"),
            F.concat(pick(["轮播", "推荐", "活动", "商品", "其他"], k % 5), (k % 12).cast("string")).alias("block_name"), (i % 4).alias("click_pv"), (i % 3).alias("click_uv"),
            (F.col("value") - 5).cast("decimal(16,2)").alias("guide_pay_amount"), F.col("at").alias("collect_time"), i.alias("log_id"), "dt",
        )

    @cached_property
    def data_trend(self) -> DataFrame:
        return self._base.groupBy("page_id", "dt").agg(
            F.countDistinct("user_id").alias("visitor_count"), F.sum((F.col("event_type") == "click").cast("int")).alias("click_uv")
        ).withColumn("stat_date", F.date_format("dt", "yyyy-MM-dd")).withColumn("data_version", F.lit("v1"))

    @cached_property
    def guide_product(self) -> DataFrame:
        k, i = F.col("k"), F.col("event_id")
        return self._base.select(
            "page_id", F.when(k % 10 == 0, k.cast("string")).otherwise(F.lpad(k.cast("string"), 19, "6")).alias("product_id"), (i % 6).alias("guide_count"),
            (i % 3).alias("guide_buyer_count"), F.col("at").alias("guide_time"), i.alias("log_id"), "dt",
        )

    @cached_property
    def module_detail(self) -> DataFrame:
        k, i = F.col("k"), F.col("event_id")
        return self._base.select(
            "page_id", F.concat(F.lit("m"), (k % 15).cast("string")).alias("module_id"), F.concat(F.lit("module "), (k % 15).cast("string")).alias("module_name"),
            pick(["推荐型", "活动型", "导购型", "内容型", "其他"], k % 5).alias("module_type"), (i % 50).alias("expose_pv"), (i % 20).alias("interact_count"), F.col("at").alias("stat_time"), i.alias("log_id"), "dt",
        )

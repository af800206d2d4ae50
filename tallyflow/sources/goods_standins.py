"""Goods, shop, behaviour and payment tables of the goods-linkage and new-product warehouses."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.sources.standins import Retail, money


class Goods(Retail):
    """Behaviour and trade logs come from the event table, goods from part, shops from supplier, users from customer."""

    @cached_property
    def behavior_log(self) -> DataFrame:
        kind = F.col("event_type")
        k = F.col("k")
        return self.events.where(kind != "purchase").select(
            F.col("event_id").alias("log_id"),
            "user_id",
            F.concat_ws("_", "user_id", F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            k.cast("bigint").alias("goods_id"),
            F.when(kind == "click", "favor").when(kind == "signup", "cart").otherwise(kind).alias("behavior_type"),
            F.col("ts").alias("behavior_time"),
            F.concat(F.when(k % 3 == 0, "iOS-").when(k % 3 == 1, "Android-").otherwise("TV-"), (F.col("user_id") % 40).cast("string")).alias("device_id"),
            F.concat(F.lit("v"), (k % 4).cast("string")).alias("app_version"),
            F.when(k % 5 == 0, "").when(k % 7 == 0, "null").otherwise((k + 1).cast("string")).alias("refer_goods_id"),
            ((F.col("value") * 20).cast("int") - 100).alias("stay_duration"),
            "dt",
        )

    @cached_property
    def trade(self) -> DataFrame:
        k = F.col("k")
        channel = F.element_at(F.array(*[F.lit(c) for c in ("alipay", "wechat", "bank", "balance", "cash")]), k % 5 + 1)
        return self.events.where("event_type = 'purchase'").select(
            F.col("event_id").alias("order_id"), "user_id", (k % 10).cast("bigint").alias("shop_id"), F.col("ts").alias("pay_time"),
            money(F.col("value") * 10).alias("payment_amount"), channel.alias("pay_channel"), F.when(k % 8 == 0, 0).otherwise(1).alias("pay_status"), "dt",
        )

    @cached_property
    def trade_lines(self) -> DataFrame:
        """Two goods per order."""
        k, n, eid = F.col("k"), F.col("n"), F.col("event_id")
        lines = self.events.where("event_type = 'purchase'").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
        quantity = F.when(eid % 97 == 0, 150).otherwise((eid % 5 + n).cast("int"))
        price = F.when(eid % 13 == 0, -F.col("value")).otherwise(F.col("value"))
        return lines.select(
            F.concat_ws("-", eid.cast("string"), n.cast("string")).alias("detail_id"),
            eid.alias("order_id"),
            F.when(n == 1, k).otherwise((k * 7 + 3) % 100).cast("bigint").alias("goods_id"),
            quantity.alias("goods_quantity"),
            price.cast("decimal(10,2)").alias("unit_price"),
            money(F.abs(price) * quantity).alias("total_price"),
            F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("promo "), k.cast("string"))).alias("promotion_info"),
            "dt",
        )

    @cached_property
    def goods_attr(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("goods_id"),
            (key % 10).alias("shop_id"),
            F.when(key % 6 == 0, "").otherwise(F.concat(F.lit(" "), "p_name", F.lit("\t"))).alias("goods_name"),
            F.col("p_type").alias("category_l1"),
            F.col("p_brand").alias("category_l2"),
            F.when(F.col("p_size") > 5, F.col("p_size").cast("string")).otherwise("").alias("category_l3"),
            (key % 2).cast("int").alias("is_traffic_item"),
            F.when(key % 3 != 0, (key % 2).cast("int")).alias("is_top_seller"),
            F.when(key % 11 == 0, -F.col("p_retailprice")).otherwise(F.col("p_retailprice")).alias("base_price"),
            F.when(key % 4 == 0, 0).otherwise(1).alias("goods_status"),
            F.when(key % 9 != 0, F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (key % 300).cast("int")), "yyyy-MM-dd")).alias("create_time"),
        )

    @cached_property
    def shop_base(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("shop_id"), F.when(key % 7 == 0, "").otherwise(F.col("s_name")).alias("shop_name"), (key % 8).cast("int").alias("shop_level"),
            F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("kind "), (key % 3).cast("string"))).alias("shop_type"),
            F.when(key % 4 != 0, F.concat(F.lit("main "), (key % 4).cast("string"))).alias("main_category"),
        )

    @cached_property
    def user_base(self) -> DataFrame:
        key = F.col("c_custkey")
        channel = F.element_at(F.array(*[F.lit(c) for c in ("MyAPP", "h5-Web", "", "mini")]), (key % 4 + 1).cast("int"))
        return self.raw("customer").select(
            key.alias("user_id"), F.when(key % 8 == 0, "").otherwise(F.col("c_name")).alias("user_name"), channel.alias("reg_channel"),
            (key % 12).cast("int").alias("user_level"),
        )


class NewGoods(Retail):
    """New-arrival tags and payments come from lineitem, goods from part, stores from supplier."""

    @cached_property
    def sku_base(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.alias("sku_id"),
            F.when(key % 5 != 0, F.col("p_name")).alias("sku_title"),
            F.col("p_type").alias("category_id"),
            F.when(key % 7 != 0, F.lower("p_type")).alias("category_name"),
            F.col("p_brand").alias("brand_id"),
            F.when(key % 6 != 0, F.upper("p_brand")).alias("brand_name"),
            F.col("p_retailprice").alias("sale_price"),
            (key % 20).alias("store_id"),
            F.date_add(F.lit("2001-01-01").cast("date"), (key % 200).cast("int")).alias("putaway_time"),
            F.when(key % 9 == 0, 0).otherwise(1).alias("is_online"),
            F.when(key % 13 == 0, 1).otherwise(0).alias("is_delete"),
        )

    @cached_property
    def new_tag(self) -> DataFrame:
        shipped = F.to_date("l_shipdate")
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_partkey").alias("sku_id"),
            F.when(F.col("l_linenumber") % 3 != 0, F.concat(F.lit("type "), F.col("l_linestatus"))).alias("new_type"),
            F.when(F.col("l_linenumber") % 4 != 0, (F.col("l_linenumber") % 2)).alias("is_tmall_new"),
            shipped.alias("putaway_time"),
            shipped.alias("new_tag_start_time"),
            F.date_add(shipped, 700).alias("new_tag_end_time"),
            F.when(F.col("l_returnflag") == "A", "通过").when(F.col("l_returnflag") == "N", "待审").alias("new_tag_audit_status"),
            F.col("l_shipdate").alias("update_time"),
        )

    @cached_property
    def sku_payment(self) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
        return self.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("payment_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("o_custkey").alias("user_id"),
            money("l_extendedprice").alias("payment_amount"),
            F.col("l_quantity").cast("bigint").alias("payment_quantity"),
            F.to_date("o_orderdate").alias("payment_time"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("channel"),
            F.when(F.col("o_orderstatus") == "O", 0).otherwise(1).alias("payment_status"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("refund_status"),
        )

    @cached_property
    def yearly_record(self) -> DataFrame:
        key = F.col("p_partkey")
        day = F.date_add(F.lit("2000-10-01").cast("date"), (key % 300).cast("int"))
        return self.raw("part").select(
            key.alias("sku_id"), day.alias("putaway_date"), F.year(day).alias("putaway_year"), F.month(day).alias("putaway_month"),
            F.when(key % 2 == 0, F.quarter(day)).alias("putaway_quarter"), F.col("p_retailprice").alias("initial_sale_price"),
            F.col("p_type").alias("category_id"), F.col("p_brand").alias("brand_id"),
        )

    @cached_property
    def store_base(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("store_id"), F.when(key % 6 != 0, F.col("s_name")).alias("store_name"),
            F.when(key % 3 != 0, F.concat(F.lit("kind "), (key % 3).cast("string"))).alias("store_type"),
            F.when(key % 4 != 0, F.concat(F.lit("site "), (key % 4).cast("string"))).alias("platform"),
            F.lit(None).cast("string").alias("category_main"), F.when(key % 10 != 9, F.lit("2000-01-01")).alias("open_date"),
            F.when(key % 5 != 0, (key % 5).cast("int")).alias("level"),
        )

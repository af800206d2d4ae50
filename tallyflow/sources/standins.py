"""Business tables read from the given parquet tables.

Each property has the columns of a source table of the warehouses. Dates stay DATE and amounts decimal, so
filters on ``dt`` reach the scan as ranges on the stored timestamp.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_AS_OF = "2001-07-31"
EVENTS_AS_OF = "2024-01-30"

MONEY = "decimal(16,2)"


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def hours(col: Column) -> Column:
    return F.make_dt_interval(F.lit(0), col.cast("int"), F.lit(0), F.lit(0))


def detail_id() -> Column:
    """Order and line alone repeat in the given files, and so may line, part and supplier; the price tells the rest apart."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents.cast("string"))


class Tables:
    """The given parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


class Retail(Tables):
    """Orders, goods and page logs of the online shop."""

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").select(
            "event_id", "ts", "user_id", "event_type", money("value").alias("value"), k.alias("k"), F.to_date("ts").alias("dt")
        )

    @cached_property
    def order_info(self) -> DataFrame:
        total = money("o_totalprice")
        off = money(total * F.lit(0.05).cast("decimal(4,2)"))
        home = self.raw("customer").select("c_custkey", F.col("c_nationkey").alias("province_id"))
        return (
            self.raw("orders")
            .join(home, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("o_custkey").alias("user_id"),
                "province_id",
                F.col("o_orderstatus").alias("order_status"),
                F.col("o_orderdate").alias("create_time"),
                total.alias("original_total_amount"),
                off.alias("activity_reduce_amount"),
                money(F.lit(0)).alias("coupon_reduce_amount"),
                (total - off).cast(MONEY).alias("total_amount"),
                F.to_date("o_orderdate").alias("dt"),
            )
        )

    @cached_property
    def order_detail(self) -> DataFrame:
        price = money("l_extendedprice")
        off = money(price * F.col("l_discount").cast("decimal(4,2)"))
        return self.raw("lineitem").select(
            detail_id().alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_suppkey").alias("shop_id"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            price.alias("split_original_amount"),
            off.alias("split_activity_amount"),
            money(price * F.col("l_tax").cast("decimal(4,2)")).alias("split_coupon_amount"),
            (price - off).cast(MONEY).alias("split_total_amount"),
        )

    @cached_property
    def order_detail_activity(self) -> DataFrame:
        rule = F.round(F.col("l_discount") * 100).cast("int")
        return self.raw("lineitem").where("l_discount > 0").select(
            detail_id().alias("order_detail_id"),
            (rule % 3).alias("activity_id"),
            rule.alias("activity_rule_id"),
        )

    @cached_property
    def order_detail_coupon(self) -> DataFrame:
        return self.raw("lineitem").where("l_tax > 0").select(
            detail_id().alias("order_detail_id"),
            F.round(F.col("l_tax") * 100).cast("int").alias("coupon_id"),
        )

    @cached_property
    def payment_info(self) -> DataFrame:
        paid = self.order_info.where(F.col("order_status").isin("F", "P"))
        at = F.col("create_time") + hours(F.col("id") % 48)
        return paid.select(
            F.col("id").alias("order_id"),
            "user_id",
            F.concat(F.lit("110"), (F.col("id") % 3 + 1).cast("string")).alias("payment_type"),
            at.alias("callback_time"),
            "total_amount",
            F.lit("1602").alias("payment_status"),
            F.to_date(at).alias("dt"),
        )

    @cached_property
    def order_status_log(self) -> DataFrame:
        done = self.raw("orders").where(F.col("o_orderstatus") == "F")
        at = F.col("o_orderdate") + hours(F.col("o_orderkey") % 96 + 48)
        return done.select(
            F.col("o_orderkey").alias("order_id"), at.alias("create_time"), F.lit("1004").alias("order_status"), F.to_date(at).alias("dt")
        )

    @cached_property
    def base_dic(self) -> DataFrame:
        """Code dictionary: payment channels from the order priorities, three per parent."""
        codes = self.raw("orders").select("o_orderpriority").distinct()
        number = F.split_part("o_orderpriority", F.lit("-"), F.lit(1))
        return codes.select(
            F.concat(F.lit("110"), number).alias("dic_code"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("dic_name"),
            F.lit("11").alias("parent_code"),
        )

    @cached_property
    def province(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("region_id"),
            F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("area_code"),
            F.concat(F.lit("CN-"), F.col("n_nationkey").cast("string")).alias("iso_code"),
            F.concat(F.lit("CN-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso_3166_2"),
        )

    @cached_property
    def region(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region_name"))

    @cached_property
    def sku_info(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_retailprice").alias("price"),
            F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("sku_name"),
            F.col("p_name").alias("sku_desc"),
            (F.col("p_size") / 10.0).alias("weight"),
            (F.col("p_partkey") % 10 != 0).alias("is_sale"),
            F.col("p_name").alias("spu_id"),
            F.concat_ws("/", "p_type", "p_brand", F.col("p_size").cast("string")).alias("category3_id"),
            F.col("p_brand").alias("tm_id"),
        )

    @cached_property
    def spu_info(self) -> DataFrame:
        return self.raw("part").select(F.col("p_name").alias("id"), F.initcap("p_name").alias("spu_name")).distinct()

    @cached_property
    def category3(self) -> DataFrame:
        return self.raw("part").select(
            F.concat_ws("/", "p_type", "p_brand", F.col("p_size").cast("string")).alias("id"),
            F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("name"),
            F.concat_ws("/", "p_type", "p_brand").alias("category2_id"),
        ).distinct()

    @cached_property
    def category2(self) -> DataFrame:
        return self.raw("part").select(
            F.concat_ws("/", "p_type", "p_brand").alias("id"), F.lower("p_brand").alias("name"), F.col("p_type").alias("category1_id")
        ).distinct()

    @cached_property
    def category1(self) -> DataFrame:
        return self.raw("part").select(F.col("p_type").alias("id"), F.lower("p_type").alias("name")).distinct()

    @cached_property
    def trademark(self) -> DataFrame:
        return self.raw("part").select(F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name")).distinct()

    @cached_property
    def sku_attr_value(self) -> DataFrame:
        word = F.explode(F.array(F.struct(F.lit("size").alias("n"), F.col("p_size").cast("string").alias("v")), F.struct(F.lit("type").alias("n"), F.col("p_type").alias("v"))))
        return self.raw("part").select("p_partkey", word.alias("a")).select(
            F.col("p_partkey").alias("sku_id"),
            F.length("a.n").cast("string").alias("attr_id"),
            F.md5("a.v").alias("value_id"),
            F.col("a.n").alias("attr_name"),
            F.col("a.v").alias("value_name"),
        )

    @cached_property
    def sku_sale_attr_value(self) -> DataFrame:
        colour = F.split_part("p_name", F.lit(" "), F.lit(1))
        return self.raw("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.lit("1").alias("sale_attr_id"),
            F.md5(colour).alias("sale_attr_value_id"),
            F.lit("colour").alias("sale_attr_name"),
            colour.alias("sale_attr_value_name"),
        )

    @cached_property
    def user_info(self) -> DataFrame:
        key = F.col("c_custkey")
        phone = F.when(key % 10 == 0, F.lit("n/a")).otherwise(F.concat(F.lit("138"), F.lpad(key.cast("string"), 8, "0")))
        mail = F.when(key % 9 == 0, F.lit("nobody")).otherwise(F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("_"))), F.lit("@mail"), (key % 4).cast("string"), F.lit(".com")))
        return self.raw("customer").select(
            key.alias("id"),
            F.col("c_name").alias("name"),
            phone.alias("phone_num"),
            mail.alias("email"),
            (key % 5 + 1).cast("string").alias("user_level"),
            F.col("c_mktsegment").alias("segment"),
            F.date_add(F.lit("1970-01-01").cast("date"), (key % 9000).cast("int")).alias("birthday"),
            F.when(key % 3 == 0, F.lit("M")).when(key % 3 == 1, F.lit("F")).alias("gender"),
            F.col("c_nationkey").alias("province_id"),
        )

    @cached_property
    def activity_rule(self) -> DataFrame:
        """One rule per discount level in use."""
        level = F.round(F.col("l_discount") * 100).cast("int")
        return self.raw("lineitem").where("l_discount > 0").select(level.alias("id")).distinct().select(
            "id",
            (F.col("id") % 3).alias("activity_id"),
            F.concat(F.lit("310"), (F.col("id") % 3 + 1).cast("string")).alias("activity_type"),
            (F.col("id") * 100).alias("condition_amount"),
            (F.col("id") + 1).alias("condition_num"),
            (F.col("id") * 5).alias("benefit_amount"),
            (10 - F.col("id") % 9).alias("benefit_discount"),
            F.col("id").alias("benefit_level"),
        )

    @cached_property
    def activity_info(self) -> DataFrame:
        return self.activity_rule.select(F.col("activity_id").alias("id")).distinct().select(
            "id", F.concat(F.lit("activity "), F.col("id").cast("string")).alias("activity_name")
        )

    @cached_property
    def coupon_info(self) -> DataFrame:
        """One coupon per last digit of the event item."""
        number = F.col("k") % 10
        return self.events.select(number.alias("id")).distinct().select(
            "id",
            F.concat(F.lit("coupon "), F.col("id").cast("string")).alias("coupon_name"),
            F.concat(F.lit("320"), (F.col("id") % 3 + 1).cast("string")).alias("coupon_type"),
            (F.col("id") * 100).alias("condition_amount"),
            (F.col("id") + 1).alias("condition_num"),
            (F.col("id") * 5).alias("benefit_amount"),
            (10 - F.col("id") % 9).alias("benefit_discount"),
            F.concat(F.lit("330"), (F.col("id") % 3 + 1).cast("string")).alias("range_type"),
        )

    def _event(self, kind: str) -> DataFrame:
        return self.events.where(F.col("event_type") == kind)

    @cached_property
    def favor_info(self) -> DataFrame:
        return self._event("click").select(F.col("event_id").alias("id"), "user_id", F.col("k").alias("sku_id"), F.col("ts").alias("create_time"), "dt")

    @cached_property
    def cart_info(self) -> DataFrame:
        return self._event("view").select(
            F.col("event_id").alias("id"),
            "user_id",
            F.col("k").alias("sku_id"),
            (F.col("event_id") % 5 + 1).alias("sku_num"),
            F.when(F.col("event_id") % 3 == 0, "1").otherwise("0").alias("is_ordered"),
            F.col("ts").alias("create_time"),
            "dt",
        )

    @cached_property
    def coupon_use(self) -> DataFrame:
        return self._event("signup").select(
            F.col("event_id").alias("id"),
            (F.col("k") % 10).alias("coupon_id"),
            "user_id",
            F.col("event_id").alias("order_id"),
            F.when(F.col("value") >= 20, F.col("ts")).alias("used_time"),
            "dt",
        )

    @cached_property
    def z_log(self) -> DataFrame:
        """Raw page log, one JSON text per row."""
        e = self.raw("events")
        k = F.get_json_object("props", "$.k").cast("int")
        text = lambda c: c.cast("string")
        common = F.struct(
            text(F.col("user_id") % 25).alias("ar"),
            F.concat(F.lit("brand"), text(k % 7)).alias("ba"),
            F.concat(F.lit("channel"), text(k % 5)).alias("ch"),
            F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"),
            F.concat(F.lit("model"), text(k % 11)).alias("md"),
            F.concat(F.lit("mid_"), text(F.col("user_id"))).alias("mid"),
            F.when(F.col("user_id") % 2 == 0, "iOS 17").otherwise("Android 14").alias("os"),
            F.when(F.col("event_type") != "error", text(F.col("user_id"))).alias("uid"),
            F.concat(F.lit("v2."), text(k % 4)).alias("vc"),
            F.concat_ws("_", text(F.col("user_id")), F.date_format("ts", "yyyyMMdd")).alias("sid"),
        )
        page = F.struct(
            text(k).alias("item"),
            F.lit("sku_id").alias("item_type"),
            F.col("event_type").alias("page_id"),
            F.when(k % 2 == 0, F.lit("home")).alias("last_page_id"),
            text(k % 10).alias("from_pos_id"),
            text(k % 3).alias("from_pos_seq"),
            text(k % 6).alias("refer_id"),
            (money("value") * 1000).cast("bigint").alias("during_time"),
        )
        ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
        return e.select(F.to_json(F.struct(common.alias("common"), page.alias("page"), ms.alias("ts"))).alias("log"), F.to_date("ts").alias("dt"))

"""Retail event facts. With ``as_of`` a builder gives the rows of that day, without it the whole history (first load)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import day, from_epoch_ms
from tallyflow.operators.dims import enrich
from tallyflow.operators.history import flow_daily, flow_first
from tallyflow.operators.ranking import first_row

LOG = """struct<
  common: struct<ar: string, ba: string, ch: string, is_new: string, md: string, mid: string, os: string, uid: string, vc: string, sid: string>,
  page: struct<item: string, item_type: string, last_page_id: string, page_id: string, from_pos_id: string, from_pos_seq: string,
               refer_id: string, during_time: bigint>,
  ts: bigint>"""


def on_day(rows: DataFrame, as_of: str | None, dt: str = "dt") -> DataFrame:
    return rows if as_of is None else rows.where(F.col(dt) == day(as_of))


def favor_add(favors: DataFrame, as_of: str | None = None) -> DataFrame:
    rows = favors.select("id", "user_id", "sku_id", F.to_date("create_time").alias("date_id"), "create_time", F.to_date("create_time").alias("dt"))
    return on_day(rows, as_of)


def coupon_used(uses: DataFrame, as_of: str | None = None) -> DataFrame:
    used = uses.where(F.col("used_time").isNotNull())
    rows = used.select("id", "coupon_id", "user_id", "order_id", F.to_date("used_time").alias("date_id"), "used_time", F.to_date("used_time").alias("dt"))
    return on_day(rows, as_of)


def cart_add(carts: DataFrame, as_of: str | None = None) -> DataFrame:
    rows = carts.select("id", "user_id", "sku_id", F.to_date("create_time").alias("date_id"), "create_time", "sku_num", F.to_date("create_time").alias("dt"))
    return on_day(rows, as_of)


def cart_snapshot(carts: DataFrame) -> DataFrame:
    """Carts not yet ordered."""
    return carts.where(F.col("is_ordered") == "0").select("id", "user_id", "sku_id", "sku_num", "dt")


def order_detail(detail: DataFrame, info: DataFrame, activity: DataFrame, coupon: DataFrame, as_of: str | None = None) -> DataFrame:
    """Order lines with user, place, activity and coupon."""
    orders = on_day(info.select(F.col("id").alias("order_id"), "user_id", "province_id", "create_time", "dt"), as_of)
    lines = detail.join(orders, "order_id", "left" if as_of is None else "inner")
    lines = lines.join(activity.withColumnRenamed("order_detail_id", "id"), "id", "left")
    lines = lines.join(coupon.withColumnRenamed("order_detail_id", "id"), "id", "left")
    zero = F.lit(0).cast("decimal(16,2)")
    return lines.select(
        "id", "order_id", "user_id", "sku_id", "shop_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        F.col("dt").alias("date_id"), "create_time", "sku_num", "split_original_amount",
        F.coalesce("split_activity_amount", zero).alias("split_activity_amount"),
        F.coalesce("split_coupon_amount", zero).alias("split_coupon_amount"),
        "split_total_amount", "dt",
    )


def order_lines(detail: DataFrame, info: DataFrame) -> DataFrame:
    """The order-line columns that summaries read: one join instead of three."""
    orders = info.select(F.col("id").alias("order_id"), "user_id", "province_id", "create_time", "dt")
    return detail.join(orders, "order_id", "left")


def pay_detail(detail: DataFrame, payments: DataFrame, info: DataFrame, activity: DataFrame, coupon: DataFrame, dictionary: DataFrame, as_of: str | None = None) -> DataFrame:
    """Paid order lines: payment day, channel name, activity and coupon attached."""
    paid = on_day(payments.where(F.col("payment_status") == "1602"), as_of)
    paid = paid.select("order_id", "user_id", F.col("payment_type").alias("payment_type_code"), "callback_time", "dt")
    lines = detail.join(paid, "order_id", "inner")
    lines = lines.join(info.select(F.col("id").alias("order_id"), "province_id"), "order_id", "left")
    lines = lines.join(activity.withColumnRenamed("order_detail_id", "id"), "id", "left")
    lines = lines.join(coupon.withColumnRenamed("order_detail_id", "id"), "id", "left")
    channels = dictionary.where(F.col("parent_code") == "11")
    lines = enrich(lines, channels, "payment_type_code", "dic_code", {"dic_name": "payment_type_name"})
    return lines.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
        "payment_type_name", F.col("dt").alias("date_id"), "callback_time", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", F.col("split_total_amount").alias("split_payment_amount"), "dt",
    )


def _flow_inputs(info: DataFrame, payments: DataFrame, status_log: DataFrame, days) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = days(info).select(
        F.col("id").alias("order_id"), "user_id", "province_id", F.col("create_time").alias("order_time"),
        "original_total_amount", "activity_reduce_amount", "coupon_reduce_amount", "total_amount",
    )
    paid = days(payments.where(F.col("payment_status") == "1602")).select(
        "order_id", F.col("callback_time").alias("payment_time"), F.col("total_amount").alias("payment_amount")
    )
    done = days(status_log.where(F.col("order_status") == "1004")).select("order_id", F.col("create_time").alias("finish_time"))
    return orders, paid, done


def trade_flow_first(info: DataFrame, payments: DataFrame, status_log: DataFrame, as_of: str) -> DataFrame:
    """Order life cycle of everything known on ``as_of``."""
    return flow_first(*_flow_inputs(info, payments, status_log, lambda d: d.where(F.col("dt") <= day(as_of))))


def trade_flow_daily(held: DataFrame, info: DataFrame, payments: DataFrame, status_log: DataFrame, as_of: str) -> DataFrame:
    """Open orders of the day before plus the day's orders, payments and finishes."""
    still_open = held.where(F.col("dt") == day("9999-12-31"))
    return flow_daily(still_open, *_flow_inputs(info, payments, status_log, lambda d: on_day(d, as_of)))


def page_view(log: DataFrame, zone: str = "UTC") -> DataFrame:
    """Page log rows, parsed once with a fixed schema; rows without a page are other kinds of log.

    The parse goes through an explode: a filter on its result would otherwise be pushed below it and parse every line twice.
    """
    parsed = log.select(F.explode(F.array(F.from_json("log", LOG))).alias("l")).where("l.page is not null")
    c = parsed.select(
        F.col("l.common.ar").alias("province_id"), F.col("l.common.ba").alias("brand"), F.col("l.common.ch").alias("channel"),
        F.col("l.common.is_new").alias("is_new"), F.col("l.common.md").alias("model"), F.col("l.common.mid").alias("mid_id"),
        F.col("l.common.os").alias("operate_system"), F.col("l.common.uid").alias("user_id"), F.col("l.common.vc").alias("version_code"),
        F.col("l.page.item").alias("page_item"), F.col("l.page.item_type").alias("page_item_type"), "l.page.last_page_id", "l.page.page_id",
        "l.page.from_pos_id", "l.page.from_pos_seq", "l.page.refer_id", from_epoch_ms("l.ts", zone).alias("view_time"),
        F.col("l.common.sid").alias("session_id"), "l.page.during_time",
    )
    return c.withColumn("dt", F.to_date("view_time"))


LOGIN_COLUMNS = ["channel", "province_id", "version_code", "mid_id", "brand", "model", "operate_system"]


def user_login(views: DataFrame) -> DataFrame:
    """First page of each session of a known user."""
    known = views.where(F.col("user_id").isNotNull())
    first = first_row(known, ["session_id"], [F.col("view_time")], ["user_id", "view_time", "dt", *LOGIN_COLUMNS])
    return first.withColumnRenamed("view_time", "login_time")


def user_register(users: DataFrame, views: DataFrame, register_page: str) -> DataFrame:
    """New users with the device and channel of their first registration page."""
    pages = views.where((F.col("page_id") == register_page) & F.col("user_id").isNotNull())
    first = first_row(pages, ["user_id"], [F.col("view_time")], LOGIN_COLUMNS)
    known = users.where(F.col("create_time").isNotNull()).withColumn("user_id", F.col("user_id").cast("string"))
    return known.join(first, "user_id", "left").withColumn("dt", F.to_date("create_time"))

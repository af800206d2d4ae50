"""Retail summaries by day, 7 and 30 days, and to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import day
from tallyflow.operators import todate
from tallyflow.operators.dims import enrich
from tallyflow.operators.horizons import horizon_sums

SKU_NAMES = ["sku_name", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name", "tm_id", "tm_name"]
PLACE = ["province_name", "area_code", "iso_code", "iso_3166_2"]
AMOUNTS = ["order_original_amount_1d", "activity_reduce_amount_1d", "coupon_reduce_amount_1d", "order_total_amount_1d"]


def _amounts() -> list:
    sums = [("split_original_amount", AMOUNTS[0]), ("split_activity_amount", AMOUNTS[1]), ("split_coupon_amount", AMOUNTS[2]), ("split_total_amount", AMOUNTS[3])]
    return [F.sum(F.coalesce(c, F.lit(0).cast("decimal(16,2)"))).alias(a) for c, a in sums]


def sku_favor_add_1d(favors: DataFrame, sku: DataFrame) -> DataFrame:
    daily = favors.groupBy("sku_id", "dt").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    return enrich(daily, sku, "sku_id", "id", SKU_NAMES)


def user_coupon_used_1d(uses: DataFrame, coupon: DataFrame) -> DataFrame:
    daily = uses.groupBy("user_id", "coupon_id", "dt").agg(F.count(F.lit(1)).alias("used_count_1d"))
    return enrich(daily, coupon, "coupon_id", "id", ["coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule"])


def province_order_1d(lines: DataFrame, province: DataFrame) -> DataFrame:
    """Lines are collapsed to orders first, so the distinct count is a plain sum and one hot place spreads over its orders."""
    orders = lines.groupBy("province_id", "dt", "order_id").agg(*_amounts())
    daily = orders.groupBy("province_id", "dt").agg(F.count(F.lit(1)).alias("order_count_1d"), *[F.sum(a).alias(a) for a in AMOUNTS])
    return enrich(daily, province, "province_id", "id", PLACE)


def province_order_nd(daily: DataFrame, as_of: str) -> DataFrame:
    renamed = daily.withColumnsRenamed({c: c[:-3] for c in ["order_count_1d", *AMOUNTS]})
    return horizon_sums(renamed, as_of, ["province_id", *PLACE], [c[:-3] for c in ["order_count_1d", *AMOUNTS]])


def user_cart_add_1d(carts: DataFrame) -> DataFrame:
    return carts.groupBy("user_id", "dt").agg(F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d"))


def user_order_1d(lines: DataFrame) -> DataFrame:
    orders = lines.groupBy("user_id", "dt", "order_id").agg(F.sum("sku_num").alias("order_num_1d"), *_amounts())
    return orders.groupBy("user_id", "dt").agg(F.count(F.lit(1)).alias("order_count_1d"), F.sum("order_num_1d").alias("order_num_1d"), *[F.sum(a).alias(a) for a in AMOUNTS])


TD_MEASURES = ["order_count_1d", "order_num_1d", *AMOUNTS]
TD_DAYS = {"first": "order_date_first", "last": "order_date_last"}


def user_order_td(daily: DataFrame, as_of: str) -> DataFrame:
    return _td_names(todate.rebuild(daily, ["user_id"], TD_MEASURES, as_of=as_of, **TD_DAYS))


def user_order_td_carry(daily: DataFrame, as_of: str, how: str) -> DataFrame:
    """Yesterday's to-date rows carried over with today's: ``how`` is 'union' or 'full_join'."""
    held = todate.rebuild(daily.where(F.col("dt") < day(as_of)), ["user_id"], TD_MEASURES, as_of=as_of, **TD_DAYS)
    today = daily.where(F.col("dt") == day(as_of))
    step = todate.carry_union if how == "union" else todate.carry_full_join
    return _td_names(step(held, today, ["user_id"], TD_MEASURES, **TD_DAYS))


def _td_names(td: DataFrame) -> DataFrame:
    return td.withColumnsRenamed({m: m[:-3] + "_td" for m in TD_MEASURES})


def user_payment_1d(paid_lines: DataFrame) -> DataFrame:
    orders = paid_lines.groupBy("user_id", "dt", "order_id").agg(F.sum("sku_num").alias("n"), F.sum("split_payment_amount").alias("amount"))
    return orders.groupBy("user_id", "dt").agg(
        F.count(F.lit(1)).alias("payment_count_1d"), F.sum("n").alias("payment_num_1d"), F.sum("amount").alias("payment_amount_1d")
    )


def user_sku_order_1d(lines: DataFrame, sku: DataFrame) -> DataFrame:
    daily = lines.groupBy("user_id", "sku_id", "dt").agg(F.count(F.lit(1)).alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_amounts())
    return enrich(daily, sku, "sku_id", "id", SKU_NAMES)


def user_sku_order_nd(lines: DataFrame, sku: DataFrame, as_of: str) -> DataFrame:
    """Summed before the goods names are joined: the join then runs on one row per user and item."""
    base = lines.select("user_id", "sku_id", "dt", F.lit(1).alias("order_count"), F.col("sku_num").alias("order_num"), *[
        F.col(c).alias(a[:-3]) for c, a in zip(["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"], AMOUNTS)
    ])
    wide = horizon_sums(base, as_of, ["user_id", "sku_id"], ["order_count", "order_num", *[a[:-3] for a in AMOUNTS]])
    return enrich(wide, sku, "sku_id", "id", SKU_NAMES)


def page_visitor_1d(views: DataFrame) -> DataFrame:
    return views.groupBy("mid_id", "brand", "model", "operate_system", "page_id", "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d")
    )


def session_1d(views: DataFrame) -> DataFrame:
    return views.groupBy("session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel", "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d")
    )


def user_login_td(users: DataFrame, logins: DataFrame, as_of: str) -> DataFrame:
    """First load: every known user; without a login the creation day stands for it."""
    seen = logins.where(F.col("dt") <= day(as_of)).groupBy("user_id").agg(F.max("dt").alias("last"), F.count(F.lit(1)).alias("n"))
    return users.join(seen, "user_id", "left").select(
        "user_id",
        F.coalesce("last", F.to_date("create_time")).alias("login_date_last"),
        F.to_date("create_time").alias("login_date_first"),
        F.coalesce("n", F.lit(1)).alias("login_count_td"),
    )


def user_login_td_daily(held: DataFrame, logins: DataFrame, as_of: str) -> DataFrame:
    """Yesterday's rows ⟗ today's logins."""
    new = logins.where(F.col("dt") == day(as_of)).groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    return held.join(new, "user_id", "full").select(
        "user_id",
        F.when(F.col("_n").isNull(), F.col("login_date_last")).otherwise(day(as_of)).alias("login_date_last"),
        F.coalesce("login_date_first", day(as_of)).alias("login_date_first"),
        (F.coalesce("login_count_td", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("login_count_td"),
    )


def login_td(logins: DataFrame, as_of: str) -> DataFrame:
    """First and last login and count per user from the login facts alone."""
    return logins.where(F.col("dt") <= day(as_of)).groupBy("user_id").agg(
        F.min("dt").alias("login_date_first"), F.max("dt").alias("login_date_last"), F.count(F.lit(1)).alias("login_count_td")
    )


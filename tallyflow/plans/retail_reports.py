"""Retail reports, one row set per report date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.ratios import rate, ratio
from tallyflow.functions.times import day, days_before, within
from tallyflow.operators.align import align_union
from tallyflow.operators.dims import enrich
from tallyflow.operators.horizons import explode_horizons, horizon_agg, horizon_rows
from tallyflow.operators.ordered import consecutive_by_islands, consecutive_by_lead, consecutive_by_mask, number_and_next
from tallyflow.operators.ranking import top_with_ties

PLACE = ["province_id", "province_name", "area_code", "iso_code", "iso_3166_2"]
CATEGORY = ["category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name"]


def dated(df: DataFrame, as_of: str) -> DataFrame:
    return df.select(day(as_of).alias("dt"), "*")


def rows() -> Column:
    return F.count(F.lit(1))


def user_stats(login_td: DataFrame, as_of: str) -> DataFrame:
    """New and active users of the last 1, 7 and 30 days."""
    active = explode_horizons(login_td, as_of, dt="login_date_last")
    is_new = F.col("login_date_first") >= F.date_sub(day(as_of), F.col("recent_days") - 1)
    out = active.groupBy("recent_days").agg(F.sum(is_new.cast("int")).alias("new_user_count"), rows().alias("active_user_count"))
    return dated(out, as_of)


def coupon_stats(user_coupon_1d: DataFrame, as_of: str) -> DataFrame:
    today = user_coupon_1d.where(F.col("dt") == day(as_of)).drop("dt")
    return dated(today.groupBy("coupon_id", "coupon_name").agg(F.sum("used_count_1d").alias("used_count"), rows().alias("used_user_count")), as_of)


def new_order_user_stats(order_td: DataFrame, as_of: str) -> DataFrame:
    first = explode_horizons(order_td, as_of, dt="order_date_first")
    return dated(first.groupBy("recent_days").agg(rows().alias("new_order_user_count")), as_of)


def order_by_province(daily: DataFrame, wide: DataFrame, as_of: str) -> DataFrame:
    today = daily.where(F.col("dt") == day(as_of)).select(
        *PLACE, F.lit(1).alias("recent_days"), F.col("order_count_1d").alias("order_count"), F.col("order_total_amount_1d").alias("order_total_amount")
    )
    return dated(today.unionByName(horizon_rows(wide, PLACE, ["order_count", "order_total_amount"])), as_of)


def consecutive_users(order_1d: DataFrame, as_of: str, how: str = "mask") -> DataFrame:
    """Users with three order days in a row within the last 7; ``near`` allows the three days to lie 3 apart."""
    recent = order_1d.where(within(as_of, 7)).select("user_id", "dt").distinct()
    if how == "lead":
        hit = consecutive_by_lead(recent, "user_id", 3)
    elif how == "near":
        hit = consecutive_by_lead(recent, "user_id", 3, gap=3)
    elif how == "islands":
        hit = consecutive_by_islands(recent, "user_id", 3)
    else:
        hit = consecutive_by_mask(recent, "user_id", 3, day(as_of))
    return dated(hit.agg(F.lit(7).alias("recent_days"), rows().alias("order_continuously_user_count")), as_of)


def order_stats_by(user_sku_1d: DataFrame, keys: list[str], as_of: str) -> DataFrame:
    """Orders and buyers per category or brand for 1, 7 and 30 days; a buyer is counted once per horizon.

    Collapsed to (keys, user) first, so a hot category spreads over its users.
    """
    users = horizon_agg(user_sku_1d, as_of, [*keys, "user_id"], [F.sum("order_count_1d").alias("n")])
    out = users.groupBy("recent_days", *keys).agg(F.sum("n").alias("order_count"), F.sum((F.col("n") > 0).cast("int")).alias("order_user_count"))
    return dated(out, as_of)


def order_to_pay_interval_avg(flow: DataFrame, as_of: str) -> DataFrame:
    """Mean seconds from order to payment of the orders paid on the day."""
    seconds = F.timestamp_diff("SECOND", F.col("order_time"), F.col("payment_time"))
    paid = flow.where(F.to_date("payment_time") == day(as_of))
    return dated(paid.agg(ratio(F.sum(seconds), rows(), None).alias("order_to_pay_interval_avg")), as_of)


def page_path(views: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    """Edges step-n:page → step-(n+1):next page with counts; the last page of a session leads to 'null'."""
    v = views.where(within(as_of, days)).select("session_id", "view_time", "page_id")
    steps = number_and_next(v, ["session_id"], ["view_time"], F.date_trunc("HOUR", "view_time"), "page_id")
    step = lambda n, page: F.concat(F.lit("step-"), n.cast("string"), F.lit(":"), page)
    edges = steps.select(
        step(F.col("rn"), F.col("page_id")).alias("source"), F.coalesce(step(F.col("rn") + 1, F.col("next_value")), F.lit("null")).alias("target")
    )
    return dated(edges.groupBy("source", "target").agg(rows().alias("path_count")), as_of)


def repeat_purchase_by_tm(user_sku_nd: DataFrame, as_of: str) -> DataFrame:
    """Share of a brand's buyers with at least two orders in 30 days."""
    users = user_sku_nd.groupBy("tm_id", "tm_name", "user_id").agg(F.sum("order_count_30d").alias("n"))
    out = users.groupBy("tm_id", "tm_name").agg(
        rate(F.sum((F.col("n") >= 2).cast("int")), F.sum((F.col("n") >= 1).cast("int")), 2).alias("order_repeat_rate")
    )
    return dated(out.withColumn("recent_days", F.lit(30)), as_of)


def sku_cart_num_top3_by_cate(cart: DataFrame, sku: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    """Three most carted items per category, ties included."""
    items = cart.where(within(as_of, days)).groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    named = enrich(items, sku, "sku_id", "id", ["sku_name", *CATEGORY])
    return dated(top_with_ties(named, ["category1_id", "category2_id", "category3_id"], "cart_num", 3), as_of)


def sku_favor_count_top3_by_tm(favor_1d: DataFrame, as_of: str) -> DataFrame:
    today = favor_1d.where(F.col("dt") == day(as_of)).select("tm_id", "tm_name", "sku_id", "sku_name", "favor_add_count_1d")
    return dated(top_with_ties(today, ["tm_id"], "favor_add_count_1d", 3), as_of)


def traffic_by_channel(sessions: DataFrame, as_of: str) -> DataFrame:
    """Visitors, mean stay, mean pages, sessions and bounce rate per channel for 1, 7 and 30 days.

    Collapsed to (channel, visitor) first, so the visitor count needs no second pass over the sessions.
    """
    visitors = horizon_agg(
        sessions, as_of, ["channel", "mid_id"],
        [rows().alias("sv"), F.sum("during_time_1d").alias("ms"), F.sum("page_count_1d").alias("pages"), F.sum((F.col("page_count_1d") == 1).cast("int")).alias("single")],
    )
    whole = lambda part: F.floor(ratio(F.sum(part), F.sum("sv"))).cast("bigint")
    out = visitors.groupBy("recent_days", "channel").agg(
        rows().alias("uv_count"),
        F.floor(ratio(F.sum("ms"), F.sum("sv")) / 1000).cast("bigint").alias("avg_duration_sec"),
        whole("pages").alias("avg_page_count"),
        F.sum("sv").alias("sv_count"),
        rate(F.sum("single"), F.sum("sv"), 2).alias("bounce_rate"),
    )
    return dated(out, as_of)


def user_action(page_visitor_1d: DataFrame, cart_1d: DataFrame, order_1d: DataFrame, payment_1d: DataFrame, as_of: str, home: str = "home", detail: str = "good_detail") -> DataFrame:
    """Funnel home → detail → cart → order → pay: visitors or users per step, one row."""
    on = lambda df: df.where(F.col("dt") == day(as_of))
    pages = on(page_visitor_1d).where(F.col("page_id").isin(home, detail)).agg(
        F.coalesce(F.sum((F.col("page_id") == home).cast("int")), F.lit(0)).alias("home_count"),
        F.coalesce(F.sum((F.col("page_id") == detail).cast("int")), F.lit(0)).alias("good_detail_count"),
    )
    parts = [pages] + [on(df).agg(rows().alias(f"{n}_count")) for df, n in ((cart_1d, "cart"), (order_1d, "order"), (payment_1d, "payment"))]
    return align_union([dated(p, as_of) for p in parts], ["dt"])


def user_change(today_td: DataFrame, previous_td: DataFrame, as_of: str) -> DataFrame:
    """Churned: last login exactly 7 days ago. Returned: here today after a gap of 8 days or more."""
    churned = today_td.where(F.col("login_date_last") == days_before(as_of, 7)).agg(rows().alias("user_churn_count"))
    before = previous_td.select("user_id", F.col("login_date_last").alias("previous"))
    here = today_td.where(F.col("login_date_last") == day(as_of)).join(before, "user_id", "inner")
    back = here.where(F.datediff("login_date_last", "previous") >= 8).agg(rows().alias("user_back_count"))
    return align_union([dated(churned, as_of), dated(back, as_of)], ["dt"])


def user_retention(login_td: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """For each first-login day of the last ``days``: share of its users seen on the report day."""
    cohort = login_td.where((F.col("login_date_first") >= days_before(as_of, days)) & (F.col("login_date_first") < day(as_of)))
    back = F.sum((F.col("login_date_last") == day(as_of)).cast("int"))
    out = cohort.groupBy(F.col("login_date_first").alias("create_date")).agg(
        back.alias("retention_count"), rows().alias("new_user_count"), F.round(ratio(back, rows()) * 100, 2).alias("retention_rate")
    )
    return dated(out.withColumn("retention_day", F.datediff(day(as_of), "create_date")), as_of)



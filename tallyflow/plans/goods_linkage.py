"""Goods-linkage warehouse: behaviour, sales and purchases per user, goods and shop over 1, 7 and 30 days, and scores on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.functions.ratios import ratio
from tallyflow.functions.times import day, days_before, within
from tallyflow.operators.dims import enrich
from tallyflow.operators.history import history_init
from tallyflow.operators.distinct import horizon_profile
from tallyflow.operators.horizons import HORIZONS, explode_horizons
from tallyflow.operators.ranking import best_row, percent_rank_whole, rank_whole, top_rows
from tallyflow.session import materialise

# Names shown for codes and for missing values.
PAY_NAMES = {"alipay": "支付宝", "wechat": "微信支付", "bank": "银行卡支付", "balance": "余额支付"}
PAY_TYPES = {"alipay": "第三方支付", "wechat": "第三方支付", "bank": "银行支付", "balance": "账户支付"}
BEHAVIOR_NAMES = {"view": "访问", "favor": "收藏", "cart": "加购"}
BEHAVIOR_GROUPS = {"view": "浏览行为", "favor": "互动行为", "cart": "互动行为"}
DEVICES = {"iOS": "iOS", "Android": "Android", "PC": "PC"}


def rows():
    return F.count(F.lit(1))


def times(kind: str):
    return F.sum((F.col("behavior_type") == kind).cast("int"))


# --- dimensions


def goods_history(goods: DataFrame, as_of: str) -> DataFrame:
    filled = goods.select(
        "goods_id",
        "shop_id",
        F.coalesce(F.nullif("goods_name", F.lit("")), F.concat(F.lit("商品_"), F.col("goods_id").cast("string"))).alias("goods_name"),
        *[clean.default_fill(c, "未分类").alias(c) for c in ("category_l1", "category_l2", "category_l3")],
        F.coalesce("is_traffic_item", F.lit(0)).alias("is_traffic_item"),
        F.coalesce("is_top_seller", F.lit(0)).alias("is_top_seller"),
        F.abs(F.coalesce("base_price", F.lit(0.0))).cast("decimal(10,2)").alias("base_price"),
        F.coalesce("goods_status", F.lit(0)).alias("goods_status"),
        F.to_date(F.coalesce("create_time", F.lit("2025-07-01"))).alias("create_date"),
    )
    return history_init(filled, day(as_of))


def shop_history(shops: DataFrame, as_of: str) -> DataFrame:
    filled = shops.select(
        "shop_id",
        F.coalesce(F.nullif("shop_name", F.lit("")), F.concat(F.lit("店铺_"), F.col("shop_id").cast("string"))).alias("shop_name"),
        clean.clamp("shop_level", 1, 5, otherwise=3).alias("shop_level"),
        clean.default_fill("shop_type", "普通店").alias("shop_type"),
        clean.default_fill("main_category", "综合").alias("main_category"),
    )
    return history_init(filled, day(as_of))


def user_history(users: DataFrame, as_of: str) -> DataFrame:
    filled = users.select(
        "user_id",
        F.coalesce(F.nullif("user_name", F.lit("")), F.concat(F.lit("用户_"), F.col("user_id").cast("string"))).alias("user_name"),
        clean.default_fill("reg_channel", "web").alias("reg_channel"),
        clean.clamp("user_level", 1, 10, otherwise=1).alias("user_level"),
    )
    return history_init(filled, day(as_of))


def pay_channels(trade: DataFrame, as_of: str) -> DataFrame:
    codes = trade.select(F.col("pay_channel").alias("channel_code")).distinct()
    named = codes.withColumn("channel_name", clean.code_to_name("channel_code", PAY_NAMES, "其他支付")).withColumn(
        "channel_type", clean.code_to_name("channel_code", PAY_TYPES, "其他")
    )
    return history_init(named, day(as_of))


def behavior_types(log: DataFrame, as_of: str) -> DataFrame:
    codes = log.select(F.col("behavior_type").alias("behavior_code")).distinct()
    named = codes.withColumn("behavior_name", clean.code_to_name("behavior_code", BEHAVIOR_NAMES, "其他行为")).withColumn(
        "behavior_group", clean.code_to_name("behavior_code", BEHAVIOR_GROUPS, "其他")
    )
    return history_init(named, day(as_of))


def devices(log: DataFrame, as_of: str) -> DataFrame:
    kind = None
    for prefix, name in DEVICES.items():
        hit = F.col("device_id").startswith(prefix)
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    seen = log.select("device_id", "app_version").distinct()
    return history_init(seen.withColumn("device_type", kind.otherwise("其他设备")), day(as_of))


# --- facts


def behavior_detail(log: DataFrame) -> DataFrame:
    refer, kind = F.col("refer_goods_id"), F.col("behavior_type")
    return log.select(
        "user_id", "session_id", "goods_id",
        F.when(~refer.isin("", "null"), refer).alias("refer_goods_id"),
        F.when(kind.isin("view", "favor", "cart"), kind).otherwise("invalid").alias("behavior_type"),
        "behavior_time", clean.clamp("stay_duration", 0, 3600).alias("stay_duration"), "dt",
    )


def order_goods(lines: DataFrame, trade: DataFrame) -> DataFrame:
    """Order lines with payer, shop and pay time; joined on order and day."""
    paid = trade.select("order_id", "dt", "user_id", "shop_id", "pay_time")
    return lines.join(paid, ["order_id", "dt"]).select(
        "detail_id", "order_id", "user_id", "shop_id", "goods_id", clean.clamp("goods_quantity", 1, 100, otherwise=1).alias("goods_quantity"),
        F.abs("unit_price").cast("decimal(10,2)").alias("unit_price"), "pay_time", clean.default_fill("promotion_info", "无促销").alias("promotion_info"), "dt",
    )


def goods_core(goods: DataFrame) -> DataFrame:
    return goods.select(
        "goods_id", "shop_id", clean.strip_control("goods_name").alias("goods_name"),
        *[F.nullif(c, F.lit("")).alias(c) for c in ("category_l1", "category_l2", "category_l3")],
        *[F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)).alias(c) for c in ("is_traffic_item", "is_top_seller")],
        F.abs("base_price").cast("decimal(10,2)").alias("base_price"),
    )


def shop_core(shops: DataFrame) -> DataFrame:
    return shops.select("shop_id", clean.strip_control("shop_name").alias("shop_name"), clean.default_fill("shop_type", "其他").alias("shop_type"), clean.default_fill("main_category", "综合").alias("main_category"))


def user_core(users: DataFrame) -> DataFrame:
    channel = clean.keyword_category(F.lower("reg_channel"), [("app", "app"), ("web", "web")], "other")
    return users.select("user_id", clean.clamp("user_level", 1, 5, otherwise=3).alias("user_level"), channel.alias("reg_channel"))


# --- summaries: one row per horizon


def user_behavior(log: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    is_kind = lambda kind: (F.col("behavior_type") == kind).cast("bigint")
    sums = {"view_count": is_kind("view"), "favor_count": is_kind("favor"), "cart_count": is_kind("cart"), "stay": F.col("stay_duration"), "n": F.lit(1)}
    out = horizon_profile(log, as_of, ["user_id"], sums, {"distinct_goods_count": "goods_id", "distinct_session_count": "session_id"}, days)
    return out.select(
        "recent_days", "user_id", "view_count", "favor_count", "cart_count", ratio("stay", "n").alias("avg_stay_duration"), "distinct_goods_count", "distinct_session_count"
    )


def _paid_lines(lines: DataFrame, trade: DataFrame) -> DataFrame:
    paid = trade.where(F.col("pay_status") == 1).select("order_id", "dt", "user_id", "shop_id", "payment_amount", "pay_time")
    return lines.join(paid, ["order_id", "dt"])


GOODS = ["goods_name", "category_l1", "category_l2", "category_l3"]
SHOP = ["shop_name", "shop_level", "shop_type", "main_category"]


def goods_sales(lines: DataFrame, trade: DataFrame, goods: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Collapsed to (goods, buyer) before the distinct count and before the goods names are joined."""
    buyers = explode_horizons(_paid_lines(lines, trade), as_of, days).groupBy("recent_days", "goods_id", "user_id").agg(
        F.sum("goods_quantity").alias("q"), F.sum("total_price").alias("r"), F.sum("unit_price").alias("p"), rows().alias("n")
    )
    sold = buyers.groupBy("recent_days", "goods_id").agg(
        F.sum("q").alias("total_sales"), F.sum("r").alias("total_revenue"), ratio(F.sum("p"), F.sum("n")).alias("avg_price"), rows().alias("distinct_buyers")
    )
    on_sale = goods.where(F.col("goods_status") == 1).select("goods_id", *GOODS)
    return sold.join(on_sale, "goods_id")


def _paid_orders(lines: DataFrame, trade: DataFrame) -> DataFrame:
    """One row per paid order with its goods totals: later means count an order once."""
    sums = lines.groupBy("order_id", "dt").agg(F.sum("goods_quantity").alias("quantity"), F.sum("total_price").alias("revenue"))
    return trade.where(F.col("pay_status") == 1).join(sums, ["order_id", "dt"])


def shop_sales(lines: DataFrame, trade: DataFrame, shops: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    buyers = explode_horizons(_paid_orders(lines, trade), as_of, days).groupBy("recent_days", "shop_id", "user_id").agg(
        rows().alias("o"), F.sum("quantity").alias("q"), F.sum("revenue").alias("r"), F.sum("payment_amount").alias("a")
    )
    sold = buyers.groupBy("recent_days", "shop_id").agg(
        F.sum("o").alias("total_orders"), F.sum("q").alias("total_sales"), F.sum("r").alias("total_revenue"),
        ratio(F.sum("a"), F.sum("o")).alias("avg_order_value"), rows().alias("distinct_buyers"),
    )
    return sold.join(shops.select("shop_id", *SHOP), "shop_id")


def user_purchases(lines: DataFrame, trade: DataFrame, goods: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Orders, spending, last purchase and favourite category (most goods lines, ties by name)."""
    paid = trade.where(F.col("pay_status") == 1)
    orders = explode_horizons(paid, as_of, days).groupBy("recent_days", "user_id").agg(
        rows().alias("total_orders"), F.sum("payment_amount").alias("total_spent"), ratio(F.sum("payment_amount"), rows()).alias("avg_order_value"),
        F.max(F.to_date("pay_time")).alias("last_purchase_date"),
    )
    per_goods = explode_horizons(_paid_lines(lines, trade), as_of, days).groupBy("recent_days", "user_id", "goods_id").agg(rows().alias("n"))
    per_category = per_goods.join(goods.select("goods_id", "category_l1"), "goods_id").groupBy("recent_days", "user_id", "category_l1").agg(F.sum("n").alias("n"))
    favourite = best_row(per_category, ["recent_days", "user_id"], [F.col("n"), F.col("category_l1")], ["category_l1"])
    return orders.join(favourite.withColumnRenamed("category_l1", "favorite_category"), ["recent_days", "user_id"], "left")


def goods_behavior(log: DataFrame, lines: DataFrame, trade: DataFrame, goods: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Views, favourites, carts, paid orders and conversion; each side is aggregated before they meet. Idle goods keep a zero row."""
    seen = explode_horizons(log, as_of, days).groupBy("recent_days", "goods_id").agg(
        times("view").alias("view_count"), times("favor").alias("favor_count"), times("cart").alias("cart_count"),
        F.sum("stay_duration").alias("stay"), rows().alias("n"),
    )
    bought = explode_horizons(_paid_lines(lines, trade), as_of, days).groupBy("recent_days", "goods_id").agg(F.countDistinct("order_id").alias("purchase_count"))
    every = goods.select("goods_id", *GOODS[:3], F.explode(F.array(*[F.lit(d) for d in days])).alias("recent_days"))
    both = every.join(seen, ["recent_days", "goods_id"], "left").join(bought, ["recent_days", "goods_id"], "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("view_count", "favor_count", "cart_count", "purchase_count")}
    return both.withColumns(counts).select(
        "recent_days", "goods_id", *GOODS[:3], *counts, ratio("purchase_count", "view_count", None).alias("conversion_rate"), ratio("stay", "n", None).alias("avg_stay_duration")
    )


# --- reports


def beside(base: DataFrame, nd: DataFrame, key: str, measures: dict[str, str], days: Sequence[int] = (7, 30)) -> DataFrame:
    """7- and 30-day measures beside each base row: one aggregate and one join instead of a join per horizon."""
    picks = [F.max(F.when(F.col("recent_days") == d, F.col(m))).alias(f"last_{d}d_{o}") for d in days for m, o in measures.items()]
    wide = nd.where(F.col("recent_days").isin(*days)).groupBy(key).agg(*picks)
    joined = base.join(wide, key, "left")
    names = [f"last_{d}d_{o}" for d in days for o in measures.values()]
    return joined.withColumns({n: F.coalesce(n, F.lit(0)) for n in names})


def user_value_tier(behavior: DataFrame, purchases: DataFrame, log: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """Activity and spending tiers of users with behaviour in 7 days and purchases in 30 and 7 days."""
    b7 = behavior.where("recent_days = 7").select("user_id", "view_count")
    p30 = purchases.where("recent_days = 30").select("user_id", F.col("total_spent").alias("spent_30d"))
    p7 = purchases.where("recent_days = 7").select("user_id", F.col("total_orders").alias("orders_7d"))
    days = log.where(within(as_of, 7)).groupBy("user_id").agg(
        F.countDistinct("dt").alias("login_days_7d"), F.max(F.when(F.col("dt") == day(as_of), F.to_date("behavior_time"))).alias("last_active_date")
    )
    joined = b7.join(p30, "user_id").join(p7, "user_id").join(users.select("user_id", "user_name", "user_level"), "user_id").join(days, "user_id", "left")
    return joined.withColumn("active_tier", clean.tier("view_count", [(100, "高活跃"), (30, "中活跃")], "低活跃")).withColumn(
        "purchase_tier", clean.tier("spent_30d", [(5000, "高价值"), (1000, "中价值")], "低价值")
    )


def goods_growth(lines: DataFrame, trade: DataFrame, as_of: str) -> DataFrame:
    """Sales of the last 7 days against the 7 days before, in one pass."""
    now = F.col("dt") >= days_before(as_of, 6)
    sums = _paid_lines(lines, trade).where(within(as_of, 14)).groupBy("goods_id").agg(
        F.sum(F.when(now, F.col("goods_quantity"))).alias("now"), F.sum(F.when(~now, F.col("goods_quantity"))).alias("before")
    )
    return sums.select("goods_id", ratio(F.col("now") - F.col("before"), "before", None).alias("growth_rate"))


def goods_hot_rank(behavior: DataFrame, sales: DataFrame, growth: DataFrame, goods: DataFrame, behavior_days: int = 1) -> DataFrame:
    """Hot score 100 × (0.3 × (1 − percent rank of views) + 0.5 × (1 − percent rank of sales) + 0.2 × growth)."""
    viewed = behavior.where(F.col("recent_days") == behavior_days).select("goods_id", "view_count", "conversion_rate")
    sold = sales.where("recent_days = 7").select("goods_id", "total_sales", "total_revenue")
    base = goods.where("goods_status = 1").select("goods_id", "goods_name", "category_l1").join(viewed, "goods_id").join(sold, "goods_id")
    base = materialise(base, "goods-rank")  # read for two ranks, their slice totals and the row count
    ranked = rank_whole(rank_whole(base, "view_count", "view_rank"), "total_sales", "purchase_rank")
    n = F.greatest(base.agg(rows()).scalar() - 1, F.lit(1))
    part = lambda rank: 1 - (F.col(rank) - 1).cast("double") / n.cast("double")
    scored = ranked.join(growth, "goods_id", "left")
    score = 0.3 * part("view_rank") + 0.5 * part("purchase_rank") + 0.2 * F.coalesce("growth_rate", F.lit(0.0))
    return scored.withColumn("hot_score", F.round(score * 100, 2)).drop("growth_rate")


def goods_view_percentile(behavior: DataFrame, behavior_days: int = 30) -> DataFrame:
    """percent_rank of views over all goods."""
    viewed = behavior.where(F.col("recent_days") == behavior_days).select("goods_id", "view_count")
    return percent_rank_whole(materialise(viewed, "view-rank"), "view_count", "view_percent_rank")


def shop_competitiveness(lines: DataFrame, trade: DataFrame, shops: DataFrame, goods: DataFrame, as_of: str) -> DataFrame:
    """0.4 × sales against 7 days ago + 0.6 × repurchase rate, with the three best goods of the day."""
    daily = _paid_orders(lines, trade).where(within(as_of, 8)).groupBy("shop_id", "dt").agg(F.sum("quantity").alias("sales"))
    along = Window.partitionBy("shop_id").orderBy("dt")
    lagged = daily.withColumn("prev", F.lag("sales", 7).over(along)).where(F.col("dt") == day(as_of)).drop("dt")
    repeat = trade.where(within(as_of, 7)).groupBy("shop_id", "user_id").agg(rows().alias("n")).groupBy("shop_id").agg(
        ratio(F.sum((F.col("n") > 1).cast("int")), rows()).alias("repurchase_rate")
    )
    sold = _paid_lines(lines, trade).where(F.col("dt") == day(as_of)).groupBy("shop_id", "goods_id").agg(F.sum("goods_quantity").alias("q"))
    named = enrich(sold, goods, "goods_id", "goods_id", ["goods_name"]).groupBy("shop_id", "goods_name").agg(F.sum("q").alias("q"))
    best = top_rows(named, ["shop_id"], [F.desc("q"), F.asc("goods_name")], 3)
    top3 = best.groupBy("shop_id").agg(F.array_sort(F.collect_list(F.struct("rn", "goods_name"))).alias("t"))
    top3 = top3.select("shop_id", F.array_join(F.transform("t", lambda s: s["goods_name"]), ",").alias("top_3_goods"))
    sales7 = shop_sales(lines, trade, shops, as_of, (7,)).select("shop_id", "shop_name", "avg_order_value", "distinct_buyers")
    joined = lagged.join(sales7, "shop_id").join(repeat, "shop_id", "left").join(top3, "shop_id", "left")
    unknown = F.coalesce(F.col("prev"), F.lit(0)) == 0
    return joined.select(
        "shop_id", "shop_name",
        F.round(0.4 * F.when(unknown, 1.0).otherwise(ratio("sales", "prev")) + 0.6 * F.coalesce("repurchase_rate", F.lit(0.0)), 2).alias("comp_index"),
        F.when(unknown, 0.0).otherwise(ratio(F.col("sales") - F.col("prev"), "prev")).alias("sales_growth_rate"),
        F.coalesce("repurchase_rate", F.lit(0.0)).alias("repurchase_rate"), "avg_order_value", "distinct_buyers", "top_3_goods",
    )


def category_conversion(behavior: DataFrame, behavior_days: int = 1) -> DataFrame:
    """Cart, favourite and buy rates per category; lost = 1 − buy rate."""
    sums = behavior.where(F.col("recent_days") == behavior_days).groupBy("category_l1", "category_l2").agg(
        *[F.sum(c).alias(c) for c in ("view_count", "cart_count", "favor_count", "purchase_count")]
    )
    bought = ratio("purchase_count", "view_count", None)
    return sums.select(
        "category_l1", "category_l2", "view_count", ratio("cart_count", "view_count", None).alias("cart_add_rate"),
        ratio("favor_count", "view_count", None).alias("favor_rate"), bought.alias("purchase_rate"), (1 - bought).alias("lost_rate"),
    )


def sales_forecast(sales: DataFrame) -> DataFrame:
    week = sales.where("recent_days = 7")
    return week.select("goods_id", *GOODS, F.round(F.col("total_sales") * F.lit(1.2).cast("decimal(2,1)")).cast("bigint").alias("sales_forecast"))



"""Service-offer warehouse: offers sent by agents, redeemed by customers, and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.functions.ratios import ratio
from tallyflow.functions.times import day
from tallyflow.operators.history import history_lag
from tallyflow.operators.horizons import HORIZONS, explode_horizons
from tallyflow.operators.ranking import rank_whole
from tallyflow.session import materialise

# Names shown for codes.
LEVELS = {1: "商品级", 2: "SKU级"}
DIM_TYPES = {1: "固定优惠", 2: "自定义优惠"}
FACT_TYPES = {1: "固定优惠券", 2: "折扣券", 3: "满减券"}
UNKNOWN_DEPARTMENT = "未知部门"


def rows():
    return F.count(F.lit(1))


def staff_history(snapshots: DataFrame) -> DataFrame:
    """Validity ranges of an agent's department and state."""
    return history_lag(snapshots, "cs_id", ["department", "status"])


def activities(activity: DataFrame, types: dict, as_of: str) -> DataFrame:
    """Running activities with code names."""
    running = activity.where((F.col("status") == 1) & (F.to_date("end_time") >= day(as_of)))
    return running.select(
        "activity_id", "activity_name", clean.code_to_name("activity_level", LEVELS, "普通级").alias("activity_level"),
        clean.code_to_name("offer_type", types, "其他").alias("offer_type"), F.to_date("start_time").alias("start_date"), F.to_date("end_time").alias("end_date"),
        "max_custom_amount", "shop_id",
    )


def offer_products(products: DataFrame, skus: DataFrame) -> DataFrame:
    """Offer amounts per item; an item's own amount goes before the product's."""
    own = skus.withColumnsRenamed({"fixed_offer_amount": "_fixed", "max_offer_amount": "_max"})
    return products.where(F.col("status") == 1).join(own, "product_id", "left").select(
        "product_id", "sku_id", "activity_id", F.coalesce("_fixed", "fixed_offer_amount").alias("fixed_offer_amount"),
        F.coalesce("_max", "max_offer_amount").alias("max_offer_amount"), "purchase_limit",
    )


def send_records(send: DataFrame, activity: DataFrame, types: dict, only_valid: bool) -> DataFrame:
    kinds = activity.select("activity_id", clean.code_to_name("offer_type", types, "其他").alias("offer_type"))
    rows_ = send.where(F.col("status") == 1) if only_valid else send
    return rows_.join(kinds, "activity_id").select("record_id", "activity_id", "customer_id", "cs_id", "offer_type", "send_time", "expire_time", "valid_hours", "dt")


def redemption_records(redemption: DataFrame) -> DataFrame:
    return redemption.where(F.col("redemption_time").isNotNull() & (F.col("actual_offer_amount") > 0))


def offers(send: DataFrame, redemption: DataFrame) -> DataFrame:
    """One row per sent offer with its redemptions of the same day."""
    done = redemption.groupBy("record_id", "dt").agg(
        rows().alias("redeemed"), F.sum("actual_offer_amount").alias("saved"), F.sum(F.col("actual_offer_amount") + F.col("payment_amount")).alias("gross")
    )
    return send.join(done, ["record_id", "dt"], "left").withColumns({"redeemed": F.coalesce("redeemed", F.lit(0)), "saved": F.coalesce("saved", F.lit(0)), "gross": F.coalesce("gross", F.lit(0))})


def agent_day(staff: DataFrame, sent: DataFrame, as_of: str) -> DataFrame:
    """Sent and redeemed offers per agent in service on the day."""
    today = sent.where(F.col("dt") == day(as_of)).groupBy("cs_id").agg(
        rows().alias("send_count"), F.sum("redeemed").alias("redemption_count"), F.round(F.sum("offer_amount").cast("double") / rows(), 2).alias("avg_offer_amount")
    )
    out = staff.where(F.col("status") == 1).join(today, "cs_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("cs_id", "cs_name", clean.default_fill("department", UNKNOWN_DEPARTMENT).alias("department"), zero("send_count"), zero("redemption_count"), "avg_offer_amount")


def customer_day(sent: DataFrame, as_of: str) -> DataFrame:
    today = sent.where(F.col("dt") == day(as_of)).groupBy("customer_id")
    return today.agg(rows().alias("offer_count"), F.round(ratio(F.sum("redeemed"), rows()), 2).alias("redemption_rate"), F.sum("saved").alias("total_savings"))


def offer_horizons(sent: DataFrame, keys: Sequence[str], as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Sent, redeemed, rate, savings and daily means per key for 1, 7 and 30 days."""
    out = explode_horizons(sent, as_of, days).groupBy("recent_days", *keys).agg(
        rows().alias("send_count"), F.sum("redeemed").alias("redemption_count"), ratio(F.sum("redeemed"), rows()).alias("redemption_rate"),
        F.sum("saved").alias("total_savings"), ratio(F.sum("offer_amount"), rows()).alias("avg_offer_amount"), ratio(F.sum("saved"), F.sum("gross")).alias("avg_discount"),
    )
    return out.withColumn("avg_daily_send", ratio("send_count", "recent_days")).withColumn("avg_daily_savings", ratio("total_savings", "recent_days"))


def wide(nd: DataFrame, keys: Sequence[str], picks: dict[str, tuple[int, str]]) -> DataFrame:
    """Chosen (horizon, measure) pairs as columns; keys without a row in every horizon used are left out, as inner joins would."""
    horizons = sorted({d for d, _ in picks.values()})
    cols = [F.max(F.when(F.col("recent_days") == d, F.col(m))).alias(o) for o, (d, m) in picks.items()]
    there = [F.max((F.col("recent_days") == d).cast("int")).alias(f"_has{d}") for d in horizons]
    out = nd.groupBy(*keys).agg(*cols, *there)
    for d in horizons:
        out = out.where(F.col(f"_has{d}") == 1).drop(f"_has{d}")
    return out


def activity_analysis(nd: DataFrame) -> DataFrame:
    return wide(nd, ["activity_id"], {
        "daily_send": (1, "send_count"), "daily_redemption": (1, "redemption_count"), "daily_redemption_rate": (1, "redemption_rate"),
        "weekly_avg_send": (7, "avg_daily_send"), "weekly_redemption": (7, "redemption_count"), "monthly_redemption_rate": (30, "redemption_rate"),
        "daily_savings": (1, "total_savings"), "weekly_savings": (7, "total_savings"), "monthly_avg_daily_savings": (30, "avg_daily_savings"),
    })


def agent_score(nd: DataFrame) -> DataFrame:
    """0.3 × redemptions of the day + 0.4 × rate of 7 days + 0.3 × rate of 30 days."""
    out = wide(nd, ["cs_id"], {
        "daily_send": (1, "send_count"), "daily_redemption": (1, "redemption_count"), "daily_avg_offer": (1, "avg_offer_amount"),
        "weekly_avg_send": (7, "avg_daily_send"), "weekly_redemption_rate": (7, "redemption_rate"), "monthly_redemption_rate": (30, "redemption_rate"),
    })
    score = F.col("daily_redemption") * 0.3 + F.col("weekly_redemption_rate") * 0.4 + F.col("monthly_redemption_rate") * 0.3
    return out.withColumn("performance_score", F.round(score, 2))


def customer_value(nd: DataFrame, high: float = 500, middle: float = 200) -> DataFrame:
    """0.6 × ln(monthly savings + 1) + tier 0.3 / 0.2 / 0.1 + 0.1 × rate of the day."""
    out = wide(nd, ["customer_id"], {
        "daily_offer_count": (1, "send_count"), "daily_redemption_rate": (1, "redemption_rate"), "weekly_offer_count": (7, "send_count"),
        "daily_savings": (1, "total_savings"), "monthly_avg_savings": (30, "total_savings"),
    })
    level = clean.tier("monthly_avg_savings", [(high, "高价值"), (middle, "中价值")], "低价值")
    bonus = F.when(F.col("monthly_activity_level") == "高价值", 0.3).when(F.col("monthly_activity_level") == "中价值", 0.2).otherwise(0.1)
    value = F.log(F.coalesce("monthly_avg_savings", F.lit(0)).cast("double") + 1) * 0.6 + bonus + F.col("daily_redemption_rate") * 0.1
    return out.withColumn("monthly_activity_level", level).withColumn("value_index", F.round(value, 2))


def offer_effectiveness(nd: DataFrame) -> DataFrame:
    """0.5 × rate + 0.3 × (1 − rank ÷ worst rank) + 0.2 × mean discount per item; rank by redemptions of 30 days."""
    month = nd.where("recent_days = 30").select("sku_id", F.col("redemption_count").alias("n"), F.col("total_savings").alias("monthly_savings"))
    ranked = rank_whole(materialise(month, "offer-rank"), "n", "best_redemption_rank").drop("n")
    worst = ranked.agg(F.max("best_redemption_rank").alias("worst")).scalar()
    today = nd.where("recent_days = 1").select(
        "sku_id", F.col("send_count").alias("daily_send_count"), F.col("redemption_rate").alias("daily_redemption_rate"), F.col("avg_discount").alias("daily_avg_discount")
    )
    score = F.col("daily_redemption_rate") * 0.5 + (1 - ratio("best_redemption_rank", worst)) * 0.3 + F.col("daily_avg_discount") * 0.2
    return today.join(ranked, "sku_id").withColumn("effectiveness_score", F.round(score, 2))

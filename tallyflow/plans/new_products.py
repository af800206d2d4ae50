"""New-product warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.times import day
from tallyflow.operators.history import history_init
from tallyflow.operators.ranking import best_row

# Audit state and names shown for missing values.
APPROVED, WAITING = "通过", "待审"
ORDINARY, UNKNOWN, OTHER = "普通新品", "未知", "其他"


def rows():
    return F.count(F.lit(1))


def filled(col: str, value):
    return F.coalesce(col, F.lit(value)).alias(col)


def sku_history(skus: DataFrame, as_of: str) -> DataFrame:
    live = skus.where((F.col("is_delete") == 0) & F.col("sku_id").isNotNull())
    out = live.select(
        "sku_id", filled("sku_title", UNKNOWN), "category_id", filled("category_name", OTHER), "brand_id", filled("brand_name", OTHER),
        F.coalesce(F.col("sale_price").cast("decimal(10,2)"), F.lit(0)).alias("sale_price"), "store_id", "putaway_time", "is_online",
    )
    return history_init(out, day(as_of))


def tag_history(tags: DataFrame, as_of: str) -> DataFrame:
    valid = tags.where((F.col("new_tag_end_time") >= day(as_of)) & F.col("sku_id").isNotNull())
    out = valid.select(
        "id", "sku_id", filled("new_type", ORDINARY), filled("is_tmall_new", 0), "new_tag_start_time", "new_tag_end_time", filled("new_tag_audit_status", WAITING)
    )
    return history_init(out, day(as_of))


def payment_history(payments: DataFrame, as_of: str) -> DataFrame:
    paid = payments.where((F.col("payment_status") == 1) & F.col("payment_time").isNotNull() & F.col("sku_id").isNotNull())
    out = paid.select("payment_id", "sku_id", "user_id", "payment_amount", "payment_quantity", "payment_time", filled("channel", UNKNOWN), "refund_status")
    return history_init(out, day(as_of))


def yearly_history(records: DataFrame, year: int, as_of: str) -> DataFrame:
    out = records.where((F.col("putaway_year") == year) & F.col("putaway_date").isNotNull()).drop("putaway_quarter")
    return history_init(out.withColumn("initial_sale_price", F.col("initial_sale_price").cast("decimal(10,2)")), day(as_of))


def store_history(stores: DataFrame, as_of: str) -> DataFrame:
    opened = stores.where(F.col("open_date").isNotNull() & F.col("store_id").isNotNull())
    out = opened.select(
        "store_id", filled("store_name", "未知店铺"), filled("store_type", "未知类型"), filled("platform", "未知平台"), filled("category_main", "未分类"), "open_date", filled("level", 0)
    )
    return history_init(out, day(as_of))


def latest_tag(tags: DataFrame, as_of: str) -> DataFrame:
    """Newest approved, still valid new-product tag per item: an aggregate, not a sort of all tags of an item."""
    valid = tags.where((F.col("new_tag_audit_status") == APPROVED) & (F.col("new_tag_end_time") >= day(as_of)) & (F.col("is_tmall_new") == 1))
    keep = ["new_type", "is_tmall_new", "putaway_time", "new_tag_start_time", "new_tag_end_time"]
    return best_row(valid, ["sku_id"], [F.col("update_time"), F.col("id")], keep)


def new_arrivals(skus: DataFrame, tags: DataFrame, as_of: str) -> DataFrame:
    """Live items that have such a tag."""
    live = skus.where((F.col("is_delete") == 0) & (F.col("is_online") == 1)).withColumnRenamed("putaway_time", "_listed")
    return live.join(latest_tag(tags, as_of), "sku_id").select(
        "sku_id", filled("sku_title", UNKNOWN), "category_id", filled("category_name", OTHER), "brand_id", filled("brand_name", OTHER), "store_id", "sale_price",
        F.coalesce("putaway_time", "_listed").alias("putaway_time"), filled("new_type", ORDINARY), "is_tmall_new", "new_tag_start_time", "new_tag_end_time",
    )


def new_payments(payments: DataFrame, arrivals: DataFrame, days: int = 30) -> DataFrame:
    """Payments within ``days`` of listing."""
    good = payments.where((F.col("payment_status") == 1) & (F.col("refund_status") == 0))
    joined = good.join(arrivals.select("sku_id", "putaway_time", "store_id"), "sku_id")
    after = F.datediff("payment_time", "putaway_time")
    return joined.where(after.between(0, days)).select(
        "payment_id", "order_id", "sku_id", "user_id", "payment_amount", "payment_quantity", "payment_time", "putaway_time", after.alias("days_after_putaway"), "store_id", filled("channel", UNKNOWN)
    )


def _per_sku(payments: DataFrame) -> DataFrame:
    return payments.groupBy("sku_id").agg(F.sum("payment_amount").alias("total_payment"), F.min("payment_time").alias("first_payment_date"))


def yearly(records: DataFrame, tags: DataFrame, skus: DataFrame, payments: DataFrame, as_of: str) -> DataFrame:
    """Items listed in a year with quarter, tag type, store and payment totals."""
    typed = latest_tag(tags, as_of).select("sku_id", "new_type")
    joined = records.where(F.col("putaway_date").isNotNull()).join(typed, "sku_id", "left").join(skus.select("sku_id", "store_id"), "sku_id", "left").join(_per_sku(payments), "sku_id", "left")
    return joined.select(
        "sku_id", "putaway_date", "putaway_year", "putaway_month", F.coalesce("putaway_quarter", F.quarter("putaway_date")).alias("putaway_quarter"), filled("new_type", ORDINARY),
        "initial_sale_price", "category_id", "brand_id", "store_id", F.coalesce("total_payment", F.lit(0)).alias("total_payment_amount"), "first_payment_date",
    )


def store_summary(stores: DataFrame, arrivals: DataFrame, payments: DataFrame) -> DataFrame:
    """New items, last listing, payments and mean days to the first payment per store; arrivals are summed before the store join."""
    paid = arrivals.select("sku_id", "store_id", "putaway_time").join(_per_sku(payments), "sku_id")
    per_store = paid.groupBy("store_id").agg(
        rows().alias("new_sku_count"), F.max("putaway_time").alias("latest_putaway_time"), F.sum("total_payment").alias("total_payment_amount"),
        F.round(F.sum(F.datediff("first_payment_date", "putaway_time")).cast("double") / rows(), 2).alias("avg_days_to_first_payment"),
    )
    named = stores.select("store_id", filled("store_name", ""), filled("store_type", ""), filled("platform", UNKNOWN), filled("category_main", "未分类"))
    return named.join(per_store, "store_id")


def category_analysis(arrivals: DataFrame, payments: DataFrame) -> DataFrame:
    """Per category: new items, payments, mean price, and the brand with most new items (ties by id)."""
    paid = arrivals.join(_per_sku(payments).select("sku_id", "total_payment"), "sku_id", "left")
    stats = paid.groupBy("category_id", "category_name").agg(
        rows().alias("new_sku_count"), F.sum(F.coalesce("total_payment", F.lit(0))).alias("total_payment_amount"),
        F.round(F.sum(F.col("sale_price").cast("decimal(16,2)")).cast("double") / rows(), 2).alias("avg_sale_price"),
    )
    brands = arrivals.groupBy("category_id", "brand_id", "brand_name").agg(rows().alias("n"))
    top = best_row(brands, ["category_id"], [F.col("n"), F.col("brand_id"), F.col("brand_name")], ["brand_id", "brand_name"])
    return stats.join(top.withColumnsRenamed({"brand_id": "top_brand_id", "brand_name": "top_brand_name"}), "category_id", "left")


def channel_analysis(payments: DataFrame) -> DataFrame:
    """Per channel: items, payments, mean payment, payers."""
    return payments.groupBy("channel").agg(
        F.countDistinct("sku_id").alias("new_sku_count"), F.sum("payment_amount").alias("total_payment_amount"),
        F.round(F.sum("payment_amount").cast("double") / F.countDistinct("payment_id"), 2).alias("avg_payment_amount"),
        F.countDistinct("user_id").alias("payment_user_count"),
    )

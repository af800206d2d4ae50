"""Page-analytics warehouse: visits by hour, blocks, trends, guided goods and modules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.functions.ratios import ratio
from tallyflow.functions.times import day, days_before, is_weekend, within
from tallyflow.operators.history import history_init
from tallyflow.operators.horizons import HORIZONS, explode_horizons
from tallyflow.operators.ranking import best_row

# Block categories by keyword, module kinds in use.
BLOCKS = [("轮播", "轮播类"), ("推荐", "推荐类"), ("活动", "活动类"), ("商品", "商品类")]
OTHER_BLOCK = "其他类"
MODULES = ("推荐型", "活动型", "导购型", "内容型")
PRODUCT_ID_LENGTH = 19


def _time(col: str) -> Column:
    return F.col(col).try_cast("timestamp_ntz")


def peak(hour: Column) -> Column:
    """9 to 12 and 19 to 21 o'clock."""
    return hour.between(9, 12) | hour.between(19, 21)


def latest_dim(rows: DataFrame, key: str, time: str, keep: Sequence[str], as_of: str, valid: Column | None = None) -> DataFrame:
    """Newest values per key; the row id breaks ties of the second-precise time."""
    known = rows.where(F.col(key).isNotNull() & (F.length(key) > 0))
    if valid is not None:
        known = known.where(valid)
    return history_init(best_row(known, [key], [F.col(time), F.col("log_id")], keep), day(as_of))


def products(guide: DataFrame, as_of: str) -> DataFrame:
    seen = guide.where(F.col("product_id").isNotNull()).select("product_id").distinct()
    return history_init(seen.withColumn("product_name", F.concat(F.lit("商品_"), "product_id")), day(as_of))


def visit_fact(base: DataFrame) -> DataFrame:
    rows = base.where(F.col("page_id").isNotNull() & F.col("visit_time").isNotNull() & (F.col("visit_pv") > 0))
    hour = F.hour(_time("visit_time"))
    return rows.select(
        clean.event_id("page_id", time="visit_time").alias("visit_id"), "page_id", "page_type", _time("visit_time").alias("visit_time"), "visitor_count", "visit_pv", "click_pv",
        hour.alias("hour_of_day"), peak(hour).alias("is_peak_hour"), "dt",
    )


def block_fact(clicks: DataFrame) -> DataFrame:
    rows = clicks.where(F.col("page_id").isNotNull() & F.col("block_id").isNotNull() & (F.col("click_pv") > 0) & (F.col("guide_pay_amount") >= 0))
    return rows.select(
        clean.event_id("page_id", "block_id", time="collect_time").alias("click_id"), "page_id", "block_id", "click_pv", "click_uv", "guide_pay_amount",
        _time("collect_time").alias("collect_time"), clean.keyword_category("block_name", BLOCKS, OTHER_BLOCK).alias("block_category"), "dt",
    )


def trend_fact(trend: DataFrame, as_of: str) -> DataFrame:
    rows = trend.where("page_id is not null and stat_date is not null and visitor_count >= 0 and click_uv >= 0")
    at = F.col("stat_date").try_cast("date")
    return rows.select(
        F.concat_ws("_", "page_id", "stat_date").alias("trend_id"), "page_id", at.alias("stat_date"), "visitor_count", "click_uv", "data_version",
        at.between(days_before(as_of, 6), day(as_of)).alias("is_current_week"), is_weekend(at).alias("is_weekend"), "dt",
    )


def guide_fact(guide: DataFrame) -> DataFrame:
    rows = guide.where((F.col("guide_count") > 0) & (F.length("product_id") == PRODUCT_ID_LENGTH))
    return rows.select(
        clean.event_id("page_id", "product_id", time="guide_time").alias("guide_id"), "page_id", "product_id", "guide_count", "guide_buyer_count",
        _time("guide_time").alias("guide_time"), F.hour(_time("guide_time")).alias("guide_hour"), (F.col("guide_buyer_count") > 0).alias("is_high_value"), "dt",
    )


def module_fact(modules: DataFrame) -> DataFrame:
    rows = modules.where((F.col("expose_pv") > 0) & F.col("module_type").isin(*MODULES))
    return rows.select(
        "module_id", "page_id", "module_name", "module_type", "expose_pv", "interact_count", _time("stat_time").alias("stat_time"),
        F.round(ratio("interact_count", "expose_pv"), 4).alias("interaction_rate"), "dt",
    )


def _nd(fact: DataFrame, as_of: str, keys: Sequence[str], aggs: Sequence[Column], days: Sequence[int]) -> DataFrame:
    return explode_horizons(fact, as_of, days).groupBy("recent_days", *keys).agg(*aggs)


def sum_if(cond: Column | str, value: str) -> Column:
    c = F.col(cond) if isinstance(cond, str) else cond
    return F.sum(F.when(c, F.col(value)).otherwise(0))


def visit_agg(fact: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    return _nd(fact, as_of, ["page_id", "page_type", "hour_of_day"], [
        *[F.sum(c).alias(c) for c in ("visitor_count", "visit_pv", "click_pv")], sum_if("is_peak_hour", "visitor_count").alias("peak_visitor_count"), sum_if("is_peak_hour", "visit_pv").alias("peak_visit_pv"),
    ], days)


def block_agg(fact: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    pay, clicks = F.sum("guide_pay_amount"), F.sum("click_pv")
    return _nd(fact, as_of, ["page_id", "block_id", "block_category"], [
        clicks.alias("click_pv"), F.sum("click_uv").alias("click_uv"), pay.alias("guide_pay_amount"), F.round(ratio(pay, clicks, None), 2).alias("avg_guide_pay_per_click"),
    ], days)


def trend_agg(fact: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    return _nd(fact, as_of, ["page_id"], [
        F.sum("visitor_count").alias("visitor_count"), F.sum("click_uv").alias("click_uv"), sum_if("is_current_week", "visitor_count").alias("week_visitor_count"),
        sum_if("is_weekend", "visitor_count").alias("weekend_visitor_count"),
    ], days)


def guide_agg(fact: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    return _nd(fact, as_of, ["page_id", "product_id"], [
        F.sum("guide_count").alias("guide_count"), F.sum("guide_buyer_count").alias("guide_buyer_count"),
        F.round(ratio(sum_if("is_high_value", "guide_count"), F.sum("guide_count"), None) * 100, 2).alias("high_value_guide_ratio"),
    ], days)


def module_agg(fact: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    return _nd(fact, as_of, ["page_id", "module_id", "module_type"], [
        F.sum("expose_pv").alias("expose_pv"), F.sum("interact_count").alias("interact_count"), F.round(ratio(F.sum("interact_count"), F.sum("expose_pv"), None) * 100, 2).alias("effective_interaction_rate"),
    ], days)


def on(nd: DataFrame, days: int) -> DataFrame:
    return nd.where(F.col("recent_days") == days)


def overview(visit_nd: DataFrame, block_nd: DataFrame, module_nd: DataFrame) -> DataFrame:
    """Clicks per visitor, peak share, pay per 100 clicks (7 days), interactions per 100 exposures (30 days). Each side is one row per page before they meet."""
    v = on(visit_nd, 1).groupBy("page_id", "page_type").agg(*[F.sum(c).alias(c) for c in ("visitor_count", "visit_pv", "click_pv", "peak_visitor_count")])
    b = on(block_nd, 7).groupBy("page_id").agg(F.sum("guide_pay_amount").alias("pay"), F.sum("click_pv").alias("clicks"))
    m = on(module_nd, 30).groupBy("page_id").agg(F.sum("interact_count").alias("acts"), F.sum("expose_pv").alias("shown"))
    return v.join(b, "page_id", "left").join(m, "page_id", "left").select(
        "page_id", "page_type", "visitor_count", "visit_pv", F.round(ratio("click_pv", "visitor_count"), 2).alias("click_per_visitor"),
        F.round(ratio("peak_visitor_count", "visitor_count") * 100, 2).alias("peak_visitor_ratio"), F.round(ratio("pay", "clicks") * 100, 2).alias("pay_per_100_clicks_7d"),
        F.round(ratio("acts", "shown") * 100, 2).alias("interact_per_100_expose_30d"),
    )


def block_performance(block_nd: DataFrame, guide_nd: DataFrame) -> DataFrame:
    """Clicks and pay of the day, share of the block's 30-day clicks, mean high-value ratio of the goods on its pages (7 days)."""
    today = on(block_nd, 1)
    sums = today.groupBy("block_id", "block_category").agg(*[F.sum(c).alias(c) for c in ("click_pv", "click_uv", "guide_pay_amount")])
    month = on(block_nd, 30).groupBy("block_id").agg(F.sum("click_pv").alias("month_clicks"))
    per_page = on(guide_nd, 7).groupBy("page_id").agg(F.sum(F.col("high_value_guide_ratio").cast("decimal(16,2)")).alias("s"), F.count("high_value_guide_ratio").alias("n"))
    pages = today.select("block_id", "block_category", "page_id").join(per_page, "page_id", "left").groupBy("block_id", "block_category").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")
    )
    return sums.join(month, "block_id", "left").join(pages, ["block_id", "block_category"], "left").select(
        "block_id", "block_category", "click_pv", "click_uv", "guide_pay_amount", F.round(ratio("guide_pay_amount", "click_pv"), 2).alias("avg_guide_pay_per_click"),
        F.round(ratio("click_pv", "month_clicks") * 100, 2).alias("click_share_30d"), F.round(ratio("s", "n", None), 2).alias("avg_high_value_ratio_7d"),
    )


def growth(now: Column | str, before: Column | str) -> Column:
    """Change in percent; NULL without an earlier period."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (now, before))
    return F.round(ratio((a - b) * 100, b, None), 2)


def two_periods(fact: DataFrame, as_of: str, keys: Sequence[str], measure: str, days: int) -> DataFrame:
    """Sums of the last ``days`` and of the ``days`` before, in one pass."""
    now = F.col("dt") >= days_before(as_of, days - 1)
    return fact.where(within(as_of, 2 * days)).groupBy(*keys).agg(F.sum(F.when(now, F.col(measure))).alias("now"), F.sum(F.when(~now, F.col(measure))).alias("before"))


def trend_report(fact: DataFrame, trend_nd: DataFrame, as_of: str) -> DataFrame:
    """Visitors of the day and week, weekend share, growth against the week before, clicks of 30 days."""
    weeks = two_periods(fact, as_of, ["page_id"], "visitor_count", 7).select("page_id", growth("now", "before").alias("visitor_growth_7d"))
    d1 = on(trend_nd, 1).select("page_id", F.col("visitor_count").alias("visitor_count_1d"))
    d7 = on(trend_nd, 7).select("page_id", "week_visitor_count", F.round(ratio("weekend_visitor_count", "visitor_count", None) * 100, 2).alias("weekend_visitor_ratio"))
    d30 = on(trend_nd, 30).select("page_id", F.col("click_uv").alias("click_uv_30d"))
    return d1.join(d7, "page_id").join(d30, "page_id").join(weeks, "page_id", "left")


def guide_report(guide_nd: DataFrame, product: DataFrame) -> DataFrame:
    """Guided visits and buyers of the day, daily mean of 7 days, conversion of 30 days."""
    d1 = on(guide_nd, 1).groupBy("product_id").agg(
        F.sum("guide_count").alias("guide_count"), F.sum("guide_buyer_count").alias("guide_buyer_count"),
        ratio(F.sum(F.col("high_value_guide_ratio").cast("decimal(16,2)")), F.count("high_value_guide_ratio")).alias("avg_high_value_ratio"),
    )
    d7 = on(guide_nd, 7).groupBy("product_id").agg((F.sum("guide_count") / 7.0).alias("avg_daily_guide_7d"))
    d30 = on(guide_nd, 30).groupBy("product_id").agg(F.round(ratio(F.sum("guide_buyer_count"), F.sum("guide_count")) * 100, 2).alias("conversion_rate_30d"))
    return d1.join(d7, "product_id").join(d30, "product_id").join(product.select("product_id", "product_name"), "product_id", "left")


def module_report(fact: DataFrame, module_nd: DataFrame, as_of: str, growth_days: int = 30) -> DataFrame:
    """Exposure and interaction of the day, daily interactions of 7 days, exposure growth against the period before."""
    d1 = on(module_nd, 1).groupBy("module_id", "module_type").agg(
        F.sum("expose_pv").alias("expose_pv_1d"), F.sum("interact_count").alias("interact_count_1d"),
        F.round(ratio(F.sum(F.col("effective_interaction_rate").cast("decimal(16,2)")), F.count("effective_interaction_rate")), 2).alias("effective_interaction_rate_1d"),
    )
    d7 = on(module_nd, 7).groupBy("module_id").agg(F.round(F.sum("interact_count") / 7.0, 0).alias("avg_daily_interact_7d"))
    periods = two_periods(fact, as_of, ["module_id"], "expose_pv", growth_days).select("module_id", growth("now", "before").alias("exposure_growth"))
    return d1.join(d7, "module_id").join(periods, "module_id", "left")

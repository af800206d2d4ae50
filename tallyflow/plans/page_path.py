"""Page-path warehouse: visits, sessions, jumps, conversion, and their summaries for 1, 7 and 30 days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.functions.ratios import ratio
from tallyflow.operators.dims import distribution_map, enrich
from tallyflow.operators.horizons import HORIZONS, explode_horizons
from tallyflow.operators.ordered import number_and_next
from tallyflow.operators.rangejoin import link_points

# Page kinds of the shop, and names shown for missing values.
SHOP_KINDS = ("home", "activity", "category", "new", "宝贝页")
NO_PAGE, NO_SOURCE, UNKNOWN = "未知页面", "无来源", "未知"
NAMELESS = {"page_name": NO_PAGE, "entry_page_name": "未知入口", "from_page_name": "未知来源", "to_page_name": "未知目标", "device_type": "未知设备"}
OTHER_TYPE = "其他"


def rows():
    return F.count(F.lit(1))


def visits(log: DataFrame, pages: DataFrame) -> DataFrame:
    """Page views with page and referrer names, stay time clamped to an hour."""
    named = enrich(log.withColumnRenamed("page_type", "log_type"), pages, "page_id", "page_id", {"page_name": "page_name", "page_type": "info_type"})
    named = enrich(named, pages, "referer_page_id", "page_id", {"page_name": "referer_page_name"})
    kind = F.when(F.col("info_type").isin(*SHOP_KINDS), "shop_page").when(F.col("log_type") == "product", "product_detail").otherwise("other_page")
    return named.select(
        "log_id", "user_id", "session_id", "page_id", F.coalesce("page_name", F.lit(NO_PAGE)).alias("page_name"), kind.alias("page_type"), "referer_page_id",
        F.coalesce("referer_page_name", F.lit(NO_SOURCE)).alias("referer_page_name"), "visit_time", clean.clamp("stay_duration", 0, 3600).alias("stay_duration"),
        F.lower("device_type").alias("device_type"), F.coalesce("province", F.lit(UNKNOWN)).alias("province"), F.coalesce("city", F.lit(UNKNOWN)).alias("city"), "is_new_visitor", "dt",
    )


def sessions(views: DataFrame) -> DataFrame:
    """Entry, exit, depth and duration per session, as one aggregate: no sort of a session, a hot one combines map-side."""
    first = lambda c: F.min_by(c, "visit_time")
    return views.groupBy("session_id").agg(
        F.min_by("user_id", "visit_time").alias("user_id"), first("page_id").alias("entry_page_id"), first("page_name").alias("entry_page_name"), first("page_type").alias("entry_page_type"),
        F.min("visit_time").alias("entry_time"), F.max_by("page_id", "visit_time").alias("exit_page_id"), F.max("visit_time").alias("exit_time"), rows().alias("path_depth"),
        F.sum("stay_duration").alias("total_duration"), first("device_type").alias("device_type"), first("is_new_visitor").alias("is_new_session"), F.min("dt").alias("dt"),
    )


def jumps(views: DataFrame) -> DataFrame:
    """One row per step from a page to the next in the session."""
    v = views.select("session_id", "user_id", "page_id", "visit_time", "dt")
    stepped = number_and_next(v, ["session_id"], ["visit_time"], F.date_trunc("HOUR", "visit_time"), "page_id", following="to_page_id")
    return stepped.where(F.col("to_page_id").isNotNull()).select("session_id", "user_id", F.col("page_id").alias("from_page_id"), "to_page_id", "dt")


def jump_counts(steps: DataFrame) -> DataFrame:
    return steps.groupBy("from_page_id", "to_page_id", "dt").agg(rows().alias("jump_count"), F.countDistinct("user_id").alias("jump_users"))


def conversions(session: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per session and order placed or paid inside it; sessions without one keep a 'view' row.

    "Order time or payment time inside the session" becomes two points per order linked by time slices,
    in place of a join on the user with two alternatives.
    """
    at = F.explode(F.array(F.struct(F.lit("order").alias("kind"), F.col("order_time").alias("at")), F.struct(F.lit("payment").alias("kind"), F.col("payment_time").alias("at"))))
    points = orders.select("user_id", "order_id", "payment_amount", at.alias("p")).select("user_id", "order_id", "payment_amount", "p.kind", "p.at").where("at is not null")
    spans = session.select("user_id", "session_id", "entry_time", "exit_time")
    hits = link_points(points, spans, ["user_id"], "at", "entry_time", "exit_time").groupBy("session_id", "order_id").agg(
        F.max((F.col("kind") == "payment").cast("int")).alias("paid"), F.max("payment_amount").alias("payment_amount")
    )
    joined = session.join(hits, "session_id", "left")
    return joined.select(
        "user_id", "session_id", F.col("path_depth").alias("page_view_count"), F.col("total_duration").alias("session_duration"), F.col("order_id").isNotNull().cast("int").alias("is_converted"),
        F.when(F.col("paid") == 1, "payment").when(F.col("order_id").isNotNull(), "order").otherwise("view").alias("conversion_type"),
        F.when(F.col("paid") == 1, F.col("payment_amount")).otherwise(0).alias("conversion_value"), "dt",
    )


def converted_sessions(session: DataFrame, conversion: DataFrame) -> DataFrame:
    """Sessions with one conversion flag and value each, so later joins do not multiply them."""
    per = conversion.groupBy("session_id").agg(F.max("is_converted").alias("is_converted"), F.sum("conversion_value").alias("conversion_value"))
    return session.join(per, "session_id", "left")


def device_stats(session: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    return explode_horizons(session, as_of, days).groupBy("recent_days", "device_type").agg(*_session_measures(), F.round(ratio(F.sum("path_depth"), rows()), 2).alias("avg_path_depth"))


def _session_measures() -> list:
    return [
        rows().alias("session_count"), F.countDistinct("user_id").alias("visitor_count"), F.round(ratio(F.sum("total_duration"), rows()), 2).alias("avg_session_duration"),
        F.round(ratio(F.sum((F.col("path_depth") == 1).cast("int")), rows()), 4).alias("bounce_rate"), F.round(ratio(F.sum("is_converted"), rows()), 4).alias("conversion_rate"),
    ]


def entry_stats(session: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Sessions by their first page."""
    return explode_horizons(session, as_of, days).groupBy("recent_days", "entry_page_id", "entry_page_name", "entry_page_type", "device_type").agg(*_session_measures())


def _session_pages(views: DataFrame, session: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Visits collapsed to (session, keys) before they meet their session."""
    per = views.groupBy("session_id", *keys).agg(rows().alias("n"), F.sum("stay_duration").alias("stay"), F.max("visit_time").alias("last_time"), F.first("user_id").alias("user_id"))
    return per.join(session.select("session_id", "dt", "entry_page_id", "exit_page_id", "exit_time", "path_depth", "is_converted"), "session_id")


def page_stats(views: DataFrame, session: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    keys = ["page_id", "page_name", "page_type", "device_type"]
    per = explode_horizons(_session_pages(views, session, keys), as_of, days)
    visits_if = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return per.groupBy("recent_days", *keys).agg(
        F.sum("n").alias("visit_count"), F.countDistinct("user_id").alias("visitor_count"), F.round(ratio(F.sum("stay"), F.sum("n")), 2).alias("avg_stay_duration"),
        visits_if(F.col("exit_page_id") == F.col("page_id")).alias("exit_count"), F.round(ratio(visits_if(F.col("path_depth") == 1), F.sum("n")), 4).alias("bounce_rate"),
        visits_if(F.col("entry_page_id") == F.col("page_id")).alias("entry_count"),
    )


def path_flow(steps: DataFrame, page: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Jumps between pages with their share of the first page's visits; users are counted on the raw jumps."""
    moved = explode_horizons(steps, as_of, days).groupBy("recent_days", "from_page_id", "to_page_id").agg(rows().alias("jump_count"), F.countDistinct("user_id").alias("jump_users"))
    totals = page.groupBy("recent_days", "page_id").agg(
        F.max("page_name").alias("name"), F.max("page_type").alias("type"), F.sum("visit_count").alias("visits"), F.sum("exit_count").alias("exits")
    )
    source = totals.select("recent_days", F.col("page_id").alias("from_page_id"), F.col("name").alias("from_page_name"), F.col("type").alias("from_page_type"), "visits", "exits")
    target = totals.select("recent_days", F.col("page_id").alias("to_page_id"), F.col("name").alias("to_page_name"), F.col("type").alias("to_page_type"))
    return moved.join(source, ["recent_days", "from_page_id"]).join(target, ["recent_days", "to_page_id"]).select(
        "recent_days", "from_page_id", "from_page_name", "from_page_type", "to_page_id", "to_page_name", "to_page_type", "jump_count", "jump_users",
        F.round(ratio("jump_count", "visits"), 4).alias("jump_rate"), F.col("exits").alias("drop_off_count"),
    )


def user_paths(session: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Sessions, views, conversions per user and the distribution of entry pages as a map."""
    wide = explode_horizons(session, as_of, days)
    sums = wide.groupBy("recent_days", "user_id").agg(
        rows().alias("session_count"), F.sum("path_depth").alias("total_page_views"), F.sum("total_duration").alias("total_duration"),
        F.round(ratio(F.sum("total_duration"), rows()), 2).alias("avg_session_duration"), F.sum("is_converted").alias("conversion_count"), F.sum("conversion_value").alias("total_conversion_value"),
    )
    entries = distribution_map(wide, ["recent_days", "user_id"], "entry_page_name", "entry_page_distribution")
    return sums.join(entries, ["recent_days", "user_id"])


def page_type_summary(views: DataFrame, session: DataFrame, as_of: str, days: Sequence[int] = HORIZONS) -> DataFrame:
    """Visits, exits, bounces and converted sessions per page kind and device. Each (session, kind) is one row, so sessions are plain counts."""
    keys = ["page_type", "device_type"]
    per = explode_horizons(_session_pages(views, session, keys), as_of, days)
    return per.groupBy("recent_days", *keys).agg(
        F.sum("n").alias("visit_count"), F.countDistinct("user_id").alias("visitor_count"), F.round(ratio(F.sum("stay"), F.sum("n")), 2).alias("avg_stay_duration"),
        F.sum((F.col("last_time") == F.col("exit_time")).cast("int")).alias("exit_count"), F.round(ratio(F.sum((F.col("path_depth") == 1).cast("int")), rows()), 4).alias("bounce_rate"),
        F.sum("is_converted").alias("conversion_count"),
    )


def report(nd: DataFrame) -> DataFrame:
    """Report form: period label, names for missing values, rates at most 1, depth at least 1."""
    out = nd.withColumn("period_type", F.concat(F.col("recent_days").cast("string"), F.lit("d"))).drop("recent_days")
    for c in out.columns:
        if c in NAMELESS:
            out = out.withColumn(c, F.coalesce(c, F.lit(NAMELESS[c])))
        elif c.endswith("page_type"):
            out = out.withColumn(c, F.coalesce(c, F.lit(OTHER_TYPE)))
        elif c.endswith("_rate"):
            out = out.withColumn(c, F.least(c, F.lit(1.0)))
        elif c.startswith("avg_path"):
            out = out.withColumn(c, F.greatest(c, F.lit(1.0)))
        elif c.startswith("avg_"):
            out = out.withColumn(c, F.greatest(c, F.lit(0.0)))
    return out

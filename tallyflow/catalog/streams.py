"""Streaming plans run to the end of the given tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.dims import dictionary_roles, enrich
from tallyflow.session import scratch_path
from tallyflow.sources import rolled, sinks
from tallyflow.sources.readers import json_table
from tallyflow.sources.standins import Retail, money
from tallyflow.sources.stream_standins import Streams
from tallyflow.streaming import cdc, dedup, dimsync, inspect, joins, logs, lookups, moderation, uniques
from tallyflow.streaming.run import drain, run_clock, start_files
from tallyflow.streaming.tables import drain_windows
from tallyflow.streaming.windows import tumble, tumble_clock, tumble_distinct


#: Micro-batches in which the steps with state across batches are replayed.
FILES = 8


class StreamWarehouse(Streams):
    @property
    def retail(self) -> Retail:
        return Retail(self.spark, self.sf_dir)


def rows():
    return F.count(F.lit(1))


def cancel_transitions(w: StreamWarehouse) -> DataFrame:
    changes = cdc.of_table(w.order_changes(), "order_info")
    return drain(cdc.fields(cdc.moved(changes, "order_status", "1003", "1001"), ["id", "user_id", "order_status"]), "cancel")


def cart_growth(w: StreamWarehouse) -> DataFrame:
    grown = cdc.grown(cdc.of_table(w.cart_changes(), "cart_info"), "sku_num")
    return drain(grown.select(cdc.after("id").alias("id"), cdc.after("sku_id").alias("sku_id"), "sku_num", "ts_ms"), "cart-growth")


def payload(w: StreamWarehouse) -> DataFrame:
    out = cdc.add_ds(cdc.payload(w.order_changes()), "tm_ms")
    at = lambda f: F.try_element_at("row", F.lit(f)).alias(f)
    return drain(out.select("op", "tm_ms", "ds", at("id"), at("order_status"), at("total_amount")), "payload")


def routed(w: StreamWarehouse) -> DataFrame:
    out = cdc.route(w.order_changes(), {"order_info": "detail_order_info", "shop_info": "detail_shop_info"})
    ident = F.coalesce(cdc.after("id"), cdc.before("id"))
    return drain(out.select(ident.alias("id"), "op", "topic"), "route", ["topic"])


def split_logs(w: StreamWarehouse) -> DataFrame:
    out = logs.split_log(w.raw_log()).select("body", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts", "kind")
    return drain(out, "split-log", ["kind"])


def dirty_lines(w: StreamWarehouse) -> DataFrame:
    broken = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    lines = w.stream("events").select("event_id", broken.alias("value"))
    out = logs.split_dirty(lines, "k int").select("event_id", "value", F.col("parsed.k").alias("k"), "topic")
    return drain(out, "dirty", ["topic"])


def clean_kinds(w: StreamWarehouse) -> DataFrame:
    """Events as raw records of all twelve kinds; a required field is missing from every record with k below 10."""
    k, t = F.col("k"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    who, ident, shop = F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.when(k >= 10, (k % 10).cast("string"))
    named = {"consumer_id": who, "shop_id": shop}
    record = {
        "visitor": {"visitor_id": ident, **named, "behavior_time": t, "is_new_visitor": (k % 2).cast("string"), "extra": k},
        "cart": {"addcart_id": ident, **named, "addcart_time": t, "addcart_num": k % 5},
        "payment": {"payment_id": ident, "order_id": ident, **named, "total_pay_amt": F.col("value")},
        "membership": {"membership_id": ident, **named, "join_time": t},
        "search": {"search_id": ident, **named, "search_time": t, "search_keyword": k.cast("string")},
        "collect": {"collect_id": ident, **named, "collect_time": t, "is_cancel_collect": k % 2},
        "consult": {"consult_id": ident, **named, "consult_time": t, "is_replied": F.lit("no")},
        "broadcast": {"broadcast_id": ident, "broadcast_time": t, **named, "history_behavior_cnt": k},
        "shop": {"shop_id": shop, "merchant_id": who, "shop_name": F.concat(F.lit("shop "), ident), "is_direct_bus": k % 2},
        "goods": {"goods_id": ident, "shop_id": shop, "goods_name": F.concat(F.lit("goods "), ident), "is_pre_sale": k % 2},
        "customer": {"consumer_id": F.when(k >= 10, who), "register_time": t, "history_shop_cnt": k},
        "channel": {"channel_code": F.when(k >= 10, ident), "channel_name": F.concat(F.lit("channel "), who), "channel_type": k},
    }
    kind, value = None, None
    for n, (name, fields) in enumerate(record.items()):
        hit, body = F.col("event_id") % len(record) == n, F.to_json(F.struct(*[c.alias(f) for f, c in fields.items()]))
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
        value = F.when(hit, body) if value is None else value.when(hit, body)
    return drain(logs.clean_all(w.events().select(kind.alias("kind"), value.alias("value"))), "clean", ["kind"])


def cart_daily_unique(w: StreamWarehouse) -> DataFrame:
    first = uniques.first_per_day(w.events("view", FILES), "user_id")
    return drain(tumble(first, "ts", "5 seconds", [], [rows().alias("cart_add_uu_ct")]), "cart-uu")


def home_detail(w: StreamWarehouse) -> DataFrame:
    pages = w.page_log(FILES).where(F.col("page_id").isin("view", "click"))
    first = uniques.first_per_day(pages, "mid", "page_id")
    count = lambda page: F.sum((F.col("kind") == page).cast("int"))
    return drain(tumble(first, "ts", "5 seconds", [], [count("view").alias("home_uv_ct"), count("click").alias("good_detail_uv_ct")]), "home-detail")


def traffic(w: StreamWarehouse) -> DataFrame:
    """Visitors, sessions, views and stay time per version, channel, area and new flag.

    Only the first view of a visitor and day goes through state; views and stay time are plain window sums.
    """
    keys = ["vc", "ch", "ar", "is_new"]
    first = uniques.first_per_day(w.page_log(FILES), "mid", keep=keys, lateness="3 seconds")
    zero = F.lit(0).cast("bigint")
    visitors = first.select("ts", *keys, F.lit(1).cast("bigint").alias("uv"), zero.alias("sv"), zero.alias("pv"), zero.alias("dur"))
    log = w.page_log(FILES).withWatermark("ts", "3 seconds")
    views = log.select("ts", *keys, zero.alias("uv"), F.col("last_page_id").isNull().cast("bigint").alias("sv"), F.lit(1).cast("bigint").alias("pv"), F.col("during_time").alias("dur"))
    sums = [F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"), F.sum("pv").alias("pv_ct"), F.sum("dur").alias("dur_sum")]
    return drain(tumble(visitors.union(views), "ts", "10 seconds", keys, sums), "traffic")


def login_return(w: StreamWarehouse) -> DataFrame:
    return drain(uniques.login_return(w.events("purchase", FILES), "user_id").select("key", "day", "uu_ct", "back_ct"), "login")


def fixed_new_flag(w: StreamWarehouse) -> DataFrame:
    log = w.page_log(files=FILES).select("event_id", "mid", "ts", "is_new")
    return drain(uniques.fix_is_new(log, "mid").select("event_id", "mid", "is_new", "fixed_is_new"), "is-new")


def twice(df: DataFrame) -> DataFrame:
    return df.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")


def dedup_exact(w: StreamWarehouse) -> DataFrame:
    return drain(dedup.exact(twice(w.events()), ["event_id"], "ts", "1 day").select("event_id", "user_id", "value"), "dedup")


def dedup_bloom(w: StreamWarehouse) -> DataFrame:
    buckets = dedup.bloom_buckets(w.raw("events").count())
    return drain(dedup.bloom(twice(w.events()), ["user_id", "event_id"], buckets=buckets, confirmed=True).select("event_id", "user_id"), "bloom")


def dedup_latest(w: StreamWarehouse) -> DataFrame:
    changes = w.order_changes(FILES).where("after is not null")
    flat = changes.select(cdc.after("user_id").alias("user_id"), cdc.after("id").alias("id"), "ts_ms")
    return drain(dedup.newest_only(flat, "user_id", "ts_ms"), "latest")


def hold_back(w: StreamWarehouse) -> DataFrame:
    held = dedup.hold_back(w.events(files=FILES).select("user_id", "event_id", "ts"), "user_id", "ts", 5000)
    return drain(held.select("user_id", "event_id"), "hold")


def province_retract(w: StreamWarehouse) -> DataFrame:
    """Orders, P orders in two versions: the second replaces the first. Order counts and amounts per province in 10 s windows.

    The second version comes a quarter of the whole time later, some micro-batches after the first, when the window of the first has
    gone out: there the old amount is taken back and the new one added.
    """
    home = w.raw("customer").select(F.col("c_custkey"), F.col("c_nationkey").cast("string").alias("province_id"))
    low, high = w.span("orders", "o_orderdate")
    gap, placed_at, changed = (high - low) // 4, F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86_400 * 1_000_000, F.col("o_orderstatus") == "P"
    amount = money("o_totalprice")
    version = lambda rows, value, after: rows.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("user_id"), value.cast("double").alias("amount"), F.timestamp_micros(placed_at + after).alias("ts"))
    orders = w.raw("orders")
    both = version(orders, amount, 1_000_000).unionByName(version(orders.where(changed), (amount / 2).cast("decimal(16,2)"), gap + 2_000_000))
    stream = w.replay(both, F.unix_micros("ts"), FILES, (low, high + gap), "order-versions")
    placed = enrich(stream, home, "user_id", "c_custkey", ["province_id"])
    keep_ms = gap // 1000 + dedup.DAY_MS
    kept = lambda rows, past: dedup.retract(rows, "id", "ts", ["amount"], keep_ms=keep_ms, past=past)
    count = F.sum(F.signum("amount")).cast("bigint")
    names = w.raw("nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("province_name"))

    def named(closed: DataFrame) -> DataFrame:
        windows = tumble(closed, "ts", "10 seconds", ["province_id"], [count.alias("order_count"), F.sum(F.col("amount").cast("decimal(16,2)")).alias("order_amount")])
        return joins.lookup(windows, names, "province_id", "id", {"province_name": "province_name"})

    return drain_windows(placed.select("id", "province_id", "amount", "ts"), "ts", "10 seconds", kept, named, "province", keep_ms)


def province_window(w: StreamWarehouse) -> DataFrame:
    """Distinct orders per province and 10 s window, counted on order lines."""
    home = w.raw("customer").select("c_custkey", F.col("c_nationkey").alias("province_id"))
    lines = enrich(w.order_lines(FILES), home, "od_user_id", "c_custkey", ["province_id"])
    out = tumble_distinct(
        lines.withWatermark("od_ts", "0 seconds"), "od_ts", "10 seconds", ["province_id"], "od_order_id", [F.max("od_amount").alias("amount")],
        [rows().alias("order_count"), F.sum("amount").alias("order_amount")],
    )
    return drain(out, "province-distinct")


def sku_window(w: StreamWarehouse) -> DataFrame:
    """Amounts per item in 5 s windows, then goods, product, brand and category names looked up on the window rows.

    Product, brand and category names are looked up on the goods first, so that the windows, of which there are nearly as many as lines, are
    shuffled once for their names and never by a few brands or categories.
    """
    r = w.retail
    lines = w.stream("lineitem").select(F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_partkey").alias("sku_id"), money("l_extendedprice").alias("amount"))
    windows = tumble(lines.withWatermark("ts", "0 seconds"), "ts", "5 seconds", ["sku_id"], [rows().alias("line_count"), F.sum("amount").alias("order_amount")])
    goods = joins.lookup(r.sku_info.select("id", "sku_name", "spu_id", "tm_id", "category3_id"), r.spu_info, "spu_id", "id", {"spu_name": "spu_name"})
    goods = joins.lookup(goods, r.trademark, "tm_id", "id", {"tm_name": "tm_name"})
    goods = joins.lookup(goods, r.category3, "category3_id", "id", {"name": "category3_name", "category2_id": "category2_id"})
    goods = joins.lookup(goods, r.category2, "category2_id", "id", {"name": "category2_name", "category1_id": "category1_id"})
    goods = joins.lookup(goods, r.category1, "category1_id", "id", {"name": "category1_name"})
    out = joins.lookup(windows, goods, "sku_id", "id", {c: c for c in goods.columns if c != "id"})
    return drain(out, "sku-window")


def keyword_count(w: StreamWarehouse) -> DataFrame:
    """Words of user questions, counted in 5 s windows; conversation n starts n seconds after the epoch."""
    talk = w.stream("conversations").where("role = 'user'").select(F.timestamp_seconds(F.col("conv_id") + F.col("turn")).alias("ts"), F.explode(logs.keywords("text")).alias("keyword"))
    return drain(tumble(talk.withWatermark("ts", "5 seconds"), "ts", "5 seconds", ["keyword"], [rows().alias("keyword_count")]), "keywords")


def moderated(w: StreamWarehouse) -> DataFrame:
    words = w.raw("benchmark").select(F.explode(logs.keywords("text")).alias("word"))
    comment = F.concat_ws(",", "text", F.split_part("text", F.lit(" "), F.lit(2)))
    comments = w.stream("conversations").select("conv_id", "turn", comment.alias("msg"))
    return drain(moderation.flag(comments, words, "msg").select("conv_id", "turn", "is_violation", "violation_grade", "violation_msg"), "moderation")


def blocked_words(w: StreamWarehouse) -> DataFrame:
    """Blocked words anywhere in a conversation."""
    words = w.raw("benchmark").select(F.explode(logs.keywords("text")).alias("word"))
    return moderation.any_blocked(w.raw("conversations"), words, "conv_id", "text")


def pay_interval(w: StreamWarehouse) -> DataFrame:
    """Payments joined to the order lines of the 30 minutes before to 5 s after, channel name looked up by hashed code."""
    pays = w.later("F", F.col("order_id") % 60 * 60 - 5, "pi", FILES)
    pays = pays.withColumn("payment_type", F.md5((F.col("pi_order_id") % 4).cast("string")))
    lines = joins.Near(w.order_lines(FILES), {"pi_order_id": "od_order_id"}, "pi_ts", "od_ts", "30 minutes", "5 seconds")
    channels = w.raw("region").select(F.md5(F.col("r_regionkey").cast("string")).alias("code"), F.struct(F.col("r_name").alias("dic_name")).alias("info")).select("code", "info.dic_name")

    def named(joined: DataFrame) -> DataFrame:
        out = joins.lookup(joined, channels, "payment_type", "code", {"dic_name": "payment_type_name"})
        return out.select(F.col("id").alias("order_detail_id"), F.col("pi_order_id").alias("order_id"), F.col("pi_user_id").alias("user_id"), "split_amount", "payment_type_name", F.col("pi_ts").alias("paid_at"))

    return joins.drain_near(pays, [lines], "pay", named)


def comment_interval(w: StreamWarehouse) -> DataFrame:
    """Comments within a minute around their order; the order's columns get the prefix info_."""
    comments = w.later(None, F.col("order_id") % 180 - 90, "cm").withColumn("appraise", (F.col("cm_order_id") % 7).cast("string"))
    orders = joins.prefixed(w.order_events(), "info_")
    near = joins.Near(orders, {"cm_order_id": "info_order_id"}, "cm_ts", "info_od_ts", "1 minute", "1 minute")
    grades = w.raw("region").select(F.col("r_regionkey").cast("string").alias("dic_code"), F.col("r_name").alias("dic_name"))

    def named(joined: DataFrame) -> DataFrame:
        out = joins.lookup(joined, grades, "appraise", "dic_code", {"dic_name": "dic_name"}, "N/A")
        return out.select(F.col("cm_order_id").alias("order_id"), "appraise", "dic_name", "info_user_id", "info_status", "info_amount", F.date_format("cm_ts", "yyyyMMdd").alias("ds"))

    return joins.drain_near(comments, [near], "comment", named, lateness="3 seconds")


def cancel_detail(w: StreamWarehouse) -> DataFrame:
    """Order lines joined to a cancel of the next 30 minutes and 5 seconds."""
    cancels = w.later("P", F.col("order_id") % 40 * 60, "ca", FILES)
    near = joins.Near(cancels, {"od_order_id": "ca_order_id"}, "od_ts", "ca_ts", "0 seconds", "1805 seconds")
    named = lambda joined: joined.select("id", F.col("od_order_id").alias("order_id"), "split_amount", F.col("ca_ts").alias("cancel_time"))
    return joins.drain_near(w.order_lines(FILES), [near], "cancel-detail", named, lateness="0 seconds")


def refund_three(w: StreamWarehouse) -> DataFrame:
    """Refund payment ⋈ refund request ⋈ order, all within an hour."""
    pays, asks = w.later("F", F.col("order_id") % 50 * 60, "rp"), w.later("F", F.col("order_id") % 30 * 60, "ri")
    asked = joins.Near(asks, {"rp_order_id": "ri_order_id"}, "rp_ts", "ri_ts", "1 hour", "1 hour")
    placed = joins.Near(w.order_events(), {"rp_order_id": "order_id"}, "rp_ts", "od_ts", "1 hour", "0 seconds")
    named = lambda joined: joined.select("order_id", "user_id", "amount", F.col("ri_ts").alias("asked_at"), F.col("rp_ts").alias("refunded_at"))
    return joins.drain_near(pays, [asked, placed], "refund", named)


def order_refund(w: StreamWarehouse) -> DataFrame:
    """Refund requests joined to their order of the last half hour; type and reason names from one dictionary under two roles."""
    asks = w.later("F", F.col("order_id") % 40 * 60, "ri")
    asks = asks.withColumn("refund_type", F.md5((F.col("ri_order_id") % 5).cast("string"))).withColumn("refund_reason_type", F.md5((F.col("ri_order_id") % 3).cast("string")))
    placed = joins.Near(w.order_events(), {"ri_order_id": "order_id"}, "ri_ts", "od_ts", "30 minutes", "0 seconds")
    names = w.raw("region").select(F.md5(F.col("r_regionkey").cast("string")).alias("dic_code"), F.col("r_name").alias("dic_name"))

    def named(joined: DataFrame) -> DataFrame:
        out = dictionary_roles(joined, names, {"refund_type": "refund_type_name", "refund_reason_type": "refund_reason_name"})
        return out.select("order_id", "user_id", "amount", "refund_type_name", "refund_reason_name", F.col("ri_ts").alias("asked_at"))

    return joins.drain_near(asks, [placed], "order-refund", named)


def login_window(w: StreamWarehouse) -> DataFrame:
    """Daily unique and returning logins in 10 s windows."""
    days = uniques.login_return(w.events("purchase", FILES), "user_id")
    sums = [F.sum("uu_ct").alias("uu_ct"), F.sum("back_ct").alias("back_ct")]
    return drain(tumble(days, "ts", "10 seconds", [], sums), "login-window")


def order_detail(w: StreamWarehouse, reach: str = "10 seconds") -> DataFrame:
    """Order lines ⋈ order ⟕ activity ⟕ coupon, four change streams; lines without activity or coupon come out once the bound has passed.

    ``reach``: how long after the line its activity or coupon may come. State grows with it; what comes later is not joined.
    """
    lines = w.order_lines(FILES).select("id", "od_order_id", "od_ts", "split_amount")
    heads = w.later(None, F.lit(0), "oi", FILES)
    acts = w.later("F", F.col("order_id") % 20, "ac", FILES).withColumn("activity_id", F.col("ac_order_id") % 5).drop("ac_user_id")
    coupons = w.later("O", F.col("order_id") % 20, "cp", FILES).withColumn("coupon_id", F.col("cp_order_id") % 7).drop("cp_user_id")
    one = joins.Near(heads, {"od_order_id": "oi_order_id"}, "od_ts", "oi_ts", "10 seconds", "10 seconds")
    two = joins.Near(acts, {"od_order_id": "ac_order_id"}, "od_ts", "ac_ts", "0 seconds", reach, "left")
    three = joins.Near(coupons, {"od_order_id": "cp_order_id"}, "od_ts", "cp_ts", "0 seconds", reach, "left")
    named = lambda joined: joined.select("id", F.col("od_order_id").alias("order_id"), F.col("oi_user_id").alias("user_id"), "activity_id", "coupon_id", "split_amount")
    return joins.drain_near(lines, [one, two, three], "order-detail", named)


def dim_sync(w: StreamWarehouse) -> DataFrame:
    """Two dimensions from the order change log, by configuration."""
    rules = [("order_info", "dim_order_info", "id", "id,user_id,order_status"), ("shop_info", "dim_shop_info", "user_id", "user_id,total_amount")]
    config = lambda spark: spark.createDataFrame(rules, dimsync.CONFIG)
    path = scratch_path(w.spark, "dim-sync")
    dimsync.sync(w.order_changes(), path, config).awaitTermination()
    live = dimsync.current(w.spark, path, config(w.spark))
    at = lambda f: F.try_element_at("info", F.lit(f)).alias(f)
    return live.select("sink_table", "row_key", at("id"), at("user_id"), at("order_status"), at("total_amount"))


def changing_lookup(w: StreamWarehouse) -> DataFrame:
    """Orders with the name their province had at the time of the order; half of the names change in the middle of the stream.

    Every fifth province has no name before, so its orders carry the default.
    """
    low, high = w.span("orders", "o_orderdate")
    code, name = F.col("n_nationkey"), F.col("n_name")
    version = lambda rows, called, at: rows.select(code.alias("code"), called.alias("province_name"), F.timestamp_micros(F.lit(at)).alias("from_ts"))
    first, second = version(w.raw("nation").where(code % 5 != 4), name, low), version(w.raw("nation").where(code % 2 == 0), F.lower(name), (low + high) // 2)
    changes = w.replay(first.unionByName(second), F.unix_micros("from_ts"), FILES, (low, high), "province-names")
    orders = w.order_events(FILES).select("order_id", (F.col("user_id") % 25).alias("province_code"), "amount", "od_ts")
    named = lookups.lookup_as_of(orders, changes, "province_code", "code", ["province_name"], "od_ts", "from_ts", "N/A", lateness="1 day")
    return drain(named, "changing-lookup")


def clock_windows(w: StreamWarehouse) -> DataFrame:
    """Events and their value per type in windows of 2 s of the clock, summed over all windows."""
    events = w.events(files=FILES).select("event_type", F.lit(1).alias("n"), (F.col("value") * 100).cast("bigint").alias("cents"))
    windows = run_clock(tumble_clock(events, 2000, ["event_type"], ["n", "cents"]), "clock", 2000)
    return windows.groupBy("event_type").agg(F.sum("n").alias("events"), F.sum("cents").alias("cents"))


def rule_changes(w: StreamWarehouse) -> DataFrame:
    """Dimensions from the order change log under rules that change while it runs.

    Shop rows count from the middle on; other rows are added later and filled back; order rows are removed and, later still, taken
    up again with fewer columns.
    """
    low, high = w.span("orders", "o_orderdate")
    at = lambda k: (low + (high - low) * k // 8) // 1000
    rules = [
        ("c", "order_info", "dim_order_info", "id", "id,user_id,order_status", at(0), True),
        ("c", "shop_info", "dim_shop_info", "user_id", "user_id,total_amount", at(4), False),
        ("c", "other_table", "dim_other", "id", "id,total_amount", at(5), True),
        ("d", "order_info", "dim_order_info", None, None, at(6), False),
        ("c", "order_info", "dim_order_info", "id", "id,order_status", at(7), False),
    ]
    log = w.replay(w.spark.createDataFrame(rules, dimsync.RULES), F.col("at_ms") * 1000, FILES, (low, high), "rules")
    path = scratch_path(w.spark, "rules")
    dimsync.sync_with_rules(w.order_changes(FILES), log, path).awaitTermination()
    at_field = lambda f: F.try_element_at("info", F.lit(f)).alias(f)
    return dimsync.current_under_rules(w.spark, path).select("sink_table", "row_key", *[at_field(f) for f in ("id", "user_id", "order_status", "total_amount")])


def upsert_latest(w: StreamWarehouse) -> DataFrame:
    """Newest order row per user; a user whose newest change is a delete is gone."""
    flat = cdc.payload(w.order_changes())
    at = lambda f: F.try_element_at("row", F.lit(f)).alias(f)
    flat = flat.select(at("user_id"), at("id"), at("order_status"), "op", F.col("tm_ms").alias("ts_ms"))
    path = scratch_path(w.spark, "upsert")
    sinks.upsert_stream(flat, path, ["user_id"], ["ts_ms"], "op").awaitTermination()
    return sinks.keyed_table(flat, path, ["user_id"], ["ts_ms"], "op").read()


def olap_json(w: StreamWarehouse) -> DataFrame:
    """Window rows as JSON lines with snake_case names, read back as a table."""
    windows = tumble(w.events("purchase").withWatermark("ts", "0 seconds"), "ts", "1 hour", ["user_id"], [rows().alias("payCount"), F.sum("value").alias("payAmount")])
    path = scratch_path(w.spark, "olap")
    sinks.olap_files(windows, path).awaitTermination()
    return json_table(w.spark.read.text(f"{path}/data").select("value"), "stt string, edt string, cur_date string, user_id bigint, pay_count bigint, pay_amount decimal(16,2)")


def bucketed_files(w: StreamWarehouse) -> DataFrame:
    """Lines in day folders: time in ms, in seconds, or unreadable."""
    ms = F.unix_millis("ts").cast("string")
    at = F.when(F.col("k") % 3 == 0, ms).when(F.col("k") % 3 == 1, F.substring(ms, 1, 10)).otherwise("soon")
    lines = w.events().select(F.to_json(F.struct("event_id", at.alias("at"))).alias("value"))
    path = scratch_path(w.spark, "buckets")
    start_files(sinks.bucketed_text(lines, "at"), path, ["day"], "text").awaitTermination()
    return w.spark.read.schema("value string, day string").text(f"{path}/data")


def stamped(w: StreamWarehouse) -> DataFrame:
    """Changes per kind of operation, and how many of them carry a processing time of this run."""
    began = F.lit(datetime.now(UTC)).cast("timestamp")
    out = drain(cdc.stamp(w.order_changes()).select("op", "process_time"), "stamped")
    return out.groupBy("op").agg(rows().alias("changes"), F.count_if(F.col("process_time") >= began).alias("stamped"))


def rolled_files(w: StreamWarehouse) -> DataFrame:
    """The lines of the day folders through the rolling sink, in eight batches and files of at most 64 KB: lines per day."""
    ms = F.unix_millis("ts").cast("string")
    at = F.when(F.col("k") % 3 == 0, ms).when(F.col("k") % 3 == 1, F.substring(ms, 1, 10)).otherwise("soon")
    lines = w.events(files=FILES).select(F.to_json(F.struct("event_id", at.alias("at"))).alias("value"))
    path = scratch_path(w.spark, "rolled")
    rolled.write_rolled(sinks.bucketed_text(lines, "at"), path, 64 << 10).awaitTermination()
    return rolled.read_rolled(w.spark, path)


def held_after_timers(w: StreamWarehouse) -> DataFrame:
    """Users whose last event is still held back when the stream has ended, and that event's time, read from the state itself."""
    held = dedup.hold_back(w.events(files=FILES).select("user_id", "event_id", "ts"), "user_id", "ts", 5000)
    path = scratch_path(w.spark, "held")
    start_files(held, path).awaitTermination()
    return inspect.held_keys(w.spark, path, "held").select("key.user_id", "value.event_id", "value.ts")


def held_after_restart(w: StreamWarehouse) -> DataFrame:
    """Marks of first visits that are still kept after the stream was stopped half-way and started again: users and days."""
    spark, path, log = w.spark, scratch_path(w.spark, "restart"), w.raw("events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    low, high = w.span("events", "ts")
    half = F.unix_micros("ts") < (low + high) // 2
    for part in (half, ~half):
        log.where(part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(log.schema).parquet(f"{path}/in")
        start_files(uniques.first_per_day(stream, "user_id"), path).awaitTermination()
    marks = inspect.held_keys(spark, path, "seen").select(F.inline(F.arrays_zip(F.col("value.keys").alias("user_id"), F.col("value.marks").alias("mark"))).alias("user_id", "mark"))
    return marks.select("user_id", F.substring("mark", 1, 10).alias("day"))


def tombstones(w: StreamWarehouse) -> DataFrame:
    """Change log as a topic of JSON values, deletes as empty payloads; parsed back to envelopes without the tombstones."""
    e = w.order_changes()
    texts = e.select(F.when(F.col("op") != "d", F.to_json(F.struct("op", "before", "after", "source", "ts_ms"))).alias("value"))
    return drain(cdc.flatten(cdc.parse(texts)), "flatten")


QUERIES = {
    "stream_cdc_flatten": tombstones,
    "stream_process_time": stamped,
    "stream_cdc_transition": cancel_transitions,
    "stream_cart_growth": cart_growth,
    "stream_cdc_payload": payload,
    "stream_route_by_table": routed,
    "stream_split_log": split_logs,
    "stream_dirty_lines": dirty_lines,
    "stream_clean_kinds": clean_kinds,
    "stream_cart_daily_unique": cart_daily_unique,
    "stream_home_detail": home_detail,
    "stream_traffic_window": traffic,
    "stream_login_return": login_return,
    "stream_fix_is_new": fixed_new_flag,
    "stream_dedup_exact": dedup_exact,
    "stream_dedup_bloom": dedup_bloom,
    "stream_dedup_latest": dedup_latest,
    "stream_hold_back": hold_back,
    "stream_province_retract": province_retract,
    "stream_province_window": province_window,
    "stream_sku_window": sku_window,
    "stream_keyword_count": keyword_count,
    "stream_moderation": moderated,
    "blocked_words": blocked_words,
    "stream_pay_interval_join": pay_interval,
    "stream_comment_interval_join": comment_interval,
    "stream_cancel_join": cancel_detail,
    "stream_refund_join": refund_three,
    "stream_order_refund_join": order_refund,
    "stream_order_detail_join": order_detail,
    "stream_login_window": login_window,
    "stream_dim_sync": dim_sync,
    "stream_changing_lookup": changing_lookup,
    "stream_clock_windows": clock_windows,
    "stream_rule_changes": rule_changes,
    "stream_upsert_latest": upsert_latest,
    "stream_olap_json": olap_json,
    "stream_bucketed_files": bucketed_files,
    "stream_rolled_files": rolled_files,
    "stream_state_after_timers": held_after_timers,
    "stream_state_after_restart": held_after_restart,
}

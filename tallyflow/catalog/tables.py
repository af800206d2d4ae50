"""Cleaning, history, ranking, set and sink operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.catalog.retail import RetailWarehouse
from tallyflow.functions import clean
from tallyflow.functions.times import day, day_range, epoch_any, iso_text
from tallyflow.functions import udtf
from tallyflow.operators import deltas, history
from tallyflow.operators.dims import attribute_sets
from tallyflow.operators.distinct import bitmap_horizons, daily_bitmaps
from tallyflow.operators.ranking import best_row, rank_whole
from tallyflow.operators.rangejoin import link_points
from tallyflow.operators.todate import rebuild
from tallyflow.operators.upsert import merge_latest
from tallyflow.plans.retail_facts import page_view
from tallyflow.plans.retail_reports import order_by_province
from tallyflow.session import materialise, scratch_path
from tallyflow.sources import readers, sinks
from tallyflow.sources.standins import EVENTS_AS_OF, ORDERS_AS_OF, money

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


class TableWarehouse(RetailWarehouse):
    def customers(self, n: int) -> DataFrame:
        """Customers on generated day n (0, 1, 2); the segment of key k changes on the days up to n with k mod 7 = day."""
        key = F.col("c_custkey")
        changes = sum(((key % 7 == d).cast("int") for d in range(1, n + 1)), F.lit(0))
        return self.raw("customer").select(
            key.alias("id"), F.concat_ws("-", "c_mktsegment", changes.cast("string")).alias("segment"), F.col("c_acctbal").alias("balance"),
            F.concat(F.lit(DAYS[n]), F.lit(" 08:00:00")).alias("operate_time"),
        )

    def changed(self, n: int) -> DataFrame:
        """Change rows of day n: each changed customer twice, an early and the final version."""
        rows = self.customers(n).where(F.col("id") % 7 == n)
        early = rows.withColumn("segment", F.lit("draft")).withColumn("operate_time", F.lit(f"{DAYS[n]} 07:00:00"))
        return rows.unionByName(early)


def history_by_rank(w: TableWarehouse) -> DataFrame:
    """Two daily steps on the first load; closed rows of the first step stay."""
    held = history.history_init(w.customers(0), day(DAYS[0]))
    one = history.history_rank(held, w.changed(1), "id", DAYS[1])
    two = history.history_rank(one, w.changed(2), "id", DAYS[2])
    closed = one.where(F.col("end_date") != day("9999-12-31"))
    return two.unionByName(closed).drop("operate_time")


def history_by_compare(w: TableWarehouse) -> DataFrame:
    held = w.customers(0).select("id", "segment").withColumn("start_date", day(DAYS[0])).withColumn("end_date", day("9999-12-31")).withColumn("is_current", F.lit(1))
    return history.history_compare(held, w.customers(1).select("id", "segment"), "id", ["segment"], DAYS[1])


def history_by_lag(w: TableWarehouse) -> DataFrame:
    snaps = None
    for n, d in enumerate(DAYS):
        one = w.customers(n).select("id", "segment").withColumn("dt", day(d))
        snaps = one if snaps is None else snaps.unionByName(one)
    return history.history_lag(snaps, "id", ["segment"])


def mask_and_hash(w: TableWarehouse) -> DataFrame:
    u = w.user_info
    hot = sorted(clean.HOT_ADDRESS_BUCKETS)
    address = F.when(F.col("id") % 50 == 0, F.upper(F.element_at(F.array(*[F.lit(a) for a in hot]), (F.col("id") % len(hot) + 1).cast("int")))).otherwise(F.concat(F.lit("0x"), F.col("id").cast("string")))
    return u.select(
        "id", clean.mask_name("name").alias("short_name"), clean.mask_name_full("name").alias("starred_name"), clean.mask_phone("phone_num").alias("phone"), clean.mask_email("email").alias("mail"),
        clean.hash_sensitive("phone_num").alias("phone_hash"), clean.hash_bucket("id", 128).alias("bucket"), clean.hash_bucket(address, 128, clean.HOT_ADDRESS_BUCKETS).alias("address_bucket"), clean.has_only("email", r"^[A-Za-z0-9_@.]+$").alias("plain_mail"),
        clean.match_or_null("email", "@mail[01]").alias("near_mail"),
    )


def hex_numbers(w: TableWarehouse) -> DataFrame:
    """Keys written as hex, read back as numbers."""
    key = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    rows = w.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("0x"), F.lower(F.hex(key)))).otherwise(key.cast("string")).alias("raw"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", clean.hex_to_number("raw").cast("bigint").alias("number"), clean.hex_to_plain("raw").alias("plain"))


def text_helpers(w: TableWarehouse) -> DataFrame:
    """Epochs told apart by digits, ISO texts, JSON lists and trimmed texts."""
    e = w.events
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").cast("string")
    raw = e.withColumn("raw", F.when(F.col("k") % 2 == 0, F.substring(ms, 1, 10)).otherwise(ms)).withColumn("list", F.when(F.col("k") % 3 != 0, F.lit('["a"]')))
    return raw.select(
        "event_id", epoch_any("raw").alias("moment"), iso_text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso"), clean.append_json("list", "event_type").alias("list"),
        clean.is_blank(F.when(F.col("k") % 4 == 0, F.lit("  ")).otherwise(F.col("event_type"))).alias("blank"),
        clean.strip_control(F.concat(F.lit(" \u0001"), "event_type", F.lit("\u007f "))).alias("stripped"), clean.event_id("user_id", time=F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_key"),
    )


def part_attributes(w: TableWarehouse) -> DataFrame:
    """Sizes and types per brand as a set of structs, and the best-priced part."""
    sets = attribute_sets(w.raw("part"), "p_brand", ["p_type", "p_size"], "kinds")
    best = best_row(w.raw("part"), ["p_brand"], [F.col("p_retailprice"), F.col("p_partkey")], ["p_partkey", "p_retailprice"])
    return sets.join(best, "p_brand")


def global_rank(w: TableWarehouse) -> DataFrame:
    """rank() of all orders by rounded price, most expensive first."""
    rows = w.raw("orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("price_k"))
    return rank_whole(rows, "price_k", "price_rank")


def shipments_in_window(w: TableWarehouse) -> DataFrame:
    """Events linked to the purchase hours of the same user: each purchase opens an interval of two hours."""
    buys = w.raw("events").where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"), F.col("ts").alias("opened"), (F.col("ts") + F.expr("interval 2 hours")).alias("closed"))
    points = w.raw("events").where("event_type <> 'purchase'").select("user_id", "event_id", "ts")
    return link_points(points, buys, ["user_id"], "ts", "opened", "closed").select("user_id", "event_id", "buy_id")


def merged(w: TableWarehouse) -> DataFrame:
    """Stored customers merged with the changes of two days, newest row per key."""
    return merge_latest(w.customers(0), w.changed(1).unionByName(w.changed(2)), ["id"], ["operate_time"])


def signed_stock(w: TableWarehouse) -> DataFrame:
    from tallyflow.operators.align import signed_balance

    opened = w.raw("orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("amount"))
    done = w.raw("orders").where("o_orderstatus = 'F'").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("amount"))
    return signed_balance(opened, done, ["priority"], ["n", "amount"])


def sink_partitions(w: TableWarehouse) -> DataFrame:
    """All days written by dynamic partition, one day replaced twice, then read back: other days are untouched."""
    path = scratch_path(w.spark, "favor-1d")
    daily = w.favor_1d
    sinks.replace_partitions(daily, path)
    for _ in range(2):
        sinks.replace_day(daily.where(F.col("dt") == day(EVENTS_AS_OF)), path, EVENTS_AS_OF)
    return readers.parquet_day(w.spark, path)


def sink_report(w: TableWarehouse) -> DataFrame:
    """Report written for two dates, the second one twice."""
    path = scratch_path(w.spark, "report")
    for as_of in ("2001-07-30", ORDERS_AS_OF, ORDERS_AS_OF):
        from tallyflow.plans.retail_summaries import province_order_nd

        sinks.report(order_by_province(w.province_1d, province_order_nd(w.province_1d, as_of), as_of), path)
    return w.spark.read.parquet(path).where(F.col("dt") == ORDERS_AS_OF)


def sink_report_text(w: TableWarehouse) -> DataFrame:
    """Report as tab-separated text, read back with its schema."""
    path = scratch_path(w.spark, "report-text")
    out = w.raw("nation").select(day(EVENTS_AS_OF).alias("dt"), "n_nationkey", "n_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).alias("region"))
    sinks.report_text(out, path)
    return readers.tsv(w.spark, path, "n_nationkey int, n_name string, region int, dt string")


def orc_days(w: TableWarehouse) -> DataFrame:
    """Events as an ORC table by day, one day read back."""
    path = scratch_path(w.spark, "orc")
    sinks.replace_partitions(w.events, path, fmt="orc")
    return readers.orc_day(w.spark, path, EVENTS_AS_OF)


def raw_log_files(w: TableWarehouse) -> DataFrame:
    """Raw log written as text lines, read as ``log`` and parsed."""
    path = scratch_path(w.spark, "raw-log")
    w.z_log.select("log").write.text(path)
    return page_view(readers.json_log(w.spark, path)).select("session_id", "page_id", "view_time", "during_time", "dt")


def verified_loads(w: TableWarehouse) -> DataFrame:
    """Three loads, one of them broken: row count of the report date or the error."""
    path = scratch_path(w.spark, "loads")
    jobs = {
        "province": lambda: w.province_1d.where(F.col("dt") == day(ORDERS_AS_OF)),
        "broken": lambda: w.province_1d.select("no_such_column"),
        "users": lambda: w.order_1d.where(F.col("dt") == day(ORDERS_AS_OF)),
    }
    done = sinks.load_and_verify(jobs, path, ORDERS_AS_OF)
    told = [(k, v if isinstance(v, int) else -1) for k, v in done.items()]
    return w.spark.createDataFrame(told, "job string, written long")


def appended_orders(w: TableWarehouse) -> DataFrame:
    """Orders appended twice: a plain append keeps both copies."""
    path = scratch_path(w.spark, "append")
    rows = w.raw("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    for _ in range(2):
        sinks.append(rows, path)
    return w.spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("order_id").alias("orders"))


def loaded_file(w: TableWarehouse) -> DataFrame:
    """Orders as tab-separated text, loaded into a table."""
    path = scratch_path(w.spark, "load-file")
    w.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).write.option("sep", "\t").csv(f"{path}/text")
    return readers.load_file(w.spark, f"{path}/text", "o_orderkey bigint, o_custkey bigint, o_orderpriority string, day string", f"{path}/table")


def preview(w: TableWarehouse) -> DataFrame:
    """The hundred dearest orders, as a first look at a table in order."""
    orders = w.raw("orders").select("o_orderkey", "o_custkey", money("o_totalprice").alias("price"))
    return readers.first_rows(orders.orderBy(F.desc("price"), "o_orderkey"), 100)


def keyed_records(w: TableWarehouse) -> DataFrame:
    """Key-value records with tombstones in between: what is left is counted per key."""
    records = w.raw("events").select(
        F.col("event_type").cast("binary").alias("key"), F.when(F.col("event_id") % 7 != 0, F.col("props").cast("binary")).alias("value"), F.col("ts").alias("timestamp")
    )
    return readers.values(records).groupBy("key").agg(F.count("*").alias("n"), F.max("value").alias("largest"))


def keyword_function(w: TableWarehouse) -> DataFrame:
    """Words of conversations by the SQL table function, counted per conversation."""
    udtf.register(w.spark)
    w.raw("conversations").createOrReplaceTempView("keyword_source")
    return w.spark.sql("SELECT id AS conv_id, word, count(*) AS n FROM keyword_udtf(TABLE(SELECT conv_id AS id, text FROM keyword_source)) GROUP BY id, word")


def user_bitmaps(w: TableWarehouse) -> DataFrame:
    """Distinct users per kind of event for 1, 7 and 30 days, from stored daily bitmaps."""
    daily = materialise(daily_bitmaps(w.events, ["event_type"], "user_id"), "daily-bitmaps")
    return bitmap_horizons(daily, EVENTS_AS_OF, ["event_type"], "user_count")


def corrected_to_date(w: TableWarehouse) -> DataFrame:
    """Order totals to date per province, loaded once and then corrected by signed changes.

    The first load lacks some orders, has others at a wrong amount, and some customers in a wrong province; the corrections restate
    the provinces they touch.
    """
    key, cust = F.col("order_id"), F.col("user_id")
    orders = w.raw("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("dt"), money("o_totalprice").alias("order_amount"))
    wrong = orders.where(key % 20 == 5).withColumn("order_amount", money(F.col("order_amount") + 1))
    homes = w.raw("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("province_id"))
    moved = homes.where(cust % 30 == 4).withColumn("province_id", F.lit(0).cast(homes.schema["province_id"].dataType))
    loaded = orders.where(~(key % 20).isin(3, 5)).unionByName(wrong)
    placed = homes.where(cust % 30 != 4).unionByName(moved)
    day_keys, keys, sums = ["province_id", "dt"], ["province_id"], ["order_count", "order_amount"]
    held = loaded.join(placed, "user_id").groupBy(*day_keys).agg(F.count(F.lit(1)).alias("order_count"), F.sum("order_amount").alias("order_amount"))
    daily = materialise(held, "daily-totals")
    to_date = materialise(rebuild(daily, keys, sums, "first_day", "last_day", ORDERS_AS_OF), "to-date")

    new_orders = deltas.signed(orders.where((key % 20).isin(3, 5)), wrong)
    new_homes = deltas.signed(homes.where(cust % 30 == 4), moved)
    changes = deltas.joined_changes(loaded, new_orders, placed, new_homes, ["user_id"])
    delta = materialise(deltas.summed_changes(changes, day_keys, ["order_amount"], "order_count"), "delta")
    now = deltas.applied(daily, delta, day_keys, ["order_amount"], "order_count")
    return deltas.restated(to_date, now, delta, keys, sums, "first_day", "last_day", ORDERS_AS_OF)


def days_of_orders(w: TableWarehouse) -> DataFrame:
    """Every day from the first to the last order, with its orders."""
    dated = w.raw("orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("ds"))
    first, last = w.raw("orders").agg(F.min("o_orderdate").cast("date").cast("string"), F.max("o_orderdate").cast("date").cast("string")).first()
    counted = dated.groupBy("ds").agg(F.count("*").alias("orders"))
    return day_range(w.spark, first, last).join(counted, "ds", "left").na.fill(0, ["orders"])


QUERIES = {
    "sink_append": appended_orders,
    "source_load_file": loaded_file,
    "source_preview": preview,
    "source_nullsafe_values": keyed_records,
    "keyword_function": keyword_function,
    "event_user_bitmaps": user_bitmaps,
    "province_td_corrected": corrected_to_date,
    "order_day_range": days_of_orders,
    "scd2_rank": history_by_rank,
    "scd2_compare": history_by_compare,
    "scd2_lag": history_by_lag,
    "mask_and_hash": mask_and_hash,
    "hex_to_decimal": hex_numbers,
    "text_helpers": text_helpers,
    "part_attribute_sets": part_attributes,
    "order_global_rank": global_rank,
    "purchase_window_links": shipments_in_window,
    "merge_latest": merged,
    "signed_balance": signed_stock,
    "sink_partitions": sink_partitions,
    "sink_report": sink_report,
    "sink_report_text": sink_report_text,
    "source_orc_days": orc_days,
    "source_raw_log": raw_log_files,
    "load_and_verify": verified_loads,
}

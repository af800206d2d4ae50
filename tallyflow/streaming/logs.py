"""Raw logs: dirty rows set apart, one log split into five kinds, and records of twelve kinds cleaned."""

from __future__ import annotations

import re
from functools import reduce



from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMMON = "struct<ar: string, ba: string, ch: string, is_new: string, md: string, mid: string, os: string, uid: string, vc: string, sid: string>"
PAGE = """struct<item: string, item_type: string, last_page_id: string, page_id: string, from_pos_id: string, from_pos_seq: string,
          refer_id: string, during_time: bigint>"""
LOG = f"""struct<common: {COMMON}, page: {PAGE}, ts: bigint, err: string, start: string, displays: array<string>, actions: array<string>>"""


def split_dirty(lines: DataFrame, schema: str, column: str = "value", topic: str = "clean", dirty: str = "dirty") -> DataFrame:
    """Parsed record and target topic per line; lines that are not a JSON object go to the dirty topic as they came."""
    parsed = lines.withColumn("parsed", F.from_json(F.col(column), schema))
    good = F.coalesce(F.try_parse_json(column).isNotNull() & F.trim(column).startswith("{"), F.lit(False))
    return parsed.withColumn("topic", F.when(good, topic).otherwise(dirty)).withColumn("parsed", F.when(good, F.col("parsed")))


def split_log(lines: DataFrame, column: str = "log") -> DataFrame:
    """One row per output record with its kind: err, start, display, action or page.

    Parsed once. A log with an error gives its error row besides the rest; a start log gives only its start row; displays and
    actions are unrolled with common and page copied. Written with ``partitionBy("kind")`` or to the topic of the kind.
    """
    p = F.from_json(F.col(column), LOG)
    rows = lines.select(F.explode(F.array(p)).alias("p")).where("p is not null")
    item = lambda kind, body: F.struct(F.lit(kind).alias("kind"), body.alias("body"))
    none = F.array().cast("array<struct<kind: string, body: string>>")
    many = lambda kind, field: F.coalesce(F.transform(F.col(f"p.{field}"), lambda x: item(kind, x)), none)
    one = lambda kind, there, body: F.when(there, F.array(item(kind, body))).otherwise(none)
    started = F.col("p.start").isNotNull()
    rest = F.concat(many("display", "displays"), many("action", "actions"), F.array(item("page", F.to_json("p.page"))))
    out = F.concat(one("err", F.col("p.err").isNotNull(), F.col("p.err")), F.when(started, F.array(item("start", F.col("p.start")))).otherwise(rest))
    return rows.select("p.common", "p.page", "p.ts", F.explode(out).alias("o")).select("o.kind", "o.body", "common", "page", "ts")


# Record kinds of the shop funnel, their required fields and output fields with types.
KINDS: dict[str, tuple[tuple[str, ...], str]] = {
    "visitor": (
        ("visitor_id", "consumer_id", "shop_id", "behavior_time"),
        """visitor_id string, consumer_id string, shop_id string, goods_id string, behavior_time string, channel string, device_type string, visit_page_type string,
        is_new_visitor int, user_agent string""",
    ),
    "cart": (
        ("addcart_id", "consumer_id", "shop_id", "addcart_time"),
        """addcart_id string, consumer_id string, shop_id string, goods_id string, sku_id string, addcart_time string, channel string, addcart_num int,
        is_cancel_addcart int, history_addcart_cnt int""",
    ),
    "payment": (
        ("payment_id", "order_id", "consumer_id", "shop_id"),
        """payment_id string, order_id string, consumer_id string, shop_id string, goods_id string, sku_id string, payment_date string, payment_time string, order_type string,
        deposit_amt decimal(16,2), balance_amt decimal(16,2), total_pay_amt decimal(16,2), freight_amt decimal(16,2), shopping_fund_amt decimal(16,2),
        red_packet_amt decimal(16,2), is_taote int, is_cross_border int, is_subsidy_half_hosting int, is_official_bid int, coupon_amt decimal(16,2), is_small_pay int,
        refund_mid_sale decimal(16,2), refund_after_sale decimal(16,2), is_instant_refund int, is_balance_paid int""",
    ),
    "search": (
        ("search_id", "consumer_id", "shop_id", "search_time"),
        "search_id string, consumer_id string, shop_id string, search_keyword string, click_goods_id string, search_time string, search_stay_sec int, channel string",
    ),
    "collect": (
        ("collect_id", "consumer_id", "shop_id", "collect_time"),
        "collect_id string, consumer_id string, shop_id string, goods_id string, collect_time string, is_cancel_collect int, history_collect_cnt int",
    ),
    "membership": (
        ("membership_id", "consumer_id", "shop_id", "join_time"),
        "membership_id string, consumer_id string, shop_id string, join_time string, membership_type string, is_quit int",
    ),
    "consult": (
        ("consult_id", "consumer_id", "shop_id", "consult_time"),
        "consult_id string, consumer_id string, shop_id string, goods_id string, consult_time string, consult_content string, is_replied int, reply_time string",
    ),
    "broadcast": (
        ("broadcast_id", "broadcast_time", "shop_id", "consumer_id"),
        """broadcast_id string, broadcast_time string, shop_id string, consumer_id string, consumer_type string, behavior_type string, channel string, goods_id string,
        history_behavior_cnt int, broadcast_content string, is_triggered int, related_behavior_ids string""",
    ),
    "shop": (
        ("shop_id", "merchant_id", "shop_name"),
        """shop_id string, merchant_id string, shop_name string, shop_category string, open_date string, is_direct_bus int, business_scope string, create_time string,
        update_time string""",
    ),
    "goods": (
        ("goods_id", "shop_id", "goods_name"),
        """goods_id string, shop_id string, goods_name string, sku_list string, goods_category string, shelf_time string, off_shelf_time string, is_pre_sale int,
        is_support_pay_later int, create_time string, update_time string""",
    ),
    "customer": (
        ("consumer_id", "register_time"),
        "consumer_id string, register_time string, first_shopping_time string, history_shop_cnt int, create_time string, update_time string",
    ),
    "channel": (("channel_code", "channel_name"), "channel_code string, channel_name string, channel_type string, is_visible_in_report string"),
}


def _fields(kind: str) -> list[list[str]]:
    return [f.strip().split(" ", 1) for f in re.split(r",(?![^(]*\))", KINDS[kind][1])]


def _typed(kind: str, texts: Column) -> Column:
    """The kind's fields taken from a map of texts and cast; text that does not fit a type becomes NULL."""
    return F.struct(*[F.try_element_at(texts, F.lit(name)).try_cast(to).alias(name) for name, to in _fields(kind)])


def clean_kind(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """Records of one kind as a typed table; rows without a required field are dropped."""
    texts = lines.select(F.from_json(F.col(column), "map<string,string>").alias("m"))
    return texts.select(_typed(kind, F.col("m")).alias("r")).select("r.*").dropna(subset=list(KINDS[kind][0]))


def clean_all(lines: DataFrame, kind: str = "kind", column: str = "value") -> DataFrame:
    """Records of all kinds in one pass, each parsed once: kind and the cleaned record as JSON; incomplete records are dropped."""
    texts = lines.select(kind, F.explode(F.array(F.from_json(F.col(column), "map<string,string>"))).alias("m"))
    cleaned = None
    for name, (required, _) in KINDS.items():
        whole = reduce(lambda a, b: a & b, [F.try_element_at("m", F.lit(r)).isNotNull() for r in required])
        hit, record = (F.col(kind) == name) & whole, F.to_json(_typed(name, F.col("m")))
        cleaned = F.when(hit, record) if cleaned is None else cleaned.when(hit, record)
    return texts.select(kind, F.explode(F.array(cleaned)).alias("record")).where(F.col("record").isNotNull())


def keywords(text: Column | str) -> Column:
    """Words of a text separated by anything but letters and digits."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(c, r"[^\p{L}\p{N}]+"), lambda w: w != "")



"""Retail plans over the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.plans import retail_dims as dims
from tallyflow.plans import retail_facts as facts
from tallyflow.plans import retail_reports as reports
from tallyflow.plans import retail_summaries as sums
from tallyflow.sources.standins import EVENTS_AS_OF, ORDERS_AS_OF, Retail


class RetailWarehouse(Retail):
    """Layers built on the source tables; each one is a lazy DataFrame."""

    @cached_property
    def sku(self) -> DataFrame:
        return dims.sku_names(self.sku_info, self.category3, self.category2, self.category1, self.trademark)

    @cached_property
    def place(self) -> DataFrame:
        return dims.province(self.province, self.region)

    @cached_property
    def coupon(self) -> DataFrame:
        return dims.coupon(self.coupon_info, self.base_dic)

    @cached_property
    def lines(self) -> DataFrame:
        return facts.order_lines(self.order_detail, self.order_info)

    @cached_property
    def pay_lines(self) -> DataFrame:
        paid = self.payment_info.select("order_id", "user_id", "dt")
        return self.order_detail.join(paid, "order_id").withColumnRenamed("split_total_amount", "split_payment_amount")

    @cached_property
    def views(self) -> DataFrame:
        return facts.page_view(self.z_log)

    def recent_views(self, as_of: str, days: int) -> DataFrame:
        """Page views of the last days: the log's own day, with a day on either side for zones, prunes before a line is parsed."""
        log = self.z_log.where(F.col("dt").between(F.date_sub(F.lit(as_of).cast("date"), days), F.date_add(F.lit(as_of).cast("date"), 1)))
        return facts.page_view(log)

    @cached_property
    def logins(self) -> DataFrame:
        return facts.user_login(self.views)

    @cached_property
    def new_users(self) -> DataFrame:
        return self.events.groupBy(F.col("user_id").cast("string").alias("user_id")).agg(F.min("ts").alias("create_time"))

    @cached_property
    def favor_1d(self) -> DataFrame:
        return sums.sku_favor_add_1d(facts.favor_add(self.favor_info), self.sku)

    @cached_property
    def coupon_1d(self) -> DataFrame:
        return sums.user_coupon_used_1d(facts.coupon_used(self.coupon_use), self.coupon)

    @cached_property
    def province_1d(self) -> DataFrame:
        return sums.province_order_1d(self.lines, self.place)

    @cached_property
    def province_nd(self) -> DataFrame:
        return sums.province_order_nd(self.province_1d, ORDERS_AS_OF)

    @cached_property
    def order_1d(self) -> DataFrame:
        return sums.user_order_1d(self.lines)

    @cached_property
    def user_sku_1d(self) -> DataFrame:
        return sums.user_sku_order_1d(self.lines, self.sku)

    @cached_property
    def user_sku_nd(self) -> DataFrame:
        return sums.user_sku_order_nd(self.lines, self.sku, ORDERS_AS_OF)

    def shopping_days(self, kind: str) -> DataFrame:
        """Users and days with an event of a kind, as the carts, orders and payments of the page-log users."""
        return self.events.where(F.col("event_type") == kind).groupBy("user_id", "dt").agg(F.count(F.lit(1)).alias("n"))

    def flow(self, as_of: str) -> DataFrame:
        return facts.trade_flow_first(self.order_info, self.payment_info, self.order_status_log, as_of)


DAY_BEFORE = {ORDERS_AS_OF: "2001-07-30", EVENTS_AS_OF: "2024-01-29"}

QUERIES = {
    # dimensions
    "activity_dim": lambda w: dims.activity(w.activity_rule, w.activity_info, w.base_dic),
    "coupon_dim": lambda w: w.coupon,
    "promotion_pos_dim": lambda w: dims.snapshot(
        w.z_log.select(F.get_json_object("log", "$.page.from_pos_id").alias("id"), F.get_json_object("log", "$.page.page_id").alias("pos_location")).distinct(),
        ["id", "pos_location"], EVENTS_AS_OF),
    "promotion_refer_dim": lambda w: dims.snapshot(
        w.z_log.select(F.get_json_object("log", "$.page.refer_id").alias("id")).distinct().withColumn("refer_name", F.concat(F.lit("refer "), "id")),
        ["id", "refer_name"], EVENTS_AS_OF),
    "province_dim": lambda w: w.place,
    "sku_snowflake_dim": lambda w: dims.sku(
        w.sku_info, w.spu_info, w.category3, w.category2, w.category1, w.trademark, w.sku_attr_value, w.sku_sale_attr_value),
    "masked_user_dim": lambda w: dims.masked_user(w.user_info),
    "date_dim": lambda w: dims.dates(w.order_info.select(F.col("dt").alias("date_id")).distinct()),
    # facts
    "favor_add_fact": lambda w: facts.favor_add(w.favor_info),
    "coupon_used_fact": lambda w: facts.coupon_used(w.coupon_use),
    "cart_add_fact": lambda w: facts.cart_add(w.cart_info),
    "cart_snapshot_fact": lambda w: facts.cart_snapshot(w.cart_info),
    "order_detail_fact": lambda w: facts.order_detail(w.order_detail, w.order_info, w.order_detail_activity, w.order_detail_coupon),
    "order_detail_fact_daily": lambda w: facts.order_detail(
        w.order_detail, w.order_info, w.order_detail_activity, w.order_detail_coupon, ORDERS_AS_OF),
    "pay_detail_fact": lambda w: facts.pay_detail(
        w.order_detail, w.payment_info, w.order_info, w.order_detail_activity, w.order_detail_coupon, w.base_dic),
    "order_flow_first": lambda w: w.flow(ORDERS_AS_OF),
    "order_flow_daily": lambda w: facts.trade_flow_daily(
        w.flow(DAY_BEFORE[ORDERS_AS_OF]), w.order_info, w.payment_info, w.order_status_log, ORDERS_AS_OF),
    "page_view_fact": lambda w: facts.page_view(w.z_log, "Asia/Shanghai"),
    "user_login_fact": lambda w: w.logins,
    "user_register_fact": lambda w: facts.user_register(w.new_users, w.views, "signup"),
    # summaries
    "sku_favor_add_1d": lambda w: w.favor_1d,
    "user_coupon_used_1d": lambda w: w.coupon_1d,
    "province_order_1d": lambda w: w.province_1d,
    "province_order_nd": lambda w: w.province_nd,
    "user_cart_add_1d": lambda w: sums.user_cart_add_1d(facts.cart_add(w.cart_info)),
    "user_order_1d": lambda w: w.order_1d,
    "user_order_td": lambda w: sums.user_order_td(w.order_1d, ORDERS_AS_OF),
    "user_order_td_union": lambda w: sums.user_order_td_carry(w.order_1d, ORDERS_AS_OF, "union"),
    "user_order_td_full_join": lambda w: sums.user_order_td_carry(w.order_1d, ORDERS_AS_OF, "full_join"),
    "user_payment_1d": lambda w: sums.user_payment_1d(w.pay_lines),
    "user_sku_order_1d": lambda w: w.user_sku_1d,
    "user_sku_order_nd": lambda w: w.user_sku_nd,
    "page_visitor_page_view_1d": lambda w: sums.page_visitor_1d(w.views),
    "session_page_view_1d": lambda w: sums.session_1d(w.views),
    "user_login_td": lambda w: sums.user_login_td(w.new_users, w.logins, EVENTS_AS_OF),
    "user_login_td_daily": lambda w: sums.user_login_td_daily(
        sums.user_login_td(w.new_users, w.logins, DAY_BEFORE[EVENTS_AS_OF]), w.logins, EVENTS_AS_OF),
    # reports
    "user_stats": lambda w: reports.user_stats(sums.login_td(w.logins, EVENTS_AS_OF), EVENTS_AS_OF),
    "coupon_stats": lambda w: reports.coupon_stats(w.coupon_1d, EVENTS_AS_OF),
    "new_order_user_stats": lambda w: reports.new_order_user_stats(sums.user_order_td(w.order_1d, ORDERS_AS_OF), ORDERS_AS_OF),
    "order_by_province": lambda w: reports.order_by_province(w.province_1d, w.province_nd, ORDERS_AS_OF),
    "consecutive_3d_lead": lambda w: reports.consecutive_users(w.shopping_days("purchase"), EVENTS_AS_OF, "lead"),
    "consecutive_3d_islands": lambda w: reports.consecutive_users(w.shopping_days("purchase"), EVENTS_AS_OF, "islands"),
    "consecutive_3d_mask": lambda w: reports.consecutive_users(w.shopping_days("purchase"), EVENTS_AS_OF, "mask"),
    "consecutive_3d_near": lambda w: reports.consecutive_users(w.shopping_days("purchase"), EVENTS_AS_OF, "near"),
    "order_stats_by_cate": lambda w: reports.order_stats_by(w.user_sku_1d, reports.CATEGORY, ORDERS_AS_OF),
    "order_stats_by_tm": lambda w: reports.order_stats_by(w.user_sku_1d, ["tm_id", "tm_name"], ORDERS_AS_OF),
    "order_to_pay_interval_avg": lambda w: reports.order_to_pay_interval_avg(w.flow(ORDERS_AS_OF), ORDERS_AS_OF),
    "page_path_edges": lambda w: reports.page_path(w.recent_views(EVENTS_AS_OF, 30), EVENTS_AS_OF, days=30),
    "repeat_purchase_by_tm": lambda w: reports.repeat_purchase_by_tm(w.user_sku_nd, ORDERS_AS_OF),
    "sku_cart_num_top3_by_cate": lambda w: reports.sku_cart_num_top3_by_cate(facts.cart_snapshot(w.cart_info), w.sku, EVENTS_AS_OF, days=30),
    "sku_favor_count_top3_by_tm": lambda w: reports.sku_favor_count_top3_by_tm(w.favor_1d, EVENTS_AS_OF),
    "traffic_by_channel": lambda w: reports.traffic_by_channel(sums.session_1d(w.recent_views(EVENTS_AS_OF, 30)), EVENTS_AS_OF),
    "user_action_funnel": lambda w: reports.user_action(
        sums.page_visitor_1d(w.views), w.shopping_days("view"), w.shopping_days("purchase"),
        w.events.where("event_type = 'purchase' and value >= 20").groupBy("user_id", "dt").count(), EVENTS_AS_OF, "view", "click"),
    "user_change": lambda w: reports.user_change(
        sums.login_td(w.logins, EVENTS_AS_OF), sums.login_td(w.logins, DAY_BEFORE[EVENTS_AS_OF]), EVENTS_AS_OF),
    "user_retention": lambda w: reports.user_retention(sums.login_td(w.logins, "2024-01-05"), "2024-01-05"),
}

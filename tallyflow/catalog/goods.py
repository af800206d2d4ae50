"""Goods-linkage, new-product and service-offer plans over the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from tallyflow.plans import goods_linkage as link
from tallyflow.plans import new_products as new
from tallyflow.plans import service_offers as offer
from tallyflow.sources.goods_standins import Goods, NewGoods
from tallyflow.sources.offer_standins import Offers
from tallyflow.sources.standins import EVENTS_AS_OF, ORDERS_AS_OF


class GoodsWarehouse(Goods):
    @cached_property
    def behavior(self) -> DataFrame:
        return link.user_behavior(self.behavior_log, EVENTS_AS_OF)

    @cached_property
    def sales(self) -> DataFrame:
        return link.goods_sales(self.trade_lines, self.trade, self.goods_attr, EVENTS_AS_OF)

    @cached_property
    def shops(self) -> DataFrame:
        return link.shop_sales(self.trade_lines, self.trade, self.shop_base, EVENTS_AS_OF)

    @cached_property
    def purchases(self) -> DataFrame:
        return link.user_purchases(self.trade_lines, self.trade, self.goods_attr, EVENTS_AS_OF)

    @cached_property
    def reactions(self) -> DataFrame:
        return link.goods_behavior(self.behavior_log, self.trade_lines, self.trade, self.goods_attr, EVENTS_AS_OF)

    @cached_property
    def on_sale(self) -> DataFrame:
        return self.goods_attr.where("goods_status = 1")


BEHAVIOR = {"view_count": "view_count", "favor_count": "favor_count", "cart_count": "cart_count", "avg_stay_duration": "avg_stay_duration"}

GOODS_QUERIES = {
    "goods_history": lambda w: link.goods_history(w.goods_attr, EVENTS_AS_OF),
    "shop_history": lambda w: link.shop_history(w.shop_base, EVENTS_AS_OF),
    "shop_user_history": lambda w: link.user_history(w.user_base, EVENTS_AS_OF),
    "pay_channel_dim": lambda w: link.pay_channels(w.trade, EVENTS_AS_OF),
    "behavior_type_dim": lambda w: link.behavior_types(w.behavior_log, EVENTS_AS_OF),
    "device_dim": lambda w: link.devices(w.behavior_log, EVENTS_AS_OF),
    "behavior_detail_fact": lambda w: link.behavior_detail(w.behavior_log),
    "order_goods_fact": lambda w: link.order_goods(w.trade_lines, w.trade),
    "goods_core_fact": lambda w: link.goods_core(w.goods_attr),
    "shop_core_fact": lambda w: link.shop_core(w.shop_base),
    "user_core_fact": lambda w: link.user_core(w.user_base),
    "user_behavior_horizons": lambda w: w.behavior,
    "goods_sales_horizons": lambda w: w.sales,
    "shop_sales_horizons": lambda w: w.shops,
    "user_purchase_horizons": lambda w: w.purchases,
    "goods_behavior_horizons": lambda w: w.reactions,
    "user_behavior_summary": lambda w: link.beside(
        w.user_base.select("user_id", "user_name", "user_level"), w.behavior, "user_id", {**BEHAVIOR, "distinct_goods_count": "distinct_goods"}),
    "goods_sales_summary": lambda w: link.beside(
        w.on_sale.select("goods_id", *link.GOODS), w.sales, "goods_id",
        {"total_sales": "sales", "total_revenue": "revenue", "avg_price": "avg_price", "distinct_buyers": "buyers"}),
    "shop_sales_summary": lambda w: link.beside(
        w.shop_base.select("shop_id", *link.SHOP), w.shops, "shop_id",
        {"total_orders": "orders", "total_sales": "sales", "total_revenue": "revenue", "avg_order_value": "avg_order_value", "distinct_buyers": "buyers"}),
    "user_purchase_summary": lambda w: link.beside(
        w.user_base.select("user_id", "user_name", "user_level"), w.purchases, "user_id",
        {"total_orders": "orders", "total_spent": "spent", "avg_order_value": "avg_order_value"}),
    "goods_behavior_summary": lambda w: link.beside(
        w.on_sale.select("goods_id", *link.GOODS[:3]), w.reactions, "goods_id",
        {**BEHAVIOR, "purchase_count": "purchase_count", "conversion_rate": "conversion_rate"}),
    "user_value_tier": lambda w: link.user_value_tier(w.behavior, w.purchases, w.behavior_log, w.user_base, EVENTS_AS_OF),
    "goods_hot_score": lambda w: link.goods_hot_rank(
        w.reactions, w.sales, link.goods_growth(w.trade_lines, w.trade, EVENTS_AS_OF), w.goods_attr, behavior_days=30),
    "goods_view_percentile": lambda w: link.goods_view_percentile(w.reactions),
    "shop_competitiveness": lambda w: link.shop_competitiveness(w.trade_lines, w.trade, w.shop_base, w.goods_attr, EVENTS_AS_OF),
    "category_conversion": lambda w: link.category_conversion(w.reactions),
    "goods_sales_forecast": lambda w: link.sales_forecast(w.sales),
}


class NewGoodsWarehouse(NewGoods):
    @cached_property
    def arrivals(self) -> DataFrame:
        return new.new_arrivals(self.sku_base, self.new_tag, ORDERS_AS_OF)

    @cached_property
    def payments(self) -> DataFrame:
        return new.new_payments(self.sku_payment, self.arrivals)


NEW_QUERIES = {
    "new_sku_history": lambda w: new.sku_history(w.sku_base, ORDERS_AS_OF),
    "new_tag_history": lambda w: new.tag_history(w.new_tag, ORDERS_AS_OF),
    "new_payment_history": lambda w: new.payment_history(w.sku_payment, ORDERS_AS_OF),
    "new_yearly_history": lambda w: new.yearly_history(w.yearly_record, 2001, ORDERS_AS_OF),
    "new_store_history": lambda w: new.store_history(w.store_base, ORDERS_AS_OF),
    "new_arrival_fact": lambda w: w.arrivals,
    "new_payment_fact": lambda w: w.payments,
    "new_yearly_fact": lambda w: new.yearly(w.yearly_record, w.new_tag, w.sku_base, w.payments, ORDERS_AS_OF),
    "new_store_summary": lambda w: new.store_summary(w.store_base, w.arrivals, w.payments),
    "new_category_analysis": lambda w: new.category_analysis(w.arrivals, w.payments),
    "new_channel_analysis": lambda w: new.channel_analysis(w.payments),
}


class OfferWarehouse(Offers):
    @cached_property
    def sent(self) -> DataFrame:
        return offer.offers(self.send, self.redemption)

    def nd(self, *keys: str) -> DataFrame:
        return offer.offer_horizons(self.sent, keys, EVENTS_AS_OF)


OFFER_QUERIES = {
    "offer_staff_history": lambda w: offer.staff_history(w.staff_snapshots),
    "offer_activity_dim": lambda w: offer.activities(w.activity, offer.DIM_TYPES, EVENTS_AS_OF),
    "offer_activity_fact": lambda w: offer.activities(w.activity, offer.FACT_TYPES, EVENTS_AS_OF),
    "offer_product_dim": lambda w: w.offer_product.where("status = 1").drop("status"),
    "offer_sku_dim": lambda w: w.offer_sku,
    "offer_product_fact": lambda w: offer.offer_products(w.offer_product, w.offer_sku),
    "offer_send_dim": lambda w: offer.send_records(w.send, w.activity, offer.DIM_TYPES, False),
    "offer_send_fact": lambda w: offer.send_records(w.send, w.activity, offer.FACT_TYPES, True),
    "offer_redemption_fact": lambda w: offer.redemption_records(w.redemption),
    "offer_agent_day": lambda w: offer.agent_day(w.service_staff, w.sent, EVENTS_AS_OF),
    "offer_customer_day": lambda w: offer.customer_day(w.sent, EVENTS_AS_OF),
    "offer_activity_horizons": lambda w: w.nd("activity_id"),
    "offer_activity_analysis": lambda w: offer.activity_analysis(w.nd("activity_id")),
    "offer_agent_score": lambda w: offer.agent_score(w.nd("cs_id")),
    "offer_customer_value": lambda w: offer.customer_value(w.nd("customer_id")),
    "offer_effectiveness": lambda w: offer.offer_effectiveness(w.nd("sku_id")),
}

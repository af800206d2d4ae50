"""Goods-linkage, new-product and service-offer statements."""

from oracles.base import EVENTS_AS_OF as E
from oracles.base import ORDERS_AS_OF as O
from oracles.base import RETAIL
from oracles.base import sql as base_sql

D, DO = f"date '{E}'", f"date '{O}'"

GOODS = RETAIL.strip() + f""",
blog AS (
  SELECT event_id log_id, user_id, user_id || '_' || strftime(ts, '%Y%m%d') session_id, cast(k AS bigint) goods_id,
    CASE event_type WHEN 'click' THEN 'favor' WHEN 'signup' THEN 'cart' ELSE event_type END behavior_type, ts behavior_time,
    CASE k % 3 WHEN 0 THEN 'iOS-' WHEN 1 THEN 'Android-' ELSE 'TV-' END || (user_id % 40) device_id, 'v' || (k % 4) app_version,
    CASE WHEN k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN 'null' ELSE cast(k + 1 AS varchar) END refer_goods_id,
    cast(floor(v * 20) AS int) - 100 stay_duration, dt
  FROM ev WHERE event_type <> 'purchase'),
trade AS (
  SELECT event_id order_id, user_id, cast(k % 10 AS bigint) shop_id, ts pay_time, cast(v * 10 AS decimal(16,2)) payment_amount,
    ['alipay','wechat','bank','balance','cash'][k % 5 + 1] pay_channel, CASE WHEN k % 8 = 0 THEN 0 ELSE 1 END pay_status, dt
  FROM ev WHERE event_type = 'purchase'),
tline AS (
  SELECT event_id || '-' || n detail_id, event_id order_id, cast(CASE WHEN n = 1 THEN k ELSE (k * 7 + 3) % 100 END AS bigint) goods_id,
    CASE WHEN event_id % 97 = 0 THEN 150 ELSE event_id % 5 + n END goods_quantity, CASE WHEN event_id % 13 = 0 THEN -v ELSE v END unit_price,
    v * CASE WHEN event_id % 97 = 0 THEN 150 ELSE event_id % 5 + n END total_price,
    CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'promo ' || k END promotion_info, dt
  FROM ev, (SELECT unnest([1, 2]) n) WHERE event_type = 'purchase'),
gattr AS (
  SELECT p_partkey goods_id, p_partkey % 10 shop_id, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE ' ' || p_name || chr(9) END goods_name, p_type category_l1,
    p_brand category_l2, CASE WHEN p_size > 5 THEN cast(p_size AS varchar) ELSE '' END category_l3, p_partkey % 2 is_traffic_item,
    CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 2 END is_top_seller, cast(p_retailprice AS decimal(10,2)) base_price,
    CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END goods_status,
    CASE WHEN p_partkey % 9 <> 0 THEN date '2023-01-01' + cast(p_partkey % 300 AS int) END create_date
  FROM part),
shop AS (
  SELECT s_suppkey shop_id, CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE s_name END shop_name, s_suppkey % 8 shop_level,
    CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'kind ' || (s_suppkey % 3) END shop_type, CASE WHEN s_suppkey % 4 <> 0 THEN 'main ' || (s_suppkey % 4) END main_category
  FROM supplier),
ubase AS (
  SELECT c_custkey user_id, CASE WHEN c_custkey % 8 = 0 THEN '' ELSE c_name END user_name, ['MyAPP','h5-Web','','mini'][c_custkey % 4 + 1] reg_channel,
    c_custkey % 12 user_level FROM customer),
recent AS (SELECT unnest([1, 7, 30]) recent_days),
log_nd AS (SELECT * FROM blog, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D}),
paid AS (SELECT * FROM trade WHERE pay_status = 1),
paid_nd AS (SELECT * FROM paid, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D}),
behavior AS (
  SELECT recent_days, user_id, count(*) FILTER (behavior_type = 'view') view_count, count(*) FILTER (behavior_type = 'favor') favor_count,
    count(*) FILTER (behavior_type = 'cart') cart_count, cast(sum(stay_duration) AS double) / count(*) avg_stay_duration,
    count(DISTINCT goods_id) distinct_goods_count, count(DISTINCT session_id) distinct_session_count FROM log_nd GROUP BY ALL),
sales AS (
  SELECT recent_days, l.goods_id, goods_name, category_l1, category_l2, category_l3, sum(goods_quantity) total_sales, sum(total_price) total_revenue,
    cast(sum(unit_price) AS double) / count(*) avg_price, count(DISTINCT user_id) distinct_buyers
  FROM tline l JOIN paid_nd p ON l.order_id = p.order_id JOIN gattr g ON g.goods_id = l.goods_id AND goods_status = 1 GROUP BY ALL),
per_order AS (SELECT order_id, sum(goods_quantity) q, sum(total_price) r FROM tline GROUP BY order_id),
shop_nd AS (
  SELECT recent_days, s.*, count(*) total_orders, sum(q) total_sales, sum(r) total_revenue, cast(sum(payment_amount) AS double) / count(*) avg_order_value,
    count(DISTINCT user_id) distinct_buyers FROM paid_nd p JOIN per_order o ON o.order_id = p.order_id JOIN shop s ON s.shop_id = p.shop_id GROUP BY ALL),
favourite AS (
  SELECT recent_days, user_id, category_l1 favorite_category FROM (
    SELECT recent_days, user_id, category_l1, row_number() OVER (PARTITION BY recent_days, user_id ORDER BY count(*) DESC, category_l1 DESC) rn
    FROM paid_nd p JOIN tline l ON l.order_id = p.order_id JOIN gattr g ON g.goods_id = l.goods_id GROUP BY recent_days, user_id, category_l1) WHERE rn = 1),
purchases AS (
  SELECT p.*, favorite_category FROM (
    SELECT recent_days, user_id, count(*) total_orders, sum(payment_amount) total_spent, cast(sum(payment_amount) AS double) / count(*) avg_order_value,
      max(cast(pay_time AS date)) last_purchase_date FROM paid_nd GROUP BY ALL) p LEFT JOIN favourite USING (recent_days, user_id)),
reactions AS (
  SELECT recent_days, g.goods_id, goods_name, category_l1, category_l2, coalesce(view_count, 0) view_count, coalesce(favor_count, 0) favor_count,
    coalesce(cart_count, 0) cart_count, coalesce(purchase_count, 0) purchase_count,
    CASE WHEN view_count > 0 THEN cast(coalesce(purchase_count, 0) AS double) / view_count END conversion_rate, cast(stay AS double) / n avg_stay_duration
  FROM gattr g CROSS JOIN recent
  LEFT JOIN (SELECT recent_days, goods_id, count(*) FILTER (behavior_type = 'view') view_count, count(*) FILTER (behavior_type = 'favor') favor_count,
      count(*) FILTER (behavior_type = 'cart') cart_count, sum(stay_duration) stay, count(*) n FROM log_nd GROUP BY ALL) b USING (recent_days, goods_id)
  LEFT JOIN (SELECT recent_days, goods_id, count(DISTINCT l.order_id) purchase_count FROM tline l JOIN paid_nd p ON l.order_id = p.order_id GROUP BY ALL) s
    USING (recent_days, goods_id))
"""


def sql(body: str, **kw) -> str:
    return base_sql(body, prelude=GOODS, **kw)


def beside(base: str, table: str, key: str, measures: dict[str, str], money: str = "", ints: str = "") -> str:
    cols = [f"coalesce(a{d}.{m}, 0) last_{d}d_{o}" for d in (7, 30) for m, o in measures.items()]
    joins = " ".join(f"LEFT JOIN (SELECT * FROM {table} WHERE recent_days = {d}) a{d} ON a{d}.{key} = b.{key}" for d in (7, 30))
    both = lambda names: " ".join(f"last_{d}d_{n}" for d in (7, 30) for n in names.split())
    return sql(f"SELECT b.*, {', '.join(cols)} FROM ({base}) b {joins}", money=both(money), ints=both(ints))


B = {"view_count": "view_count", "favor_count": "favor_count", "cart_count": "cart_count", "avg_stay_duration": "avg_stay_duration"}

SQL = {
    "goods_history": sql(
        f"""SELECT goods_id, shop_id, CASE WHEN goods_name = '' THEN '商品_' || goods_id ELSE goods_name END goods_name, category_l1, category_l2,
            CASE WHEN category_l3 = '' THEN '未分类' ELSE category_l3 END category_l3, is_traffic_item, coalesce(is_top_seller, 0) is_top_seller, base_price,
            goods_status, coalesce(create_date, date '2025-07-01') create_date, {D} start_date, date '9999-12-31' end_date FROM gattr""",
        days="create_date start_date end_date", money="base_price", ints="goods_status"),
    "shop_history": sql(
        f"""SELECT shop_id, CASE WHEN shop_name = '' THEN '店铺_' || shop_id ELSE shop_name END shop_name,
            CASE WHEN shop_level BETWEEN 1 AND 5 THEN shop_level ELSE 3 END shop_level, CASE WHEN shop_type = '' THEN '普通店' ELSE shop_type END shop_type,
            coalesce(main_category, '综合') main_category, {D} start_date, date '9999-12-31' end_date FROM shop""", days="start_date end_date"),
    "shop_user_history": sql(
        f"""SELECT user_id, CASE WHEN user_name = '' THEN '用户_' || user_id ELSE user_name END user_name, CASE WHEN reg_channel = '' THEN 'web' ELSE reg_channel END reg_channel,
            CASE WHEN user_level BETWEEN 1 AND 10 THEN user_level ELSE 1 END user_level, {D} start_date, date '9999-12-31' end_date FROM ubase""",
        days="start_date end_date"),
    "pay_channel_dim": sql(
        f"""SELECT DISTINCT pay_channel channel_code, CASE pay_channel WHEN 'alipay' THEN '支付宝' WHEN 'wechat' THEN '微信支付' WHEN 'bank' THEN '银行卡支付'
            WHEN 'balance' THEN '余额支付' ELSE '其他支付' END channel_name, CASE WHEN pay_channel IN ('alipay', 'wechat') THEN '第三方支付' WHEN pay_channel = 'bank' THEN '银行支付'
            WHEN pay_channel = 'balance' THEN '账户支付' ELSE '其他' END channel_type, {D} start_date, date '9999-12-31' end_date FROM trade""", days="start_date end_date"),
    "behavior_type_dim": sql(
        f"""SELECT DISTINCT behavior_type behavior_code, CASE behavior_type WHEN 'view' THEN '访问' WHEN 'favor' THEN '收藏' WHEN 'cart' THEN '加购' ELSE '其他行为' END behavior_name,
            CASE behavior_type WHEN 'view' THEN '浏览行为' WHEN 'favor' THEN '互动行为' WHEN 'cart' THEN '互动行为' ELSE '其他' END behavior_group,
            {D} start_date, date '9999-12-31' end_date FROM blog""", days="start_date end_date"),
    "device_dim": sql(
        f"""SELECT DISTINCT device_id, app_version, CASE WHEN device_id LIKE 'iOS%' THEN 'iOS' WHEN device_id LIKE 'Android%' THEN 'Android' ELSE '其他设备' END device_type,
            {D} start_date, date '9999-12-31' end_date FROM blog""", days="start_date end_date"),
    "behavior_detail_fact": sql(
        """SELECT user_id, session_id, goods_id, CASE WHEN refer_goods_id NOT IN ('', 'null') THEN refer_goods_id END refer_goods_id,
           CASE WHEN behavior_type = 'error' THEN 'invalid' ELSE behavior_type END behavior_type, behavior_time,
           greatest(0, least(3600, stay_duration)) stay_duration, dt FROM blog""", days="dt", seconds="behavior_time", ints="stay_duration"),
    "order_goods_fact": sql(
        """SELECT detail_id, l.order_id, user_id, shop_id, goods_id, CASE WHEN goods_quantity > 100 THEN 1 ELSE goods_quantity END goods_quantity, abs(unit_price) unit_price,
           pay_time, CASE WHEN coalesce(promotion_info, '') = '' THEN '无促销' ELSE promotion_info END promotion_info, l.dt FROM tline l JOIN trade t ON l.order_id = t.order_id""",
        days="dt", seconds="pay_time", money="unit_price"),
    "goods_core_fact": sql(
        """SELECT goods_id, shop_id, trim(replace(goods_name, chr(9), '')) || '' goods_name, category_l1, category_l2, nullif(category_l3, '') category_l3, is_traffic_item,
           CASE WHEN is_top_seller = 1 THEN 1 ELSE 0 END is_top_seller, base_price FROM gattr""", money="base_price", ints="is_top_seller"),
    "shop_core_fact": sql(
        "SELECT shop_id, shop_name, CASE WHEN shop_type = '' THEN '其他' ELSE shop_type END shop_type, coalesce(main_category, '综合') main_category FROM shop"),
    "user_core_fact": sql(
        """SELECT user_id, CASE WHEN user_level BETWEEN 1 AND 5 THEN user_level ELSE 3 END user_level,
           CASE WHEN reg_channel = 'MyAPP' THEN 'app' WHEN reg_channel = 'h5-Web' THEN 'web' ELSE 'other' END reg_channel FROM ubase"""),
    "user_behavior_horizons": sql("SELECT * FROM behavior", ints="recent_days"),
    "goods_sales_horizons": sql("SELECT * FROM sales", ints="recent_days total_sales", money="total_revenue"),
    "shop_sales_horizons": sql("SELECT * FROM shop_nd", ints="recent_days total_sales", money="total_revenue"),
    "user_purchase_horizons": sql("SELECT * FROM purchases", ints="recent_days", money="total_spent", days="last_purchase_date"),
    "goods_behavior_horizons": sql("SELECT * FROM reactions", ints="recent_days"),
    "user_behavior_summary": beside("SELECT user_id, user_name, user_level FROM ubase", "behavior", "user_id", {**B, "distinct_goods_count": "distinct_goods"}),
    "goods_sales_summary": beside(
        "SELECT goods_id, goods_name, category_l1, category_l2, category_l3 FROM gattr WHERE goods_status = 1", "sales", "goods_id",
        {"total_sales": "sales", "total_revenue": "revenue", "avg_price": "avg_price", "distinct_buyers": "buyers"}, "revenue", "sales"),
    "shop_sales_summary": beside("SELECT * FROM shop", "shop_nd", "shop_id",
        {"total_orders": "orders", "total_sales": "sales", "total_revenue": "revenue", "avg_order_value": "avg_order_value", "distinct_buyers": "buyers"}, "revenue", "sales"),
    "user_purchase_summary": beside("SELECT user_id, user_name, user_level FROM ubase", "purchases", "user_id",
        {"total_orders": "orders", "total_spent": "spent", "avg_order_value": "avg_order_value"}, "spent"),
    "goods_behavior_summary": beside(
        "SELECT goods_id, goods_name, category_l1, category_l2 FROM gattr WHERE goods_status = 1", "reactions", "goods_id",
        {**B, "purchase_count": "purchase_count", "conversion_rate": "conversion_rate"}),
    "user_value_tier": sql(
        f"""SELECT b.user_id, b.view_count, c.total_spent spent_30d, p.total_orders orders_7d, user_name, user_level, login_days_7d, last_active_date,
            CASE WHEN view_count > 100 THEN '高活跃' WHEN view_count > 30 THEN '中活跃' ELSE '低活跃' END active_tier,
            CASE WHEN c.total_spent > 5000 THEN '高价值' WHEN c.total_spent > 1000 THEN '中价值' ELSE '低价值' END purchase_tier
            FROM behavior b JOIN purchases c ON b.user_id = c.user_id AND c.recent_days = 30 JOIN purchases p ON b.user_id = p.user_id AND p.recent_days = 7
            JOIN ubase u ON u.user_id = b.user_id
            LEFT JOIN (SELECT user_id, count(DISTINCT dt) login_days_7d, max(dt) FILTER (dt = {D}) last_active_date FROM blog WHERE dt BETWEEN {D} - 6 AND {D} GROUP BY user_id) a
              ON a.user_id = b.user_id WHERE b.recent_days = 7""", money="spent_30d", days="last_active_date"),
    "goods_hot_score": sql(
        f"""WITH growth AS (SELECT goods_id, sum(goods_quantity) FILTER (l.dt > {D} - 7) n, sum(goods_quantity) FILTER (l.dt <= {D} - 7) b
              FROM tline l JOIN paid p ON l.order_id = p.order_id WHERE l.dt BETWEEN {D} - 13 AND {D} GROUP BY goods_id)
---
SELECT s.goods_id, s.goods_name, s.category_l1, view_count, conversion_rate, total_sales, total_revenue, rank() OVER (ORDER BY view_count DESC) view_rank,
 rank() OVER (ORDER BY total_sales DESC) purchase_rank,
 round((0.3::double * (1 - percent_rank() OVER (ORDER BY view_count DESC)) + 0.5::double * (1 - percent_rank() OVER (ORDER BY total_sales DESC))
   + 0.2::double * coalesce(cast(n - b AS double) / nullif(cast(b AS double), 0), 0)) * 100, 2) hot_score
FROM sales s JOIN reactions r ON r.goods_id = s.goods_id AND r.recent_days = 30 LEFT JOIN growth g ON g.goods_id = s.goods_id WHERE s.recent_days = 7""",
        ints="total_sales", money="total_revenue"),
    "goods_view_percentile": sql(
        "SELECT goods_id, view_count, percent_rank() OVER (ORDER BY view_count DESC) view_percent_rank FROM reactions WHERE recent_days = 30"),
    "shop_competitiveness": sql(
        f"""WITH day_sales AS (SELECT shop_id, p.dt, sum(q) q FROM paid p JOIN per_order o ON o.order_id = p.order_id WHERE p.dt BETWEEN {D} - 7 AND {D} GROUP BY shop_id, p.dt),
            lagged AS (SELECT * FROM (SELECT shop_id, dt, q, lag(q, 7) OVER (PARTITION BY shop_id ORDER BY dt) prev FROM day_sales) WHERE dt = {D}),
            repeat_buyers AS (SELECT shop_id, cast(count(*) FILTER (n > 1) AS double) / count(*) r FROM
              (SELECT shop_id, user_id, count(*) n FROM trade WHERE dt BETWEEN {D} - 6 AND {D} GROUP BY ALL) GROUP BY shop_id),
            best AS (SELECT *, row_number() OVER (PARTITION BY shop_id ORDER BY q DESC, goods_name) rn FROM
              (SELECT p.shop_id, goods_name, sum(goods_quantity) q FROM tline l JOIN paid p ON l.order_id = p.order_id LEFT JOIN gattr g ON g.goods_id = l.goods_id
               WHERE p.dt = {D} GROUP BY p.shop_id, goods_name)),
            top3 AS (SELECT shop_id, string_agg(goods_name, ',' ORDER BY rn) top_3_goods FROM best WHERE rn <= 3 GROUP BY shop_id)
---
SELECT l.shop_id, shop_name, round(0.4::double * CASE WHEN coalesce(prev, 0) = 0 THEN 1 ELSE cast(q AS double) / prev END + 0.6::double * coalesce(r, 0), 2) comp_index,
 CASE WHEN coalesce(prev, 0) = 0 THEN 0 ELSE cast(q - prev AS double) / prev END sales_growth_rate, coalesce(r, 0) repurchase_rate, avg_order_value, distinct_buyers, top_3_goods
FROM lagged l JOIN shop_nd s ON s.shop_id = l.shop_id AND recent_days = 7 LEFT JOIN repeat_buyers b ON b.shop_id = l.shop_id LEFT JOIN top3 t ON t.shop_id = l.shop_id"""),
    "category_conversion": sql(
        """SELECT category_l1, category_l2, sum(view_count) view_count, sum(cart_count) / nullif(cast(sum(view_count) AS double), 0) cart_add_rate,
           sum(favor_count) / nullif(cast(sum(view_count) AS double), 0) favor_rate, sum(purchase_count) / nullif(cast(sum(view_count) AS double), 0) purchase_rate,
           1 - sum(purchase_count) / nullif(cast(sum(view_count) AS double), 0) lost_rate FROM reactions WHERE recent_days = 1 GROUP BY ALL""", ints="view_count"),
    "goods_sales_forecast": sql(
        "SELECT goods_id, goods_name, category_l1, category_l2, category_l3, round(total_sales * 1.2) sales_forecast FROM sales WHERE recent_days = 7", ints="sales_forecast"),
}

NEW = f"""
sku AS (
  SELECT p_partkey sku_id, CASE WHEN p_partkey % 5 <> 0 THEN p_name ELSE '未知' END sku_title, p_type category_id,
    CASE WHEN p_partkey % 7 <> 0 THEN lower(p_type) ELSE '其他' END category_name, p_brand brand_id, CASE WHEN p_partkey % 6 <> 0 THEN upper(p_brand) ELSE '其他' END brand_name,
    cast(p_retailprice AS decimal(10,2)) sale_price, p_partkey % 20 store_id, date '2001-01-01' + cast(p_partkey % 200 AS int) listed,
    CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE 1 END is_online FROM part WHERE p_partkey % 13 <> 0),
tag AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id, l_partkey sku_id,
    CASE WHEN l_linenumber % 3 <> 0 THEN 'type ' || l_linestatus ELSE '普通新品' END new_type, CASE WHEN l_linenumber % 4 <> 0 THEN l_linenumber % 2 ELSE 0 END is_tmall_new,
    cast(l_shipdate AS date) started, cast(l_shipdate AS date) + 700 ended, CASE l_returnflag WHEN 'A' THEN '通过' ELSE '待审' END audit, l_linenumber, l_linestatus
  FROM lineitem),
good_tag AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY started DESC, id DESC) rn FROM tag
    WHERE audit = '通过' AND ended >= {DO} AND is_tmall_new = 1) WHERE rn = 1),
pay AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey payment_id, l_orderkey order_id, l_partkey sku_id, o_custkey user_id,
    cast(l_extendedprice AS decimal(16,2)) payment_amount, cast(l_quantity AS bigint) payment_quantity, cast(o_orderdate AS date) payment_time,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '未知' END channel, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END refund_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O'),
arrival AS (
  SELECT s.sku_id, sku_title, category_id, category_name, brand_id, brand_name, store_id, sale_price, started putaway_time, new_type, is_tmall_new,
    started new_tag_start_time, ended new_tag_end_time FROM sku s JOIN good_tag t ON s.sku_id = t.sku_id WHERE is_online = 1),
new_pay AS (
  SELECT payment_id, order_id, p.sku_id, user_id, payment_amount, payment_quantity, payment_time, putaway_time, payment_time - putaway_time days_after_putaway, store_id, channel
  FROM pay p JOIN arrival a ON a.sku_id = p.sku_id WHERE refund_status = 0 AND payment_time - putaway_time BETWEEN 0 AND 30),
per_sku AS (SELECT sku_id, sum(payment_amount) total, min(payment_time) first FROM new_pay GROUP BY sku_id),
yearly AS (
  SELECT p_partkey sku_id, date '2000-10-01' + cast(p_partkey % 300 AS int) putaway_date, cast(p_retailprice AS decimal(10,2)) initial_sale_price, p_retailprice raw_price,
    p_type category_id, p_brand brand_id FROM part)
"""


def new(body: str, **kw) -> str:
    return base_sql(body, prelude=NEW, **kw)


RANGE = f"{DO} start_date, date '9999-12-31' end_date"

SQL |= {
    "new_sku_history": new(
        f"""SELECT sku_id, sku_title, category_id, category_name, brand_id, brand_name, sale_price, store_id, listed putaway_time, is_online, {RANGE} FROM sku""",
        days="putaway_time start_date end_date", money="sale_price", ints="is_online"),
    "new_tag_history": new(
        f"""SELECT id, sku_id, new_type, is_tmall_new, started new_tag_start_time, ended new_tag_end_time, audit new_tag_audit_status, {RANGE}
            FROM tag WHERE ended >= {DO}""",
        days="new_tag_start_time new_tag_end_time start_date end_date", ints="is_tmall_new"),
    "new_payment_history": new(
        f"SELECT payment_id, sku_id, user_id, payment_amount, payment_quantity, payment_time, channel, refund_status, {RANGE} FROM pay",
        days="payment_time start_date end_date", money="payment_amount", ints="refund_status"),
    "new_yearly_history": new(
        f"""SELECT sku_id, putaway_date, year(putaway_date) putaway_year, month(putaway_date) putaway_month, initial_sale_price, category_id, brand_id, {RANGE}
            FROM yearly WHERE year(putaway_date) = 2001""", days="putaway_date start_date end_date", money="initial_sale_price"),
    "new_store_history": new(
        f"""SELECT s_suppkey store_id, CASE WHEN s_suppkey % 6 <> 0 THEN s_name ELSE '未知店铺' END store_name,
            CASE WHEN s_suppkey % 3 <> 0 THEN 'kind ' || (s_suppkey % 3) ELSE '未知类型' END store_type, CASE WHEN s_suppkey % 4 <> 0 THEN 'site ' || (s_suppkey % 4) ELSE '未知平台' END platform,
            '未分类' category_main, '2000-01-01' open_date, s_suppkey % 5 AS level, {RANGE} FROM supplier WHERE s_suppkey % 10 <> 9""", days="start_date end_date"),
    "new_arrival_fact": new("SELECT * FROM arrival", days="putaway_time new_tag_start_time new_tag_end_time", money="sale_price", ints="is_tmall_new"),
    "new_payment_fact": new("SELECT * FROM new_pay", days="payment_time putaway_time", money="payment_amount"),
    "new_yearly_fact": new(
        """SELECT y.sku_id, putaway_date, year(putaway_date) putaway_year, month(putaway_date) putaway_month, quarter(putaway_date) putaway_quarter,
           coalesce(new_type, '普通新品') new_type, raw_price initial_sale_price, category_id, brand_id, y.sku_id % 20 store_id,
           coalesce(total, 0) total_payment_amount, first first_payment_date FROM yearly y LEFT JOIN good_tag t ON t.sku_id = y.sku_id LEFT JOIN per_sku p ON p.sku_id = y.sku_id""",
        days="putaway_date first_payment_date", money="total_payment_amount"),
    "new_store_summary": new(
        """SELECT s_suppkey store_id, CASE WHEN s_suppkey % 6 <> 0 THEN s_name ELSE '' END store_name, CASE WHEN s_suppkey % 3 <> 0 THEN 'kind ' || (s_suppkey % 3) ELSE '' END store_type,
           CASE WHEN s_suppkey % 4 <> 0 THEN 'site ' || (s_suppkey % 4) ELSE '未知' END platform, '未分类' category_main, count(*) new_sku_count,
           max(putaway_time) latest_putaway_time, sum(total) total_payment_amount, round(cast(sum(first - putaway_time) AS double) / count(*), 2) avg_days_to_first_payment
           FROM supplier JOIN arrival a ON a.store_id = s_suppkey JOIN per_sku p ON p.sku_id = a.sku_id GROUP BY ALL""",
        days="latest_putaway_time", money="total_payment_amount"),
    "new_category_analysis": new(
        """WITH brand AS (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY n DESC, brand_id DESC, brand_name DESC) rn FROM
             (SELECT category_id, brand_id, brand_name, count(*) n FROM arrival GROUP BY ALL))
---
SELECT a.category_id, a.category_name, count(*) new_sku_count, sum(coalesce(total, 0)) total_payment_amount, round(cast(sum(sale_price) AS double) / count(*), 2) avg_sale_price,
 b.brand_id top_brand_id, b.brand_name top_brand_name
FROM arrival a LEFT JOIN per_sku p ON p.sku_id = a.sku_id LEFT JOIN brand b ON b.category_id = a.category_id AND rn = 1 GROUP BY ALL""", money="total_payment_amount"),
    "new_channel_analysis": new(
        """SELECT channel, count(DISTINCT sku_id) new_sku_count, sum(payment_amount) total_payment_amount,
           round(cast(sum(payment_amount) AS double) / count(DISTINCT payment_id), 2) avg_payment_amount, count(DISTINCT user_id) payment_user_count FROM new_pay GROUP BY channel""",
        money="total_payment_amount"),
}

OFFER = RETAIL.strip() + f""",
act AS (
  SELECT id activity_id, 'offer ' || id activity_name, id % 3 lv, id % 4 ot, date '2024-01-26' + id end_date, id * 10 max_custom_amount, id % 3 shop_id, id % 5 <> 0 active
  FROM (SELECT DISTINCT k % 10 id FROM ev)),
red AS (
  SELECT event_id record_id, CASE WHEN v >= 1 THEN ts + interval 1 hour END redemption_time, cast(cast(v AS decimal(18,4)) / 2 AS decimal(16,2)) saved_raw,
    cast(v * 3 AS decimal(16,2)) payment_amount, v, dt FROM ev WHERE event_type IN ('purchase', 'signup')),
redeem AS (SELECT record_id, redemption_time, cast((cast(v * 100 AS bigint) + 1) // 2 AS decimal(16,2)) / 100 actual_offer_amount, payment_amount, dt FROM red),
offers AS (
  SELECT event_id record_id, k % 10 activity_id, k * 10 + 1 sku_id, user_id customer_id, k % 25 cs_id, v offer_amount, e.dt,
    CASE WHEN record_id IS NULL THEN 0 ELSE 1 END redeemed, cast(coalesce(actual_offer_amount, 0) AS decimal(16,2)) saved,
    cast(coalesce(actual_offer_amount + payment_amount, 0) AS decimal(16,2)) gross FROM ev e LEFT JOIN redeem r ON r.record_id = event_id),
recent AS (SELECT unnest([1, 7, 30]) recent_days)
"""


def off(body: str, **kw) -> str:
    return base_sql(body, prelude=OFFER, **kw)


def offer_nd(key: str) -> str:
    return f"""(SELECT recent_days, {key}, count(*) send_count, sum(redeemed) redemption_count, cast(sum(redeemed) AS double) / count(*) redemption_rate, sum(saved) total_savings,
      cast(sum(offer_amount) AS double) / count(*) avg_offer_amount, coalesce(cast(sum(saved) AS double) / nullif(cast(sum(gross) AS double), 0), 0) avg_discount,
      cast(count(*) AS double) / recent_days avg_daily_send, cast(sum(saved) AS double) / recent_days avg_daily_savings
      FROM offers, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D} GROUP BY recent_days, {key})"""


def joined(key: str, cols: str, days=(1, 7, 30)) -> str:
    head = f"FROM {offer_nd(key)} d{days[0]} "
    rest = " ".join(f"JOIN {offer_nd(key)} d{d} ON d{d}.{key} = d{days[0]}.{key} AND d{d}.recent_days = {d}" for d in days[1:])
    return f"SELECT d{days[0]}.{key}, {cols} {head} {rest} WHERE d{days[0]}.recent_days = {days[0]}"


LEVEL = "CASE lv WHEN 1 THEN '商品级' WHEN 2 THEN 'SKU级' ELSE '普通级' END"
DIM_TYPE = "CASE ot WHEN 1 THEN '固定优惠' WHEN 2 THEN '自定义优惠' ELSE '其他' END"
FACT_TYPE = "CASE ot WHEN 1 THEN '固定优惠券' WHEN 2 THEN '折扣券' WHEN 3 THEN '满减券' ELSE '其他' END"


def activity(kind: str) -> str:
    return off(
        f"""SELECT activity_id, activity_name, {LEVEL} activity_level, {kind} offer_type, date '2024-01-01' start_date, end_date, max_custom_amount, shop_id
            FROM act WHERE active AND end_date >= {D}""", days="start_date end_date", ints="activity_id max_custom_amount shop_id")  # fmt: skip


def sent(kind: str, rule: str) -> str:
    return off(
        f"""SELECT event_id record_id, activity_id, user_id customer_id, k % 25 cs_id, {kind} offer_type, ts send_time, ts + interval 24 hour expire_time, 24 valid_hours, dt
            FROM ev JOIN act ON activity_id = k % 10 WHERE {rule}""", days="dt", seconds="send_time expire_time", ints="activity_id cs_id valid_hours")  # fmt: skip


PRODUCTS = "SELECT p_partkey product_id, p_partkey % 10 activity_id, p_size fixed_offer_amount, p_size * 2 max_offer_amount, p_partkey % 5 + 1 purchase_limit FROM part WHERE p_partkey % 7 <> 0"
SKUS = "SELECT p_partkey * 10 + 1 sku_id, p_partkey product_id, CASE WHEN p_partkey % 3 <> 0 THEN p_size + 1 END fixed_offer_amount, cast(NULL AS int) max_offer_amount FROM part WHERE p_size > 10"

SQL |= {
    "offer_staff_history": off(
        """WITH s AS (SELECT DISTINCT k % 25 cs_id, dt, 'dept ' || ((k % 25 + day(dt) // 10) % 3) department, (k % 25 + day(dt) // 15) % 2 status FROM ev),
           c AS (SELECT *, lag(department || status) OVER (PARTITION BY cs_id ORDER BY dt) before FROM s),
           starts AS (SELECT * FROM c WHERE before IS NULL OR before <> department || status)
---
SELECT cs_id, department, status, dt start_date, coalesce(lead(dt) OVER (PARTITION BY cs_id ORDER BY dt) - 1, date '9999-12-31') end_date,
 CASE WHEN lead(dt) OVER (PARTITION BY cs_id ORDER BY dt) IS NULL THEN 1 ELSE 0 END is_current FROM starts""",
        days="start_date end_date", ints="cs_id status is_current"),
    "offer_activity_dim": activity(DIM_TYPE),
    "offer_activity_fact": activity(FACT_TYPE),
    "offer_product_dim": off(PRODUCTS, ints="fixed_offer_amount max_offer_amount"),
    "offer_sku_dim": off(SKUS, ints="fixed_offer_amount max_offer_amount"),
    "offer_product_fact": off(
        f"""SELECT p.product_id, s.sku_id, activity_id, coalesce(s.fixed_offer_amount, p.fixed_offer_amount) fixed_offer_amount,
            coalesce(s.max_offer_amount, p.max_offer_amount) max_offer_amount, purchase_limit FROM ({PRODUCTS}) p LEFT JOIN ({SKUS}) s ON s.product_id = p.product_id""",
        ints="fixed_offer_amount max_offer_amount"),
    "offer_send_dim": sent(DIM_TYPE, "true"),
    "offer_send_fact": sent(FACT_TYPE, "event_type <> 'error'"),
    "offer_redemption_fact": off(
        """SELECT record_id redemption_id, record_id, record_id order_id, redemption_time, actual_offer_amount, payment_amount, dt FROM redeem
           WHERE redemption_time IS NOT NULL AND actual_offer_amount > 0""", days="dt", seconds="redemption_time", money="actual_offer_amount payment_amount"),
    "offer_agent_day": off(
        f"""SELECT n_nationkey cs_id, 'agent ' || n_name cs_name, CASE WHEN n_nationkey % 6 <> 0 THEN 'dept ' || (n_nationkey % 3) ELSE '未知部门' END department,
            count(record_id) send_count, coalesce(sum(redeemed), 0) redemption_count, round(cast(sum(offer_amount) AS double) / count(record_id), 2) avg_offer_amount
            FROM nation LEFT JOIN offers ON cs_id = n_nationkey AND dt = {D} WHERE n_nationkey % 8 <> 7 GROUP BY ALL""", ints="cs_id redemption_count"),
    "offer_customer_day": off(
        f"""SELECT customer_id, count(*) offer_count, round(cast(sum(redeemed) AS double) / count(*), 2) redemption_rate, sum(saved) total_savings
            FROM offers WHERE dt = {D} GROUP BY customer_id""", money="total_savings"),
    "offer_activity_horizons": off(f"SELECT * FROM {offer_nd('activity_id')}", ints="recent_days activity_id redemption_count", money="total_savings"),
    "offer_activity_analysis": off(
        joined("activity_id", """d1.send_count daily_send, d1.redemption_count daily_redemption, d1.redemption_rate daily_redemption_rate, d7.avg_daily_send weekly_avg_send,
          d7.redemption_count weekly_redemption, d30.redemption_rate monthly_redemption_rate, d1.total_savings daily_savings, d7.total_savings weekly_savings,
          d30.avg_daily_savings monthly_avg_daily_savings"""), ints="activity_id daily_redemption weekly_redemption", money="daily_savings weekly_savings"),
    "offer_agent_score": off(
        joined("cs_id", """d1.send_count daily_send, d1.redemption_count daily_redemption, d1.avg_offer_amount daily_avg_offer, d7.avg_daily_send weekly_avg_send,
          d7.redemption_rate weekly_redemption_rate, d30.redemption_rate monthly_redemption_rate,
          round(d1.redemption_count * 0.3::double + d7.redemption_rate * 0.4::double + d30.redemption_rate * 0.3::double, 2) performance_score"""),
        ints="cs_id daily_redemption"),
    "offer_customer_value": off(
        f"""SELECT *, round(ln(cast(monthly_avg_savings AS double) + 1) * 0.6::double
              + CASE monthly_activity_level WHEN '高价值' THEN 0.3::double WHEN '中价值' THEN 0.2::double ELSE 0.1::double END + daily_redemption_rate * 0.1::double, 2) value_index FROM (
            SELECT *, CASE WHEN monthly_avg_savings > 500 THEN '高价值' WHEN monthly_avg_savings > 200 THEN '中价值' ELSE '低价值' END monthly_activity_level FROM (
            {joined("customer_id", '''d1.send_count daily_offer_count, d1.redemption_rate daily_redemption_rate, d7.send_count weekly_offer_count,
               d1.total_savings daily_savings, d30.total_savings monthly_avg_savings''')}))""", money="daily_savings monthly_avg_savings"),
    "offer_effectiveness": off(
        f"""SELECT d1.sku_id, d1.send_count daily_send_count, d1.redemption_rate daily_redemption_rate, d1.avg_discount daily_avg_discount, best_redemption_rank,
            m.total_savings monthly_savings, round(d1.redemption_rate * 0.5::double + (1 - cast(best_redemption_rank AS double) / worst) * 0.3::double + d1.avg_discount * 0.2::double, 2) effectiveness_score
            FROM {offer_nd("sku_id")} d1 JOIN (SELECT *, max(best_redemption_rank) OVER () worst FROM (SELECT sku_id, total_savings, rank() OVER (ORDER BY redemption_count DESC) best_redemption_rank
              FROM {offer_nd("sku_id")} WHERE recent_days = 30)) m ON m.sku_id = d1.sku_id WHERE d1.recent_days = 1""", ints="sku_id", money="monthly_savings"),
}

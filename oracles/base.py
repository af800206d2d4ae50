"""The same business tables as DuckDB expressions, written independently of the Spark code."""

ORDERS_AS_OF = "2001-07-31"
EVENTS_AS_OF = "2024-01-30"

RETAIL = """
ev AS (
  SELECT event_id, ts, user_id, event_type, cast(value AS decimal(16,2)) v, cast(regexp_extract(props, '[0-9]+') AS int) k,
         cast(ts AS date) dt
  FROM events),
order_info AS (
  SELECT o_orderkey id, o_custkey user_id, c_nationkey province_id, o_orderstatus order_status, o_orderdate create_time,
         cast(o_totalprice AS decimal(16,2)) original_total_amount,
         cast(cast(o_totalprice AS decimal(16,2)) * cast(0.05 AS decimal(4,2)) AS decimal(16,2)) activity_reduce_amount,
         cast(0 AS decimal(16,2)) coupon_reduce_amount,
         cast(cast(o_totalprice AS decimal(16,2))
              - cast(cast(o_totalprice AS decimal(16,2)) * cast(0.05 AS decimal(4,2)) AS decimal(16,2)) AS decimal(16,2)) total_amount,
         cast(o_orderdate AS date) dt
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
order_detail AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || cast(round(l_extendedprice * 100) AS bigint) id, l_orderkey order_id, l_partkey sku_id,
         l_suppkey shop_id, cast(l_quantity AS bigint) sku_num, cast(l_extendedprice AS decimal(16,2)) split_original_amount,
         cast(cast(l_extendedprice AS decimal(16,2)) * cast(l_discount AS decimal(4,2)) AS decimal(16,2)) split_activity_amount,
         cast(cast(l_extendedprice AS decimal(16,2)) * cast(l_tax AS decimal(4,2)) AS decimal(16,2)) split_coupon_amount,
         cast(cast(l_extendedprice AS decimal(16,2))
              - cast(cast(l_extendedprice AS decimal(16,2)) * cast(l_discount AS decimal(4,2)) AS decimal(16,2)) AS decimal(16,2)) split_total_amount,
         CASE WHEN l_discount > 0 THEN cast(round(l_discount * 100) AS int) END activity_rule_id,
         CASE WHEN l_tax > 0 THEN cast(round(l_tax * 100) AS int) END coupon_id
  FROM lineitem),
order_detail_inc AS (
  SELECT d.*, o.user_id, o.province_id, o.create_time, o.dt, o.order_status
  FROM order_detail d LEFT JOIN order_info o ON d.order_id = o.id),
payment_info AS (
  SELECT id order_id, user_id, '110' || (id % 3 + 1) payment_type, create_time + to_hours(cast(id % 48 AS int)) callback_time,
         total_amount, cast(create_time + to_hours(cast(id % 48 AS int)) AS date) dt
  FROM order_info WHERE order_status IN ('F', 'P')),
finish_log AS (
  SELECT o_orderkey order_id, o_orderdate + to_hours(cast(o_orderkey % 96 + 48 AS int)) finish_time
  FROM orders WHERE o_orderstatus = 'F'),
province AS (
  SELECT n_nationkey id, n_name province_name, lpad(cast(n_nationkey AS varchar), 4, '0') area_code, 'CN-' || n_nationkey iso_code,
         'CN-' || lpad(cast(n_nationkey AS varchar), 2, '0') iso_3166_2, n_regionkey region_id, r_name region_name
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
sku AS (
  SELECT p_partkey id, p_name || ' ' || p_partkey sku_name, p_type category1_id, lower(p_type) category1_name,
         p_type || '/' || p_brand category2_id, lower(p_brand) category2_name,
         p_type || '/' || p_brand || '/' || p_size category3_id, 'size ' || p_size category3_name,
         p_brand tm_id, upper(p_brand) tm_name
  FROM part),
page_view AS (
  SELECT cast(user_id % 25 AS varchar) province_id, 'brand' || (k % 7) brand, 'channel' || (k % 5) channel,
         CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END is_new, 'model' || (k % 11) model, 'mid_' || user_id mid_id,
         CASE WHEN user_id % 2 = 0 THEN 'iOS 17' ELSE 'Android 14' END operate_system,
         CASE WHEN event_type <> 'error' THEN cast(user_id AS varchar) END user_id, 'v2.' || (k % 4) version_code,
         cast(k AS varchar) page_item, 'sku_id' page_item_type, CASE WHEN k % 2 = 0 THEN 'home' END last_page_id,
         event_type page_id, cast(k % 10 AS varchar) from_pos_id, cast(k % 3 AS varchar) from_pos_seq, cast(k % 6 AS varchar) refer_id,
         date_trunc('millisecond', ts) view_time, user_id || '_' || strftime(ts, '%Y%m%d') session_id, cast(v * 1000 AS bigint) during_time, dt,
         event_id
  FROM ev),
order_1d AS (
  SELECT user_id, dt, count(DISTINCT order_id) order_count_1d, cast(sum(sku_num) AS bigint) order_num_1d, sum(split_original_amount) order_original_amount_1d,
         sum(split_activity_amount) activity_reduce_amount_1d, sum(split_coupon_amount) coupon_reduce_amount_1d,
         sum(split_total_amount) order_total_amount_1d
  FROM order_detail_inc GROUP BY user_id, dt),
login AS (
  SELECT user_id, session_id, min(view_time) login_time, cast(min(view_time) AS date) dt, arg_min(channel, view_time) channel,
         arg_min(province_id, view_time) province_id, arg_min(version_code, view_time) version_code, arg_min(mid_id, view_time) mid_id,
         arg_min(brand, view_time) brand, arg_min(model, view_time) model, arg_min(operate_system, view_time) operate_system
  FROM page_view WHERE user_id IS NOT NULL GROUP BY user_id, session_id),
login_td AS (
  SELECT user_id, min(dt) login_date_first, max(dt) login_date_last, count(*) login_count_td FROM login GROUP BY user_id)
"""


def sql(body: str, days: str = "", money: str = "", ints: str = "", seconds: str = "", prelude: str = RETAIL) -> str:
    """``body`` over the prelude, with result columns brought to plain types: text days, double amounts, bigint counts."""
    casts = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in days.split()]
    casts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in seconds.split()]
    casts += [f"cast({c} AS double) AS {c}" for c in money.split()]
    casts += [f"cast({c} AS bigint) AS {c}" for c in ints.split()]
    star = f"* REPLACE ({', '.join(casts)})" if casts else "*"
    body = body.strip()
    extra = ""
    if body.upper().startswith("WITH "):
        cut = body.index("\n---\n")
        extra, body = ", " + body[5:cut], body[cut + 5 :]
    head = prelude.strip().rstrip(",")
    return f"WITH {head}{extra}\nSELECT {star} FROM (\n{body}\n) result"

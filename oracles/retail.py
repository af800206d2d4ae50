"""Retail statements."""

from oracles.base import EVENTS_AS_OF as E
from oracles.base import ORDERS_AS_OF as O
from oracles.base import sql

D = "date '{}'".format
LOGIN_COLS = "channel, province_id, version_code, mid_id, brand, model, operate_system"
SKU_COLS = "sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name"
FAVOR_1D = f"(SELECT f.*, {SKU_COLS} FROM (SELECT k sku_id, dt, count(*) favor_add_count_1d FROM ev WHERE event_type = 'click' GROUP BY k, dt) f LEFT JOIN sku ON f.sku_id = sku.id)"
DIC = "(SELECT DISTINCT '110' || split_part(o_orderpriority, '-', 1) dic_code, split_part(o_orderpriority, '-', 2) dic_name FROM orders)"
COUPON = """(SELECT id, 'coupon ' || id coupon_name, '320' || (id % 3 + 1) coupon_type_code, cast(NULL AS varchar) coupon_type_name,
  id * 100 condition_amount, id + 1 condition_num, id * 5 benefit_amount, 10 - id % 9 benefit_discount,
  CASE id % 3 WHEN 0 THEN '满' || (id * 100) || '元减' || (id * 5) || '元' WHEN 1 THEN '满' || (id + 1) || '件打' || (10 - id % 9) || '折'
              ELSE '减' || (id * 5) || '元' END benefit_rule,
  '330' || (id % 3 + 1) range_type_code, cast(NULL AS varchar) range_type_name
  FROM (SELECT DISTINCT k % 10 id FROM ev))"""
COUPON_1D = f"""(SELECT u.*, coupon_name, coupon_type_code, coupon_type_name, benefit_rule FROM
  (SELECT user_id, k % 10 coupon_id, dt, count(*) used_count_1d FROM ev WHERE event_type = 'signup' AND v >= 20 GROUP BY ALL) u
  LEFT JOIN {COUPON} c ON u.coupon_id = c.id)"""
PROVINCE_1D = """(SELECT province_id, dt, count(DISTINCT order_id) order_count_1d, sum(split_original_amount) order_original_amount_1d,
   sum(split_activity_amount) activity_reduce_amount_1d, sum(split_coupon_amount) coupon_reduce_amount_1d,
   sum(split_total_amount) order_total_amount_1d FROM order_detail_inc GROUP BY province_id, dt)"""
MEASURES_1D = "order_count_1d order_num_1d order_original_amount_1d activity_reduce_amount_1d coupon_reduce_amount_1d order_total_amount_1d".split()
AMT = " ".join(MEASURES_1D[2:])


def flow(known: str, finished: str) -> str:
    """Order rows with the payment and finish known on a day."""
    return f"""
SELECT o.id order_id, o.user_id, o.province_id, o.create_time order_time, o.original_total_amount, o.activity_reduce_amount,
       o.coupon_reduce_amount, o.total_amount, p.callback_time payment_time, p.total_amount payment_amount, f.finish_time,
       coalesce(cast(f.finish_time AS date), date '9999-12-31') dt
FROM order_info o
LEFT JOIN payment_info p ON p.order_id = o.id AND p.dt <= {D(O)}
LEFT JOIN finish_log f ON f.order_id = o.id AND cast(f.finish_time AS date) <= {D(O)}
WHERE o.dt <= {D(O)} {finished}"""


FLOW_TYPES = dict(days="dt", seconds="order_time payment_time finish_time", money="original_total_amount activity_reduce_amount coupon_reduce_amount total_amount payment_amount", ints="province_id")
TD_SQL = sql(
    f"""SELECT user_id, min(dt) order_date_first, max(dt) order_date_last, sum(order_count_1d) order_count_td, sum(order_num_1d) order_num_td,
        {', '.join(f'sum({m}) {m[:-3]}_td' for m in MEASURES_1D[2:])} FROM order_1d WHERE dt <= {D(O)} GROUP BY user_id""",
    days="order_date_first order_date_last",
    ints="order_count_td order_num_td",
    money=" ".join(m[:-3] + "_td" for m in MEASURES_1D[2:]),
)
RECENT_BUYERS = f"(SELECT DISTINCT user_id, dt FROM ev WHERE event_type = 'purchase' AND dt BETWEEN {D(E)} - 6 AND {D(E)})"
THREE_DAYS = sql(
    f"""SELECT {D(E)} dt, 7 recent_days, count(DISTINCT a.user_id) order_continuously_user_count
        FROM {RECENT_BUYERS} a JOIN {RECENT_BUYERS} b ON a.user_id = b.user_id AND b.dt = a.dt + 1
        JOIN {RECENT_BUYERS} c ON a.user_id = c.user_id AND c.dt = a.dt + 2""",
    days="dt",
    ints="recent_days",
)


def nd_columns(measures: list[str]) -> str:
    out = []
    for n in (7, 30):
        for m in measures:
            out.append(f"sum(CASE WHEN dt > {D(O)} - {n} THEN {m}_1d ELSE 0 END) {m}_{n}d")
    return ", ".join(out)


ND = [m[:-3] for m in MEASURES_1D]
USER_SKU_1D = f"""(SELECT u.*, {SKU_COLS} FROM (SELECT user_id, sku_id, dt, count(*) order_count_1d, cast(sum(sku_num) AS bigint) order_num_1d,
   sum(split_original_amount) order_original_amount_1d, sum(split_activity_amount) activity_reduce_amount_1d,
   sum(split_coupon_amount) coupon_reduce_amount_1d, sum(split_total_amount) order_total_amount_1d
   FROM order_detail_inc GROUP BY user_id, sku_id, dt) u LEFT JOIN sku ON u.sku_id = sku.id)"""


def stats_by(keys: str) -> str:
    part = f"""SELECT {D(O)} dt, {{n}} recent_days, {keys}, sum(order_count_1d) order_count, count(DISTINCT user_id) order_user_count
               FROM {USER_SKU_1D} WHERE dt BETWEEN {D(O)} - {{n}} + 1 AND {D(O)} GROUP BY {keys}"""
    return sql(" UNION ALL ".join(part.replace("{n}", str(n)) for n in (1, 7, 30)), days="dt", ints="recent_days order_count")


CATEGORY = "category1_id, category1_name, category2_id, category2_name, category3_id, category3_name"

SQL = {
    "activity_dim": sql(
        f"""SELECT a.id activity_rule_id, a.id % 3 activity_id, 'activity ' || (a.id % 3) activity_name, '310' || (a.id % 3 + 1) activity_type_code,
        d.dic_name activity_type_name, a.id * 100 condition_amount, a.id + 1 condition_num, a.id * 5 benefit_amount, 10 - a.id % 9 benefit_discount,
        CASE a.id % 3 WHEN 0 THEN '满' || (a.id * 100) || '元减' || (a.id * 5) || '元'
                      WHEN 1 THEN '满' || (a.id + 1) || '件打' || (10 - a.id % 9) || '折' ELSE '打' || (10 - a.id % 9) || '折' END benefit_rule,
        a.id benefit_level
        FROM (SELECT DISTINCT activity_rule_id id FROM order_detail WHERE activity_rule_id IS NOT NULL) a
        LEFT JOIN {DIC} d ON d.dic_code = '310' || (a.id % 3 + 1)""",
        ints="activity_rule_id activity_id condition_amount condition_num benefit_amount benefit_discount benefit_level",
    ),
    "coupon_dim": sql(f"SELECT * FROM {COUPON}", ints="id condition_amount condition_num benefit_amount benefit_discount"),
    "promotion_pos_dim": sql(f"SELECT DISTINCT from_pos_id id, page_id pos_location, {D(E)} dt FROM page_view", days="dt"),
    "promotion_refer_dim": sql(f"SELECT DISTINCT refer_id id, 'refer ' || refer_id refer_name, {D(E)} dt FROM page_view", days="dt"),
    "province_dim": sql("SELECT * FROM province", ints="id region_id"),
    "sku_snowflake_dim": sql(
        """SELECT s.*, p_retailprice price, p_name sku_desc, p_size / 10.0 weight, cast(p_partkey % 10 <> 0 AS bigint) is_sale, p_name spu_id,
        array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') spu_name,
        '[{"attr_id":"4","value_id":"' || least(md5(cast(p_size AS varchar)), md5(cast(p_size AS varchar))) || '","attr_name":"size","value_name":"' || p_size || '"}' attr_a,
        '{"attr_id":"4","value_id":"' || md5(p_type) || '","attr_name":"type","value_name":"' || p_type || '"}]' attr_b,
        '[{"sale_attr_id":"1","sale_attr_value_id":"' || md5(split_part(p_name, ' ', 1)) || '","sale_attr_name":"colour","sale_attr_value_name":"'
          || split_part(p_name, ' ', 1) || '"}]' sale_attrs,
        md5(cast(p_size AS varchar)) < md5(p_type) size_first
        FROM sku s JOIN part ON id = p_partkey"""
    ),
    "date_dim": sql(
        """SELECT DISTINCT dt date_id, week(dt) week_id, isodow(dt) week_day, day(dt) AS day, month(dt) AS month, quarter(dt) AS quarter, year(dt) AS year,
           CASE WHEN isodow(dt) < 6 THEN 1 ELSE 0 END is_workday FROM order_info""",
        days="date_id", ints="week_id week_day day month quarter year is_workday"),
    "masked_user_dim": sql(
        """SELECT c_custkey id, substr(c_name, 1, 1) || '*' AS name,
        CASE WHEN c_custkey % 10 <> 0 THEN '138****' || lpad(cast(c_custkey AS varchar), 8, '0')[5:] END phone_num,
        CASE WHEN c_custkey % 9 <> 0 THEN '*@mail' || (c_custkey % 4) || '.com' END email, cast(c_custkey % 5 + 1 AS varchar) user_level,
        c_mktsegment segment, date '1970-01-01' + cast(c_custkey % 9000 AS int) birthday,
        CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END gender, c_nationkey province_id FROM customer""",
        days="birthday", ints="province_id"),
    "favor_add_fact": sql("SELECT event_id id, user_id, k sku_id, dt date_id, ts create_time, dt FROM ev WHERE event_type = 'click'",
        days="date_id dt", seconds="create_time", ints="sku_id"),
    "coupon_used_fact": sql(
        "SELECT event_id id, k % 10 coupon_id, user_id, event_id order_id, dt date_id, ts used_time, dt FROM ev WHERE event_type = 'signup' AND v >= 20",
        days="date_id dt", seconds="used_time", ints="coupon_id"),
    "cart_add_fact": sql(
        "SELECT event_id id, user_id, k sku_id, dt date_id, ts create_time, event_id % 5 + 1 sku_num, dt FROM ev WHERE event_type = 'view'",
        days="date_id dt", seconds="create_time", ints="sku_id"),
    "cart_snapshot_fact": sql(
        "SELECT event_id id, user_id, k sku_id, event_id % 5 + 1 sku_num, dt FROM ev WHERE event_type = 'view' AND event_id % 3 <> 0",
        days="dt", ints="sku_id"),
    "order_detail_fact": sql(
        """SELECT id, order_id, user_id, sku_id, shop_id, province_id, activity_rule_id % 3 activity_id, activity_rule_id, coupon_id, dt date_id,
           create_time, sku_num, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, dt FROM order_detail_inc""",
        days="date_id dt", seconds="create_time", ints="province_id activity_id activity_rule_id coupon_id",
        money="split_original_amount split_activity_amount split_coupon_amount split_total_amount"),
    "order_detail_fact_daily": sql(
        f"""SELECT id, order_id, user_id, sku_id, shop_id, province_id, activity_rule_id % 3 activity_id, activity_rule_id, coupon_id, dt date_id,
           create_time, sku_num, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, dt FROM order_detail_inc
           WHERE dt = {D(O)}""",
        days="date_id dt", seconds="create_time", ints="province_id activity_id activity_rule_id coupon_id",
        money="split_original_amount split_activity_amount split_coupon_amount split_total_amount"),
    "pay_detail_fact": sql(
        f"""SELECT d.id, d.order_id, p.user_id, sku_id, o.province_id, activity_rule_id % 3 activity_id, activity_rule_id, coupon_id,
           payment_type payment_type_code, dic_name payment_type_name, p.dt date_id, callback_time, sku_num, split_original_amount,
           split_activity_amount, split_coupon_amount, split_total_amount split_payment_amount, p.dt
           FROM order_detail d JOIN payment_info p ON d.order_id = p.order_id LEFT JOIN order_info o ON d.order_id = o.id
           LEFT JOIN {DIC} dic ON p.payment_type = dic_code""",
        days="date_id dt", seconds="callback_time", ints="province_id activity_id activity_rule_id coupon_id",
        money="split_original_amount split_activity_amount split_coupon_amount split_payment_amount"),
    "order_flow_first": sql(flow("", ""), **FLOW_TYPES),
    "order_flow_daily": sql(flow("", f"AND coalesce(cast(f.finish_time AS date), date '9999-12-31') >= {D(O)}"), **FLOW_TYPES),
    "page_view_fact": sql(
        "SELECT * EXCLUDE (event_id) REPLACE (view_time + interval 8 hour AS view_time, cast(view_time + interval 8 hour AS date) AS dt) FROM page_view",
        days="dt", seconds="view_time"),
    "user_login_fact": sql(f"SELECT user_id, session_id, login_time, dt, {LOGIN_COLS} FROM login", days="dt", seconds="login_time"),
    "user_register_fact": sql(
        f"""WITH first_page AS (SELECT user_id, {', '.join(f'arg_min({c}, view_time) {c}' for c in LOGIN_COLS.split(', '))}
            FROM page_view WHERE page_id = 'signup' GROUP BY user_id)
---
SELECT cast(u.user_id AS varchar) user_id, u.create_time, cast(u.create_time AS date) dt, {LOGIN_COLS}
FROM (SELECT user_id, min(ts) create_time FROM ev GROUP BY user_id) u LEFT JOIN first_page f ON cast(u.user_id AS varchar) = f.user_id""",
        days="dt", seconds="create_time"),
    "sku_favor_add_1d": sql(f"SELECT * FROM {FAVOR_1D}", days="dt", ints="sku_id"),
    "user_coupon_used_1d": sql(f"SELECT * FROM {COUPON_1D}", days="dt", ints="coupon_id"),
    "province_order_1d": sql(
        f"SELECT o.*, province_name, area_code, iso_code, iso_3166_2 FROM {PROVINCE_1D} o LEFT JOIN province ON province_id = id",
        days="dt", ints="province_id", money=AMT),
    "province_order_nd": sql(
        f"""SELECT province_id, province_name, area_code, iso_code, iso_3166_2, {nd_columns([m for m in ND if m != 'order_num'])}
            FROM {PROVINCE_1D} LEFT JOIN province ON province_id = id WHERE dt BETWEEN {D(O)} - 29 AND {D(O)} GROUP BY ALL""",
        ints="province_id order_count_7d order_count_30d", money=" ".join(f"{m}_{n}d" for n in (7, 30) for m in ND[2:])),
    "user_cart_add_1d": sql(
        "SELECT user_id, dt, count(*) cart_add_count_1d, sum(event_id % 5 + 1) cart_add_num_1d FROM ev WHERE event_type = 'view' GROUP BY user_id, dt",
        days="dt", ints="cart_add_num_1d"),
    "user_order_1d": sql("SELECT * FROM order_1d", days="dt", money=AMT),
    "user_order_td": TD_SQL,
    "user_order_td_union": TD_SQL,
    "user_order_td_full_join": TD_SQL,
    "user_payment_1d": sql(
        """SELECT p.user_id, p.dt, count(DISTINCT d.order_id) payment_count_1d, sum(sku_num) payment_num_1d, sum(split_total_amount) payment_amount_1d
           FROM order_detail d JOIN payment_info p ON d.order_id = p.order_id GROUP BY p.user_id, p.dt""",
        days="dt", ints="payment_num_1d", money="payment_amount_1d"),
    "user_sku_order_1d": sql(f"SELECT * FROM {USER_SKU_1D}", days="dt", money=AMT),
    "user_sku_order_nd": sql(
        f"SELECT user_id, sku_id, {SKU_COLS}, {nd_columns(ND)} FROM {USER_SKU_1D} WHERE dt BETWEEN {D(O)} - 29 AND {D(O)} GROUP BY ALL",
        ints="order_count_7d order_count_30d order_num_7d order_num_30d", money=" ".join(f"{m}_{n}d" for n in (7, 30) for m in ND[2:])),
    "page_visitor_page_view_1d": sql(
        """SELECT mid_id, brand, model, operate_system, page_id, dt, sum(during_time) during_time_1d, count(*) view_count_1d FROM page_view GROUP BY ALL""",
        days="dt", ints="during_time_1d"),
    "session_page_view_1d": sql(
        """SELECT session_id, mid_id, brand, model, operate_system, version_code, channel, dt, sum(during_time) during_time_1d, count(*) page_count_1d
           FROM page_view GROUP BY ALL""", days="dt", ints="during_time_1d"),
    "user_login_td": sql(
        f"""SELECT cast(u.user_id AS varchar) user_id, coalesce(l.login_date_last, u.d) login_date_last, u.d login_date_first, coalesce(login_count_td, 1) login_count_td
            FROM (SELECT user_id, cast(min(ts) AS date) d FROM ev GROUP BY user_id) u LEFT JOIN login_td l ON cast(u.user_id AS varchar) = l.user_id""",
        days="login_date_first login_date_last"),
    "user_login_td_daily": sql(
        f"""WITH before AS (SELECT user_id, max(dt) d, count(*) n FROM login WHERE dt < {D(E)} GROUP BY user_id),
            today AS (SELECT user_id, count(*) n FROM login WHERE dt = {D(E)} GROUP BY user_id)
---
SELECT cast(u.user_id AS varchar) user_id, CASE WHEN t.user_id IS NOT NULL THEN {D(E)} ELSE coalesce(b.d, u.d) END login_date_last,
  u.d login_date_first, coalesce(b.n, 1) + coalesce(t.n, 0) login_count_td
FROM (SELECT user_id, cast(min(ts) AS date) d FROM ev GROUP BY user_id) u
LEFT JOIN before b ON cast(u.user_id AS varchar) = b.user_id LEFT JOIN today t ON cast(u.user_id AS varchar) = t.user_id""",
        days="login_date_first login_date_last"),
    "user_stats": sql(
        " UNION ALL ".join(
            f"""SELECT {D(E)} dt, {n} recent_days, count(*) FILTER (login_date_first > {D(E)} - {n}) new_user_count, count(*) active_user_count
                FROM login_td WHERE login_date_last > {D(E)} - {n}""" for n in (1, 7, 30)),
        days="dt", ints="recent_days"),
    "coupon_stats": sql(
        f"""SELECT dt, coupon_id, coupon_name, sum(used_count_1d) used_count, count(*) used_user_count FROM {COUPON_1D}
            WHERE dt = {D(E)} GROUP BY dt, coupon_id, coupon_name""", days="dt", ints="coupon_id used_count"),
    "new_order_user_stats": sql(
        " UNION ALL ".join(
            f"""SELECT {D(O)} dt, {n} recent_days, count(*) new_order_user_count FROM (SELECT user_id, min(dt) f FROM order_1d WHERE dt <= {D(O)} GROUP BY user_id)
                WHERE f > {D(O)} - {n}""" for n in (1, 7, 30)) ,
        days="dt", ints="recent_days").replace(") result", ") result WHERE new_order_user_count > 0"),
    "order_by_province": sql(
        f"""SELECT {D(O)} dt, 1 recent_days, province_id, province_name, area_code, iso_code, iso_3166_2, order_count_1d order_count,
            order_total_amount_1d order_total_amount FROM {PROVINCE_1D} JOIN province ON province_id = id WHERE dt = {D(O)} UNION ALL """
        + " UNION ALL ".join(
            f"""SELECT {D(O)} dt, {n} recent_days, province_id, province_name, area_code, iso_code, iso_3166_2,
            sum(CASE WHEN dt > {D(O)} - {n} THEN order_count_1d ELSE 0 END) order_count,
            sum(CASE WHEN dt > {D(O)} - {n} THEN order_total_amount_1d ELSE 0 END) order_total_amount
            FROM {PROVINCE_1D} o JOIN province ON province_id = id WHERE o.dt BETWEEN {D(O)} - 29 AND {D(O)} GROUP BY ALL""" for n in (7, 30)),
        days="dt", ints="recent_days province_id order_count", money="order_total_amount"),
    "consecutive_3d_lead": THREE_DAYS,
    "consecutive_3d_islands": THREE_DAYS,
    "consecutive_3d_mask": THREE_DAYS,
    "consecutive_3d_near": sql(
        f"""SELECT {D(E)} dt, 7 recent_days, count(DISTINCT user_id) order_continuously_user_count FROM
            (SELECT user_id, dt, lead(dt, 2) OVER (PARTITION BY user_id ORDER BY dt) far FROM {RECENT_BUYERS}) WHERE far - dt <= 3""",
        days="dt", ints="recent_days"),
    "order_stats_by_cate": stats_by(CATEGORY),
    "order_stats_by_tm": stats_by("tm_id, tm_name"),
    "order_to_pay_interval_avg": sql(
        f"""SELECT {D(O)} dt, sum(date_diff('second', o.create_time, p.callback_time)) / count(*) order_to_pay_interval_avg
            FROM order_info o JOIN payment_info p ON o.id = p.order_id WHERE p.dt = {D(O)} AND o.dt <= {D(O)}""", days="dt",
        money="order_to_pay_interval_avg"),
    "page_path_edges": sql(
        f"""SELECT {D(E)} dt, 'step-' || rn || ':' || page_id source, coalesce('step-' || (rn + 1) || ':' || nxt, 'null') target, count(*) path_count FROM
            (SELECT page_id, row_number() OVER w rn, lead(page_id) OVER w nxt FROM page_view WHERE dt BETWEEN {D(E)} - 29 AND {D(E)}
             WINDOW w AS (PARTITION BY session_id ORDER BY view_time)) GROUP BY ALL""", days="dt"),
    "repeat_purchase_by_tm": sql(
        f"""SELECT {D(O)} dt, 30 recent_days, tm_id, tm_name, round(count(*) FILTER (n >= 2) / count(*), 2) order_repeat_rate FROM
            (SELECT tm_id, tm_name, user_id, sum(order_count_1d) n FROM {USER_SKU_1D} WHERE dt BETWEEN {D(O)} - 29 AND {D(O)} GROUP BY ALL) GROUP BY tm_id, tm_name""",
        days="dt", ints="recent_days"),
    "sku_cart_num_top3_by_cate": sql(
        f"""WITH items AS (SELECT k sku_id, sum(event_id % 5 + 1) cart_num FROM ev WHERE event_type = 'view' AND event_id % 3 <> 0
              AND dt BETWEEN {D(E)} - 29 AND {D(E)} GROUP BY k)
---
SELECT * FROM (SELECT {D(E)} dt, sku_id, cart_num, sku_name, {CATEGORY},
  rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) rk FROM items LEFT JOIN sku ON sku_id = id) WHERE rk <= 3""",
        days="dt", ints="sku_id cart_num"),
    "sku_favor_count_top3_by_tm": sql(
        f"""SELECT * FROM (SELECT dt, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d,
            rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) rk FROM {FAVOR_1D} WHERE dt = {D(E)}) WHERE rk <= 3""",
        days="dt", ints="sku_id"),
    "traffic_by_channel": sql(
        """WITH s AS (SELECT session_id, mid_id, brand, model, operate_system, version_code, channel, dt, sum(during_time) ms, count(*) pages
             FROM page_view GROUP BY ALL)
---
""" + " UNION ALL ".join(
            f"""SELECT {D(E)} dt, {n} recent_days, channel, count(DISTINCT mid_id) uv_count, floor(sum(ms) / count(*) / 1000) avg_duration_sec,
                floor(sum(pages) / count(*)) avg_page_count, count(*) sv_count, round(count(*) FILTER (pages = 1) / count(*), 2) bounce_rate
                FROM s WHERE dt BETWEEN {D(E)} - {n} + 1 AND {D(E)} GROUP BY channel""" for n in (1, 7, 30)),
        days="dt", ints="recent_days avg_duration_sec avg_page_count"),
    "user_action_funnel": sql(
        f"""SELECT {D(E)} dt,
            (SELECT count(*) FROM (SELECT DISTINCT mid_id, brand, model, operate_system FROM page_view WHERE dt = {D(E)} AND page_id = 'view')) home_count,
            (SELECT count(*) FROM (SELECT DISTINCT mid_id, brand, model, operate_system FROM page_view WHERE dt = {D(E)} AND page_id = 'click')) good_detail_count,
            (SELECT count(DISTINCT user_id) FROM ev WHERE dt = {D(E)} AND event_type = 'view') cart_count,
            (SELECT count(DISTINCT user_id) FROM ev WHERE dt = {D(E)} AND event_type = 'purchase') order_count,
            (SELECT count(DISTINCT user_id) FROM ev WHERE dt = {D(E)} AND event_type = 'purchase' AND v >= 20) payment_count""", days="dt"),
    "user_change": sql(
        f"""SELECT {D(E)} dt, (SELECT count(*) FROM login_td WHERE login_date_last = {D(E)} - 7) user_churn_count,
            (SELECT count(*) FROM (SELECT user_id, max(dt) FILTER (dt < {D(E)}) p, max(dt) l FROM login GROUP BY user_id) WHERE l = {D(E)} AND l - p >= 8) user_back_count""",
        days="dt"),
    "user_retention": sql(
        """WITH td AS (SELECT user_id, min(dt) f, max(dt) l FROM login WHERE dt <= date '2024-01-05' GROUP BY user_id)
---
SELECT date '2024-01-05' dt, f create_date, date '2024-01-05' - f retention_day, count(*) FILTER (l = date '2024-01-05') retention_count,
  count(*) new_user_count, round(count(*) FILTER (l = date '2024-01-05') / count(*) * 100, 2) retention_rate
FROM td WHERE f BETWEEN date '2024-01-05' - 7 AND date '2024-01-05' - 1 GROUP BY f""", days="dt create_date"),
}
SQL["sku_snowflake_dim"] = SQL["sku_snowflake_dim"].replace(
    "SELECT * FROM (",
    """SELECT * EXCLUDE (attr_a, attr_b, size_first),
 CASE WHEN size_first THEN attr_a || ',' || attr_b ELSE '[' || attr_b[:-2] || ',' || attr_a[2:] || ']' END attrs FROM (""",
    1,
)

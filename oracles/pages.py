"""Page-path and page-analytics statements."""

from oracles.base import EVENTS_AS_OF as E
from oracles.base import RETAIL
from oracles.base import sql as base_sql

D = f"date '{E}'"

PATH = RETAIL.strip() + """,
info AS (
  SELECT pid, 'page ' || pid page_name, CASE kind WHEN 'view' THEN 'home' WHEN 'signup' THEN 'activity' WHEN 'click' THEN 'detail' WHEN 'purchase' THEN 'category' ELSE 'other' END t
  FROM (SELECT DISTINCT event_type || '-' || (k % 4) pid, event_type kind FROM ev) WHERE pid <> 'error-3'),
visit AS (
  SELECT event_id log_id, user_id, user_id || '_' || strftime(ts, '%Y%m%d') session_id, event_type || '-' || (k % 4) page_id, coalesce(p.page_name, '未知页面') page_name,
    CASE WHEN p.t IN ('home', 'activity', 'category') THEN 'shop_page' WHEN event_type = 'click' THEN 'product_detail' ELSE 'other_page' END page_type,
    CASE WHEN k % 3 <> 0 THEN 'view-' || (k % 5) END referer_page_id, coalesce(r.page_name, '无来源') referer_page_name, ts visit_time,
    greatest(0, least(3600, cast(floor(v * 20) AS int) - 100)) stay_duration, ['pc', 'mobile', 'tablet'][user_id % 3 + 1] device_type,
    coalesce('province ' || nullif(k % 6, 0), '未知') province, coalesce('city ' || nullif(k % 7, 0), '未知') city, k % 2 is_new_visitor, dt
  FROM ev LEFT JOIN info p ON p.pid = event_type || '-' || (k % 4) LEFT JOIN info r ON r.pid = CASE WHEN k % 3 <> 0 THEN 'view-' || (k % 5) END),
sess AS (
  SELECT session_id, any_value(user_id) user_id, arg_min(page_id, visit_time) entry_page_id, arg_min(page_name, visit_time) entry_page_name,
    arg_min(page_type, visit_time) entry_page_type, min(visit_time) entry_time, arg_max(page_id, visit_time) exit_page_id, max(visit_time) exit_time, count(*) path_depth,
    sum(stay_duration) total_duration, arg_min(device_type, visit_time) device_type, arg_min(is_new_visitor, visit_time) is_new_session, min(dt) dt FROM visit GROUP BY session_id),
ord AS (
  SELECT event_id order_id, user_id, ts - to_hours(k % 3) order_time, CASE WHEN k % 5 <> 0 THEN ts + to_hours(k % 12) END payment_time, v payment_amount FROM ev WHERE event_type = 'purchase'),
conv AS (
  SELECT s.user_id, session_id, path_depth page_view_count, total_duration session_duration, CASE WHEN order_id IS NULL THEN 0 ELSE 1 END is_converted,
    CASE WHEN payment_time BETWEEN entry_time AND exit_time THEN 'payment' WHEN order_id IS NOT NULL THEN 'order' ELSE 'view' END conversion_type,
    CASE WHEN payment_time BETWEEN entry_time AND exit_time THEN payment_amount ELSE 0 END conversion_value, dt
  FROM sess s LEFT JOIN ord o ON o.user_id = s.user_id AND (order_time BETWEEN entry_time AND exit_time OR payment_time BETWEEN entry_time AND exit_time)),
outcome AS (
  SELECT s.*, is_converted, conversion_value FROM sess s JOIN (SELECT session_id, max(is_converted) is_converted, sum(conversion_value) conversion_value FROM conv GROUP BY ALL) c USING (session_id)),
step AS (
  SELECT * FROM (SELECT session_id, user_id, page_id from_page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY visit_time) to_page_id, dt FROM visit) WHERE to_page_id IS NOT NULL),
recent AS (SELECT unnest([1, 7, 30]) recent_days),
sess_nd AS (SELECT * FROM outcome, recent WHERE dt BETWEEN AS_OF - recent_days + 1 AND AS_OF),
visit_nd AS (
  SELECT r.recent_days, v.*, s.entry_page_id, s.exit_page_id, s.exit_time, s.path_depth, s.is_converted
  FROM visit v JOIN outcome s ON s.session_id = v.session_id, recent r WHERE v.dt BETWEEN AS_OF - r.recent_days + 1 AND AS_OF),
device_nd AS (
  SELECT recent_days, device_type, count(*) session_count, count(DISTINCT user_id) visitor_count, round(cast(sum(total_duration) AS double) / count(*), 2) avg_session_duration,
    round(count(*) FILTER (path_depth = 1) / count(*), 4) bounce_rate, round(cast(sum(is_converted) AS double) / count(*), 4) conversion_rate,
    round(cast(sum(path_depth) AS double) / count(*), 2) avg_path_depth FROM sess_nd GROUP BY ALL),
entry_nd AS (
  SELECT recent_days, entry_page_id, entry_page_name, entry_page_type, device_type, count(*) session_count, count(DISTINCT user_id) visitor_count,
    round(cast(sum(total_duration) AS double) / count(*), 2) avg_session_duration, round(count(*) FILTER (path_depth = 1) / count(*), 4) bounce_rate,
    round(cast(sum(is_converted) AS double) / count(*), 4) conversion_rate FROM sess_nd GROUP BY ALL),
page_nd AS (
  SELECT recent_days, page_id, page_name, page_type, device_type, count(*) visit_count, count(DISTINCT user_id) visitor_count,
    round(cast(sum(stay_duration) AS double) / count(*), 2) avg_stay_duration, count(*) FILTER (exit_page_id = page_id) exit_count,
    round(count(*) FILTER (path_depth = 1) / count(*), 4) bounce_rate, count(*) FILTER (entry_page_id = page_id) entry_count FROM visit_nd GROUP BY ALL),
flow_nd AS (
  SELECT j.recent_days, from_page_id, f.name from_page_name, f.type from_page_type, to_page_id, t.name to_page_name, t.type to_page_type, jump_count, jump_users,
    round(cast(jump_count AS double) / f.visits, 4) jump_rate, f.exits drop_off_count
  FROM (SELECT recent_days, from_page_id, to_page_id, count(*) jump_count, count(DISTINCT user_id) jump_users FROM step, recent
        WHERE dt BETWEEN AS_OF - recent_days + 1 AND AS_OF GROUP BY ALL) j
  JOIN (SELECT recent_days, page_id, max(page_name) AS name, max(page_type) AS type, sum(visit_count) visits, sum(exit_count) exits FROM page_nd GROUP BY ALL) f
    ON f.recent_days = j.recent_days AND f.page_id = from_page_id
  JOIN (SELECT DISTINCT recent_days, page_id, page_name AS name, page_type AS type FROM page_nd) t ON t.recent_days = j.recent_days AND t.page_id = to_page_id)
""".replace("AS_OF", D)


def path(body: str, **kw) -> str:
    return base_sql(body, prelude=PATH, **kw)


PERIOD = "* EXCLUDE (recent_days), recent_days || 'd' period_type"



def history(table: str, key: str, now: dict[str, str], ints: str = "") -> str:
    """Current rows ∪ closed rows that differ; ``now`` gives each tracked column's new value."""
    fresh = ", ".join(f"{e} AS {c}" for c, e in now.items())
    differs = " OR ".join(f"{c} IS DISTINCT FROM ({e})" for c, e in now.items())
    return path(
        f"""SELECT {key}, {fresh}, {D} start_date, date '9999-12-31' end_date, 1 is_current FROM {table}
            UNION ALL SELECT {key}, {', '.join(now)}, date '2024-01-01', {D} - 1, 0 FROM {table} WHERE {differs}""",
        days="start_date end_date", ints=f"is_current {ints}")


SQL = {
    "path_user_history": history("customer", "c_custkey", {"c_mktsegment": "CASE WHEN c_custkey % 4 = 0 THEN 'NEW' ELSE c_mktsegment END", "c_nationkey": "c_nationkey"}, "c_nationkey"),
    "path_product_history": history(
        "part", "p_partkey", {"p_retailprice": "CASE WHEN p_partkey % 5 = 0 THEN p_retailprice + 1 ELSE p_retailprice END", "p_type": "nullif(p_type, 'PROMO')"}),
    "path_page_history": history(
        "(SELECT pid page_id, page_name, t page_type FROM info)", "page_id", {"page_type": "CASE WHEN page_type = 'home' THEN 'start' ELSE page_type END", "page_name": "page_name"}),
    "path_visit_fact": path("SELECT * FROM visit", days="dt", seconds="visit_time", ints="stay_duration is_new_visitor"),
    "session_path": path("SELECT * FROM sess", days="dt", seconds="entry_time exit_time", ints="total_duration is_new_session"),
    "path_jump_fact": path("SELECT from_page_id, to_page_id, dt, count(*) jump_count, count(DISTINCT user_id) jump_users FROM step GROUP BY ALL", days="dt"),
    "session_conversion": path("SELECT * FROM conv", days="dt", ints="session_duration is_converted", money="conversion_value"),
    "path_device_horizons": path("SELECT * FROM device_nd", ints="recent_days"),
    "path_page_horizons": path("SELECT * FROM page_nd", ints="recent_days"),
    "path_entry_horizons": path("SELECT * FROM entry_nd", ints="recent_days"),
    "path_flow_horizons": path("SELECT * FROM flow_nd", ints="recent_days drop_off_count"),
    "entry_page_map": path(
        """SELECT s.*, entry_page_distribution FROM (
             SELECT recent_days, user_id, count(*) session_count, sum(path_depth) total_page_views, sum(total_duration) total_duration,
               round(cast(sum(total_duration) AS double) / count(*), 2) avg_session_duration, sum(is_converted) conversion_count, sum(conversion_value) total_conversion_value
             FROM sess_nd GROUP BY ALL) s
           JOIN (SELECT recent_days, user_id, '{' || string_agg('"' || entry_page_name || '":' || n, ',' ORDER BY entry_page_name) || '}' entry_page_distribution
             FROM (SELECT recent_days, user_id, entry_page_name, count(*) n FROM sess_nd GROUP BY ALL) GROUP BY ALL) m USING (recent_days, user_id)""",
        ints="recent_days total_page_views total_duration conversion_count", money="total_conversion_value"),
    "path_page_type_horizons": path(
        """SELECT recent_days, page_type, device_type, count(*) visit_count, count(DISTINCT user_id) visitor_count, round(cast(sum(stay_duration) AS double) / count(*), 2) avg_stay_duration,
           count(*) FILTER (visit_time = exit_time) exit_count, round(cast(count(DISTINCT CASE WHEN path_depth = 1 THEN session_id END) AS double) / count(DISTINCT session_id), 4) bounce_rate,
           count(DISTINCT CASE WHEN is_converted = 1 THEN session_id END) conversion_count FROM visit_nd GROUP BY recent_days, page_type, device_type""", ints="recent_days"),
    "path_device_report": path(f"SELECT {PERIOD} FROM device_nd"),
    "path_page_report": path(f"SELECT {PERIOD} FROM page_nd"),
    "path_entry_report": path(f"SELECT {PERIOD} FROM entry_nd"),
    "path_flow_report": path(f"SELECT * REPLACE (least(jump_rate, 1) AS jump_rate) FROM (SELECT {PERIOD} FROM flow_nd)", ints="drop_off_count"),
}

PAGES = RETAIL.strip() + f""",
pev AS (SELECT *, 'p' || (k % 20) page_id, date_trunc('second', ts) sec, strftime(ts, '%Y%m%d%H%M%S') digits FROM ev),
vfact AS (
  SELECT page_id || '_' || digits visit_id, page_id, event_type page_type, sec visit_time, k % 3 + 1 visitor_count, event_id % 7 visit_pv, event_id % 5 click_pv,
    hour(ts) hour_of_day, CASE WHEN hour(ts) IN (9, 10, 11, 12, 19, 20, 21) THEN 1 ELSE 0 END is_peak_hour, dt FROM pev WHERE k % 33 <> 0 AND event_id % 7 > 0),
bfact AS (
  SELECT page_id || '_b' || (k % 12) || '_' || digits click_id, page_id, 'b' || (k % 12) block_id, event_id % 4 click_pv, event_id % 3 click_uv, v - 5 guide_pay_amount, sec collect_time,
    ['轮播类', '推荐类', '活动类', '商品类', '其他类'][k % 5 + 1] block_category, dt FROM pev WHERE event_id % 4 > 0 AND v >= 5),
tfact AS (
  SELECT page_id || '_' || strftime(dt, '%Y-%m-%d') trend_id, page_id, dt stat_date, count(DISTINCT user_id) visitor_count, count(*) FILTER (event_type = 'click') click_uv, 'v1' data_version,
    CASE WHEN dt BETWEEN {D} - 6 AND {D} THEN 1 ELSE 0 END is_current_week, CASE WHEN isodow(dt) > 5 THEN 1 ELSE 0 END is_weekend, dt FROM pev GROUP BY page_id, dt),
gfact AS (
  SELECT page_id || '_' || lpad(cast(k AS varchar), 19, '6') || '_' || digits guide_id, page_id, lpad(cast(k AS varchar), 19, '6') product_id, event_id % 6 guide_count,
    event_id % 3 guide_buyer_count, sec guide_time, hour(ts) guide_hour, CASE WHEN event_id % 3 > 0 THEN 1 ELSE 0 END is_high_value, dt FROM pev WHERE event_id % 6 > 0 AND k % 10 <> 0),
mfact AS (
  SELECT 'm' || (k % 15) module_id, page_id, 'module ' || (k % 15) module_name, ['推荐型', '活动型', '导购型', '内容型'][k % 5 + 1] module_type, event_id % 50 expose_pv,
    event_id % 20 interact_count, sec stat_time, round(cast(event_id % 20 AS double) / (event_id % 50), 4) interaction_rate, dt FROM pev WHERE event_id % 50 > 0 AND k % 5 < 4),
recent AS (SELECT unnest([1, 7, 30]) recent_days),
vnd AS (SELECT recent_days, page_id, page_type, hour_of_day, sum(visitor_count) visitor_count, sum(visit_pv) visit_pv, sum(click_pv) click_pv,
  sum(is_peak_hour * visitor_count) peak_visitor_count, sum(is_peak_hour * visit_pv) peak_visit_pv FROM vfact, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D} GROUP BY ALL),
bnd AS (SELECT recent_days, page_id, block_id, block_category, sum(click_pv) click_pv, sum(click_uv) click_uv, sum(guide_pay_amount) guide_pay_amount,
  round(cast(sum(guide_pay_amount) AS double) / sum(click_pv), 2) avg_guide_pay_per_click FROM bfact, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D} GROUP BY ALL),
tnd AS (SELECT recent_days, page_id, sum(visitor_count) visitor_count, sum(click_uv) click_uv, sum(is_current_week * visitor_count) week_visitor_count,
  sum(is_weekend * visitor_count) weekend_visitor_count FROM tfact, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D} GROUP BY ALL),
gnd AS (SELECT recent_days, page_id, product_id, sum(guide_count) guide_count, sum(guide_buyer_count) guide_buyer_count,
  round(cast(sum(is_high_value * guide_count) AS double) / sum(guide_count) * 100, 2) high_value_guide_ratio FROM gfact, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D} GROUP BY ALL),
mnd AS (SELECT recent_days, page_id, module_id, module_type, sum(expose_pv) expose_pv, sum(interact_count) interact_count,
  round(cast(sum(interact_count) AS double) / sum(expose_pv) * 100, 2) effective_interaction_rate FROM mfact, recent WHERE dt BETWEEN {D} - recent_days + 1 AND {D} GROUP BY ALL)
"""


def page(body: str, **kw) -> str:
    return base_sql(body, prelude=PAGES, **kw)


RANGE = f"{D} start_date, date '9999-12-31' end_date"


def latest(key: str, cols: str, rule: str = "true") -> str:
    return page(
        f"""SELECT *, {RANGE} FROM (SELECT {key}, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key.split(' ')[0]} ORDER BY sec DESC, event_id DESC) rn
            FROM (SELECT *, 'b' || (k % 12) b, 'm' || (k % 15) m FROM pev WHERE {rule})) WHERE rn = 1)""", days="start_date end_date")  # fmt: skip


SQL |= {
    "page_info_dim": latest("page_id", "'page ' || page_id || ' ' || strftime(ts, '%d') page_name, event_type page_type", "k % 33 <> 0"),
    "page_block_dim": latest("b block_id", "['轮播', '推荐', '活动', '商品', '其他'][k % 5 + 1] || (k % 12) block_name, page_id"),
    "page_module_dim": latest("m module_id", "'module ' || (k % 15) module_name, ['推荐型', '活动型', '导购型', '内容型', '其他'][k % 5 + 1] module_type, page_id", "event_id % 50 > 0"),
    "page_product_dim": page(
        f"""SELECT product_id, '商品_' || product_id product_name, {RANGE} FROM
            (SELECT DISTINCT CASE WHEN k % 10 = 0 THEN cast(k AS varchar) ELSE lpad(cast(k AS varchar), 19, '6') END product_id FROM ev)""", days="start_date end_date"),
    "page_visit_fact": page("SELECT * FROM vfact", days="dt", seconds="visit_time", ints="visitor_count is_peak_hour"),
    "page_block_fact": page("SELECT * FROM bfact", days="dt", seconds="collect_time", money="guide_pay_amount"),
    "page_trend_fact": page("SELECT * FROM tfact", days="dt stat_date", ints="is_current_week is_weekend"),
    "page_guide_fact": page("SELECT * FROM gfact", days="dt", seconds="guide_time", ints="is_high_value"),
    "page_module_fact": page("SELECT * FROM mfact", days="dt", seconds="stat_time"),
    "page_visit_horizons": page("SELECT * FROM vnd", ints="recent_days visitor_count visit_pv click_pv peak_visitor_count peak_visit_pv"),
    "page_block_horizons": page("SELECT * FROM bnd", ints="recent_days click_pv click_uv", money="guide_pay_amount"),
    "page_trend_horizons": page("SELECT * FROM tnd", ints="recent_days visitor_count click_uv week_visitor_count weekend_visitor_count"),
    "page_guide_horizons": page("SELECT * FROM gnd", ints="recent_days guide_count guide_buyer_count"),
    "page_module_horizons": page("SELECT * FROM mnd", ints="recent_days expose_pv interact_count"),
    "page_overview_report": page(
        """SELECT v.page_id, page_type, visitor_count, visit_pv, round(cast(click_pv AS double) / visitor_count, 2) click_per_visitor,
           round(cast(peak AS double) / visitor_count * 100, 2) peak_visitor_ratio, coalesce(round(cast(pay AS double) / clicks * 100, 2), 0) pay_per_100_clicks_7d,
           coalesce(round(cast(acts AS double) / shown * 100, 2), 0) interact_per_100_expose_30d
           FROM (SELECT page_id, page_type, sum(visitor_count) visitor_count, sum(visit_pv) visit_pv, sum(click_pv) click_pv, sum(peak_visitor_count) peak FROM vnd WHERE recent_days = 1 GROUP BY ALL) v
           LEFT JOIN (SELECT page_id, sum(guide_pay_amount) pay, sum(click_pv) clicks FROM bnd WHERE recent_days = 7 GROUP BY ALL) b ON b.page_id = v.page_id
           LEFT JOIN (SELECT page_id, sum(interact_count) acts, sum(expose_pv) shown FROM mnd WHERE recent_days = 30 GROUP BY ALL) m ON m.page_id = v.page_id""",
        ints="visitor_count visit_pv"),
    "page_block_report": page(
        """SELECT a.block_id, a.block_category, click_pv, click_uv, guide_pay_amount, round(cast(guide_pay_amount AS double) / click_pv, 2) avg_guide_pay_per_click,
           round(cast(click_pv AS double) / month_clicks * 100, 2) click_share_30d, avg_high_value_ratio_7d
           FROM (SELECT block_id, block_category, sum(click_pv) click_pv, sum(click_uv) click_uv, sum(guide_pay_amount) guide_pay_amount FROM bnd WHERE recent_days = 1 GROUP BY ALL) a
           JOIN (SELECT block_id, sum(click_pv) month_clicks FROM bnd WHERE recent_days = 30 GROUP BY ALL) c ON c.block_id = a.block_id
           JOIN (SELECT block_id, block_category, round(cast(sum(cast(high_value_guide_ratio AS decimal(16,2))) AS double) / count(high_value_guide_ratio), 2) avg_high_value_ratio_7d
                 FROM bnd b LEFT JOIN gnd g ON g.page_id = b.page_id AND g.recent_days = 7 WHERE b.recent_days = 1 GROUP BY ALL) h ON h.block_id = a.block_id AND h.block_category = a.block_category""",
        ints="click_pv click_uv", money="guide_pay_amount"),
    "page_trend_report": page(
        f"""SELECT a.page_id, a.visitor_count visitor_count_1d, b.week_visitor_count, round(cast(b.weekend_visitor_count AS double) / b.visitor_count * 100, 2) weekend_visitor_ratio,
            c.click_uv click_uv_30d, round(cast((b.visitor_count - p.n) * 100 AS double) / p.n, 2) visitor_growth_7d
            FROM tnd a JOIN tnd b ON b.page_id = a.page_id AND b.recent_days = 7 JOIN tnd c ON c.page_id = a.page_id AND c.recent_days = 30
            LEFT JOIN (SELECT page_id, sum(visitor_count) n FROM tfact WHERE dt BETWEEN {D} - 13 AND {D} - 7 GROUP BY page_id) p ON p.page_id = a.page_id WHERE a.recent_days = 1""",
        ints="visitor_count_1d week_visitor_count click_uv_30d"),
    "page_guide_report": page(
        """SELECT a.*, avg_daily_guide_7d, conversion_rate_30d, '商品_' || a.product_id product_name FROM
           (SELECT product_id, sum(guide_count) guide_count, sum(guide_buyer_count) guide_buyer_count,
              cast(sum(cast(high_value_guide_ratio AS decimal(16,2))) AS double) / count(high_value_guide_ratio) avg_high_value_ratio FROM gnd WHERE recent_days = 1 GROUP BY ALL) a
           JOIN (SELECT product_id, cast(sum(guide_count) AS double) / 7 avg_daily_guide_7d FROM gnd WHERE recent_days = 7 GROUP BY ALL) b ON b.product_id = a.product_id
           JOIN (SELECT product_id, round(cast(sum(guide_buyer_count) AS double) / sum(guide_count) * 100, 2) conversion_rate_30d FROM gnd WHERE recent_days = 30 GROUP BY ALL) c
             ON c.product_id = a.product_id""", ints="guide_count guide_buyer_count"),
    "page_module_report": page(
        f"""SELECT a.*, avg_daily_interact_7d, round(cast((n - p) * 100 AS double) / p, 2) exposure_growth FROM
            (SELECT module_id, module_type, sum(expose_pv) expose_pv_1d, sum(interact_count) interact_count_1d,
               round(cast(sum(cast(effective_interaction_rate AS decimal(16,2))) AS double) / count(*), 2) effective_interaction_rate_1d FROM mnd WHERE recent_days = 1 GROUP BY ALL) a
            JOIN (SELECT module_id, round(cast(sum(interact_count) AS double) / 7, 0) avg_daily_interact_7d FROM mnd WHERE recent_days = 7 GROUP BY ALL) b ON b.module_id = a.module_id
            LEFT JOIN (SELECT module_id, sum(expose_pv) FILTER (dt > {D} - 14) n, sum(expose_pv) FILTER (dt <= {D} - 14) p FROM mfact
              WHERE dt BETWEEN {D} - 27 AND {D} GROUP BY module_id) g ON g.module_id = a.module_id""", ints="expose_pv_1d interact_count_1d"),
}

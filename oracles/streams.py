"""Statements for the streaming queries. Windows that were still open at the end of the stream are left out, as append mode does."""

from oracles.base import RETAIL
from oracles.base import sql as base_sql

STREAMS = RETAIL.strip() + """,
chg AS (
  SELECT o_orderkey k, o_custkey u, CASE o_orderstatus WHEN 'F' THEN '1002' WHEN 'P' THEN '1003' ELSE '1001' END st, cast(cast(o_totalprice AS decimal(16,2)) AS varchar) amt,
    ['u','c','u','r','u','d'][o_orderkey % 6 + 1] op, CASE o_orderpriority WHEN '5-LOW' THEN 'shop_info' WHEN '4-NOT SPECIFIED' THEN 'other_table' ELSE 'order_info' END tab,
    epoch_ms(o_orderdate) + o_orderkey % 86400000 ts_ms FROM orders),
od AS (
  SELECT o_orderkey order_id, o_custkey user_id, o_orderstatus status, cast(o_totalprice AS decimal(16,2)) amount, o_orderdate + to_seconds(o_orderkey % 86400) od_ts FROM orders),
ln AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || cast(round(l_extendedprice * 100) AS bigint) id, l_orderkey order_id,
    cast(l_extendedprice AS decimal(16,2)) split_amount, od_ts FROM lineitem JOIN od ON od.order_id = l_orderkey),
plog AS (
  SELECT event_id, ts, 'mid_' || user_id mid, 'v2.' || (k % 4) vc, 'channel' || (k % 5) ch, cast(user_id % 25 AS varchar) ar, CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END is_new,
    event_type page_id, CASE WHEN k % 2 = 0 THEN 'home' END last_page_id, cast(v * 1000 AS bigint) during_time, dt FROM ev),
blocked AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(text, '[^\\p{L}\\p{N}]+')) w FROM benchmark) WHERE w <> '')
"""


def st(body: str, **kw) -> str:
    return base_sql(body, prelude=STREAMS, **kw)


def bounds(width: int, ts: str = "ts") -> str:
    start = f"make_timestamp(epoch_us({ts}) // {width * 1000000} * {width * 1000000})"
    return f"""strftime({start}, '%Y-%m-%d %H:%M:%S') stt, strftime({start} + interval {width} second, '%Y-%m-%d %H:%M:%S') edt, strftime({start}, '%Y-%m-%d') cur_date"""


def closed(width: int, limit: str, ts: str = "ts") -> str:
    """Window end not after the watermark."""
    return f"make_timestamp(epoch_us({ts}) // {width * 1000000} * {width * 1000000}) + interval {width} second <= {limit}"


def firsts(kind: str, rule: str) -> str:
    return f"(SELECT user_id, {kind} kind, dt, min(ts) ts FROM ev WHERE {rule} GROUP BY ALL)"


MAX = "(SELECT max(ts) FROM f)"

SQL = {
    "stream_cdc_flatten": st(
        """SELECT k || '_' || ts_ms id_ts, op, 'shop' db, tab AS "table", CASE WHEN op = 'u' THEN '{"id":"' || k || '","user_id":"' || u || '","order_status":"1001","total_amount":"' || amt || '"}' END AS before,
           '{"id":"' || k || '","user_id":"' || u || '","order_status":"' || st || '","total_amount":"' || amt || '"}' AS after, ts_ms FROM chg WHERE op <> 'd'"""),
    "stream_cdc_transition": st(
        "SELECT cast(k AS varchar) id, cast(u AS varchar) user_id, st order_status, ts_ms FROM chg WHERE op = 'u' AND st = '1003' AND tab = 'order_info'"),
    "stream_cart_growth": st(
        """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id, cast(l_partkey AS varchar) sku_id,
           CASE WHEN l_linenumber % 2 = 1 THEN cast(l_quantity AS bigint) - l_partkey % 40 ELSE cast(l_quantity AS bigint) END sku_num, epoch_ms(l_shipdate) ts_ms
           FROM lineitem WHERE l_linenumber % 2 = 0 OR cast(l_quantity AS bigint) > l_partkey % 40"""),
    "stream_cdc_payload": st(
        """SELECT op, ts_ms tm_ms, strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') ds, cast(k AS varchar) id, CASE WHEN op = 'd' THEN '1001' ELSE st END order_status, amt total_amount FROM chg"""),
    "stream_route_by_table": st(
        "SELECT cast(k AS varchar) id, op, CASE tab WHEN 'order_info' THEN 'detail_order_info' WHEN 'shop_info' THEN 'detail_shop_info' ELSE 'main' END topic FROM chg"),
    "stream_split_log": st(
        """WITH base AS (SELECT 'mid_' || user_id mid, event_type page_id, epoch_us(ts) // 1000 ts, k, v FROM ev)
---
SELECT '{"code":' || (k % 9) || '}' body, mid, page_id, ts, 'err' kind FROM base WHERE page_id = 'error'
UNION ALL SELECT '{"entry":"icon"}', mid, page_id, ts, 'start' FROM base WHERE page_id = 'signup'
UNION ALL SELECT '{"id":"d' || i || '"}', mid, page_id, ts, 'display' FROM base, (SELECT unnest([1, 2]) i) WHERE page_id <> 'signup' AND i <= k % 3
UNION ALL SELECT '{"id":"a1"}', mid, page_id, ts, 'action' FROM base WHERE page_id <> 'signup' AND k % 2 = 1
UNION ALL SELECT '{"item":"' || k || '","page_id":"' || page_id || '","during_time":' || cast(v * 1000 AS bigint) || '}', mid, page_id, ts, 'page' FROM base WHERE page_id <> 'signup'"""),
    "stream_dirty_lines": st(
        """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 1, 4) ELSE props END AS value,
           CASE WHEN event_id % 10 <> 0 THEN cast(regexp_extract(props, '[0-9]+') AS bigint) END k, CASE WHEN event_id % 10 = 0 THEN 'dirty' ELSE 'clean' END topic FROM events"""),
    "stream_clean_kinds": st(
        """WITH b AS (SELECT event_id e, user_id u, k % 10 s, strftime(ts, '%Y-%m-%d %H:%M:%S') t, k, v, event_id % 12 n FROM ev WHERE k >= 10),
            h AS (SELECT *, '","consumer_id":"' || u || '","shop_id":"' || s || '"' who FROM b)
---
SELECT 'visitor' kind, '{"visitor_id":"' || e || who || ',"behavior_time":"' || t || '","is_new_visitor":' || (k % 2) || '}' record FROM h WHERE n = 0
UNION ALL SELECT 'cart', '{"addcart_id":"' || e || who || ',"addcart_time":"' || t || '","addcart_num":' || (k % 5) || '}' FROM h WHERE n = 1
UNION ALL SELECT 'payment', '{"payment_id":"' || e || '","order_id":"' || e || who || ',"total_pay_amt":' || v || '}' FROM h WHERE n = 2
UNION ALL SELECT 'membership', '{"membership_id":"' || e || who || ',"join_time":"' || t || '"}' FROM h WHERE n = 3
UNION ALL SELECT 'search', '{"search_id":"' || e || who || ',"search_keyword":"' || k || '","search_time":"' || t || '"}' FROM h WHERE n = 4
UNION ALL SELECT 'collect', '{"collect_id":"' || e || who || ',"collect_time":"' || t || '","is_cancel_collect":' || (k % 2) || '}' FROM h WHERE n = 5
UNION ALL SELECT 'consult', '{"consult_id":"' || e || who || ',"consult_time":"' || t || '"}' FROM h WHERE n = 6
UNION ALL SELECT 'broadcast', '{"broadcast_id":"' || e || '","broadcast_time":"' || t || '","shop_id":"' || s || '","consumer_id":"' || u || '","history_behavior_cnt":' || k || '}' FROM h WHERE n = 7
UNION ALL SELECT 'shop', '{"shop_id":"' || s || '","merchant_id":"' || u || '","shop_name":"shop ' || e || '","is_direct_bus":' || (k % 2) || '}' FROM h WHERE n = 8
UNION ALL SELECT 'goods', '{"goods_id":"' || e || '","shop_id":"' || s || '","goods_name":"goods ' || e || '","is_pre_sale":' || (k % 2) || '}' FROM h WHERE n = 9
UNION ALL SELECT 'customer', '{"consumer_id":"' || u || '","register_time":"' || t || '","history_shop_cnt":' || k || '}' FROM h WHERE n = 10
UNION ALL SELECT 'channel', '{"channel_code":"' || e || '","channel_name":"channel ' || u || '","channel_type":"' || k || '"}' FROM h WHERE n = 11"""),
    "stream_cart_daily_unique": st(
        f"""WITH f AS {firsts("''", "event_type = 'view'")}
---
SELECT {bounds(5)}, count(*) cart_add_uu_ct FROM f WHERE {closed(5, MAX)} GROUP BY ALL"""),
    "stream_home_detail": st(
        f"""WITH f AS {firsts("event_type", "event_type IN ('view', 'click')")}
---
SELECT {bounds(5)}, count(*) FILTER (kind = 'view') home_uv_ct, count(*) FILTER (kind = 'click') good_detail_uv_ct FROM f WHERE {closed(5, MAX)} GROUP BY ALL"""),
    "stream_traffic_window": st(
        f"""WITH f AS (SELECT mid, arg_min(vc, ts) vc, arg_min(ch, ts) ch, arg_min(ar, ts) ar, arg_min(is_new, ts) is_new, min(ts) ts FROM plog GROUP BY mid, dt),
            u AS (SELECT ts, vc, ch, ar, is_new, 1 uv, 0 sv, 0 pv, 0 dur FROM f UNION ALL
                  SELECT ts, vc, ch, ar, is_new, 0, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 1, during_time FROM plog)
---
SELECT {bounds(10)}, vc, ch, ar, is_new, sum(uv) uv_ct, sum(sv) sv_ct, sum(pv) pv_ct, sum(dur) dur_sum FROM u WHERE {closed(10, "(SELECT max(ts) - interval 3 second FROM f)")} GROUP BY ALL""",
        ints="uv_ct sv_ct pv_ct dur_sum"),
    "stream_login_return": st(
        """SELECT cast(user_id AS varchar) AS key, strftime(dt, '%Y-%m-%d') AS day, 1 uu_ct, CASE WHEN dt - lag(dt) OVER (PARTITION BY user_id ORDER BY dt) >= 8 THEN 1 ELSE 0 END back_ct
           FROM (SELECT DISTINCT user_id, dt FROM ev WHERE event_type = 'purchase')""", ints="uu_ct back_ct"),
    "stream_fix_is_new": st(
        """WITH f AS (SELECT mid, CASE WHEN arg_min(is_new, ts) = '1' THEN min(dt) ELSE min(dt) - 1 END new_day FROM plog GROUP BY mid)
---
SELECT event_id, mid, is_new, CASE WHEN is_new = '1' AND dt <> new_day THEN '0' ELSE is_new END fixed_is_new FROM plog JOIN f USING (mid)"""),
    "stream_dedup_exact": st("SELECT event_id, user_id, v AS value FROM ev", money="value"),
    "stream_dedup_bloom": st("SELECT event_id, user_id FROM ev"),
    "stream_dedup_latest": st(
        "SELECT cast(u AS varchar) user_id, cast(min(k) AS varchar) id, ts_ms FROM chg WHERE op <> 'd' GROUP BY u, ts_ms"),
    "stream_hold_back": st(
        """SELECT user_id, event_id FROM (SELECT user_id, event_id, epoch_us(ts) // 1000 + 5000 due, lead(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts, event_id) after FROM ev)
           WHERE due <= coalesce(after, (SELECT epoch_us(max(ts)) // 1000 FROM ev))"""),
    "stream_province_retract": st(
        f"""WITH g AS (SELECT (epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) // 4 gap FROM orders),
            h AS (SELECT od.*, make_timestamp(epoch_us(od_ts) + 2000000 + gap) again, cast(cast((cast(amount * 100 AS bigint) + 1) // 2 AS decimal(18,2)) / 100 AS decimal(16,2)) half FROM od, g),
            v AS (SELECT user_id, amount, 1 n, od_ts + interval 1 second ts FROM h
                  UNION ALL SELECT user_id, -amount, -1, again FROM h WHERE status = 'P' UNION ALL SELECT user_id, half, 1, again FROM h WHERE status = 'P')
---
SELECT {bounds(10)}, cast(c_nationkey AS varchar) province_id, any_value(n_name) province_name, sum(n) order_count, sum(amount) order_amount
FROM v JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey WHERE {closed(10, "(SELECT max(ts) FROM v)")} GROUP BY stt, edt, cur_date, c_nationkey""",
        money="order_amount", ints="order_count"),
    "stream_province_window": st(
        f"""WITH o AS (SELECT * FROM od WHERE order_id IN (SELECT l_orderkey FROM lineitem))
---
SELECT {bounds(10, 'od_ts')}, c_nationkey province_id, count(*) order_count, sum(amount) order_amount
            FROM o JOIN customer ON c_custkey = user_id WHERE {closed(10, "(SELECT max(od_ts) FROM o)", 'od_ts')} GROUP BY ALL""", ints="province_id", money="order_amount"),
    "stream_process_time": st("SELECT op, count(*) changes, count(*) stamped FROM chg GROUP BY op"),
    "stream_sku_window": st(
        f"""WITH l AS (SELECT l_shipdate ts, l_partkey sku_id, cast(l_extendedprice AS decimal(16,2)) amount FROM lineitem)
---
SELECT w.*, sku_name, p_name spu_id, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') spu_name,
 tm_id, tm_name, category3_id, category3_name, category2_id, category2_name, category1_id, category1_name FROM (
 SELECT {bounds(5)}, sku_id, count(*) line_count, sum(amount) order_amount FROM l WHERE {closed(5, '(SELECT max(ts) FROM l)')} GROUP BY ALL) w
 LEFT JOIN sku ON sku.id = sku_id LEFT JOIN part ON p_partkey = sku_id""", money="order_amount"),
    "stream_keyword_count": st(
        f"""WITH w AS (SELECT make_timestamp((conv_id + turn) * 1000000) ts, unnest(regexp_split_to_array(text, '[^\\p{{L}}\\p{{N}}]+')) keyword FROM conversations WHERE role = 'user')
---
SELECT {bounds(5)}, keyword, count(*) keyword_count FROM w WHERE keyword <> '' AND {closed(5, "(SELECT max(ts) - interval 5 second FROM w WHERE keyword <> '')")} GROUP BY ALL"""),
    "stream_moderation": st(
        """WITH c AS (SELECT conv_id, turn, string_split(text || ',' || split_part(text, ' ', 2), ',')[-1] last FROM conversations)
---
SELECT conv_id, turn, CASE WHEN w IS NULL THEN 0 ELSE 1 END is_violation, CASE WHEN w IS NULL THEN '' ELSE 'P0' END violation_grade, coalesce(w, '') violation_msg
FROM c LEFT JOIN blocked ON w = last""", ints="is_violation"),
    "blocked_words": st(
        """SELECT conv_id, '["' || string_agg(w, '","' ORDER BY w) || '"]' blocked_words FROM
           (SELECT DISTINCT conv_id, unnest(regexp_split_to_array(text, '[^\\p{L}\\p{N}]+')) w FROM conversations) SEMI JOIN blocked USING (w) GROUP BY conv_id"""),
    "stream_pay_interval_join": st(
        """WITH p AS (SELECT *, od_ts + to_seconds(order_id % 60 * 60 - 5) paid_at FROM od WHERE status = 'F')
---
SELECT l.id order_detail_id, p.order_id, p.user_id, split_amount, r_name payment_type_name, paid_at FROM p JOIN ln l ON l.order_id = p.order_id
 AND l.od_ts BETWEEN paid_at - interval 30 minute AND paid_at + interval 5 second LEFT JOIN region ON r_regionkey = p.order_id % 4""", money="split_amount", seconds="paid_at"),
    "stream_comment_interval_join": st(
        """WITH c AS (SELECT *, od_ts + to_seconds(order_id % 180 - 90) cm_ts FROM od)
---
SELECT order_id, cast(order_id % 7 AS varchar) appraise, coalesce(r_name, 'N/A') dic_name, user_id info_user_id, status info_status, amount info_amount, strftime(cm_ts, '%Y%m%d') ds
FROM c LEFT JOIN region ON r_regionkey = order_id % 7 WHERE cm_ts BETWEEN od_ts - interval 1 minute AND od_ts + interval 1 minute""", money="info_amount"),
    "stream_cancel_join": st(
        """SELECT l.id, l.order_id, split_amount, od.od_ts + to_seconds(od.order_id % 40 * 60) cancel_time FROM ln l JOIN od ON od.order_id = l.order_id
           WHERE status = 'P' AND od.order_id % 40 * 60 <= 1805""", money="split_amount", seconds="cancel_time"),
    "stream_refund_join": st(
        """SELECT order_id, user_id, amount, od_ts + to_seconds(order_id % 30 * 60) asked_at, od_ts + to_seconds(order_id % 50 * 60) refunded_at FROM od WHERE status = 'F'""",
        money="amount", seconds="asked_at refunded_at"),
    "stream_dim_sync": st(
        """WITH x AS (SELECT *, CASE tab WHEN 'order_info' THEN 'dim_order_info' ELSE 'dim_shop_info' END sink, cast(CASE tab WHEN 'order_info' THEN k ELSE u END AS varchar) AS key FROM chg WHERE tab <> 'other_table'),
            y AS (SELECT *, coalesce(max(CASE WHEN op = 'd' THEN ts_ms END) OVER (PARTITION BY sink, key), -1) gone FROM x),
            newest AS (SELECT *, row_number() OVER (PARTITION BY sink, key ORDER BY ts_ms DESC) rn FROM y WHERE op <> 'd' AND ts_ms > gone)
---
SELECT sink sink_table, md5(key) row_key, CASE tab WHEN 'order_info' THEN cast(k AS varchar) END id, cast(u AS varchar) user_id, CASE tab WHEN 'order_info' THEN st END order_status,
 CASE tab WHEN 'shop_info' THEN amt END total_amount FROM newest WHERE rn = 1"""),
    "stream_order_refund_join": st(
        """SELECT order_id, user_id, amount, a.r_name refund_type_name, b.r_name refund_reason_name, od_ts + to_seconds(order_id % 40 * 60) asked_at
           FROM od JOIN region a ON a.r_regionkey = order_id % 5 JOIN region b ON b.r_regionkey = order_id % 3 WHERE status = 'F' AND order_id % 40 <= 30""",
        money="amount", seconds="asked_at"),
    "stream_login_window": st(
        f"""WITH d AS (SELECT user_id, dt, min(ts) ts FROM ev WHERE event_type = 'purchase' GROUP BY user_id, dt),
            f AS (SELECT *, CASE WHEN dt - lag(dt) OVER (PARTITION BY user_id ORDER BY dt) >= 8 THEN 1 ELSE 0 END back FROM d)
---
SELECT {bounds(10)}, count(*) uu_ct, sum(back) back_ct FROM f WHERE {closed(10, MAX)} GROUP BY ALL""", ints="back_ct"),
    "stream_upsert_latest": st(
        """SELECT cast(u AS varchar) user_id, cast(k AS varchar) id, st order_status, op, ts_ms FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY ts_ms DESC) rn FROM chg)
           WHERE rn = 1 AND op <> 'd'"""),
    "stream_olap_json": st(
        f"""WITH f AS (SELECT * FROM ev WHERE event_type = 'purchase')
---
SELECT {bounds(3600)}, user_id, count(*) pay_count, sum(v) pay_amount FROM f WHERE {closed(3600, MAX)} GROUP BY ALL""", money="pay_amount"),
    "stream_bucketed_files": st(
        """SELECT '{"event_id":' || event_id || ',"at":"' || CASE k % 3 WHEN 0 THEN cast(epoch_us(ts) // 1000 AS varchar) WHEN 1 THEN substr(cast(epoch_us(ts) // 1000 AS varchar), 1, 10) ELSE 'soon' END || '"}' AS value,
           CASE WHEN k % 3 = 2 THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day FROM ev"""),
}

SQL["stream_order_detail_join"] = st(
    """WITH d AS (SELECT l.id, l.order_id, od.user_id, od.status, od.od_ts, split_amount FROM ln l JOIN od ON od.order_id = l.order_id),
        a AS (SELECT d.*, CASE WHEN status = 'F' AND order_id % 20 <= 10 THEN order_id % 5 END activity_id, CASE WHEN status = 'O' AND order_id % 20 <= 10 THEN order_id % 7 END coupon_id FROM d)
---
SELECT id, order_id, user_id, activity_id, coupon_id, split_amount FROM a
WHERE od_ts + interval 10 second <= (SELECT least(max(od_ts) FILTER (status = 'F'), max(od_ts + to_seconds(order_id % 20)) FILTER (status = 'O')) - interval 5 second FROM od)""",
    money="split_amount")

SQL["stream_changing_lookup"] = st(
    """WITH s AS (SELECT (epoch_us(min(o_orderdate)) + epoch_us(max(o_orderdate))) // 2 mid FROM orders),
        e AS (SELECT epoch_us(max(od_ts)) // 1000 - 86400000 passed FROM od)
---
SELECT order_id, user_id % 25 province_code, amount, od_ts, CASE WHEN n_nationkey % 2 = 0 AND epoch_us(od_ts) >= mid THEN lower(n_name) WHEN n_nationkey % 5 <> 4 THEN n_name ELSE 'N/A' END province_name
FROM od, s, e, nation WHERE n_nationkey = user_id % 25 AND epoch_us(od_ts) // 1000 < passed""", money="amount", seconds="od_ts")
SQL["stream_clock_windows"] = st("SELECT event_type, count(*) events, sum(v) * 100 cents FROM ev GROUP BY event_type", ints="cents")
SQL["stream_rule_changes"] = st(
    """WITH b AS (SELECT epoch_us(min(o_orderdate)) lo, epoch_us(max(o_orderdate)) hi FROM orders),
        t AS (SELECT (lo + (hi - lo) * 4 // 8) // 1000 t4, (lo + (hi - lo) * 7 // 8) // 1000 t7 FROM b),
        x AS (SELECT 'dim_order_info' sink, cast(k AS varchar) AS key, chg.* FROM chg, t WHERE tab = 'order_info' AND ts_ms >= t7
              UNION ALL SELECT 'dim_shop_info', cast(u AS varchar), chg.* FROM chg, t WHERE tab = 'shop_info' AND ts_ms >= t4
              UNION ALL SELECT 'dim_other', cast(k AS varchar), chg.* FROM chg WHERE tab = 'other_table'),
        y AS (SELECT *, coalesce(max(CASE WHEN op = 'd' THEN ts_ms END) OVER (PARTITION BY sink, key), -1) gone FROM x),
        newest AS (SELECT *, row_number() OVER (PARTITION BY sink, key ORDER BY ts_ms DESC) rn FROM y WHERE op <> 'd' AND ts_ms > gone)
---
SELECT sink sink_table, md5(key) row_key, CASE WHEN sink <> 'dim_shop_info' THEN cast(k AS varchar) END id, CASE WHEN sink = 'dim_shop_info' THEN cast(u AS varchar) END user_id,
 CASE WHEN sink = 'dim_order_info' THEN st END order_status, CASE WHEN sink <> 'dim_order_info' THEN amt END total_amount FROM newest WHERE rn = 1""")

SQL["stream_rolled_files"] = SQL["stream_bucketed_files"]
SQL["stream_state_after_timers"] = st(
    """SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) rn FROM ev)
       WHERE rn = 1 AND epoch_us(ts) // 1000 + 5000 > (SELECT epoch_us(max(ts)) // 1000 FROM ev)""", seconds="ts")
# a mark goes when the watermark is a day past the end of its day
SQL["stream_state_after_restart"] = st(
    """SELECT DISTINCT cast(user_id AS varchar) user_id, strftime(dt, '%Y-%m-%d') AS day FROM ev
       WHERE epoch_ms(dt::timestamp) + 2 * 86400000 > (SELECT epoch_us(max(ts)) // 1000 FROM ev)""")

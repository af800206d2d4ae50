"""Statements for cleaning, history, ranking and sinks."""

from oracles.base import EVENTS_AS_OF as E
from oracles.base import ORDERS_AS_OF as O
from oracles.base import sql
from oracles.retail import SQL as RETAIL_SQL

SEG = """(SELECT c_custkey id, c_acctbal balance, c_mktsegment || '-0' s0, c_mktsegment || CASE WHEN c_custkey % 7 = 1 THEN '-1' ELSE '-0' END s1,
  c_mktsegment || CASE WHEN c_custkey % 7 IN (1, 2) THEN '-1' ELSE '-0' END s2, c_custkey % 7 m FROM customer)"""

SQL = {
    "sink_append": sql("SELECT o_orderstatus status, 2 * count(*) n, count(DISTINCT o_orderkey) orders FROM orders GROUP BY o_orderstatus"),
    "source_load_file": sql("SELECT o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders"),
    "source_preview": sql("SELECT o_orderkey, o_custkey, cast(o_totalprice AS decimal(16,2)) price FROM orders ORDER BY price DESC, o_orderkey LIMIT 100", money="price"),
    "source_nullsafe_values": sql("SELECT event_type AS key, count(*) n, max(props) largest FROM events WHERE event_id % 7 <> 0 GROUP BY event_type"),
    "keyword_function": sql(
        "SELECT conv_id, word, count(*) n FROM (SELECT conv_id, unnest(regexp_split_to_array(text, '[^\\p{L}\\p{N}]+')) word FROM conversations) WHERE word <> '' GROUP BY conv_id, word"),
    "event_user_bitmaps": sql(
        f"SELECT event_type, d recent_days, count(DISTINCT user_id) user_count FROM ev, (SELECT unnest([1, 7, 30]) d) WHERE dt BETWEEN date '{E}' - cast(d - 1 AS int) AND date '{E}' GROUP BY event_type, d",
        ints="recent_days"),
    "province_td_corrected": sql(
        f"""SELECT c_nationkey province_id, min(o_orderdate::date) first_day, max(o_orderdate::date) last_day, count(*) order_count, sum(cast(o_totalprice AS decimal(16,2))) order_amount
            FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate::date <= date '{O}' GROUP BY c_nationkey""", days="first_day last_day", money="order_amount", ints="province_id"),
    "order_day_range": sql(
        """WITH r AS (SELECT unnest(range(min(o_orderdate)::date::timestamp, max(o_orderdate)::date::timestamp + interval 1 day, interval 1 day)) d FROM orders)
---
SELECT strftime(d, '%Y%m%d') ds, count(o_orderkey) orders FROM r LEFT JOIN orders ON o_orderdate::date = d::date GROUP BY d"""),
    "scd2_rank": sql(
        f"""SELECT id, s0 segment, balance, date '2024-01-01' start_date, CASE m WHEN 1 THEN date '2024-01-01' WHEN 2 THEN date '2024-01-02' ELSE date '9999-12-31' END end_date FROM {SEG}
            UNION ALL SELECT id, s2, balance, CASE m WHEN 1 THEN date '2024-01-02' ELSE date '2024-01-03' END, date '9999-12-31' FROM {SEG} WHERE m IN (1, 2)""", days="start_date end_date"),
    "scd2_compare": sql(
        f"""SELECT id, s1 segment, date '2024-01-02' start_date, date '9999-12-31' end_date, 1 is_current FROM {SEG}
            UNION ALL SELECT id, s0, date '2024-01-01', date '2024-01-01', 0 FROM {SEG} WHERE s0 <> s1""", days="start_date end_date", ints="is_current"),
    "scd2_lag": sql(
        f"""SELECT id, s0 segment, date '2024-01-01' start_date, CASE m WHEN 1 THEN date '2024-01-01' WHEN 2 THEN date '2024-01-02' ELSE date '9999-12-31' END end_date,
              CASE WHEN m IN (1, 2) THEN 0 ELSE 1 END is_current FROM {SEG}
            UNION ALL SELECT id, s2, CASE m WHEN 1 THEN date '2024-01-02' ELSE date '2024-01-03' END, date '9999-12-31', 1 FROM {SEG} WHERE m IN (1, 2)""",
        days="start_date end_date", ints="is_current"),
    "mask_and_hash": sql(
        """WITH u AS (SELECT c_custkey id, c_name, CASE WHEN c_custkey % 10 = 0 THEN 'n/a' ELSE '138' || lpad(cast(c_custkey AS varchar), 8, '0') END phone,
             CASE WHEN c_custkey % 9 = 0 THEN 'nobody' ELSE lower(replace(c_name, '#', '_')) || '@mail' || (c_custkey % 4) || '.com' END mail FROM customer)
---
SELECT id, c_name[1] || '*' short_name, c_name[1] || repeat('*', length(c_name) - 1) starred_name, CASE WHEN phone <> 'n/a' THEN phone[1:3] || '****' || phone[8:] END phone,
 CASE WHEN mail <> 'nobody' THEN '*@' || split_part(mail, '@', 2) END mail, md5(phone) phone_hash,
 lpad(cast(cast('0x' || right(md5(cast(id AS varchar)), 3) AS bigint) % 128 AS varchar), 4, '0') bucket,
 CASE WHEN id % 50 = 0 THEN ['9001','9006','9003','9007','9005','9002','9004'][id % 7 + 1] ELSE lpad(cast(cast('0x' || right(md5('0x' || id), 3) AS bigint) % 128 AS varchar), 4, '0') END address_bucket, 1 plain_mail, CASE WHEN id % 9 <> 0 AND id % 4 < 2 THEN mail END near_mail FROM u""",
        ints="plain_mail"),
    "hex_to_decimal": sql(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey * 100 + l_linenumber AS number, cast(l_orderkey * 100 + l_linenumber AS varchar) plain FROM lineitem""",
        ints="l_linenumber"),
    "text_helpers": sql(
        """SELECT event_id, CASE WHEN k % 2 = 0 THEN date_trunc('second', ts) ELSE ts END AS moment, strftime(ts, '%Y-%m-%d %H:%M:%S') iso,
           CASE WHEN k % 3 <> 0 THEN '["a","' || event_type || '"]' ELSE '["' || event_type || '"]' END list, CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END blank, event_type stripped,
           user_id || '_' || strftime(ts, '%Y%m%d%H%M%S') event_key FROM ev""", seconds="moment", ints="blank"),
    "part_attribute_sets": sql(
        """SELECT p_brand, '[' || string_agg('{"p_type":"' || p_type || '","p_size":' || p_size || '}', ',' ORDER BY p_type, p_size) || ']' kinds, max(p_partkey) p_partkey, max(p_retailprice) p_retailprice
           FROM (SELECT DISTINCT p.p_brand, p_type, p_size, b.p_partkey, b.p_retailprice FROM part p
                 JOIN (SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey DESC) rn FROM part) WHERE rn = 1) b
                 ON b.p_brand = p.p_brand) GROUP BY p_brand"""),
    "order_global_rank": sql(
        "SELECT o_orderkey, cast(floor(o_totalprice / 1000) AS bigint) price_k, rank() OVER (ORDER BY floor(o_totalprice / 1000) DESC) price_rank FROM orders"),
    "purchase_window_links": sql(
        """SELECT e.user_id, e.event_id, b.event_id buy_id FROM events e JOIN events b ON b.user_id = e.user_id AND b.event_type = 'purchase' AND e.event_type <> 'purchase'
           AND e.ts BETWEEN b.ts AND b.ts + interval 2 hour"""),
    "merge_latest": sql(
        f"""SELECT id, CASE m WHEN 1 THEN s1 WHEN 2 THEN s2 ELSE s0 END segment, balance,
            CASE m WHEN 1 THEN '2024-01-02' WHEN 2 THEN '2024-01-03' ELSE '2024-01-01' END || ' 08:00:00' operate_time FROM {SEG}"""),
    "signed_balance": sql(
        """SELECT o_orderpriority priority, count(*) FILTER (o_orderstatus <> 'F') n, sum(cast(o_totalprice AS decimal(16,2))) FILTER (o_orderstatus <> 'F') amount
           FROM orders GROUP BY o_orderpriority""", money="amount"),
    "sink_partitions": RETAIL_SQL["sku_favor_add_1d"],
    "sink_report": RETAIL_SQL["order_by_province"],
    "sink_report_text": sql(
        f"SELECT date '{E}' dt, n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END region FROM nation", days="dt", ints="n_nationkey region"),
    "source_orc_days": sql(f"SELECT event_id, ts, user_id, event_type, v AS value, k, dt FROM ev WHERE dt = date '{E}'", seconds="ts", money="value", ints="k", days="dt"),
    "source_raw_log": sql("SELECT session_id, page_id, view_time, during_time, dt FROM page_view", seconds="view_time", days="dt"),
    "load_and_verify": sql(
        f"""SELECT 'province' job, count(DISTINCT province_id) written FROM order_detail_inc WHERE dt = date '{O}' UNION ALL SELECT 'broken', -1
            UNION ALL SELECT 'users', count(*) FROM order_1d WHERE dt = date '{O}'"""),
}

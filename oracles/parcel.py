"""Parcel statements."""

from oracles.base import ORDERS_AS_OF as O
from oracles.base import sql as base_sql

D = f"date '{O}'"

PARCEL = """
district AS (SELECT DISTINCT 1000 + s_nationkey * 10 + s_suppkey % 4 id, 100 + s_nationkey parent_id FROM supplier),
region_info AS (
  SELECT *, 'R' || id dict_code, substr(name, 1, 8) short_name FROM (
    SELECT r_regionkey + 1 id, 0 parent_id, r_name AS name FROM region
    UNION ALL SELECT 100 + n_nationkey, n_regionkey + 1, n_name FROM nation
    UNION ALL SELECT id, parent_id, 'district ' || id FROM district)),
organ AS (
  SELECT o.*, r.name region_name, r.dict_code region_code, CASE WHEN org_parent_id IS NOT NULL THEN 'hub ' || p.name END org_parent_name FROM (
    SELECT 100 + n_nationkey id, 'hub ' || n_name org_name, 1 org_level, 100 + n_nationkey region_id, NULL org_parent_id FROM nation
    UNION ALL SELECT id, 'station ' || id, 2, id, parent_id FROM district) o
  LEFT JOIN region_info r ON r.id = region_id LEFT JOIN region_info p ON p.id = org_parent_id),
waybill AS (
  SELECT o_orderkey id, 'W' || lpad(cast(o_orderkey AS varchar), 10, '0') order_no,
    ['60010','60020','60030','60040','60050','60060','60070','60080','60999'][o_orderkey % 9 + 1] status,
    '7000' || (o_orderkey % 2 + 1) collect_type, o_custkey user_id,
    1000 + ((c_nationkey + 7) % 25) * 10 + o_orderkey % 4 receiver_district_id, 100 + (c_nationkey + 7) % 25 receiver_city_id,
    substr(c_name, 1, 1) || '*' receiver_name, 1000 + c_nationkey * 10 + o_orderkey % 4 sender_district_id, 100 + c_nationkey sender_city_id,
    n_regionkey + 1 sender_province_id, substr(reverse(c_name), 1, 1) || '*' sender_name, '8000' || (o_orderkey % 3 + 1) payment_type,
    o_orderkey % 3 + 1 cargo_num, cast(o_totalprice AS decimal(16,2)) amount, o_orderdate + interval 3 day estimate_arrive_time,
    o_orderkey % 1000 distance, o_orderdate + to_hours(cast(o_orderkey % 24 AS int)) made,
    o_orderdate + to_hours(cast(o_orderkey % 24 + o_orderkey % 72 AS int)) changed
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderkey % 50 <> 0),
cargo AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id, l_orderkey order_id,
    CASE l_returnflag WHEN 'A' THEN '81001' WHEN 'N' THEN '81002' ELSE '81003' END cargo_type, l_linenumber * 10 volume_length,
    l_suppkey % 50 volume_width, l_partkey % 40 volume_height, l_quantity weight FROM lineitem),
bound AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id, l_orderkey order_id, l_linenumber ln,
    CASE WHEN l_linenumber % 2 = 0 THEN 100 + l_suppkey % 25 ELSE 1000 + s_nationkey * 10 + l_suppkey % 4 END org_id,
    l_shipdate + to_hours(cast(l_partkey % 24 AS int)) came, l_suppkey
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey),
sorts AS (SELECT id, order_id, org_id, came + interval 2 hour sort_time, l_suppkey + 1 sorter_emp_id, cast(came + interval 2 hour AS date) dt FROM bound WHERE ln % 3 <> 0),
outs AS (SELECT id, order_id, org_id, came + interval 5 hour outbound_time, l_suppkey + 2 outbound_emp_id, cast(came + interval 5 hour AS date) dt FROM bound WHERE ln % 4 <> 0),
truck AS (
  SELECT id, id % 25 team_id, 'T-' || id plate, id % 7 truck_model_id, 'name 9000' || (id % 7 % 3 + 1) truck_model_type_name,
    '9000' || (id % 7 % 3 + 1) truck_model_type FROM (SELECT DISTINCT s_suppkey % 50 id FROM supplier)),
trip AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id, l_suppkey shift_id, l_suppkey % 20 line_id,
    100 + l_suppkey % 25 start_org_id, 'hub ' || n_name start_org_name, 100 + (l_suppkey + 3) % 25 end_org_id, l_linenumber order_num,
    l_suppkey driver1_emp_id, 'D*' driver1_name, CASE WHEN l_partkey % 3 <> 0 THEN l_partkey % 100 + 10000 END driver2_emp_id,
    CASE WHEN l_partkey % 3 <> 0 THEN 'D*' END driver2_name, l_suppkey % 50 truck_id, md5('T-' || (l_suppkey % 50)) truck_no,
    epoch_ms(l_shipdate) actual_start_time, epoch_ms(l_shipdate) + cast(l_quantity AS bigint) * 3600000 actual_end_time,
    cast(l_extendedprice AS decimal(16,2)) actual_distance, cast(l_quantity AS bigint) * 3600 finish_dur_sec,
    CASE WHEN s_suppkey IS NOT NULL AND cast(l_quantity AS bigint) * 60 > l_suppkey % 20 * 60 + 600 THEN 1 ELSE 0 END is_late,
    epoch_ms(l_shipdate) + CASE WHEN s_suppkey IS NOT NULL THEN (l_suppkey % 20 * 60 + 600) * 60000 END estimate_end_time,
    cast(l_shipdate + to_hours(cast(l_quantity AS int)) AS date) dt
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = l_suppkey % 25 WHERE l_linenumber <> 7),
cargo_orders AS (
  SELECT DISTINCT w.id order_id, cargo_type, 'name ' || cargo_type cargo_type_name, sender_district_id, sender_city_id, amount, cast(made AS date) dt
  FROM waybill w JOIN cargo ON order_id = w.id),
cargo_1d AS (
  SELECT g.id org_id, g.org_name, sender_city_id city_id, r.name city_name, cargo_type, cargo_type_name, dt, count(*) order_count, sum(amount) order_amount
  FROM cargo_orders c LEFT JOIN organ g ON g.region_id = sender_district_id LEFT JOIN region_info r ON r.id = sender_city_id GROUP BY ALL),
received AS (SELECT id order_id, amount, sender_district_id, cast(changed AS date) dt FROM waybill w WHERE status NOT IN ('60010','60020','60999') AND id IN (SELECT order_id FROM cargo)),
delivered AS (SELECT id order_id, amount, sender_district_id, cast(changed AS date) dt FROM waybill w WHERE status NOT IN ('60020','60030') AND id IN (SELECT order_id FROM cargo)),
dispatched AS (SELECT id order_id, amount, cast(changed AS date) dt FROM waybill w WHERE status IN ('60050','60060','60070','60080') AND id IN (SELECT order_id FROM cargo)),
station AS (
  SELECT g.id org_id, g.org_name, region_id, c.id city_id, c.name city_name, p.id province_id, p.name province_name
  FROM organ g JOIN region_info c ON c.id = org_parent_id JOIN region_info p ON p.id = c.parent_id WHERE org_level = 2),
depot AS (
  SELECT org_id, org_name, city_id, city_name, province_id, province_name FROM station
  UNION ALL SELECT g.id, g.org_name, c.id, c.name, p.id, p.name
  FROM organ g JOIN region_info c ON c.id = g.region_id JOIN region_info p ON p.id = c.parent_id WHERE org_level = 1),
receive_1d AS (SELECT org_id, org_name, city_id, city_name, province_id, province_name, dt, count(*) order_count, sum(amount) order_amount
  FROM received LEFT JOIN station ON region_id = sender_district_id GROUP BY ALL),
deliver_1d AS (SELECT org_id, org_name, city_id, city_name, province_id, province_name, dt, count(*) order_count
  FROM delivered LEFT JOIN station ON region_id = sender_district_id GROUP BY ALL),
sort_1d AS (SELECT s.org_id, org_name, city_id, city_name, province_id, province_name, dt, count(*) sort_count
  FROM sorts s LEFT JOIN depot d ON d.org_id = s.org_id GROUP BY ALL),
recent AS (SELECT 1 n UNION ALL SELECT 7 UNION ALL SELECT 30),
shift_nd AS (
  SELECT n recent_days, shift_id, line_id, start_org_id org_id, start_org_name org_name, driver1_emp_id, driver1_name, driver2_emp_id, driver2_name,
    truck_id, count(*) trans_finish_count, sum(actual_distance) trans_finish_distance, sum(finish_dur_sec) trans_finish_dur_sec,
    sum(order_num) trans_finish_order_count, sum(is_late) trans_finish_delay_count
  FROM trip, recent WHERE n > 1 AND dt BETWEEN date 'AS_OF' - n + 1 AND date 'AS_OF' GROUP BY ALL)
""".replace("AS_OF", O)


def sql(body: str, **kw) -> str:
    return base_sql(body, prelude=PARCEL, **kw)


WB_IDS = "receiver_district_id receiver_city_id sender_district_id sender_city_id sender_province_id"


def event(time: str, column: str, rule: str) -> str:
    return sql(
        f"""SELECT c.*, w.* EXCLUDE (id, made, changed), w.{column} {time}, 'name ' || cargo_type cargo_type_name, 'name ' || status status_name,
            'name ' || collect_type collect_type_name, 'name ' || payment_type payment_type_name, cast(w.{column} AS date) dt
            FROM cargo c JOIN waybill w ON c.order_id = w.id WHERE {rule}""",
        days="dt", seconds=f"{time} estimate_arrive_time", ints=WB_IDS + " volume_length", money="amount")


def daily(rule: str) -> str:
    return sql(
        f"""SELECT id order_id, order_no, user_id, amount, sender_city_id, receiver_city_id, status, changed event_time FROM waybill
            WHERE cast(changed AS date) = {D} AND cast(made AS date) <= {D} AND {rule}""",
        seconds="event_time", ints="sender_city_id receiver_city_id", money="amount")


def over(table: str, keys: str, sums: str, ns=(1, 7, 30)) -> str:
    """Daily table summed for each horizon."""
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {n} recent_days, {lead}{sums} FROM {table} WHERE dt BETWEEN {D} - {n} + 1 AND {D} {group}" for n in ns
    )


def express(keys: str) -> str:
    """The three streams joined on null-safe keys, independent of the union form."""
    ks = [k.strip() for k in keys.split(",")] if keys else []
    parts = {
        "a": over("receive_1d", keys, "sum(order_count) receive_order_count, sum(order_amount) receive_order_amount"),
        "b": over("deliver_1d", keys, "sum(order_count) deliver_suc_count"),
        "c": over("sort_1d", keys, "sum(sort_count) sort_count"),
    }
    all_keys = ["recent_days", *ks]
    universe = " UNION ".join(f"SELECT {', '.join(all_keys)} FROM {p}" for p in parts)
    joins = " ".join("LEFT JOIN %s ON %s" % (p, " AND ".join(f"u.{k} IS NOT DISTINCT FROM {p}.{k}" for k in all_keys)) for p in parts)
    ctes = ", ".join(f"{p} AS ({q})" for p, q in parts.items())
    return sql(
        f"""WITH {ctes}
---
SELECT {D} dt, u.*, receive_order_count, receive_order_amount, deliver_suc_count, sort_count FROM ({universe}) u {joins}""",
        days="dt", money="receive_order_amount",
        ints="recent_days receive_order_count deliver_suc_count sort_count " + " ".join(k for k in ks if k.endswith("_id")))


TRIP_SUMS = "sum(trans_finish_count) trans_finish_count, sum(trans_finish_distance) trans_finish_distance, sum(trans_finish_dur_sec) trans_finish_dur_sec"
TRIP_RAW = "count(*) trans_finish_count, sum(actual_distance) trans_finish_distance, sum(finish_dur_sec) trans_finish_dur_sec"
MEANS = """cast(trans_finish_distance AS double) / trans_finish_count avg_trans_finish_distance,
           cast(trans_finish_dur_sec AS double) / trans_finish_count avg_trans_finish_dur_sec"""
TRIP_TYPES = dict(money="trans_finish_distance", ints="recent_days trans_finish_count trans_finish_dur_sec")


def orders_and_trips(keys: str, trip_keys: str) -> str:
    k = [x.strip() for x in keys.split(",")]
    on = " AND ".join(f"a.{x} IS NOT DISTINCT FROM b.{x}" for x in ["recent_days", *k])
    return sql(
        f"""WITH a AS ({over('cargo_1d', keys, 'sum(order_count) order_count, sum(order_amount) order_amount')}),
            t AS (SELECT trip.*, c.id city_id, c.name city_name, start_org_id org_id, start_org_name org_name FROM trip JOIN region_info c ON c.id = start_org_id),
            b AS (SELECT *, {MEANS} FROM ({over('t', trip_keys, TRIP_RAW)}))
---
SELECT {D} dt, coalesce(a.recent_days, b.recent_days) recent_days, {', '.join(f'coalesce(a.{x}, b.{x}) {x}' for x in k)}, order_count, order_amount,
 trans_finish_count, trans_finish_distance, trans_finish_dur_sec, avg_trans_finish_distance, avg_trans_finish_dur_sec FROM a FULL JOIN b ON {on}""",
        days="dt", money="order_amount trans_finish_distance", ints=f"recent_days order_count trans_finish_count trans_finish_dur_sec {k[0]}")


DEPOT_INTS = "org_id city_id province_id"
NEVER_PAID = "status NOT IN ('60020', '60030')"

SQL = {
    "parcel_complex_dim": sql(
        """SELECT d.id + 5000 id, 'complex ' || d.id complex_name, c.id city_id, d.id district_id, 'district ' || d.id district_name, c.name city_name,
           p.id province_id, p.name province_name,
           (SELECT '["' || string_agg(DISTINCT cast(s_suppkey + 900 AS varchar), '","' ORDER BY cast(s_suppkey + 900 AS varchar)) || '"]' FROM supplier
            WHERE 1000 + s_nationkey * 10 + s_suppkey % 4 = d.id) courier_emp_ids
           FROM district d JOIN region_info c ON c.id = d.parent_id JOIN region_info p ON p.id = c.parent_id""",
        ints="id city_id district_id province_id"),
    "parcel_courier_dim": sql(
        """SELECT s_suppkey id, s_suppkey + 900 emp_id, 100 + s_nationkey org_id, 'hub ' || n_name org_name,
           md5('139' || lpad(cast(s_suppkey AS varchar), 8, '0')) working_phone, '7000' || (s_suppkey % 2 + 1) express_type,
           'name 7000' || (s_suppkey % 2 + 1) express_type_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""", ints="org_id"),
    "parcel_organ_dim": sql("SELECT * FROM organ", ints="id org_level region_id org_parent_id"),
    "parcel_region_dim": sql("SELECT * FROM region_info", ints="id parent_id"),
    "parcel_shift_dim": sql(
        """SELECT s_suppkey id, s_suppkey % 20 line_id, lpad(cast(s_suppkey % 24 AS varchar), 2, '0') || ':00' start_time, s_suppkey driver1_emp_id,
           s_suppkey % 50 truck_id, 'line ' || (s_suppkey % 20) line_name, 'L' || (s_suppkey % 20) line_no,
           '9100' || (s_suppkey % 20 % 2 + 1) transport_line_type_id, 'name 9100' || (s_suppkey % 20 % 2 + 1) transport_line_type_name,
           s_suppkey % 20 * 10 + 50 distance, s_suppkey % 20 * 60 + 600 estimated_time FROM supplier"""),
    "parcel_driver_dim": sql(
        """SELECT s_suppkey id, s_suppkey + 500 emp_id, 100 + s_nationkey org_id, 'hub ' || h.n_name org_name, s_suppkey % 30 team_id, 'team ' || t.n_name team_name,
           CASE WHEN s_suppkey % 4 = 0 THEN '1970-01-01 00:00:00' ELSE strftime(date '2010-01-01' + cast(s_suppkey % 3000 AS int), '%Y-%m-%d 00:00:00') END init_license_date,
           CASE WHEN s_suppkey % 5 = 0 THEN '2099-12-31 23:59:59' ELSE strftime(date '2010-01-01' + cast(s_suppkey % 3000 + 3650 AS int), '%Y-%m-%d 00:00:00') END expire_date
           FROM supplier JOIN nation h ON s_nationkey = h.n_nationkey LEFT JOIN nation t ON t.n_nationkey = s_suppkey % 30""", ints="org_id"),
    "parcel_truck_dim": sql(
        """SELECT t.id, team_id, 'team ' || n_name team_name, md5(plate) truck_no, truck_model_id, 'model ' || truck_model_id truck_model_name, truck_model_type,
           truck_model_type_name, '9100' || (truck_model_id % 2 + 1) truck_brand, 'name 9100' || (truck_model_id % 2 + 1) truck_brand_name,
           truck_model_id * 1000 + 2000 load_weight, 100 + team_id org_id, 'hub ' || n_name org_name FROM truck t JOIN nation ON n_nationkey = team_id"""),
    "parcel_address_history": sql(
        """SELECT c_custkey id, c_custkey user_id, md5('138' || lpad(cast(c_custkey AS varchar), 8, '0')) phone, 100 + c_nationkey city_id,
           'street ' || c_custkey address, c_custkey % 2 is_default, timestamp '2000-01-01 08:30:00' + to_hours(cast(c_custkey % 500 AS int)) start_date,
           '9999-12-31' end_date FROM customer""", ints="city_id", seconds="start_date"),
    "parcel_user_history": sql(
        """SELECT c_custkey id, c_name login_name, c_mktsegment user_level, date '1970-01-01' + cast(c_custkey % 9000 AS int) birthday,
           CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END gender, date '1970-01-01' + cast(c_custkey AS int) start_date, date '9999-12-31' end_date FROM customer""",
        days="birthday start_date end_date"),
    "parcel_inbound_fact": sql("SELECT id, order_id, org_id, came inbound_time, l_suppkey inbound_emp_id, cast(came AS date) dt FROM bound", seconds="inbound_time", days="dt"),
    "parcel_outbound_fact": sql("SELECT * FROM outs", seconds="outbound_time", days="dt"),
    "parcel_sort_fact": sql("SELECT * FROM sorts", seconds="sort_time", days="dt"),
    "parcel_sort_fact_daily": sql(f"SELECT * FROM sorts WHERE dt = {D}", seconds="sort_time", days="dt"),
    "parcel_outbound_fact_daily": sql(f"SELECT * FROM outs WHERE dt = {D}", seconds="outbound_time", days="dt"),
    "parcel_order_fact": event("order_time", "made", "true"),
    "parcel_cancel_fact": event("cancel_time", "changed", "status = '60050'"),
    "parcel_pay_fact": event("payment_time", "changed", "status NOT IN ('60010', '60999')"),
    "parcel_receive_fact": event("receive_time", "changed", "status NOT IN ('60010', '60020', '60999')"),
    "parcel_dispatch_fact": event("dispatch_time", "changed", "status IN ('60050', '60060', '60070', '60080')"),
    "parcel_bound_finish_fact": event("bound_finish_time", "changed", NEVER_PAID),
    "parcel_deliver_fact": event("deliver_suc_time", "changed", NEVER_PAID),
    "parcel_sign_fact": event("sign_time", "changed", NEVER_PAID),
    "parcel_order_process": sql(
        """SELECT c.*, w.* EXCLUDE (id, made, changed), 'name ' || cargo_type cargo_type_name, 'name ' || status status_name,
            'name ' || collect_type collect_type_name, 'name ' || payment_type payment_type_name, cast(made AS date) start_date,
            CASE WHEN status IN ('60040', '60050') THEN cast(changed AS date) ELSE date '9999-12-31' END end_date,
            CASE WHEN status IN ('60040', '60050') THEN cast(changed AS date) ELSE date '9999-12-31' END dt
            FROM cargo c JOIN waybill w ON c.order_id = w.id""",
        days="dt start_date end_date", seconds="estimate_arrive_time", ints=WB_IDS + " volume_length", money="amount"),
    "parcel_cancel_daily": daily("status = '60050'"),
    "parcel_receive_daily": daily("status NOT IN ('60010', '60020', '60999')"),
    "parcel_trip_fact": sql("SELECT * FROM trip", days="dt", money="actual_distance", ints="order_num is_late"),
    "parcel_cargo_type_1d": sql("SELECT * FROM cargo_1d", days="dt", money="order_amount", ints="org_id city_id"),
    "parcel_cargo_type_nd": sql(
        over("cargo_1d", "org_id, org_name, city_id, city_name, cargo_type, cargo_type_name", "sum(order_count) order_count, sum(order_amount) order_amount", (7, 30)),
        money="order_amount", ints="recent_days order_count org_id city_id"),
    "parcel_bound_finish_td": sql(f"SELECT count(*) order_count, sum(amount) order_amount FROM delivered WHERE dt <= {D}", money="order_amount"),
    "parcel_dispatch_1d": sql("SELECT dt, count(*) order_count, sum(amount) order_amount FROM dispatched GROUP BY dt", days="dt", money="order_amount"),
    "parcel_dispatch_nd": sql(over("dispatched", "", "count(*) order_count, sum(amount) order_amount", (7, 30)), money="order_amount", ints="recent_days"),
    "parcel_dispatch_td": sql(f"SELECT count(*) order_count, sum(amount) order_amount FROM dispatched WHERE dt <= {D}", money="order_amount"),
    "parcel_deliver_1d": sql("SELECT * FROM deliver_1d", days="dt", ints=DEPOT_INTS),
    "parcel_deliver_nd": sql(over("deliver_1d", "org_id, org_name, city_id, city_name, province_id, province_name", "sum(order_count) order_count", (7, 30)),
        ints=f"recent_days order_count {DEPOT_INTS}"),
    "parcel_receive_1d": sql("SELECT * FROM receive_1d", days="dt", ints=DEPOT_INTS, money="order_amount"),
    "parcel_receive_nd": sql(over("receive_1d", "org_id, org_name, city_id, city_name, province_id, province_name",
        "sum(order_count) order_count, sum(order_amount) order_amount", (7, 30)), ints=f"recent_days order_count {DEPOT_INTS}", money="order_amount"),
    "parcel_sort_1d": sql("SELECT * FROM sort_1d", days="dt", ints=DEPOT_INTS),
    "parcel_sort_nd": sql(over("sort_1d", "org_id, org_name, city_id, city_name, province_id, province_name", "sum(sort_count) sort_count", (7, 30)),
        ints=f"recent_days sort_count {DEPOT_INTS}"),
    "parcel_truck_model_trips_1d": sql(
        f"""SELECT start_org_id org_id, start_org_name org_name, truck_model_type, truck_model_type_name, dt, {TRIP_RAW}
            FROM trip LEFT JOIN truck ON truck.id = truck_id GROUP BY ALL""",
        days="dt", money="trans_finish_distance", ints="trans_finish_dur_sec"),
    "parcel_shift_trips_nd": sql(
        """SELECT s.*, org_id city_id, n_name city_name, CASE WHEN su.s_suppkey IS NOT NULL THEN 'line ' || line_id END line_name, truck_model_type, truck_model_type_name
           FROM shift_nd s LEFT JOIN nation ON n_nationkey + 100 = org_id LEFT JOIN truck t ON t.id = truck_id LEFT JOIN supplier su ON su.s_suppkey = shift_id""",
        money="trans_finish_distance", ints="recent_days trans_finish_dur_sec trans_finish_order_count trans_finish_delay_count"),
    "parcel_city_stats": orders_and_trips("city_id, city_name", "city_id, city_name"),
    "parcel_org_stats": orders_and_trips("org_id, org_name", "org_id, org_name"),
    "parcel_driver_stats": sql(
        f"""WITH trips AS (SELECT recent_days, driver1_emp_id driver_id, driver1_name driver_name, CASE WHEN driver2_emp_id IS NULL THEN 2 ELSE 1 END w, s.*
              FROM shift_nd s UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, 1, s.* FROM shift_nd s WHERE driver2_emp_id IS NOT NULL),
            d AS (SELECT recent_days, driver_id, driver_name, sum(w * trans_finish_count) / 2 trans_finish_count,
              cast(sum(w * trans_finish_distance * 5) AS double) / 10 trans_finish_distance, sum(w * trans_finish_dur_sec) / 2 trans_finish_dur_sec,
              sum(w * trans_finish_delay_count) / 2 trans_finish_late_count FROM trips GROUP BY 1, 2, 3)
---
SELECT {D} dt, *, {MEANS} FROM d""", days="dt", ints="recent_days"),
    "parcel_express_city_stats": express("city_id, city_name"),
    "parcel_express_org_stats": express("org_id, org_name"),
    "parcel_express_province_stats": express("province_id, province_name"),
    "parcel_express_province_full_join": express("province_id, province_name") ,
    "parcel_express_stats": express(""),
    "parcel_line_stats": sql(
        f"""SELECT {D} dt, recent_days, line_id, 'line ' || line_id AS name, {TRIP_SUMS}, sum(trans_finish_order_count) trans_finish_order_count
            FROM shift_nd GROUP BY ALL""",
        days="dt", money="trans_finish_distance", ints="recent_days trans_finish_count trans_finish_dur_sec trans_finish_order_count"),
    "parcel_shift_stats": sql(
        f"""SELECT {D} dt, recent_days, shift_id, {TRIP_SUMS}, sum(trans_finish_order_count) trans_finish_order_count FROM shift_nd GROUP BY ALL""",
        days="dt", money="trans_finish_distance", ints="recent_days trans_finish_count trans_finish_dur_sec trans_finish_order_count"),
    "parcel_truck_stats": sql(
        f"""SELECT {D} dt, *, {MEANS} FROM (SELECT recent_days, truck_model_type, truck_model_type_name, {TRIP_SUMS}
            FROM shift_nd LEFT JOIN truck ON truck.id = truck_id GROUP BY ALL)""", days="dt", **TRIP_TYPES),
    "parcel_order_stats": sql(
        f"SELECT {D} dt, * FROM ({over('cargo_1d', '', 'sum(order_count) order_count, sum(order_amount) order_amount')})",
        days="dt", money="order_amount", ints="recent_days order_count"),
    "parcel_order_cargo_type_stats": sql(
        f"SELECT {D} dt, * FROM ({over('cargo_1d', 'cargo_type, cargo_type_name', 'sum(order_count) order_count, sum(order_amount) order_amount')})",
        days="dt", money="order_amount", ints="recent_days order_count"),
    "parcel_trip_stats": sql(f"SELECT {D} dt, * FROM ({over('trip', '', TRIP_RAW)})", days="dt", **TRIP_TYPES),
    "parcel_receive_dispatch_stats": sql(
        f"""SELECT {D} dt, a.*, dispatch_order_count, dispatch_order_amount FROM
            ({over('received', '', 'nullif(count(*), 0) receive_order_count, sum(amount) receive_order_amount')}) a JOIN
            ({over('dispatched', '', 'nullif(count(*), 0) dispatch_order_count, sum(amount) dispatch_order_amount')}) b USING (recent_days)""",
        days="dt", money="receive_order_amount dispatch_order_amount", ints="recent_days"),
    "parcel_open_balance_td": sql(
        f"""SELECT {D} dt, (SELECT count(*) FROM dispatched WHERE dt <= {D}) - (SELECT count(*) FROM delivered WHERE dt <= {D}) bounding_order_count,
            (SELECT sum(amount) FROM dispatched WHERE dt <= {D}) - (SELECT sum(amount) FROM delivered WHERE dt <= {D}) bounding_order_amount""",
        days="dt", money="bounding_order_amount"),
}

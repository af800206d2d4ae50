"""Operators against brute force on small frames, with hot keys."""

import random
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.functions.ratios import percent, rate
from tallyflow.functions.times import day, day_range, epoch_any
from tallyflow.operators import deltas, history, todate
from tallyflow.operators.align import align_join, align_union
from tallyflow.operators.distinct import bitmap_horizons, daily_bitmaps, horizon_profile
from tallyflow.operators.horizons import explode_horizons, horizon_rows, horizon_sums
from tallyflow.operators.ordered import consecutive_by_islands, consecutive_by_lead, consecutive_by_mask, number_and_next
from tallyflow.operators.ranking import percent_rank_whole, rank_whole, top_with_ties
from tallyflow.operators.rangejoin import crowded_slices, link_points


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_rank_whole_equals_window_with_hot_and_null_values(spark):
    rng = random.Random(7)
    values = [None] * 5 + [50] * 400 + [rng.randint(0, 300) for _ in range(800)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int").repartition(7)
    for down in (True, False):
        way = F.desc_nulls_last("v") if down else F.asc_nulls_last("v")
        want = df.withColumn("rk", F.rank().over(Window.orderBy(way)))
        assert tuples(rank_whole(df, "v", "rk", down, slices=16), "id", "rk") == tuples(want, "id", "rk")


def test_percent_rank_whole(spark):
    df = spark.createDataFrame([(i, i % 11) for i in range(200)], "id int, v int")
    want = df.withColumn("p", F.percent_rank().over(Window.orderBy(F.desc("v"))))
    assert tuples(percent_rank_whole(df, "v", "p"), "id", "p") == tuples(want, "id", "p")


def test_percent_rank_of_one_row(spark):
    df = spark.createDataFrame([(1, 2)], "id int, v int")
    assert percent_rank_whole(df, "v", "p").first().p == 0.0


def test_number_and_next_never_broadcasts_its_slices(spark):
    """Columns parsed from a text make Spark guess the slices far too small."""
    log = spark.range(50).select(F.to_json(F.struct((F.col("id") % 7).alias("k"), F.timestamp_seconds("id").alias("at"), F.col("id").alias("page"))).alias("log"))
    df = log.select(F.from_json("log", "k int, at timestamp, page bigint").alias("l")).select("l.*")
    got = number_and_next(df, ["k"], ["at"], F.date_trunc("HOUR", "at"), "page")
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 50


def test_number_and_next_equals_window_for_a_hot_key(spark):
    start = datetime(2024, 1, 1)
    rows = [("hot", start + timedelta(minutes=7 * i), f"p{i % 9}") for i in range(700)]
    rows += [(f"k{i}", start + timedelta(hours=i, minutes=j * 50), f"q{j}") for i in range(40) for j in range(3)]
    rows += [(None, start + timedelta(hours=i), "n") for i in range(5)]
    df = spark.createDataFrame(rows, "k string, at timestamp, page string")
    w = Window.partitionBy("k").orderBy("at")
    want = df.withColumn("rn", F.row_number().over(w)).withColumn("nxt", F.lead("page").over(w))
    got = number_and_next(df, ["k"], ["at"], F.date_trunc("HOUR", "at"), "page", "rn", "nxt")
    assert tuples(got, "k", "at", "rn", "nxt") == tuples(want, "k", "at", "rn", "nxt")


def test_link_points_equals_theta_join_across_slices(spark):
    start = datetime(2024, 1, 1)
    rng = random.Random(3)
    spans = [(i % 3, i, start + timedelta(minutes=rng.randint(0, 3000)), rng.randint(0, 400)) for i in range(60)]
    spans = [(u, i, s, s + timedelta(minutes=m)) for u, i, s, m in spans]
    points = [(rng.randint(0, 3), j, start + timedelta(minutes=rng.randint(0, 3400))) for j in range(300)]
    a = spark.createDataFrame(points, "u int, j int, at timestamp")
    b = spark.createDataFrame(spans, "u int, i int, s timestamp, e timestamp")
    want = sorted((j, i) for u, j, at in points for v, i, s, e in spans if u == v and s <= at <= e)
    assert sorted((r.j, r.i) for r in link_points(a, b, ["u"], "at", "s", "e").collect()) == want


def test_link_points_of_a_crowded_hour(spark):
    """A key with most rows in one hour, many of them at one moment, and a few elsewhere."""
    rng, start = random.Random(3), datetime(2024, 1, 1)
    at = lambda s: start + timedelta(seconds=s)
    points = [("hot", k, at(rng.choice((600, 601.5, rng.uniform(0, 3599))))) for k in range(3000)] + [("cold", k, at(rng.uniform(0, 9000))) for k in range(200)]
    points += points[:5]
    spans = [(u, k, at(s), at(s + rng.uniform(0, d))) for k, (u, s, d) in enumerate([("hot", rng.uniform(-100, 3600), 400) for _ in range(60)] + [("cold", rng.uniform(0, 9000), 9000) for _ in range(40)] + [("hot", 600, 0)])]
    p, i = spark.createDataFrame(points, "u string, j int, at timestamp"), spark.createDataFrame(spans, "u string, i int, s timestamp, e timestamp")
    want = sorted((j, i_) for u, j, t in points for v, i_, s, e in spans if u == v and s <= t <= e)
    for most in (50, 100_000):
        assert sorted((r.j, r.i) for r in link_points(p, i, ["u"], "at", "s", "e", most=most).collect()) == want
    sliced = p.withColumn("_slice", F.date_trunc("HOUR", "at")).withColumn("_us", F.unix_micros("at"))
    [cuts] = crowded_slices(sliced, ["u", "_slice"], 500).collect()
    assert cuts.u == "hot" and len(cuts["_cuts"]) > 50 and max(cuts["_copies"]) >= 2


def test_distincts_of_nested_horizons(spark):
    rng = random.Random(5)
    rows = [(rng.choice(("a", "a", "a", "b", None)), rng.choice((None, *range(40))), rng.choice("xyz"), rng.randint(1, 9), date(2024, 1, rng.randint(1, 31))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, w string, n int, dt date")
    as_of = "2024-01-20"
    got = horizon_profile(df, as_of, ["k"], {"n": F.col("n")}, {"vs": "v", "ws": "w"}, (1, 3, 7, 15))
    want = explode_horizons(df, as_of, (1, 3, 7, 15)).groupBy("recent_days", "k").agg(F.sum("n").alias("n"), F.countDistinct("v").alias("vs"), F.countDistinct("w").alias("ws"))
    cols = ["recent_days", "k", "n", "vs", "ws"]
    assert tuples(got, *cols) == tuples(want, *cols)
    numbers = df.withColumn("v", F.col("v") * 5000)
    bits = bitmap_horizons(daily_bitmaps(numbers, ["k"], "v"), as_of, ["k"], "vs", (1, 3, 7, 15))
    assert tuples(bits, "recent_days", "k", "vs") == tuples(want.where("vs > 0"), "recent_days", "k", "vs")


def test_signed_changes_equal_a_rebuild(spark):
    rng = random.Random(6)
    a = [(rng.randint(0, 30), rng.randint(1, 5), rng.randint(1, 100)) for _ in range(400)]
    b = [(k, rng.randint(0, 3)) for k in range(31)]
    new_a = [r for r in a if rng.random() > 0.1] + [(rng.randint(0, 30), 3, 7) for _ in range(20)] + a[:3]
    new_b = [(k, v if k % 7 else 3) for k, v in b]
    frame = lambda rows, s: spark.createDataFrame(rows, s)
    left, left2 = frame(a, "k int, d int, n int"), frame(new_a, "k int, d int, n int")
    right, right2 = frame(b, "k int, g int"), frame(new_b, "k int, g int")
    total = lambda x, y: x.join(y, "k").groupBy("g", "d").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    delta = deltas.summed_changes(deltas.joined_changes(left, deltas.changes_between(left, left2), right, deltas.changes_between(right, right2), ["k"]), ["g", "d"], ["n"], "c")
    assert tuples(deltas.applied(total(left, right), delta, ["g", "d"], ["n"], "c"), "g", "d", "c", "n") == tuples(total(left2, right2), "g", "d", "c", "n")


def test_three_consecutive_day_forms_agree(spark):
    rng = random.Random(5)
    as_of = date(2024, 1, 7)
    rows = {(u, as_of - timedelta(days=rng.randint(0, 6))) for u in range(300) for _ in range(4)}
    days = spark.createDataFrame(sorted(rows), "u int, dt date")
    want = sorted({u for u, d in rows if (u, d + timedelta(1)) in rows and (u, d + timedelta(2)) in rows})
    for df in (consecutive_by_lead(days, "u", 3), consecutive_by_islands(days, "u", 3), consecutive_by_mask(days, "u", 3, day("2024-01-07"))):
        assert sorted(r.u for r in df.collect()) == want


def test_horizon_forms_agree(spark):
    rows = [(i % 5, date(2024, 1, 30) - timedelta(days=i % 40), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, dt date, m int")
    wide = horizon_sums(df, "2024-01-30", ["k"], ["m"])
    a = horizon_rows(wide, ["k"], ["m"])
    b = explode_horizons(df, "2024-01-30", (7, 30)).groupBy("k", "recent_days").agg(F.sum("m").alias("m"))
    assert tuples(a, "k", "recent_days", "m") == tuples(b, "k", "recent_days", "m")


def test_to_date_forms_agree(spark):
    rows = [(i % 17, date(2024, 1, 1) + timedelta(days=i % 10), i) for i in range(300)]
    daily = spark.createDataFrame(rows, "u int, dt date, n int").groupBy("u", "dt").agg(F.sum("n").alias("n"))
    whole = todate.rebuild(daily, ["u"], ["n"], "f", "l", "2024-01-10")
    held = todate.rebuild(daily, ["u"], ["n"], "f", "l", "2024-01-09")
    today = daily.where(F.col("dt") == "2024-01-10")
    for step in (todate.carry_union, todate.carry_full_join):
        assert tuples(step(held, today, ["u"], ["n"], "f", "l"), "u", "f", "l", "n") == tuples(whole, "u", "f", "l", "n")


def test_align_forms_agree_with_null_keys(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, None, 6)], "k int, t string, a int")
    b = spark.createDataFrame([(2, None, 7), (3, "y", 8)], "k int, t string, b int")
    c = spark.createDataFrame([(1, "x", 9)], "k int, t string, c int")
    cols = ["k", "t", "a", "b", "c"]
    assert tuples(align_union([a, b, c], ["k", "t"]), *cols) == tuples(align_join([a, b, c], ["k", "t"]), *cols)
    assert tuples(align_union([a, b, c], ["k", "t"]), *cols) == sorted([(1, "x", 5, None, 9), (2, None, 6, 7, None), (3, "y", None, 8, None)], key=repr)


def test_top_with_ties_keeps_all_ties(spark):
    df = spark.createDataFrame([("g", i, 10 if i < 5 else 1) for i in range(20)], "g string, i int, v int")
    assert top_with_ties(df, ["g"], "v", 3).count() == 5


def test_accumulating_fact_day_by_day_equals_first_load(spark):
    rng = random.Random(11)
    base = date(2024, 1, 1)
    orders = [(i, base + timedelta(days=rng.randint(0, 6))) for i in range(120)]
    pays = [(i, d + timedelta(days=rng.randint(0, 2))) for i, d in orders if i % 3]
    fins = [(i, d + timedelta(days=rng.randint(2, 4))) for i, d in orders if i % 4 == 0]
    o = spark.createDataFrame([(i, datetime.combine(d, datetime.min.time()), d) for i, d in orders], "order_id int, order_time timestamp_ntz, d date")
    p = spark.createDataFrame([(i, datetime.combine(d, datetime.min.time()), i * 10, d) for i, d in pays], "order_id int, payment_time timestamp_ntz, payment_amount int, d date")
    f = spark.createDataFrame([(i, datetime.combine(d, datetime.min.time()), d) for i, d in fins], "order_id int, finish_time timestamp_ntz, d date")
    until = lambda df, n: df.where(F.col("d") <= F.lit(base + timedelta(days=n))).drop("d")
    on = lambda df, n: df.where(F.col("d") == F.lit(base + timedelta(days=n))).drop("d")
    table = {(r.order_id, r.payment_time, r.payment_amount, r.finish_time, r.dt) for r in history.flow_first(until(o, 2), until(p, 2), until(f, 2)).collect()}
    cols = "order_id int, payment_time timestamp_ntz, payment_amount int, finish_time timestamp_ntz, dt date"
    for n in (3, 4, 5):
        held = spark.createDataFrame([r for r in table if r[4] == date(9999, 12, 31)], cols)
        new = history.flow_daily(held, on(o, n).drop("order_time"), on(p, n), on(f, n)).select("order_id", "payment_time", "payment_amount", "finish_time", "dt").collect()
        table = {r for r in table if r[4] != date(9999, 12, 31)} | {tuple(r) for r in new}
    want = {(r.order_id, r.payment_time, r.payment_amount, r.finish_time, r.dt) for r in history.flow_first(until(o, 5), until(p, 5), until(f, 5)).collect()}
    assert table == want


def test_history_rank_is_stable_on_rerun(spark):
    held = spark.createDataFrame([(1, "a", date(2024, 1, 1), date(9999, 12, 31)), (2, "b", date(2024, 1, 1), date(9999, 12, 31))], "id int, v string, start_date date, end_date date")
    held = held.withColumn("operate_time", F.lit("t0"))
    changes = spark.createDataFrame([(1, "c", "t2"), (1, "x", "t1"), (3, "n", "t1")], "id int, v string, operate_time string")
    once = history.history_rank(held, changes, "id", "2024-01-02")
    got = {(r.id, r.v, str(r.start_date), str(r.end_date)) for r in once.collect()}
    assert got == {(1, "c", "2024-01-02", "9999-12-31"), (1, "a", "2024-01-01", "2024-01-01"), (2, "b", "2024-01-01", "9999-12-31"), (3, "n", "2024-01-02", "9999-12-31")}


def test_hex_numbers_of_any_length(spark):
    values = ["0x" + hex(10**30 + 7)[2:].zfill(64), "0x" + "f" * 31, hex(10**38 - 1), hex(10**38), "0x" + "f" * 64, "0x", "0xZZ", "0x0"]
    got = [r.n for r in spark.createDataFrame([(v,) for v in values], "v string").select(clean.hex_to_number("v").cast("string").alias("n")).collect()]
    assert got == [str(10**30 + 7), str(16**31 - 1), str(10**38 - 1), None, None, "0", None, "0"]


def test_cleaning(spark):
    hot = "0xdAC17F958D2ee523a2206206994597C13D831ec7"
    big = hex(2**118 + 12345)
    row = spark.createDataFrame([(hot, big, "0xff", "17", None, " \x01a\x7f ")], "hot string, big string, h string, d string, n string, t string").select(
        clean.hash_bucket("hot", overrides=clean.HOT_ADDRESS_BUCKETS).alias("hot"),
        clean.hex_to_number("big").cast("string").alias("big"),
        clean.hex_to_plain("big").alias("big_text"),
        clean.hex_to_plain("n").alias("none"),
        clean.hex_to_number("h").cast("int").alias("h"),
        clean.hex_to_number("d").cast("int").alias("d"),
        clean.strip_control("t").alias("t"),
        clean.default_fill("n", "x").alias("filled"),
        clean.clamp(F.lit(-5), 0, 3600).alias("low"),
        clean.clamp(F.lit(9), 1, 5, otherwise=3).alias("level"),
        rate(F.lit(1), F.lit(0)).alias("zero"),
        percent(F.lit(1), F.lit(3)).alias("third"),
        clean.mask_name_full(F.lit("Anna")).alias("name"),
    )
    r = row.first()
    assert (r.hot, r.big, r.big_text, r.none) == ("9002", str(2**118 + 12345), str(2**118 + 12345), "0")
    assert (r.h, r.d, r.t, r.filled, r.low, r.level, r.zero, r.third, r.name) == (255, 17, "a", "x", 0, 3, 0.0, 33.33, "A***")


def test_epochs_and_day_range(spark):
    df = spark.createDataFrame([("1704067200",), ("1704067200123",), ("soon",)], "raw string").select(F.date_format(epoch_any("raw"), "yyyy-MM-dd HH:mm:ss.SSS").alias("t"))
    assert [r.t for r in df.collect()] == ["2024-01-01 00:00:00.000", "2024-01-01 00:00:00.123", None]
    assert [r.ds for r in day_range(spark, "2024-02-27", "2024-03-01").collect()] == ["20240227", "20240228", "20240229", "20240301"]


def test_keep_edge_keeps_one_row_per_key_and_batch(spark):
    from tallyflow.streaming.combine import keep_edge

    df = spark.createDataFrame(pd.DataFrame({"k": [1, 1, 2], "t": [2, 1, 5]})).coalesce(1)
    assert tuples(keep_edge(df, ["k"], ["t"]), "k", "t") == [(1, 1), (2, 5)]
    assert tuples(keep_edge(df, ["k"], ["t"], last=True), "k", "t") == [(1, 2), (2, 5)]

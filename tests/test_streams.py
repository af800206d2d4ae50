"""State over several micro-batches and restarts. Each file is one micro-batch."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyflow.sources.stream_standins import Streams
from tallyflow.streaming import dedup, joins, logs, lookups, moderation, tables, uniques
from tallyflow.streaming.run import file_stream, start_files, state_settings
from tallyflow.streaming.windows import tumble, tumble_distinct

START = datetime(2024, 1, 1)


def at(days=0.0, seconds=0.0):
    return START + timedelta(days=days, seconds=seconds)


class Feed:
    """A folder of numbered files read one per trigger, and a sink that keeps its checkpoint."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, folder, schema, 0

    def add(self, *rows):
        path = f"{self.folder}/in"
        self.n += 1
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(path)

    def run(self, build):
        stream = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")
        out = build(stream)
        start_files(out, f"{self.folder}/out").awaitTermination()
        return self.spark.read.schema(out.schema).parquet(f"{self.folder}/out/data")


@pytest.fixture()
def feed(spark, folder):
    return lambda schema: Feed(spark, folder, schema)


def test_first_per_day_over_batches_and_restart(feed):
    f = feed("u int, ts timestamp")
    build = lambda s: uniques.first_per_day(s, "u")
    f.add((1, at(0, 5)), (1, at(0, 3)), (2, at(0, 9)))
    assert sorted((r.key, r.ts) for r in f.run(build).collect()) == [("1", at(0, 3)), ("2", at(0, 9))]
    f.add((1, at(0, 50)), (1, at(1, 1)), (2, at(0, 70)))
    f.add((1, at(1, 90)), (2, at(1, 80)))
    got = sorted((r.key, r.day) for r in f.run(build).collect())
    assert got == [("1", "2024-01-01"), ("1", "2024-01-02"), ("2", "2024-01-01"), ("2", "2024-01-02")]


def test_first_per_day_forgets_old_days_only(feed):
    f = feed("u int, ts timestamp")
    build = lambda s: uniques.first_per_day(s, "u")
    for d in (0, 1, 5, 6):
        f.add((1, at(d, 1)), (1, at(d, 2)))
        f.add((1, at(d, 3)))
    assert f.run(build).count() == 4


def test_login_gap_over_batches(feed):
    f = feed("u int, ts timestamp")
    build = lambda s: uniques.login_return(s, "u", 8)
    f.add((1, at(0)), (1, at(0, 9)))
    f.add((1, at(7)), (2, at(7)))
    f.add((1, at(15, 3)), (2, at(14, 9)))
    got = sorted((r.key, r.day, r.back_ct) for r in f.run(build).collect())
    assert got == [("1", "2024-01-01", 0), ("1", "2024-01-08", 0), ("1", "2024-01-16", 1), ("2", "2024-01-08", 0), ("2", "2024-01-15", 0)]


def test_new_flag_is_kept_on_the_first_day_only(feed):
    f = feed("id int, mid string, ts timestamp, is_new string")
    build = lambda s: uniques.fix_is_new(s, "mid")
    f.add((1, "a", at(0, 1), "1"), (2, "b", at(0, 1), "0"))
    f.add((3, "a", at(0, 9), "1"), (4, "a", at(1, 1), "1"), (5, "b", at(0, 8), "1"))
    got = sorted((r.id, r.fixed_is_new) for r in f.run(build).collect())
    assert got == [(1, "1"), (2, "0"), (3, "1"), (4, "0"), (5, "0")]


def test_new_flag_has_no_more_answers_than_rows(feed):
    """The answer goes to the salts that have rows of the visitor and day, and each row meets it once."""
    f = feed("mid string, ts timestamp, is_new string")
    rows = [("a", at(seconds=i), "1") for i in range(40)] + [("b", at(seconds=1), "0")]
    f.add(*rows)
    f.add(("a", at(1), "1"), ("b", at(1), "1"))
    out = f.run(lambda s: uniques.fix_is_new(s, "mid"))
    got = sorted((r.mid, r.day, r.is_new, r.fixed_is_new) for r in out.collect())
    assert got == sorted([("a", "2024-01-01", "1", "1")] * 40 + [("b", "2024-01-01", "0", "0"), ("a", "2024-01-02", "1", "0"), ("b", "2024-01-02", "1", "0")])
    plan = uniques.fix_is_new(f.spark.readStream.schema(f.schema).parquet(f"{f.folder}/in"), "mid")._jdf.queryExecution().logical().toString()
    assert "explode" not in plan.lower()


def test_retract_replaces_earlier_version_in_window(feed):
    f = feed("id string, k string, ts timestamp, amount double")
    build = lambda s: dedup.retract(s, "id", "ts", ["amount"], "1 hour")
    f.add(("x", "p", at(0, 1), 10.0), ("y", "p", at(0, 2), 5.0))
    f.add(("x", "q", at(0, 4), 7.0))
    f.add(("x", "q", at(0, 3), 99.0))
    out = f.run(build)
    assert sorted((r.k, r.amount) for r in out.collect()) == [("p", -10.0), ("p", 5.0), ("p", 10.0), ("q", 7.0)]
    sums = {r.k: r.s for r in out.groupBy("k").agg(F.sum("amount").alias("s")).collect()}
    assert sums == {"p": 5.0, "q": 7.0}


def test_retraction_on_tables_equals_retraction_in_a_store(spark, folder, feed):
    """Late rows, rows no longer held, rows held to the last moment, nulls and a restart; each batch is run twice."""
    import os
    import random

    f = feed("id string, k string, ts timestamp, amount double")
    rng, keep_ms = random.Random(4), 1_000_000
    rows = [[(rng.choice([*"abcdef", None]), rng.choice(["p", "q", None]), at(0, 600 * b + 0.25 * (7 * i + rng.randrange(7)) * 20), rng.choice([None, 0.0, 1.5, float(i)])) for i in range(40)] for b in range(5)]
    rows[0] += [("x", "p", at(0, 10.5), 3.0), ("y", "p", at(0, 11), 4.0)]
    seen = [max(r[2] for b in rows[: n + 1] for r in b) for n in range(5)]
    # what is held to the very watermark of the batch before, and one millisecond less or more
    for n, gap in ((2, 0.0), (2, 0.001), (2, -0.001)):
        rows[0].append((f"edge{gap}", "p", seen[n] - timedelta(seconds=30 + keep_ms / 1000 + gap), 5.0))
    for n in (3, 4):
        rows[n] += [(f"edge{gap}", "q", seen[n] - timedelta(seconds=n), 6.0 + n) for gap in (0.0, 0.001, -0.001)]
    rows[4].append(("x", "q", seen[4] - timedelta(seconds=1), 7.0))
    sums = lambda kept: tumble(kept, "ts", "10 seconds", ["k"], [F.sum("amount").alias("s"), F.count(F.lit(1)).alias("n")])
    numbers: list = []

    class Twice(tables.HeldWindows):
        def __call__(self, batch, number):
            numbers.append(number)
            super().__call__(batch, number)
            super().__call__(batch, number)

    def run():
        stream = spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        step = lambda rows, past: dedup.retract(rows, "id", "ts", ["amount"], "30 seconds", keep_ms, past)
        new = Twice(stream, "ts", "10 seconds", step, sums, f"{folder}/tables", "30 seconds", keep_ms)
        new.run()
        return sorted(map(str, (tuple(r) for r in new.read().select("stt", "edt", "cur_date", "k", "s", "n").collect())))

    build = lambda s: sums(dedup.retract(s, "id", "ts", ["amount"], "30 seconds", keep_ms))
    for part in (rows[:2], rows[2:]):
        for r in part:
            f.add(*r)
        want = sorted(map(str, (tuple(r) for r in f.run(build).select("stt", "edt", "cur_date", "k", "s", "n").collect())))
        assert run() == want and len(want) > 10
    assert run() == want and numbers == list(range(5))
    assert not os.path.exists(f"{folder}/tables/checkpoint/state") and len(os.listdir(f"{folder}/tables/kept")) < 5


def test_newest_only_over_batches(feed):
    f = feed("k string, v int, ts long")
    f.add(("a", 1, 10), ("a", 2, 12))
    f.add(("a", 3, 11), ("b", 9, 1))
    f.add(("a", 4, 13))
    got = sorted((r.k, r.v) for r in f.run(lambda s: dedup.newest_only(s, "k", "ts")).collect())
    assert got == [("a", 1), ("a", 2), ("a", 4), ("b", 9)]


@pytest.mark.parametrize("files", [1, 3, 8])
def test_results_do_not_depend_on_the_batches(spark, folder, files):
    """The same rows in time order, cut into 1, 3 or 8 files."""
    rows = [(f"u{i % 5}", i, at(0, 3 * i + i % 7), 10.0 + i, "1") for i in range(64)]
    rows.append(("end", 999, at(0, 5000), 1.0, "1"))
    schema, size = "k string, v int, ts timestamp, amount double, is_new string", -(-len(rows) // files)

    def run(name, build):
        f = Feed(spark, f"{folder}/{name}", schema)
        for n in range(files):
            f.add(*sorted(rows[n * size : (n + 1) * size], reverse=n % 2 == 1))
        return f.run(build)

    newest = run("newest", lambda s: dedup.newest_only(s.withColumn("ms", F.unix_millis("ts")), "k", "ms"))
    assert newest.count() == len(rows)
    held = run("held", lambda s: dedup.hold_back(s, "k", "ts", 16_000))
    times = {k: sorted((r[2], r[1]) for r in rows if r[0] == k) for k in ("u0", "u1", "u2", "u3", "u4")}
    want = sorted(v for ts in times.values() for (t, v), (after, _) in zip(ts, [*ts[1:], (at(0, 9e5), None)]) if (after - t).total_seconds() >= 16)
    assert sorted(r.v for r in held.collect()) == want and 0 < len(want) < 64
    flags = run("flags", lambda s: uniques.fix_is_new(s, "k").select("v", "fixed_is_new"))
    assert sorted((r.v, r.fixed_is_new) for r in flags.collect()) == sorted((r[1], "1") for r in rows)
    pairs = run("pairs", lambda s: dedup.retract(s, "k", "ts", ["amount"]))
    last = {k: max((r[2], r[3]) for r in rows if r[0] == k)[1] for k in (*times, "end")}
    assert {r.k: r.s for r in pairs.groupBy("k").agg(F.sum("amount").alias("s")).collect()} == last


def test_corrections_reach_windows_that_are_open(feed):
    f = feed("id string, ts timestamp, amount double")
    f.add(("x", at(0, 1), 10.0), ("y", at(0, 2), 1.0))
    f.add(("z", at(0, 30), 1.0))
    f.add(("x", at(0, 31), 7.0), ("y", at(0, 45), 2.0))
    got = sorted((r.id, r.amount, r.ts) for r in f.run(lambda s: dedup.retract(s, "id", "ts", ["amount"], "15 seconds")).collect())
    # the watermark is at 15 s when the second versions come: the old times are closed, so the pairs meet in the new ones
    assert got == [("x", -10.0, at(0, 31)), ("x", 7.0, at(0, 31)), ("x", 10.0, at(0, 1)), ("y", -1.0, at(0, 45)), ("y", 1.0, at(0, 2)), ("y", 2.0, at(0, 45)), ("z", 1.0, at(0, 30))]


def test_a_late_day_of_a_visitor_is_not_lost(feed):
    f = feed("id int, mid string, ts timestamp, is_new string")
    f.add((1, "a", at(1, 100), "1"))
    f.add((2, "a", at(0, 82_800), "1"))
    f.add((3, "a", at(1, 200), "1"))
    got = sorted((r.id, r.fixed_is_new) for r in f.run(lambda s: uniques.fix_is_new(s, "mid")).collect())
    assert got == [(1, "1"), (2, "0"), (3, "1")]


def test_whole_numbers_beside_nulls_keep_their_digits(feed):
    f = feed("k string, ts timestamp, n long")
    f.add(("a", at(0, 1), 2**53 + 1), ("b", at(0, 2), None), ("a", at(0, 1), 2**53 + 1))
    f.add(("end", at(0, 900), 5))
    got = sorted(((r.k, r.n) for r in f.run(lambda s: dedup.hold_back(s, "k", "ts", 5000)).collect()), key=repr)
    assert got == [("a", 2**53 + 1), ("b", None)]


def test_hold_back_emits_latest_once(feed):
    f = feed("k string, v int, ts timestamp")
    build = lambda s: dedup.hold_back(s, "k", "ts", 5000)
    f.add(("a", 1, at(0, 1)))
    f.add(("a", 2, at(0, 3)))
    f.add(("b", 1, at(0, 100)))
    assert sorted((r.k, r.v) for r in f.run(build).collect()) == [("a", 2)]


def test_exact_and_bloom_dedup_over_batches(feed):
    f = feed("k int, ts timestamp")
    f.add(*[(i, at(0, i)) for i in range(50)] * 3)
    f.add(*[(i, at(0, i)) for i in range(40, 60)])
    assert f.run(lambda s: dedup.exact(s, ["k"], "ts", "1 day")).count() == 60


def test_bloom_over_batches(feed):
    f = feed("k int, ts timestamp")
    f.add(*[(i, at(0, i)) for i in range(50)] * 3)
    f.add(*[(i, at(0, i)) for i in range(40, 60)])
    assert f.run(lambda s: dedup.bloom(s, ["k"], buckets=4)).count() == 60


def test_bloom_takes_more_keys_than_a_block_holds(feed):
    f = feed("k int, ts timestamp")
    for i in range(4):
        f.add(*[(k, at(0, k)) for k in range(i * 1000, i * 1000 + 1500)])
    build = lambda s, **how: dedup.bloom(s, ["k"], expected_per_bucket=100, buckets=2, **how)
    assert sorted(r.k for r in f.run(build).collect()) == list(range(4500))


def test_bloom_confirmed_loses_no_row(feed):
    f = feed("a int, b int")
    for i in range(3):
        f.add((1, None), (None, 1), *[(k, k) for k in range(i * 300, i * 300 + 600)])
    got = f.run(lambda s: dedup.bloom(s, ["a", "b"], expected_per_bucket=50, error=0.5, buckets=2, confirmed=True))
    want = [(1, None), (None, 1), *[(k, k) for k in range(1200)]]
    assert sorted(((r.a, r.b) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_bloom_buckets_follow_the_keys():
    assert dedup.bloom_buckets(100_000) == 16 and dedup.bloom_buckets(16_000_000) == 160


def test_bloom_size():
    bits, hashes = dedup.bloom_size(1000, 0.01)
    assert (bits, hashes) == (9586, 7)


def test_windows_equal_batch_for_closed_windows(feed):
    f = feed("k int, ts timestamp")
    rows = [(i % 3, at(0, i)) for i in range(100)]
    f.add(*rows[:60])
    f.add(*rows[60:])
    out = f.run(lambda s: tumble(s.withWatermark("ts", "0 seconds"), "ts", "10 seconds", ["k"], [F.count(F.lit(1)).alias("n")]))
    assert sum(r.n for r in out.collect()) == 90


def test_distinct_in_window_over_batches(feed):
    f = feed("k int, o int, ts timestamp")
    f.add((1, 7, at(0, 1)), (1, 8, at(0, 5)))
    f.add((1, 7, at(0, 6)), (1, 7, at(0, 11)))
    f.add((1, 9, at(0, 40)))
    n = [F.count(F.lit(1)).alias("n")]
    build = lambda s: tumble_distinct(s.withWatermark("ts", "0 seconds"), "ts", "10 seconds", ["k"], "o", n, n)
    assert sorted((r.stt[-2:], r.n) for r in f.run(build).collect()) == [("00", 2), ("10", 1)]


def test_interval_join_over_batches(spark, folder, feed):
    f = feed("id int, kind string, ts timestamp")
    side = lambda s, kind, p: s.where(F.col("kind") == kind).select(F.col("id").alias(f"{p}_id"), F.col("ts").alias(f"{p}_ts"))
    f.add((1, "order", at(0, 0)), (2, "order", at(0, 0)))
    f.add((1, "pay", at(0, 1700)), (2, "pay", at(0, 1900)))
    build = lambda s: joins.bounded(side(s, "pay", "p"), side(s, "order", "o"), {"p_id": "o_id"}, "p_ts", "o_ts", "30 minutes", "5 seconds")
    assert [r.p_id for r in f.run(build).collect()] == [1]


def test_near_joins_keep_tables_in_place_of_a_row_store(spark, folder, feed):
    """Two joins in a row over batches, a stop and a repeated batch: pairs of a batch and across batches once each, no state store."""
    import os
    import random

    f = feed("n int, id int, kind string, ts timestamp")
    side = lambda s, kind: s.where(F.col("kind") == kind).select(F.col("id").alias(f"{kind}_id"), F.col("n").alias(f"{kind}_n"), F.col("ts").alias(f"{kind}_ts"))
    rng, rows = random.Random(3), []
    for b in range(6):
        rows.append([(100 * b + i, rng.choice([1, 2, 3, None]), rng.choice(["a", "b", "c"]), None if i % 20 == 7 else at(0, 1000 * b + rng.randrange(1000))) for i in range(40)])
    last: list = []

    class Twice(joins.NearJoins):
        def __call__(self, batch, number):
            last.append(number)
            super().__call__(batch, number)
            super().__call__(batch, number)

    def run():
        stream = spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        steps = [joins.Near(side(stream, "b"), {"a_id": "b_id"}, "a_ts", "b_ts", "10 minutes", "15 minutes"), joins.Near(side(stream, "c"), {"a_id": "c_id"}, "a_ts", "c_ts", "1 minute", "20 minutes")]
        near = Twice(side(stream, "a"), steps, f"{folder}/out", "5 seconds", lambda j: j.select("a_n", "b_n", "c_n"))
        near.run()
        return sorted(tuple(r) for r in near.read().collect())

    f.add(*rows[0])
    f.add(*rows[1])
    run()
    for r in rows[2:]:
        f.add(*r)
    got = run()
    of = lambda kind: [(n, i, t) for r in rows for n, i, k, t in r if k == kind and i is not None and t is not None]
    near = lambda x, y, before, after: x[1] == y[1] and -before <= (y[2] - x[2]).total_seconds() <= after
    want = sorted((a[0], b[0], c[0]) for a in of("a") for b in of("b") if near(a, b, 600, 900) for c in of("c") if near(a, c, 60, 1200))
    assert got == want and len(want) > 100 and last == list(range(6))
    assert not os.path.exists(f"{folder}/out/checkpoint/state")
    assert len(os.listdir(f"{folder}/out/arrived")) < 6


def test_near_joins_leave_out_what_bounded_leaves_out(spark, folder, feed):
    """A row not after the watermark of the batch before is late; a row within the lateness still finds its partner."""
    f = feed("id int, kind string, ts timestamp")
    side = lambda s, kind, p: s.where(F.col("kind") == kind).select(F.col("id").alias(f"{p}_id"), F.col("ts").alias(f"{p}_ts"))
    pair = lambda i, t: [(i, "order", t), (i, "pay", t)]
    f.add(*pair(1, at(0, 100)))
    f.add(*pair(2, at(0, 5000)))
    f.add(*pair(3, at(0, 9000)), *pair(4, at(0, 90)), *pair(5, at(0, 97)))
    f.add(*pair(6, at(0, 4990)), *pair(7, at(0, 4999)), (2, "pay", at(0, 5001)))
    old = f.run(lambda s: joins.bounded(side(s, "pay", "p"), side(s, "order", "o"), {"p_id": "o_id"}, "p_ts", "o_ts", "30 minutes", "5 seconds"))
    stream = spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    new = joins.drain_near(side(stream, "pay", "p"), [joins.Near(side(stream, "order", "o"), {"p_id": "o_id"}, "p_ts", "o_ts", "30 minutes", "5 seconds")], "near", lambda j: j.select("p_id", "o_ts"))
    assert sorted((r.p_id, r.o_ts) for r in new.collect()) == sorted((r.p_id, r.o_ts) for r in old.collect())
    assert {5, 7} <= {r.p_id for r in new.collect()} and not {4, 6} & {r.p_id for r in new.collect()}


def test_near_left_joins_equal_left_joins_of_streams(spark, folder, feed):
    """Lines that found no partner come out when it can come no more; late rows, nulls, a restart, each batch run twice."""
    import os
    import random

    f = feed("n int, id int, kind string, ts timestamp")
    side = lambda s, k: s.where(F.col("kind") == k).select(F.col("n").alias(f"{k}_n"), F.col("id").alias(f"{k}_id"), F.col("ts").alias(f"{k}_ts"))
    rng = random.Random(5)
    rows = [[(1000 * b + i, rng.choice([*range(3), None]), rng.choice("aabcd"), at(0, 1000 * b + rng.randrange(1000))) for i in range(60)] for b in range(5)]
    rows[4] += [(9000 + i, i, kind, at(0, 100)) for i, kind in enumerate("abcd")]

    def stored(s):
        one = joins.bounded(side(s, "a"), side(s, "b"), {"a_id": "b_id"}, "a_ts", "b_ts", "1 minute", "4 minutes").drop("b_ts")
        c, d = side(s, "c").withWatermark("c_ts", "5 seconds"), side(s, "d").withWatermark("d_ts", "5 seconds")
        two = one.join(c, (F.col("a_id") == F.col("c_id")) & F.expr("c_ts >= a_ts and c_ts <= a_ts + interval 2 minutes"), "left").drop("c_ts")
        three = two.join(d, (F.col("a_id") == F.col("d_id")) & F.expr("d_ts >= a_ts and d_ts <= a_ts + interval 90 seconds"), "left")
        return three.select("a_n", "b_n", "c_n", "d_n")

    class Twice(joins.NearJoins):
        def __call__(self, batch, number):
            super().__call__(batch, number)
            super().__call__(batch, number)

    def run():
        stream = spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        near = lambda k, before, after, how="inner": joins.Near(side(stream, k), {"a_id": f"{k}_id"}, "a_ts", f"{k}_ts", before, after, how)
        steps = [near("b", "1 minute", "4 minutes"), near("c", "0 seconds", "2 minutes", "left"), near("d", "0 seconds", "90 seconds", "left")]
        new = Twice(side(stream, "a"), steps, f"{folder}/tables", "5 seconds", lambda j: j.select("a_n", "b_n", "c_n", "d_n"))
        new.run()
        return sorted((tuple(r) for r in new.read().collect()), key=repr)

    for part in (rows[:2], rows[2:]):
        for r in part:
            f.add(*r)
        want = sorted((tuple(r) for r in f.run(stored).collect()), key=repr)
        assert run() == want and len(want) > 10
    assert run() == want and len({(r[2] is None, r[3] is None) for r in want}) == 4
    assert not os.path.exists(f"{folder}/tables/checkpoint/state") and len(os.listdir(f"{folder}/tables/arrived")) < 4


def test_a_replay_leaves_one_copy_of_its_rows(spark):
    import os

    folder, _ = Streams(spark, "/root/testdata/sf0.001").feed(spark.range(100), F.col("id"), 4, (0, 99), "one-copy")
    assert spark.read.parquet(folder).count() == 100
    assert os.listdir(os.path.dirname(folder.removeprefix("file:"))) == ["feed"]


def test_split_log_kinds(spark):
    lines = ['{"common":{"mid":"m"},"err":{"c":1},"start":{"e":"x"},"ts":1}', '{"common":{"mid":"m"},"page":{"page_id":"p"},"displays":[{"i":1},{"i":2}],"actions":[{"a":1}],"ts":2}']
    out = logs.split_log(spark.createDataFrame([(x,) for x in lines], "log string"))
    assert sorted(r.kind for r in out.collect()) == ["action", "display", "display", "err", "page", "start"]


def test_dirty_lines(spark):
    lines = spark.createDataFrame([('{"k":1}',), ("{broken",), ("",), (None,), ("[1]",)], "value string")
    got = [(r.value, r.topic) for r in logs.split_dirty(lines, "k int").collect()]
    assert [t for _, t in got] == ["clean", "dirty", "dirty", "dirty", "dirty"]


def test_clean_kind_requires_fields(spark):
    lines = spark.createDataFrame([('{"channel_code":"c","channel_name":"n","channel_type":3}',), ('{"channel_code":"c"}',)], "value string")
    assert [tuple(r) for r in logs.clean_kind(lines, "channel").collect()] == [("c", "n", "3", None)]


def test_moderation_checks_last_part(spark):
    words = spark.createDataFrame([("bad",), ("bad",)], "word string")
    rows = spark.createDataFrame([(1, "fine,bad"), (2, "bad,fine"), (3, "bad"), (4, "")], "id int, msg string")
    got = {r.id: (r.is_violation, r.violation_grade, r.violation_msg) for r in moderation.flag(rows, words, "msg").collect()}
    assert got == {1: (1, "P0", "bad"), 2: (0, "", ""), 3: (1, "P0", "bad"), 4: (0, "", "")}


def test_file_stream_reads_named_file(spark):
    assert file_stream(spark, "/root/testdata/sf0.001", "events.parquet").isStreaming


def test_state_is_cut_to_the_cores_and_not_counted(spark):
    """A session with very many shuffle partitions does not open a store for each of them in every batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "600")
    try:
        with state_settings(spark):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
            assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "600"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_replayed_slices_come_in_files_of_several_tasks(spark, folder):
    """A slice of 250,000 rows is read by three tasks, and a table replayed twice is written once."""
    spark.range(250_000).select(F.col("id").alias("event_id"), F.lit(START).cast("timestamp_ntz").alias("ts")).write.parquet(f"{folder}/events.parquet")
    streams = Streams(spark, folder)
    streams.replayed("events", "ts", 1)
    streams.replayed("events", "ts", 1)
    ((path, each),) = streams.feeds.values()
    assert each == 3 and spark.read.parquet(path).count() == 250_000 and len(spark.read.parquet(path).inputFiles()) == 3


def test_dimension_keeps_known_columns_and_drops_deleted_rows(spark, feed, folder):
    from tallyflow.streaming import cdc, dimsync

    f = feed(cdc.ENVELOPE)
    src = {"table": "shop"}
    f.add(("c", None, {"id": "1", "name": "a", "kind": "x"}, src, 1), ("c", None, {"id": "2", "name": "b"}, src, 1), ("c", None, {"id": "9"}, {"table": "other"}, 1))
    f.add(("u", None, {"id": "1", "name": "a2", "kind": None}, src, 2), ("d", {"id": "2"}, None, src, 2))
    config = lambda s: s.createDataFrame([("shop", "dim_shop", "id", "id,name,kind")], dimsync.CONFIG)
    changes = spark.readStream.schema(cdc.ENVELOPE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    dimsync.sync(changes, f"{folder}/dim", config).awaitTermination()
    rows = dimsync.current(spark, f"{folder}/dim", config(spark)).collect()
    assert [r["info"] for r in rows] == [{"id": "1", "name": "a2", "kind": "x"}]


def test_keyword_function_in_sql(spark):
    from tallyflow.functions.udtf import register

    register(spark)
    got = spark.sql("select id, word from keyword_udtf(table(select * from values (1, 'red, green  red'), (2, null), (3, ''), (4, 'été!x') t(id, text)))").collect()
    assert sorted(map(tuple, got)) == [(1, "green"), (1, "red"), (1, "red"), (4, "x"), (4, "été")]


@pytest.mark.parametrize("files", [1, 3])
def test_lookup_takes_the_version_of_the_time(spark, folder, files):
    """Versions change between and inside batches; facts before the first version get the default."""
    facts = [(n, f"k{n % 3}", at(0, 10 * n), n / 4) for n in range(60)] + [(99, None, at(0, 5), None), (100, "end", at(0, 9000), 1.0)]
    versions = [("k0", "a", at(0, 0)), ("k0", "b", at(0, 200)), ("k0", "c", at(0, 395)), ("k1", "z", at(0, 300)), ("k2", None, at(0, 100)), ("k2", "y", at(0, 50))]

    def replay(rows, schema, name, when):
        f = Feed(spark, f"{folder}/{name}", schema)
        for k in range(files):
            part = [r for r in rows if min(int(when(r) / 600 * files), files - 1) == k]
            f.add(*part)
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name}/in")

    since = lambda t: (t - START).total_seconds()
    left = replay(facts, "n int, k string, ts timestamp, x double", "facts", lambda r: since(r[2]))
    right = replay(versions, "code string, name string, ts timestamp", "versions", lambda r: since(r[2]))
    out = lookups.lookup_as_of(left, right, "k", "code", ["name"], "ts", "ts", "N/A", buckets=2, salts=2)
    start_files(out, f"{folder}/out").awaitTermination()
    got = {r.n: (r.name, r.x, r.ts) for r in spark.read.schema(out.schema).parquet(f"{folder}/out/data").collect()}

    def name(k, t):
        known = [(v[2], v[1]) for v in versions if v[0] == k and v[2] <= t]
        return (max(known)[1] if known else None) or "N/A"

    assert {n: v[0] for n, v in got.items()} == {n: name(k, t) for n, k, t, _ in facts if n != 100}
    assert got[7][1:] == (1.75, at(0, 70)) and got[99][1] is None


def test_rules_fill_back_and_drop(spark, folder):
    """A rule that arrives after the changes it counts for, one that ends, and one that starts again."""
    from tallyflow.streaming import cdc, dimsync

    change = lambda i, ms, op="c": (op, {"id": str(i)} if op == "d" else None, {"id": str(i), "name": f"n{ms}"} if op != "d" else None, {"table": "shop"}, ms)
    changes, rules = Feed(spark, f"{folder}/c", cdc.ENVELOPE), Feed(spark, f"{folder}/r", dimsync.RULES)
    rule = lambda op, sink, ms, back=False: (op, "shop", sink, "id", "id,name", ms, back)
    changes.add(change(1, 10), change(2, 11))
    rules.add(rule("c", "first", 0))
    changes.add(change(1, 20), change(3, 21))
    rules.add(rule("c", "all", 20, True), rule("c", "late", 15))
    changes.add(change(4, 30), change(2, 31, "d"))
    rules.add(rule("d", "first", 30))
    changes.add(change(5, 40), change(1, 41))
    rules.add(rule("c", "first", 40))
    read = lambda f: spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{f.folder}/in")
    dimsync.sync_with_rules(read(changes), read(rules), f"{folder}/dim").awaitTermination()
    got = {(r.sink_table, r["info"]["id"], r["info"]["name"]) for r in dimsync.current_under_rules(spark, f"{folder}/dim").collect()}
    assert got == {
        ("all", "1", "n41"), ("all", "3", "n21"), ("all", "4", "n30"), ("all", "5", "n40"),
        ("late", "1", "n41"), ("late", "3", "n21"), ("late", "4", "n30"), ("late", "5", "n40"), ("first", "5", "n40"), ("first", "1", "n41"),
    }


def test_windows_of_the_clock_lose_nothing(feed):
    from tallyflow.streaming.run import run_clock
    from tallyflow.streaming.windows import tumble_clock

    f = feed("k string, n int")
    for b in range(3):
        f.add(*[("a" if i % 3 else None, i) for i in range(50)])
    stream = f.spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{f.folder}/in")
    out = run_clock(tumble_clock(stream, 1000, ["k"], ["n"]), "clock-test", 1000).collect()
    assert {k: sum(r.n for r in out if r.k == k) for k in ("a", None)} == {k: 3 * sum(i for i in range(50) if bool(i % 3) == (k == "a")) for k in ("a", None)}
    assert all(r.stt < r.edt for r in out)


def test_rolled_files_are_bounded_and_count_once(spark, folder):
    """A batch that failed in the middle is written again; every line is there once, in files of bounded size."""
    import os

    from tallyflow.sources import rolled

    f = Feed(spark, folder, "value string, day string")
    for b in range(3):
        f.add(*[(f"{b}-{i}" + "x" * (i % 50), f"d{i % 2}") for i in range(300)])
    stream = lambda: spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    broken = F.udf(lambda v: 1 / 0 if v.startswith("2-299") and not os.path.exists(f"{folder}/go") else v)
    build = lambda: stream().select(broken("value").alias("value"), "day")
    with pytest.raises(Exception):
        rolled.write_rolled(build(), f"{folder}/t", 2000).awaitTermination()
    assert rolled.read_rolled(spark, f"{folder}/t").count() == 600
    open(f"{folder}/go", "w").close()
    rolled.write_rolled(build(), f"{folder}/t", 2000).awaitTermination()
    got = sorted(map(tuple, rolled.read_rolled(spark, f"{folder}/t").collect()))
    assert got == sorted((f"{b}-{i}" + "x" * (i % 50), f"d{i % 2}") for b in range(3) for i in range(300))
    sizes = [n for _, n, _ in rolled.batches(f"{folder}/t")]
    assert max(sizes) <= 2000 and len(sizes) > 6 and sum(k for _, _, k in rolled.batches(f"{folder}/t")) == 900
    # the same batch committed once more replaces its files
    writer = rolled.RolledWriter(f"{folder}/t/data", 2000)
    import pyarrow as pa

    again = writer.write(iter([pa.RecordBatch.from_pydict({"value": ["only"], "day": ["d0"]})]))
    writer.commit([again, None], 2)
    assert rolled.read_rolled(spark, f"{folder}/t").count() == 601


def test_changes_are_not_dealt_by_their_few_tables(spark):
    from tallyflow.streaming import dimsync

    change = "op string, before map<string,string>, after map<string,string>, source map<string,string>, ts_ms bigint"
    rows = [("c", None, {"id": str(n)}, {"table": "a"}, n) for n in range(10)]
    one = spark.createDataFrame(rows, change).coalesce(1)
    parts = dimsync.dealt(one, 3)
    assert parts.rdd.getNumPartitions() == 4 and sorted(r.ts_ms for r in parts.collect()) == list(range(10))
    cells = dimsync.to_cells(parts, spark.createDataFrame([("a", "dim_a", "id", "id")], dimsync.CONFIG))
    assert "hashpartitioning(source_table" not in cells._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.text for r in cells.collect()) == sorted(str(n) for n in range(10))


def test_state_of_visits_and_logins_is_one_entry_a_bucket(spark, feed, folder):
    from tallyflow.streaming import inspect

    f = feed("u int, ts timestamp")
    f.add(*[(u, at(0, u)) for u in range(9)], (None, at(0, 9)))
    f.add(*[(u, at(8, u)) for u in range(12)])
    first = f.run(lambda s: uniques.first_per_day(s, "u", buckets=2))
    assert first.count() == 22
    assert inspect.held_keys(spark, f"{folder}/out", "seen").count() <= 2
    logins = feed("u int, ts timestamp")
    logins.folder = f"{folder}/logins"
    logins.add(*[(u, at(0, u)) for u in range(9)])
    logins.add(*[(u, at(8, u)) for u in range(12)])
    got = sorted((int(r.key), r.day, r.back_ct) for r in logins.run(lambda s: uniques.login_return(s, "u", 8, buckets=2)).collect())
    assert got == sorted([(u, "2024-01-01", 0) for u in range(9)] + [(u, "2024-01-09", int(u < 9)) for u in range(12)])
    assert inspect.held_keys(spark, f"{folder}/logins/out", "last").count() <= 2

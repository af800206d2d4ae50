"""Sinks and keyed tables: running a load again changes nothing."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.session import shared_dir
from tallyflow.sources import readers, sinks
from tallyflow.sources.store import KeyedTable


def table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("dt", "k", "n").collect())


def rows(spark, *items):
    return spark.createDataFrame(list(items), "dt string, k int, n int")


def test_replace_partitions_leaves_other_days(spark, folder):
    path = f"{folder}/t"
    sinks.replace_partitions(rows(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 2)), path)
    for _ in range(2):
        sinks.replace_day(rows(spark, ("x", 1, 9), ("x", 2, 9)), path, "2024-01-02")
    assert [(str(d), k, n) for d, k, n in table(spark, path)] == [("2024-01-01", 1, 1), ("2024-01-02", 1, 9), ("2024-01-02", 2, 9)]


def test_a_day_can_be_replaced_by_nothing(spark, folder):
    path = f"{folder}/e"
    sinks.replace_partitions(rows(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 2)), path)
    none = rows(spark, ("x", 1, 9)).limit(0)
    sinks.replace_day(none, path, "2024-01-02")
    sinks.report(none, path, "2024-01-01")
    assert table(spark, path) == []


def test_report_rerun_replaces_changed_rows(spark, folder):
    path = f"{folder}/r"
    sinks.report(rows(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 2)), path)
    sinks.report(rows(spark, ("2024-01-02", 1, 3)), path)
    assert [r[2] for r in table(spark, path)] == [1, 3]


def test_table_can_replace_what_it_reads(spark, folder):
    path = f"{folder}/self"
    sinks.replace_partitions(rows(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 2)), path)
    doubled = spark.read.parquet(path).withColumn("n", F.col("n") * 2).select("dt", "k", "n")
    sinks.replace_partitions(doubled, path, self_read=True)
    assert [r[2] for r in table(spark, path)] == [2, 4]


def test_append_adds_rows(spark, folder):
    for _ in range(2):
        sinks.append(rows(spark, ("2024-01-01", 1, 1)), f"{folder}/a")
    assert len(table(spark, f"{folder}/a")) == 2


def test_load_and_verify_goes_on_after_an_error(spark, folder):
    good = lambda: rows(spark, ("2024-01-01", 1, 1), ("2024-01-01", 2, 1))
    bad = lambda: rows(spark, ("2024-01-01", 1, 1)).select("missing")
    out = sinks.load_and_verify({"a": good, "b": bad, "c": good}, folder, "2024-01-01")
    assert out["a"] == out["c"] == 2 and "missing" in out["b"]


def test_load_file_and_tsv(spark, folder):
    spark.createDataFrame([(1, "a\tb"), (2, None)], "k int, t string").select(F.concat_ws("\t", "k", F.coalesce(F.lit("x"))).alias("v")).write.option("compression", "gzip").text(f"{folder}/in")
    loaded = readers.load_file(spark, f"{folder}/in", "k int, t string", f"{folder}/out")
    assert sorted(r.k for r in loaded.collect()) == [1, 2]
    assert readers.first_rows(readers.tsv(spark, f"{folder}/in", "k int, t string"), 1).count() == 1


def test_keyed_table_repeat_delete_and_late_change(spark, folder):
    schema = T.StructType().add("k", "integer").add("v", "string").add("op", "string").add("ts", "long")
    t = KeyedTable(spark, f"{folder}/k", schema, ["k"], ["ts"], "op", capacity=2)
    batch = lambda *r: spark.createDataFrame(list(r), schema)
    state = lambda: sorted((r.k, r.v) for r in t.read().collect())
    t.upsert(batch((1, "a", "c", 1), (2, "b", "c", 1), (1, "a2", "u", 2)), 0)
    assert state() == [(1, "a2"), (2, "b")]
    for _ in range(2):
        t.upsert(batch((2, "b", "d", 5), (3, "c", "c", 5)), 1)
        assert state() == [(1, "a2"), (3, "c")]
    t.upsert(batch((1, "old", "u", 1)), 2)
    assert state() == [(1, "a2"), (3, "c")]
    t.upsert(batch((2, "again", "c", 9)), 3)
    assert state() == [(1, "a2"), (2, "again"), (3, "c")]


#: 50 were run as well; each takes some seconds
BATCHES = 12


def test_keyed_table_over_many_batches(spark, folder):
    """Buckets split and stay below their size, readers open current files only, old versions go."""
    schema = T.StructType().add("k", "long").add("v", "long").add("op", "string").add("ts", "long")
    t, want = KeyedTable(spark, f"{folder}/k", schema, ["k"], ["ts"], "op", capacity=60), {}
    for n in range(BATCHES):
        rows_ = [((n * 17 + i * i) % 400 if n < BATCHES - 2 else 1000 + i, n * 100 + i, "d" if (i + n) % 11 == 0 else "u", n * 100 + i) for i in range(40)]
        t.upsert(spark.createDataFrame(rows_, schema), n)
        if n % 6 == 5:  # a repeated batch
            t.upsert(spark.createDataFrame(rows_, schema), n)
        want |= {k: (v, op) for k, v, op, _ in rows_}
    live = t.read()
    assert {r.k: r.v for r in live.collect()} == {k: v for k, (v, op) in want.items() if op != "d"}
    buckets = t.directory(t.newest())
    assert max(b.n_rows for b in buckets) <= 60 and sum(b.n_rows for b in buckets) == len(want) and len(buckets) >= 4
    assert sorted(b.code << (16 - b.depth) for b in buckets) and sum(2.0**-b.depth for b in buckets) == 1
    held = [b for b in buckets if b.n_rows]
    assert len(live.inputFiles()) == len(held)
    import glob

    assert len(glob.glob(f"{folder}/k/rows/*/*/*.parquet")) <= 2 * len(buckets) + 8 and len(t.versions()) == 2


def test_json_rows_use_snake_case_and_topics(spark):
    df = spark.createDataFrame([(1, 2)], "orderCount int, sku int")
    r = sinks.json_rows(df, key="sku", topic=F.lit("t")).first()
    assert (r.key, r.value, r.topic) == ("2", '{"order_count":1,"sku":2}', "t")


def test_tombstones_are_dropped(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b"v")), (bytearray(b"k"), None)], "key binary, value binary").withColumn("timestamp", F.current_timestamp())
    assert [r.value for r in readers.values(df).collect()] == ["v"]


class Named:
    """A session whose settings name a shared folder, on a cluster master."""

    def __init__(self, folder, master="spark://host"):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "a"})


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(Named("hdfs://n/shared/")) == "hdfs://n/shared"
    with pytest.raises(ValueError):
        shared_dir(Named(None))
    assert shared_dir(spark) == shared_dir(spark)


@pytest.mark.parametrize("text,folder_name", [("1704067200", "20240101"), ("1704067200000", "20240101"), ("x", "error_bucket"), (None, "error_bucket")])
def test_day_bucket(spark, text, folder_name):
    assert spark.createDataFrame([(text,)], "t string").select(sinks.day_bucket("t").alias("d")).first().d == folder_name

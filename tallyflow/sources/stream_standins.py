"""Streams over the given parquet files: event stream, page log, and change logs of orders and order lines."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.session import scratch_path
from tallyflow.sources.standins import Tables, detail_id, money
from tallyflow.streaming.run import file_stream, little_disk
from tallyflow.streaming.tables import delete


#: Rows of one file of a replayed slice. A file is one task of its micro-batch, up to where the rows are dealt to their state.
ROWS_PER_FILE = 100_000


def text(c: Column) -> Column:
    return c.cast("string")


def as_map(**fields: Column) -> Column:
    parts: list[Column] = []
    for name, value in fields.items():
        parts += [F.lit(name), text(value)]
    return F.create_map(*parts)


class Streams(Tables):
    @cached_property
    def feeds(self) -> dict[tuple[str, str, int], tuple[str, int]]:
        """Folders of the tables replayed so far, with the files of a slice."""
        return {}

    def stream(self, table: str) -> DataFrame:
        return file_stream(self.spark, self.sf_dir, f"{table}.parquet")

    def replayed(self, table: str, by: str, files: int = 8) -> DataFrame:
        """The table in ``files`` slices in the order of ``by``, one per micro-batch. Streams of one query share what is written."""
        rows = self.raw(table)
        if (table, by, files) not in self.feeds:
            at = F.unix_micros(F.col(by).cast("timestamp"))
            self.feeds[table, by, files] = self.feed(rows, at, files, self.span(table, by), table)
        return self.feed_stream(rows.schema, *self.feeds[table, by, files])

    def span(self, table: str, by: str) -> tuple[int, int]:
        """First and last microsecond of a column."""
        at = F.unix_micros(F.col(by).cast("timestamp"))
        low, high = self.raw(table).agg(F.min(at), F.max(at)).first()
        return low or 0, high or 0

    def replay(self, rows: DataFrame, at: Column, files: int, span: tuple[int, int], name: str) -> DataFrame:
        """``rows`` as a stream of ``files`` slices of equal length of ``span``; what lies outside, or has no time, comes with the first
        or the last slice. Streams replayed with the same span have the same times in the same batch.

        The rows are read once, into one folder per slice. The slices then enter the stream's folder one after another, as a file
        source takes files by their age, each as so many files that none holds much more than ``ROWS_PER_FILE`` rows.
        """
        return self.feed_stream(rows.schema, *self.feed(rows, at, files, span, name))

    def feed_stream(self, schema: T.StructType, folder: str, each: int) -> DataFrame:
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", each).parquet(folder)

    def feed(self, rows: DataFrame, at: Column, files: int, span: tuple[int, int], name: str) -> tuple[str, int]:
        """Folder of the slices in their order, and the files of each."""
        (low, high), folder = span, scratch_path(self.spark, f"replay-{name}")
        part = F.floor((at - low) * files / F.lit(high - low + 1))
        part = F.coalesce(F.least(F.greatest(part, F.lit(0)), F.lit(files - 1)), F.lit(0))
        layout = T.StructType([*rows.schema.fields, T.StructField("replay_slice", T.LongType())])
        with little_disk(self.spark):
            rows.withColumn("replay_slice", part.cast("bigint")).write.partitionBy("replay_slice").parquet(f"{folder}/slices")
            slices = self.spark.read.schema(layout).parquet(f"{folder}/slices")
            each = max(1, -(-slices.count() // (files * ROWS_PER_FILE)))
            for k in range(files):
                slices.where(F.col("replay_slice") == k).drop("replay_slice").repartition(each).write.mode("append").parquet(f"{folder}/feed")
        delete(self.spark, f"{folder}/slices")
        return f"{folder}/feed", each

    def events(self, kind: str | None = None, files: int | None = None) -> DataFrame:
        """Events with ``ts`` as a timestamp that can carry a watermark; with ``files`` replayed in so many micro-batches."""
        k = F.get_json_object("props", "$.k").cast("int")
        rows = self.replayed("events", "ts", files) if files else self.stream("events")
        rows = rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", money("value").alias("value"), k.alias("k"))
        return rows if kind is None else rows.where(F.col("event_type") == kind)

    def page_log(self, files: int | None = None) -> DataFrame:
        k = F.col("k")
        return self.events(files=files).select(
            "event_id", "ts", F.concat(F.lit("mid_"), text(F.col("user_id"))).alias("mid"), F.concat(F.lit("v2."), text(k % 4)).alias("vc"), F.concat(F.lit("channel"), text(k % 5)).alias("ch"),
            text(F.col("user_id") % 25).alias("ar"), F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"), F.col("event_type").alias("page_id"),
            F.when(k % 2 == 0, F.lit("home")).alias("last_page_id"), (F.col("value") * 1000).cast("bigint").alias("during_time"),
        )

    def raw_log(self) -> DataFrame:
        """Log lines as JSON with error, start, displays and actions."""
        k, kind = F.col("k"), F.col("event_type")
        common = F.struct(F.concat(F.lit("mid_"), text(F.col("user_id"))).alias("mid"), text(F.col("user_id")).alias("uid"))
        page = F.struct(kind.alias("page_id"), text(k).alias("item"), (F.col("value") * 1000).cast("bigint").alias("during_time"))
        items = lambda n, name: F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.concat(F.lit(name), text(i)).alias("id"))))
        err = F.when(kind == "error", F.struct((k % 9).alias("code")))
        start = F.when(kind == "signup", F.struct(F.lit("icon").alias("entry")))
        log = F.struct(common.alias("common"), page.alias("page"), err.alias("err"), start.alias("start"), items(k % 3, "d").alias("displays"), items(k % 2, "a").alias("actions"), F.unix_millis("ts").alias("ts"))
        return self.events().select(F.to_json(log).alias("log"))

    def order_changes(self, files: int | None = None) -> DataFrame:
        """Change log of orders: created as 1001; F moved to 1002 and P to 1003; every fourth key a delete, insert or snapshot row."""
        key = F.col("o_orderkey")
        status = F.when(F.col("o_orderstatus") == "F", "1002").when(F.col("o_orderstatus") == "P", "1003").otherwise("1001")
        op = F.element_at(F.array(*[F.lit(o) for o in ("u", "c", "u", "r", "u", "d")]), (key % 6 + 1).cast("int"))
        now = as_map(id=key, user_id=F.col("o_custkey"), order_status=status, total_amount=money("o_totalprice"))
        was = as_map(id=key, user_id=F.col("o_custkey"), order_status=F.lit("1001"), total_amount=money("o_totalprice"))
        table = F.when(F.col("o_orderpriority") == "5-LOW", "shop_info").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "other_table").otherwise("order_info")
        orders = self.replayed("orders", "o_orderdate", files) if files else self.stream("orders")
        return orders.select(
            op.alias("op"), F.when(op.isin("u", "d"), was).alias("before"), F.when(op != "d", now).alias("after"), as_map(db=F.lit("shop"), table=table).alias("source"),
            (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + key % 86_400_000).alias("ts_ms"),
        )

    def cart_changes(self) -> DataFrame:
        n = F.col("l_quantity").cast("int")
        op = F.element_at(F.array(F.lit("r"), F.lit("u"), F.lit("c"), F.lit("u")), F.col("l_linenumber") % 4 + 1)
        ident = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        return self.stream("lineitem").select(
            op.alias("op"), F.when(op == "u", as_map(id=ident, sku_num=F.col("l_partkey") % 40)).alias("before"), as_map(id=ident, sku_id=F.col("l_partkey"), sku_num=n).alias("after"),
            as_map(db=F.lit("shop"), table=F.lit("cart_info")).alias("source"), F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"),
        )

    def order_events(self, files: int | None = None) -> DataFrame:
        """Orders as events, ``od_ts`` spread over the day by key."""
        at = F.timestamp_millis(F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86_400 * 1000)
        orders = self.replayed("orders", "o_orderdate", files) if files else self.stream("orders")
        return orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("amount"), at.alias("od_ts")
        )

    def order_lines(self, files: int = 8) -> DataFrame:
        """Every line of every order as an event at the time of the order, replayed in slices of the order day."""
        at = F.timestamp_millis(F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86_400 * 1000)
        placed = self.raw("orders").select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("od_user_id"), money("o_totalprice").alias("od_amount"), at.alias("od_ts"))
        lines = self.raw("lineitem").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        made = lines.select(detail_id().alias("id"), F.col("l_orderkey").alias("od_order_id"), "od_user_id", "od_amount", money("l_extendedprice").alias("split_amount"), "od_ts", "o_orderdate")
        return self.replay(made, F.unix_micros(F.col("o_orderdate").cast("timestamp")), files, self.span("orders", "o_orderdate"), "order-lines").drop("o_orderdate")

    def later(self, status: str | None, seconds: Column, prefix: str, files: int | None = None) -> DataFrame:
        """Follow-up events of orders (payments, cancels, refunds, comments), some seconds after the order."""
        rows = self.order_events(files)
        rows = rows if status is None else rows.where(F.col("status") == status)
        at = F.timestamp_millis(F.unix_millis("od_ts") + seconds * 1000)
        return rows.select(F.col("order_id").alias(f"{prefix}_order_id"), F.col("user_id").alias(f"{prefix}_user_id"), at.alias(f"{prefix}_ts"))

"""Change stream to dimension tables, driven by a small configuration table.

Every column of a dimension row is kept under its own key, so a later change that lacks a column leaves the known value alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tallyflow.sources.store import KeyedTable
from tallyflow.streaming.run import each_batch

CONFIG = "source_table string, sink_table string, sink_row_key string, sink_columns string"
RULES = "op string, source_table string, sink_table string, sink_row_key string, sink_columns string, at_ms bigint, backfill boolean"
RULE_NAMES = [f.split()[0] for f in RULES.split(", ")]
RULE_FIELDS = ", ".join(f.replace(" ", ": ") for f in RULES.split(", "))
CELLS = T.StructType().add("sink_table", "string").add("row_key", "string").add("field", "string").add("text", "string").add("ts_ms", "long")
DELETED = ""

#: Changes that one task turns into cells.
CHANGES_PER_TASK = 250_000


def dealt(changes: DataFrame, per_task: int = CHANGES_PER_TASK) -> DataFrame:
    """The changes of a batch in parts of about ``per_task`` rows, however few files they come in."""
    parts = -(-changes.count() // per_task)
    if parts <= 1:
        return changes
    return changes.withColumn("_nth", F.monotonically_increasing_id()).repartition(parts, "_nth").drop("_nth")


def to_cells(changes: DataFrame, config: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-empty configured column, under the md5 of the row key; a delete gives one row with the field DELETED.

    Tables without a rule are left out. The rules, a handful, go to every task: dealt by their few tables the changes would meet in as
    few tasks.
    """
    table = F.try_element_at("source", F.lit("table"))
    routed = changes.withColumn("source_table", table).join(F.broadcast(config), "source_table", "inner")
    gone = F.col("op") == "d"
    row = F.when(gone, F.col("before")).otherwise(F.col("after"))
    wanted = F.split("sink_columns", ",")
    kept = F.map_filter(F.col("row"), lambda k, v: F.array_contains(wanted, k) & v.isNotNull() & (v != ""))
    cells = F.when(gone, F.create_map(F.lit(DELETED), F.lit(DELETED))).otherwise(kept)
    key = F.try_element_at("row", F.col("sink_row_key"))
    keyed = routed.withColumn("row", row).where(key.isNotNull() & (key != ""))
    return keyed.select("sink_table", F.md5(key).alias("row_key"), F.explode(cells).alias("field", "text"), "ts_ms", *keep)


def sync(changes: DataFrame, path: str, config: Callable[[SparkSession], DataFrame]) -> StreamingQuery:
    """Upserts every micro-batch; the configuration is read again each time, so a changed rule counts from the next batch on."""
    spark = changes.sparkSession

    def step(df: DataFrame, batch: int) -> None:
        cells_table(spark, path).upsert(to_cells(dealt(df), config(df.sparkSession)), batch)

    return each_batch(changes, path, step)


# rules that change while the stream runs


def spans(rules: DataFrame) -> DataFrame:
    """From when to when (``from_ms`` up to ``to_ms``, either may be open) each rule of the log counts.

    A rule counts from its ``at_ms``, with ``backfill`` from the beginning, until the next entry for its source and sink.
    """
    w = Window.partitionBy("source_table", "sink_table").orderBy("at_ms", "op")
    from_ms = F.when(~F.coalesce("backfill", F.lit(False)), F.col("at_ms"))
    ranged = rules.withColumn("to_ms", F.lead("at_ms").over(w)).withColumn("from_ms", from_ms).where("op <> 'd'")
    return ranged.select("source_table", "sink_table", "sink_row_key", "sink_columns", "from_ms", "to_ms")


def to_cells_in_time(changes: DataFrame, ranged: DataFrame) -> DataFrame:
    """Cells of the changes under the rules that count at their time."""
    cells = to_cells(changes, ranged, ["from_ms", "to_ms"])
    inside = (F.col("from_ms").isNull() | (F.col("ts_ms") >= F.col("from_ms"))) & (F.col("to_ms").isNull() | (F.col("ts_ms") < F.col("to_ms")))
    return cells.where(inside).drop("from_ms", "to_ms")


def sync_with_rules(changes: DataFrame, rules: DataFrame, path: str) -> StreamingQuery:
    """Upserts every micro-batch under a rule log that is itself a stream.

    Rules and changes of a batch are kept, each under its batch, so that a repeated batch replaces its own. A rule applies to the
    changes of its batch and of later ones; where it counts from an earlier time, it is also applied to the changes stored by the batches
    before, pruned to its span. A rule that replaces another should come no later than the changes it applies to: columns that
    the replaced rule has written meanwhile stay.
    """
    spark, whole = changes.sparkSession, changes.schema
    both = changes.select(F.struct(*changes.columns).alias("change"), F.lit(None).cast(f"struct<{RULE_FIELDS}>").alias("rule"))
    both = both.unionByName(rules.select(F.lit(None).cast(whole).alias("change"), F.struct(*RULE_NAMES).alias("rule")))

    def step(df: DataFrame, batch: int) -> None:
        kept(df.where("rule is not null").select("rule.*"), f"{path}/rules", batch)
        kept(df.where("change is not null").select("change.*"), f"{path}/changes", batch)
        log = rule_log(spark, path, batch)
        ranged = spans(log)
        own = spark.read.schema(whole).parquet(f"{path}/changes/batch={batch}")
        cells = to_cells_in_time(own, ranged)
        if batch and not spark.read.schema(RULES).parquet(f"{path}/rules/batch={batch}").isEmpty():
            earlier = spark.read.schema(T.StructType([*whole.fields, T.StructField("batch", T.LongType())])).parquet(f"{path}/changes").where(F.col("batch") < batch)
            same = lambda rules: rules.withColumn("since", F.coalesce("from_ms", F.lit(-1)))
            known = same(spans(log.where(F.col("batch") < batch))).select("source_table", "sink_table", "sink_row_key", "sink_columns", "since")
            new = same(ranged).join(known, known.columns, "left_anti").drop("since")
            cells = cells.unionByName(to_cells_in_time(earlier.drop("batch"), new))
        cells_table(spark, path).upsert(cells, batch)

    return each_batch(both, path, step)


def kept(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch}")


def rule_log(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    log = spark.read.schema(f"{RULES}, batch long").parquet(f"{path}/rules")
    return log if upto is None else log.where(F.col("batch") <= upto)


def current_under_rules(spark: SparkSession, path: str) -> DataFrame:
    """Dimensions whose last rule still counts, from the cells since that rule, or an unbroken chain of rules, began.

    A removed rule drops its dimension; a later rule for the same sink starts it anew.
    """
    log = rule_log(spark, path)
    ends = log.where("op = 'd'").groupBy("source_table", "sink_table").agg(F.max("at_ms").alias("ended"))
    live = spans(log).where("to_ms is null").join(ends, ["source_table", "sink_table"], "left")
    since = live.groupBy("sink_table").agg(F.max(F.when(F.col("from_ms").isNotNull(), F.col("ended"))).alias("since"))
    return _rows(cells_table(spark, path).read().join(since, "sink_table").where("since is null or ts_ms >= since").drop("since"))


def cells_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, f"{path}/table", CELLS, ["sink_table", "row_key", "field"], ["ts_ms"])


def current(spark: SparkSession, path: str, config: DataFrame) -> DataFrame:
    """Rows of the dimensions still configured, their columns as a map; values older than the row's last delete are gone.

    A rule taken away drops its dimension.
    """
    return _rows(cells_table(spark, path).read().join(config.select("sink_table").distinct(), "sink_table", "left_semi"))


def _rows(cells: DataFrame) -> DataFrame:
    """Cells of a row side by side; a row has no more cells than its rule has columns."""
    rows = cells.groupBy("sink_table", "row_key").agg(
        F.max(F.when(F.col("field") == DELETED, F.col("ts_ms"))).alias("deleted_at"),
        F.collect_list(F.struct("field", "text", "ts_ms")).alias("cells"),
    )
    live = F.filter("cells", lambda c: (c["field"] != DELETED) & (F.col("deleted_at").isNull() | (c["ts_ms"] > F.col("deleted_at"))))
    info = F.map_from_entries(F.transform(live, lambda c: F.struct(c["field"], c["text"])))
    return rows.select("sink_table", "row_key", info.alias("info")).where(F.size("info") > 0)

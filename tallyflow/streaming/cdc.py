"""Change-log envelopes: op, before, after, source, ts_ms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = "op string, before map<string,string>, after map<string,string>, source map<string,string>, ts_ms bigint"


def parse(values: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to envelope; empty payloads (tombstones) and unreadable texts are left out here, see ``logs.split_dirty``."""
    envelope = F.from_json(F.col(column).cast("string"), ENVELOPE)
    # through an explode, so that the filter on the result does not parse a second time below it
    parsed = values.where(F.col(column).isNotNull()).select(F.explode(F.array(envelope)).alias("e"))
    return parsed.where("e.op is not null").select("e.*")


def after(field: str) -> Column:
    return F.try_element_at("after", F.lit(field))


def before(field: str) -> Column:
    return F.try_element_at("before", F.lit(field))


def of_table(changes: DataFrame, table: str, ops: Sequence[str] = ()) -> DataFrame:
    rows = changes.where(F.try_element_at("source", F.lit("table")) == table)
    return rows.where(F.col("op").isin(*ops)) if ops else rows


def fields(changes: DataFrame, names: Sequence[str]) -> DataFrame:
    return changes.select(*[after(n).alias(n) for n in names], "ts_ms")


def moved(changes: DataFrame, field: str, to: str, frm: str | None = None) -> DataFrame:
    """Updates that moved a field to ``to`` (from ``frm``, or from any known value)."""
    was = before(field) == frm if frm is not None else before(field).isNotNull()
    return changes.where((F.col("op") == "u") & was & (after(field) == to))


def grown(changes: DataFrame, field: str) -> DataFrame:
    """Added quantity: snapshot and inserted rows count in full, updates by how much they grew."""
    now, was = after(field).try_cast("int"), before(field).try_cast("int")
    full = F.col("op").isin("r", "c")
    rows = changes.where(full | ((F.col("op") == "u") & (now > was)))
    return rows.withColumn(field, F.when(full, now).otherwise(now - was))


def payload(changes: DataFrame) -> DataFrame:
    """The row after the change, or the row before a delete, with op and time."""
    there = F.when(F.col("after").isNotNull() & (F.size("after") > 0), F.col("after")).otherwise(F.col("before"))
    return changes.select("op", F.col("ts_ms").alias("tm_ms"), there.alias("row"), "source")


def flatten(changes: DataFrame, key: str = "id") -> DataFrame:
    """Flat change log: id_ts, op, db, table, before and after as JSON, time."""
    ident = F.coalesce(after(key), before(key))
    return changes.select(
        F.concat_ws("_", ident, F.col("ts_ms").cast("string")).alias("id_ts"), "op", F.try_element_at("source", F.lit("db")).alias("db"), F.try_element_at("source", F.lit("table")).alias("table"),
        F.to_json("before").alias("before"), F.to_json("after").alias("after"), "ts_ms",
    )


def route(changes: DataFrame, topics: Mapping[str, str], main: str = "main") -> DataFrame:
    """Target topic per row from its source table; unknown tables go to ``main``."""
    table = F.try_element_at("source", F.lit("table"))
    topic = F.lit(main)
    for name, target in topics.items():
        topic = F.when(table == name, F.lit(target)).otherwise(topic)
    return changes.withColumn("topic", topic)


def event_time(column: str = "ts_ms") -> Column:
    return F.timestamp_millis(F.col(column))


def add_ds(df: DataFrame, ms: str = "ts_ms") -> DataFrame:
    return df.withColumn("ds", F.date_format(F.timestamp_millis(F.col(ms)), "yyyyMMdd"))


def stamp(changes: DataFrame) -> DataFrame:
    """Adds the processing time; it differs from run to run, so keep it out of comparisons."""
    return changes.withColumn("process_time", F.current_timestamp())

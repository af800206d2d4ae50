"""Writers. Every one gives the same table when it runs again for the same date or batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tallyflow.operators.upsert import latest_per_key
from tallyflow.session import materialise
from tallyflow.sources.store import CAPACITY, KeyedTable
from tallyflow.streaming.run import each_batch


def replace_partitions(df: DataFrame, path: str, by: str = "dt", fmt: str = "parquet", self_read: bool = False) -> None:
    """Replace exactly the partitions present in ``df``. With ``self_read`` (df reads the table it replaces) it is materialised first.

    Rebalanced on the partition column: small days share a file writer, and a day that holds a large part of the rows is
    split over several tasks by AQE.
    """
    out = materialise(df, "replace") if self_read else df
    out.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).format(fmt).save(path)


def replace_day(df: DataFrame, path: str, dt: str, fmt: str = "parquet") -> None:
    """Replace one named partition; without rows the old ones go too, as the day's folder itself is overwritten."""
    df.drop("dt").hint("rebalance").write.mode("overwrite").format(fmt).save(f"{path}/dt={dt}")


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Plain append; running it twice adds the rows twice."""
    df.write.mode("append").format(fmt).save(path)


def report(df: DataFrame, path: str, dt: str | None = None) -> None:
    """Report rows kept per report date: a re-run for a date replaces that date's rows, changed ones included.

    With ``dt`` the date is replaced even by nothing; without it only the dates that have rows are.
    """
    if dt is None:
        replace_partitions(df, path, "dt")
    else:
        replace_day(df.where(F.col("dt") == F.lit(dt)), path, dt)


def report_text(df: DataFrame, path: str) -> None:
    """Tab-separated report files, one folder per report date."""
    text = df.select("dt", *[F.col(c).cast("string").alias(c) for c in df.columns if c != "dt"])
    text.hint("rebalance", F.col("dt")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("sep", "\t").option("nullValue", "\\N").partitionBy("dt").csv(path)


def load_and_verify(jobs: Mapping[str, Callable[[], DataFrame]], folder: str, as_of: str) -> dict[str, int | str]:
    """Run loads in order; give the row count written for the date, or the error. A failed load does not stop the next."""
    outcome: dict[str, int | str] = {}
    for name, build in jobs.items():
        try:
            df = build()
            report(df, f"{folder}/{name}", as_of)
            outcome[name] = df.sparkSession.read.parquet(f"{folder}/{name}").where(F.col("dt") == as_of).count()
        except Exception as e:  # noqa: BLE001 - reported to the caller
            outcome[name] = f"{type(e).__name__}: {e}"
    return outcome


def day_bucket(column: Column | str) -> Column:
    """``yyyyMMdd`` of an epoch (seconds below 10^10 are promoted to milliseconds); 'error_bucket' when it is no number."""
    c = F.col(column) if isinstance(column, str) else column
    n = c.try_cast("bigint")
    ms = F.when(n < 10_000_000_000, n * 1000).otherwise(n)
    return F.coalesce(F.date_format(F.timestamp_millis(ms), "yyyyMMdd"), F.lit("error_bucket"))


def bucketed_text(lines: DataFrame, field: str, column: str = "value") -> DataFrame:
    """Text lines with the folder they belong to, from a time field inside the JSON."""
    return lines.select(F.col(column).alias("value"), day_bucket(F.get_json_object(column, f"$.{field}")).alias("day"))


def json_rows(df: DataFrame, key: str | None = None, topic: Column | None = None) -> DataFrame:
    """Rows as JSON text with snake_case names, in the form of the Kafka sink: key, value and, when given, topic."""
    cols = [F.to_json(F.struct(*[F.col(c).alias(snake(c)) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    if topic is not None:
        cols.append(topic.alias("topic"))
    return df.select(*cols)


def snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")


def kafka_writer(rows: DataFrame, servers: str, path: str, topic: str | None = None):
    """Stream writer for JSON rows; without ``topic`` each row's own topic column is used. Needs the connector and a broker."""
    writer = rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
    writer = writer.option("checkpointLocation", f"{path}/checkpoint")
    return writer.option("topic", topic) if topic else writer


def olap_files(stream: DataFrame, path: str) -> StreamingQuery:
    """Window rows as JSON lines, one folder per batch id: a repeated batch overwrites its own folder."""
    step = lambda df, batch: json_rows(df).write.mode("overwrite").text(f"{path}/data/batch={batch}")
    return each_batch(stream, path, step)


def upsert_stream(stream: DataFrame, path: str, keys: list[str], order: list[str], op: str | None = None, capacity: int = CAPACITY) -> StreamingQuery:
    """Keep the newest row per key of a change stream in a keyed table."""
    spark, schema = stream.sparkSession, stream.schema
    return each_batch(stream, path, lambda df, batch: KeyedTable(spark, f"{path}/table", schema, keys, order, op, capacity).upsert(df, batch))


def keyed_table(stream: DataFrame, path: str, keys: list[str], order: list[str], op: str | None = None, capacity: int = CAPACITY) -> KeyedTable:
    return KeyedTable(stream.sparkSession, f"{path}/table", StructType(stream.schema.fields), keys, order, op, capacity)


def jdbc_upsert(stream: DataFrame, path: str, url: str, table: str, keys: list[str], order: list[str], properties: Mapping[str, str]) -> StreamingQuery:
    """Newest row per key of each batch to a staging table of a database, named after the batch; a repeated batch overwrites its own.

    The merge into ``table`` by key, and dropping the merged staging tables, is left to the database: each has its own statement
    for it.
    """

    def step(df: DataFrame, batch: int) -> None:
        latest_per_key(df, keys, order).write.jdbc(url, f"{table}_staging_{batch}", mode="overwrite", properties=dict(properties))

    return each_batch(stream, path, step)

"""Readers for the warehouse's stored forms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def orc_day(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """Partitioned ORC table; the filter on ``dt`` prunes folders."""
    df = spark.read.orc(path)
    return df if dt is None else df.where(F.col("dt") == dt)


def parquet_day(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if dt is None else df.where(F.col("dt") == dt)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated text, plain or gzip."""
    return spark.read.schema(schema).option("sep", "\t").option("nullValue", "\\N").csv(path)


def load_file(spark: SparkSession, path: str, schema: str, target: str, sep: str = "\t") -> DataFrame:
    """Bulk load of a text file into a table, replacing what was there."""
    spark.read.schema(schema).option("sep", sep).csv(path).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def json_log(spark: SparkSession, path: str) -> DataFrame:
    """One raw JSON text per row in column ``log``."""
    return spark.read.text(path).withColumnRenamed("value", "log")


def kafka(spark: SparkSession, servers: str, topic: str, offset: str = "latest", options: Mapping[str, str] | None = None) -> DataFrame:
    """Topic values as text; tombstones are dropped. Needs the Kafka connector on the class path and a broker."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", offset)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return values(reader.load())


def values(records: DataFrame) -> DataFrame:
    """Binary record values as text, NULL payloads left out."""
    return records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp").where(F.col("value").isNotNull())


def json_table(records: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """JSON topic as a typed table."""
    return records.select(F.from_json(F.col(column), schema).alias("r")).select("r.*")


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """First rows of a table for inspection."""
    return df.limit(n)

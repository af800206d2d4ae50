"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyflow.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that further columns, whatever their names, cannot clash; a null text counts as empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: later jobs read it again and lost executors cost nothing."""
    return materialise(df, f"llm-{name}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a few rows, without copies: what is made of a part is gone before the next one."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: the optimizer would copy a plain column into every place that uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)

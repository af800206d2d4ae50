"""Functions for SQL text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf


@arrow_udtf(returnType="id bigint, word string")
class Keywords:
    """``keyword_udtf(TABLE(...))``: the words of column ``text`` beside the ``id`` of their row, in the order of the text.

    Whole Arrow batches are split at once. In DataFrame code use ``streaming.logs.keywords``, which stays in the JVM.
    """

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
        words = pc.split_pattern_regex(texts, r"[^\p{L}\p{N}]+")
        row, flat = pc.list_parent_indices(words), pc.list_flatten(words)
        there = pc.not_equal(flat, "")
        ids = batch.column("id").cast(pa.int64()).take(row)
        yield pa.table({"id": ids.filter(there), "word": flat.filter(there)})


def register(spark: SparkSession) -> None:
    spark.udtf.register("keyword_udtf", Keywords)

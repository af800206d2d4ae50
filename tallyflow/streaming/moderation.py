"""Comments checked against a list of blocked words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRADE = "P0"


def flag(comments: DataFrame, blocked: DataFrame, text: str, word: str = "word") -> DataFrame:
    """The last comma-separated part of a comment is looked up: is_violation, grade and the word found."""
    last = F.element_at(F.split(F.col(text), ","), -1)
    words = blocked.select(F.col(word).alias("_word")).distinct()
    joined = comments.withColumn("_last", last).join(words, F.col("_last") == F.col("_word"), "left")
    hit = F.col("_word").isNotNull()
    return joined.select(
        *comments.columns,
        hit.cast("int").alias("is_violation"),
        F.when(hit, GRADE).otherwise("").alias("violation_grade"),
        F.when(hit, F.col("_last")).otherwise("").alias("violation_msg"),
    )


def any_blocked(comments: DataFrame, blocked: DataFrame, key: str, text: str, word: str = "word") -> DataFrame:
    """Blocked words found anywhere in a comment, by an equi-join on its words."""
    words = comments.select(key, F.explode(F.array_distinct(F.split(F.col(text), r"[^\p{L}\p{N}]+"))).alias("_w"))
    hits = words.join(blocked.select(F.col(word).alias("_w")).distinct(), "_w", "left_semi")
    return hits.groupBy(key).agg(F.array_sort(F.collect_set("_w")).alias("blocked_words"))

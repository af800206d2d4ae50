"""Benchmark items inside documents: size-partitioned MinHash containment search (operator 10); DataFrame functions only.

Items and documents become sets of word shingles, hashed to 64 bits. Items are partitioned by the size of their set; the
signature of an item holds its smallest hashes, as many as its partition needs so that a document that contains ``containment``
of an item holds at least one of them, whatever the document's length. Documents too small to contain that much of any item of a
partition are not asked about it. Every match of a signature value is a candidate and is verified on the whole sets.

Signatures are sent to the executors in blocks of at most ``BLOCK`` values, one pass over the documents a block: what is
broadcast is bounded, and the documents are not shuffled for the search.

Words are runs of letters and digits in lower case. An item of fewer words than the shingle is one shingle of all its words.

Defined results: a null text counts as empty; an item or a document without words matches nothing; texts are read whole; equal rows
give equal matches; rows with a null id match nothing; empty tables give an empty result; further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tallyflow.llm.frames import let, written

WORDS = 5
#: Signature values in one broadcast: at most about 40 MB as a hash table.
BLOCK = 500_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(w: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; ``w`` must be a plain value."""
    n = F.size(w) - size + 1
    run = lambda i: F.xxhash64(F.lit(size), *[F.get(w, i + k) for k in range(size)])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), run)).otherwise(F.array().cast("array<long>"))


def item_sets(items: DataFrame, size: int, containment: float, id_col: str, text_col: str) -> DataFrame:
    """``item_id``, ``members``, ``n``, ``width`` (words of its shingles), ``partition`` (power of two of n), ``signature``."""

    def own(w: Column) -> Column:
        members = F.when(F.size(w) >= size, shingles_of(w, size))
        for k in range(1, size):
            members = members.when(F.size(w) == k, shingles_of(w, k))
        return F.struct(F.least(F.size(w), F.lit(size)).alias("width"), F.array_sort(F.array_distinct(members)).alias("members"))

    some = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.inline(F.array(let(words(F.col(text_col)), own))))
    sets = some.where("width > 0").dropDuplicates(["item_id", "members"])
    sets = sets.withColumn("n", F.size("members")).withColumn("partition", F.floor(F.log2(F.col("n"))).cast("int"))
    # of n members n - ceil(c n) may be missing; the largest set of the partition decides for all of it
    largest = F.pow(F.lit(2), F.col("partition") + 1).cast("int") - 1
    keep = F.floor(largest * (1 - containment) + 1e-9).cast("int") + 1
    return sets.withColumn("signature", F.slice("members", F.lit(1), keep))


def candidates(docs: DataFrame, sets: DataFrame, containment: float) -> DataFrame:
    """``doc_id``, ``item_id``: pairs with a common signature value; ``docs``: ``doc_id``, ``members``."""
    wanted = sets.select("item_id", F.ceil(F.col("n") * containment).alias("least"), F.explode("signature").alias("h"))
    wanted = written(wanted.withColumn("block", F.pmod(F.xxhash64("h"), F.lit(_blocks(wanted)))), "signatures")
    sized = lambda m: F.transform(m, lambda h: F.struct(h.alias("h"), F.size(m).alias("size")))
    each = docs.select("doc_id", F.inline(let(F.col("members"), sized)))
    out = None
    for block in range(wanted.agg(F.max("block")).first()[0] + 1 if not wanted.isEmpty() else 0):
        part = F.broadcast(wanted.where(F.col("block") == block).select("h", "item_id", "least"))
        hits = each.join(part, "h").where(F.col("size") >= F.col("least")).select("doc_id", "item_id")
        out = hits if out is None else out.unionByName(hits)
    return (out if out is not None else each.select("doc_id", F.col("h").alias("item_id")).limit(0)).distinct()


def _blocks(values: DataFrame) -> int:
    """Hash blocks so that each holds about half of ``BLOCK`` values."""
    return max(1, math.ceil(values.count() / (BLOCK / 2)))


def contaminated(
    df: DataFrame, items: DataFrame, containment: float = 0.75, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item``, ``n_shared``, ``containment`` for every pair that reaches the threshold."""
    sets = written(item_sets(items, size, containment, item_id, item_text), "items")
    widths = sorted(r.width for r in sets.select("width").distinct().collect())
    every = lambda w: F.flatten(F.array(*[shingles_of(w, k) for k in widths])) if widths else F.array().cast("array<long>")
    docs = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), let(words(F.col(text_col)), every).alias("members"))
    pairs = written(candidates(docs, sets, containment), "candidates")
    asked = docs.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.col("members").alias("held"))
    both = pairs.join(asked, "doc_id").join(sets.select("item_id", "members", "n"), "item_id")
    shared = both.select("doc_id", "item_id", F.col("n").cast("long").alias("n_item"), F.size(F.array_intersect("members", "held")).cast("long").alias("n_shared"))
    rate = F.col("n_shared") / F.col("n_item")
    return shared.where(rate >= containment).distinct().select("doc_id", "item_id", "n_item", "n_shared", rate.alias("containment"))


def clean(df: DataFrame, items: DataFrame, containment: float = 0.75) -> DataFrame:
    """The rows, with all their columns, of documents that contain no benchmark item."""
    found = written(contaminated(df, items, containment).select("doc_id").distinct(), "contaminated")
    return df.join(found, df["doc_id"].cast("long") == found["doc_id"], "left_anti")

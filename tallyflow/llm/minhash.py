"""Near duplicates by bottom-k sketches of one hash function (operator 8).

A document's sketch is the ``K`` smallest hashes of its shingle set (all of a small set). Documents with the same set form a class
and one of them stands for it. Two documents whose similarity is ``similarity`` share at least ``least_overlap`` sketch values,
but for a chance below one in a million; so a document with fewer values that anybody shares is settled at once. The values of
the others are inverted lists. Their overlaps give pairs, the sketch of the union estimates the similarity, and what passes is
verified on the full sets, read again from the texts.

A list may hold any number of documents, so no list is expanded into all its pairs. In each of ``PIVOT_ROUNDS`` rounds every list
pairs one member with the members that are not yet in its component: groups of near copies grow together in a few rounds. What is
then still apart inside a list is paired exhaustively, but only across components, only by the lists of the rarest values of each sketch
(of 40 values that share 16, two documents share one of their 25 rarest), each pair once, at the first such value; parity bits of
the full sets rule out most pairs on the spot, and the largest component of a list is never paired with itself. No candidate is dropped.

Defined results: a null text counts as empty; an empty set links with nothing; texts are read whole; equal rows are one class and
link with each other; rows with a null id are counted, link with nothing and are kept; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyflow.llm.components import connected_components
from tallyflow.llm.frames import documents, slices, written
from tallyflow.llm.shingles import set_key, shingle_sets

K = 40
#: Sets of up to this size are their own sketch: exact, and as large as the partner of a set of K at 0.75 can be.
WHOLE = 56
LEAST = 16
PIVOT_ROUNDS = 2
#: 64-bit words of the parity bits of a set.
PARITY = 8


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``s1``, ``s2`` (key of the set), ``sketch`` (ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            n, s1, s2, sketch = [], [], [], []
            for s in shingle_sets(b.column("text")):
                n.append(len(s))
                key = set_key(s)
                s1.append(key[0])
                s2.append(key[1])
                sketch.append(s if len(s) <= WHOLE else s[:K].copy())
            cols = [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, s1, s2)), pa.array(sketch, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "s1", "s2", "sketch"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, sketch array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """``doc``, ``members``, ``parity``: the whole shingle sets, and for each bit whether an odd number of members falls on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            sets = list(shingle_sets(b.column("text")))
            odd = [np.packbits(np.bincount(s & (64 * PARITY - 1), minlength=64 * PARITY) & 1).view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sets, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))], ["doc", "members", "parity"])

    return docs.mapInArrow(run, "doc long, members array<long>, parity array<long>")


def least_overlap(n: Column, similarity: float) -> Column:
    """Sketch values that two documents of this similarity share at least."""
    return F.least(F.lit(LEAST), F.ceil(n * F.lit(similarity)).cast("int"))


def links(docs: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """``a``, ``b``: pairs of class representatives that are linked; together they connect all that is connected."""
    reps = found.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch")
    values = reps.select("doc", "n", F.explode("sketch").alias("v"))
    shared = values.join(values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "v")
    enough = shared.groupBy("doc").agg(F.count("*").alias("k"), F.first("n").alias("n")).where(F.col("k") >= least_overlap(F.col("n"), similarity)).select("doc")
    shared = written(shared.join(enough, "doc", "left_semi").select("doc", "v"), "lists")
    wanted = written(shared.select("doc").distinct(), "wanted")
    sketch = written(reps.join(wanted, "doc", "left_semi"), "sketches-of-lists")
    tried = linked = None
    sets = written(full_sets(docs.join(wanted.withColumnRenamed("doc", "doc_id"), "doc_id", "left_semi")).dropDuplicates(["doc"]), "sets")
    for turn in range(PIVOT_ROUNDS + 1):
        lists = shared.withColumn("component", F.col("doc"))
        if linked is not None:
            known = connected_components(linked).withColumnRenamed("node", "doc")
            lists = shared.join(known, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        if turn == PIVOT_ROUNDS:
            pairs = _remaining_pairs(lists, sketch, sets, similarity)
        else:
            pairs = _pivot_pairs(lists, turn)
        pairs = pairs.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        likely = written(_likely(pairs, sketch), "likely")
        good = written(_verified(likely, sets, similarity), "links")
        linked = good if linked is None else linked.unionByName(good)
    return linked


def _pivot_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """One member of each list with those of other components; another member in every turn."""
    order = F.col("doc") if turn == 0 else F.xxhash64("doc", F.lit(turn))
    pivot = lists.groupBy("v").agg(F.min_by(F.struct("doc", "component"), order).alias("p"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    pivot = pivot.select("v", F.col("p.doc").alias("other"), F.col("p.component").alias("theirs"))
    return lists.join(pivot, "v").where("component <> theirs").select("doc", "other")


def _remaining_pairs(lists: DataFrame, sketch: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Every pair across components that can still be linked, once, by the rarest values of the sketches.

    Sketches of m values that must share c hold a common value among their m - c + 1 rarest, in one order of all values. Values that no
    other sketch holds are rarer still and use up the first places. A pair comes out at the first value its rare values have in common.
    Common members of the full sets cancel out in their parities, so two sets differ in at least as many members as their parities in
    bits; more than (1 - t) / (1 + t) of both sizes rules a pair out.
    """
    lists = written(lists, "lists-of-components")
    per_value = lists.groupBy("v").agg(F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    apart = lists.join(per_value.where("low < high").select("v"), "v", "left_semi").select("doc").distinct()
    held = lists.join(apart, "doc", "left_semi").join(per_value.select("v", "df"), "v")
    # at most WHOLE values a document
    own = held.groupBy("doc", "component").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("held"))
    sized = own.join(sketch.select("doc", "n", F.size("sketch").alias("m")), "doc").join(sets.select("doc", "parity"), "doc")
    places = F.col("m") - least_overlap(F.col("n"), similarity) + 1 - (F.col("m") - F.size("held"))
    rare = sized.where(places > 0).select("doc", "component", "n", "parity", F.slice("held.v", F.lit(1), places).alias("rare"))
    rare = written(rare.withColumn("v", F.explode("rare")), "rare")
    main = rare.groupBy("v", "component").agg(F.count("*").alias("c")).groupBy("v").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count("*").alias("k")).where("k > 1")
    met = rare.join(main.select("v", "main"), "v")
    one = met.where("component <> main").select("v", *[F.col(c).alias(c + "1") for c in ("doc", "component", "n", "parity", "rare")])
    two = met.withColumnRenamed("v", "v2")
    sizes = (F.col("n") >= F.col("n1") * similarity) & (F.col("n1") >= F.col("n") * similarity)
    once = (F.col("component") != F.col("component1")) & ((F.col("component") == F.col("main")) | (F.col("doc1") < F.col("doc")))
    differ = sum((F.bit_count(F.get("parity", k).bitwiseXOR(F.get("parity1", k))) for k in range(PARITY)), F.lit(0))
    close = differ <= (F.col("n") + F.col("n1")) * ((1 - similarity) / (1 + similarity)) + 1e-9
    first = F.get(F.array_intersect("rare", "rare1"), 0) == F.col("v")
    return one.join(two, (F.col("v") == F.col("v2")) & once & sizes & close & first).select("doc", F.col("doc1").alias("other"))


def _likely(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """Pairs whose similarity, estimated on the sketch of the union, is not clearly below the threshold."""
    one = sketch.select(F.col("doc").alias("a"), F.col("sketch").alias("x"))
    two = sketch.select(F.col("doc").alias("b"), F.col("sketch").alias("y"))
    both = pairs.join(one, "a").join(two, "b")
    low = F.slice(F.array_sort(F.array_union("x", "y")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect(low, F.col("x")), F.col("y")))
    return both.where(common >= F.lit(LEAST / K) * F.size(low)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    one = sets.select(F.col("doc").alias("a"), F.col("members").alias("x"))
    two = sets.select(F.col("doc").alias("b"), F.col("members").alias("y"))
    similar = _similar(F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y"), similarity)
    return pairs.join(one, "a").join(two, "b").where(similar).select("a", "b")


def _similar(common: Column, sizes: Column, similarity: float) -> Column:
    """Common members against the union, in whole numbers: c / (sizes - c) >= p / 100 for a similarity of p hundredths."""
    p = math.floor(similarity * 100 + 0.5)
    return common * (100 + p) >= p * sizes


def near_duplicates(df: DataFrame, similarity: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row."""
    docs = documents(df, id_col, text_col)
    found = written(sketches(docs), "sketches")
    key = ["n_shingles", "s1", "s2"]
    some = found.where("n_shingles > 0 and doc_id is not null")
    classes = written(some.groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    reps = some.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    linked = links(docs, reps, similarity)
    component = connected_components(linked)
    of_class = classes.join(component, classes.rep == component.node, "left").select(*key, F.coalesce("component", "rep").alias("component"))
    out = found.select("doc_id", *key).join(of_class, key, "left")
    # an empty set has no class
    component_id = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

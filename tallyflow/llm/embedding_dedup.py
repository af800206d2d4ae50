"""Near duplicates among embeddings: sign hashing, exact cosine, connected components (operator 1).

Equal vectors form a class, one row stands for it. Random hyperplanes give every class ``tables`` short bucket keys and one long
signature. Classes that meet in a bucket of any table and differ in few bits of the signature are candidates; their cosine is
computed in double precision from the vectors themselves. The number of bits per table follows the logarithm of the number of
classes, so buckets stay small as the data grows, and the number of tables follows the bits, so that a pair exactly at the
threshold is missed with a chance of ``miss`` at most (closer pairs far less often).

Buckets are joined, not collected: a crowded one is split by the skew handling of the join.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
lengths do not link; equal vectors link with each other; rows that share an id are one node; rows with a null id have no links, no
component and are kept; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyflow.llm.components import connected_components
from tallyflow.llm.frames import written

#: Bits of the long signature, as 64-bit words.
WORDS = 4


def plan(n: int, cosine: float, miss: float) -> tuple[int, int]:
    """Bits per table and tables for ``n`` classes."""
    bits = min(30, max(8, math.ceil(math.log2(max(2, n))) - 4))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same))


def most_differences(cosine: float) -> int:
    """Signature bits in which two vectors at the threshold differ at most: seven standard deviations above the mean."""
    p, n = math.acos(cosine) / math.pi, 64 * WORDS
    return min(n, math.ceil(n * p + 7 * math.sqrt(n * p * (1 - p))))


@lru_cache(8)
def _planes(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count)).astype(np.float32)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Components as doubles and the offsets of the vectors."""
    off = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return values[off[0] : off[-1]], off - off[0]


def hashed(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``vec``, ``dim``, ``keys`` (one number per table), ``s0`` ... (long signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, off = _vectors(b.column("embedding"))
            length = np.diff(off)
            keys, sign = np.zeros((len(length), tables), np.int32), np.zeros((len(length), WORDS), np.uint64)
            for dim in np.unique(length):
                rows = np.flatnonzero(length == dim)
                v = values[off[rows][:, None] + np.arange(dim)]
                v = (v / np.abs(v).max(axis=1, keepdims=True)).astype(np.float32)  # only the direction counts; no overflow
                side = v @ _planes(int(dim), bits * tables + 64 * WORDS, seed) > 0
                short = side[:, : bits * tables].reshape(len(rows), tables, bits)
                keys[rows] = (short * (1 << np.arange(bits, dtype=np.int32))).sum(axis=2)
                sign[rows] = np.packbits(side[:, bits * tables :], axis=1).view(np.uint64)
            cols = [b.column("vec"), pa.array(length.astype(np.int32)), pa.array(list(keys), pa.list_(pa.int32())), *(pa.array(sign[:, k].view(np.int64)) for k in range(WORDS))]
            yield pa.RecordBatch.from_arrays(cols, ["vec", "dim", "keys", *(f"s{k}" for k in range(WORDS))])

    return classes.mapInArrow(run, "vec long, dim int, keys array<int>, " + ", ".join(f"s{k} long" for k in range(WORDS)))


def candidates(marked: DataFrame, cosine: float) -> DataFrame:
    """``a``, ``b``: classes that share a bucket and differ in few bits of the signature."""
    words = [f"s{k}" for k in range(WORDS)]
    rows = marked.select("vec", "dim", *words, F.posexplode("keys").alias("t", "key"))
    one = rows.select("t", "dim", "key", F.col("vec").alias("a"), *[F.col(w).alias("x" + w) for w in words])
    two = rows.select("t", "dim", "key", F.col("vec").alias("b"), *[F.col(w).alias("y" + w) for w in words])
    differ = sum((F.bit_count(F.col("x" + w).bitwiseXOR(F.col("y" + w))) for w in words), F.lit(0))
    met = (one.t == two.t) & (one.dim == two.dim) & (one.key == two.key) & (one.a < two.b) & (differ <= most_differences(cosine))
    return one.join(two, met).select("a", "b").distinct()


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """``a``, ``b`` with a cosine of at least ``cosine`` in double precision."""
    x = classes.select(F.col("vec").alias("a"), F.col("embedding").alias("x"))
    y = classes.select(F.col("vec").alias("b"), F.col("embedding").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            (u, off), (v, _) = _vectors(b.column("x")), _vectors(b.column("y"))
            at, length = off[:-1], np.diff(off)
            u = u / np.repeat(np.maximum.reduceat(np.abs(u), at), length)
            v = v / np.repeat(np.maximum.reduceat(np.abs(v), at), length)
            dot = lambda p, q: np.add.reduceat(p * q, at)
            good = dot(u, v) / np.sqrt(dot(u, u) * dot(v, v)) >= cosine
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(good)), b.column("b").filter(pa.array(good))], ["a", "b"])

    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, cosine: float = 0.95, miss: float = 1e-5, seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    usable = F.coalesce((F.size("embedding") > 0) & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    good = rows.where(usable)
    classes = written(good.groupBy("embedding").agg(F.min("vec_id").alias("vec"), F.count("*").alias("copies")), "classes")
    bits, tables = plan(classes.count(), cosine, miss)
    marked = written(hashed(classes.select("vec", "embedding"), bits, tables, seed), "signatures")
    pairs = written(candidates(marked, cosine), "candidates")
    links = written(verified(pairs, classes, cosine), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("vec").alias("b"), "copies")
    beside = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("beside"))
    component = connected_components(links)
    told = (
        classes.join(beside, classes.vec == beside.a, "left")
        .join(component, classes.vec == component.node, "left")
        .select("embedding", (F.col("copies") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"), F.coalesce("component", "vec").alias("component_id"))
    )
    told = written(told, "told")
    linked = good.join(told, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

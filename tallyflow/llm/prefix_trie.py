"""Prefix trie of conversations from padded turn-id matrices (operator 12).

A turn becomes a symbol of 20 bytes: the md5 of its role and text, and the byte length of its text. A conversation is the string of
its symbols, so no text is shuffled. Strings are dealt to range shards by (string, conversation id); equal conversations may lie in
several shards, so a very common one is no single task's load. Inside a shard:

1. the symbols become dense turn ids and the rows a padded matrix, built ``WIDTH`` columns at a time and only for rows that still
   have turns or are not told apart yet; ``np.lexsort`` orders them;
2. change masks against the row above, OR-accumulated over the columns, mark where nodes start: at depth d a row starts a node when it
   differs from the row above within its first d columns;
3. ``reduceat`` over these starts aggregates every depth.

Everything a node needs is a sum or a minimum over its rows once the first and last row of a shard know their neighbours: children and
distinct texts are counted where a node starts, leaves where one ends. Nodes that reach over the edge of a shard are recombined by the
md5 of their path; their member ids travel as sorted chunks, hashed in order.

Bounds: a conversation is a matrix row, 20 bytes a turn, and must fit into a task; a node's members need not.

Defined results: null role or text counts as empty; null turns come first; rows of one conversation with equal turns are ordered by their
symbol; repeated rows are turns of their own; rows without a conversation id belong to none; texts may have any length; an empty table
has no nodes; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyflow.llm.frames import shuffle_partitions, written

SYMBOL = 20
WIDTH = 8
SHARD_BYTES = 8 << 20
CHUNK_IDS = 400
SHARED, MODULUS = 5, 9
EMPTY = hashlib.sha256(b"").hexdigest()

PARTS = (
    "kind int, shard int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, all_bytes long, distinct_bytes long, ends_sha256 string, chunk binary"
)
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "all_bytes", "distinct_bytes")]
    + [("ends_sha256", pa.string()), ("chunk", pa.binary())]
)
WHOLE, SPANNING, ENDS = 0, 1, 2


# conversations as strings of symbols


def _symbol(role: Column, text: Column) -> Column:
    """40 hex digits: md5 of the length of the role, the role and the text; then the text's byte length."""
    ident = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    return F.concat(ident, F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def sequences(conversations: DataFrame, rebuild: bool = True) -> DataFrame:
    """``conv_id``, ``seq``: symbols side by side in the order of the turns.

    With ``rebuild`` conversation c starts with the first h = crc32(c) % 9 turns of conversation c - c % 5, followed by its own turns
    after its first h. All of one base lie together, so one shuffle serves the grouping and the base.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    c = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id is not null").select(c.alias("conv_id"), (c - c % SHARED).alias("base"), F.col("turn").alias("turn"), _symbol(text("role"), text("text")).alias("symbol"))
    listed = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "symbol"))).alias("t"))
    own = listed.select("base", "conv_id", F.unhex(F.array_join(F.col("t.symbol"), "")).alias("own"))
    if not rebuild:
        return own.select("conv_id", F.col("own").alias("seq"))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.substring("own", 1, SYMBOL * MODULUS))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string")) % MODULUS * SYMBOL).cast("int")
    cut = own.withColumn("head", F.coalesce(head, F.unhex(F.lit("")))).withColumn("h", h)
    return cut.select("conv_id", F.concat(F.expr("substring(head, 1, h)"), F.expr("substring(own, h + 1)")).alias("seq"))


# one shard


class Shard:
    """Rows of one shard in lexicographic order, with what the neighbouring shards say about its edges."""

    def __init__(self, conv: np.ndarray, seqs: list[bytes], before: bytes | None, after: bytes | None):
        size = np.fromiter(map(len, seqs), np.int64, len(seqs)) // SYMBOL
        raw = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, SYMBOL)
        flat, begin = turn_ids(raw), np.cumsum(size) - size
        order = lexorder(flat, begin, size, conv)
        self.conv, self.size, self.begin = conv[order], size[order], begin[order]
        self.lengths = raw[:, 16:].copy().view(">u4").ravel().astype(np.int64)
        self.first, self.last = seqs[order[0]], seqs[order[-1]]
        self.before = common(before, self.first)
        self.after = common(self.last, after)
        self.same = shared_prefixes(flat, self.begin, self.size)
        self.same[0] = self.before
        following = np.append(self.same[1:], self.after)
        self.ends_leaf = following < self.size
        # bytes of a row's turns from depth d on: running sums over the flat lengths
        self.sums = np.concatenate([[0], np.cumsum(self.lengths)])

    def bytes_from(self, rows: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
        """Text bytes of the rows' turns number ``depth`` (from 1) to the last; depth 0 is the root, which has no text."""
        start = np.minimum(np.maximum(np.asarray(depth), 1) - 1, self.size[rows])
        return self.sums[self.begin[rows] + self.size[rows]] - self.sums[self.begin[rows] + start]

    def nodes(self, shard: int) -> Iterator[pa.RecordBatch]:
        first_keys, last_keys = path_keys(self.first, self.before), path_keys(self.last, self.after)
        rows = np.arange(len(self.conv))
        parent_of, parent_min, parent_key = np.zeros(len(rows), np.int64), np.array([0]), [None]
        depth, has_parent = 0, False
        while len(rows):
            # rows[k] starts a node of this depth when it differs from the row above within its first ``depth`` turns
            starts = np.flatnonzero(self.same[rows] < depth)
            if not len(starts) or starts[0]:
                starts = np.concatenate([[0], starts])
            n = len(starts)
            least = np.minimum.reduceat(self.conv[rows], starts)
            total = lambda x: np.add.reduceat(x, starts)
            ended = total((self.size[rows] == depth).astype(np.int64))
            node_key: list[bytes | None] = [None] * n
            if rows[0] == 0 and depth <= self.before:
                node_key[0] = first_keys[depth]
            if rows[-1] == len(self.conv) - 1 and depth <= self.after:
                node_key[-1] = last_keys[depth]
            hashes, chunks = [EMPTY] * n, []
            for k in np.flatnonzero(ended).tolist():
                members = self.conv[rows[starts[k] : starts[k] + ended[k]]]
                if node_key[k] is None:
                    hashes[k] = hashlib.sha256(",".join(map(str, members.tolist())).encode()).hexdigest()
                else:
                    chunks += [(node_key[k], int(members[a]), ",".join(map(str, members[a : a + CHUNK_IDS].tolist())).encode()) for a in range(0, len(members), CHUNK_IDS)]
            above = parent_of[rows[starts]]
            up = [parent_key[p] for p in above.tolist()] if has_parent else [None] * n
            up_min = pa.array(np.where([u is None for u in up], parent_min[above], 0), mask=np.array([u is not None for u in up])) if has_parent else pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([WHOLE if x is None else SPANNING for x in node_key], pa.int32()), pa.array(np.full(n, shard, np.int32)), pa.array(node_key, pa.binary()), pa.array(up, pa.binary()),
                    pa.array(np.full(n, depth, np.int64)), pa.array(least), up_min, pa.array(total(np.ones(len(rows), np.int64))),
                    pa.array(total(((self.same[rows] <= depth) & (self.size[rows] > depth)).astype(np.int64))), pa.array(total(self.ends_leaf[rows].astype(np.int64))),
                    pa.array(total(self.bytes_from(rows, depth))), pa.array(total(self.bytes_from(rows, np.maximum(depth, self.same[rows] + 1)))),
                    pa.array(hashes, pa.string()), pa.nulls(n, pa.binary()),
                ],
                schema=_SCHEMA,
            )
            if chunks:
                yield _chunk_batch(chunks, shard, depth)
            parent_of[rows] = np.repeat(np.arange(n), np.diff(np.append(starts, len(rows))))
            parent_min, parent_key, has_parent = least, node_key, True
            depth += 1
            rows = rows[self.size[rows] >= depth]


def _chunk_batch(chunks: list[tuple[bytes, int, bytes]], shard: int, depth: int) -> pa.RecordBatch:
    n = len(chunks)
    fixed = {"kind": pa.array(np.full(n, ENDS, np.int32)), "shard": pa.array(np.full(n, shard, np.int32)), "depth": pa.array(np.full(n, depth, np.int64))}
    own = {"key": pa.array([c[0] for c in chunks], pa.binary()), "conv_id": pa.array([c[1] for c in chunks], pa.int64()), "chunk": pa.array([c[2] for c in chunks], pa.binary())}
    return pa.RecordBatch.from_arrays([{**fixed, **own}.get(f.name, pa.nulls(n, f.type)) for f in _SCHEMA], schema=_SCHEMA)


def turn_ids(raw: np.ndarray) -> np.ndarray:
    """Dense ids from 1, in the byte order of the symbols."""
    high, low, size = raw[:, :8].copy().view(">u8").ravel(), raw[:, 8:16].copy().view(">u8").ravel(), raw[:, 16:].copy().view(">u4").ravel()
    by = np.lexsort((size, low, high))
    new = np.zeros(len(by), bool)
    for x in (high, low, size):
        new[1:] |= x[by][1:] != x[by][:-1]
    out = np.empty(len(by), np.int64)
    out[by] = np.cumsum(new) + 1
    return out


def tile(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, rows: np.ndarray, at: int) -> np.ndarray:
    """Columns ``at`` to ``at + WIDTH`` of the padded matrix; 0 stands behind the last turn."""
    place = at + np.arange(WIDTH)
    inside = place < size[rows][:, None]
    return np.where(inside, flat[np.where(inside, begin[rows][:, None] + place, 0)], 0) if len(flat) else np.zeros((len(rows), WIDTH), np.int64)


def lexorder(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows by their turn ids, a prefix before what extends it, equal rows by conversation id."""
    order, group = np.argsort(conv, kind="stable"), np.zeros(len(conv), np.int64)
    open_, at = np.arange(len(conv)), 0
    while len(open_) > 1:
        rows = order[open_]
        m = tile(flat, begin, size, rows, at)
        by = np.lexsort((conv[rows], *m.T[::-1], group))
        order[open_], m = rows[by], m[by]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (m[1:] != m[:-1]).any(axis=1)])
        number = np.cumsum(new) - 1
        go_on = (np.bincount(number)[number] > 1) & (m[:, -1] > 0)
        open_, group, at = open_[go_on], number[go_on], at + WIDTH
    return order


def shared_prefixes(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many leading turns each row shares with the row above, from change masks OR-accumulated over the columns."""
    out = np.zeros(len(size), np.int64)
    at, rows = 0, np.arange(1, len(size))
    while len(rows):
        changed = tile(flat, begin, size, rows, at) != tile(flat, begin, size, rows - 1, at)
        changed |= np.minimum(size[rows], size[rows - 1])[:, None] <= at + np.arange(WIDTH)
        same = WIDTH - np.logical_or.accumulate(changed, axis=1).sum(axis=1)
        out[rows] += same
        rows, at = rows[same == WIDTH], at + WIDTH
    return out


def common(a: bytes | None, b: bytes | None) -> int:
    """Symbols that two neighbours share; -1 at the ends of the whole order."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // SYMBOL
    x, y = (np.frombuffer(s, np.uint8, n * SYMBOL).reshape(n, SYMBOL) for s in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def path_keys(seq: bytes, depth: int) -> dict[int, bytes]:
    """md5 of each prefix of a row up to ``depth`` symbols."""
    out, h = {}, hashlib.md5()
    for d in range(depth + 1):
        out[d] = h.digest()
        h.update(seq[d * SYMBOL : (d + 1) * SYMBOL])
    return out


# shards together


def trie(conversations: DataFrame, rebuild: bool = True) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes that shared turns need not be stored again, over the subtree), ``ends_sha256`` of the members that end there."""
    spark = conversations.sparkSession
    laid = written(sequences(conversations, rebuild), "sequences")
    size = laid.agg(F.sum(F.octet_length("seq") + 16)).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-size // SHARD_BYTES))
    dealt = written(laid.repartitionByRange(shards, "seq", "conv_id").withColumn("shard", F.spark_partition_id()), "shards")
    # one row per shard: the neighbours' edge rows
    edges = dealt.groupBy("shard").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    along = Window.orderBy("shard")
    edges = edges.select("shard", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))

    def run(rows: pa.Table, edge: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _SCHEMA.empty_table()
        e = edge.to_pylist()[0]
        one = Shard(rows.column("conv_id").to_numpy(), rows.column("seq").to_pylist(), e["before"], e["after"])
        return pa.Table.from_batches(list(one.nodes(e["shard"])), _SCHEMA)

    parts = written(dealt.groupBy("shard").cogroup(edges.groupBy("shard")).applyInArrow(run, PARTS), "nodes")
    return _recombined(parts)


def _recombined(parts: DataFrame) -> DataFrame:
    sums = ["n_convs", "n_children", "n_leaves", "all_bytes", "distinct_bytes"]
    spanning = parts.where(F.col("kind") == SPANNING)
    joined = spanning.groupBy("key").agg(F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums])
    joined = written(joined.join(_hashed(parts.where(F.col("kind") == ENDS)), "key", "left"), "spanning")
    least = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_least"))
    # a spanning parent is looked up by (shard, key): no more rows meet than a shard holds
    by_shard = spanning.select("shard", F.col("key").alias("parent_key")).join(least, "parent_key")
    whole = parts.where(F.col("kind") == WHOLE).join(by_shard, ["shard", "parent_key"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_least"))
    over = joined.join(least, "parent_key", "left").withColumn("parent_conv_id", F.col("_least")).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    named = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("all_bytes") - F.col("distinct_bytes")).alias("saved_tokens"), "ends_sha256"]
    return whole.select(*named).unionByName(over.select(*named))


def _hashed(chunks: DataFrame) -> DataFrame:
    """SHA-256 of each node's chunks in the order of their first id; a node's chunks stream by, they are never held together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()], pa.string())], ["key", "ends_sha256"])
        for b in batches:
            for k, chunk in zip(b.column("key").to_pylist(), b.column("chunk").to_pylist(), strict=True):
                if k == key:
                    h.update(b",")
                else:
                    if h is not None:
                        yield done()
                    key, h = k, hashlib.sha256()
                h.update(chunk)
        if h is not None:
            yield done()

    return chunks.select("key", "conv_id", "chunk").repartition("key").sortWithinPartitions("key", "conv_id").select("key", "chunk").mapInArrow(run, "key binary, ends_sha256 string")

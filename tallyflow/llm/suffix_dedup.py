"""Exact repeats of byte strings by column-wise sorting of many documents (operator 7).

Which ``length``-byte strings also start earlier is decided by a positional Burrows-Wheeler transform: a collection of segments is
read column by column from the right, every round inserts one symbol of each segment, re-sorts the collection by that symbol
(stable, so suffixes stay sorted) and updates the common prefixes of neighbours. Suffixes that share ``length`` symbols are one
group; all but the earliest of it are repeats.

The collection is dealt out so that each task holds what may be equal and nothing is compared twice:

1. Documents are packed into chunks of about a megabyte, a compressed table in the shared folder.
2. Every window of ``length`` bytes belongs to its minimizer, the leftmost least hash of its ``K``-grams; equal windows have equal
   minimizers at equal offsets. A run of windows with one minimizer is a segment. Hashes of minimizer and segment are shuffled by
   the minimizer, after equal segments of a task are reduced to their first.
3. A minimizer that occurs once has no repeats. Of equal segments all but the first are repeats as a whole. Only different
   segments of one minimizer remain; their bytes are cut from the chunks, shuffled by the minimizer, aligned at it and sorted
   column by column. A minimizer with more than ``HOT`` segments is split: windows at nearby offsets share a core of bytes, and the
   hash of the core deals them out.
4. The repeats of each chunk are united and taken out.

Each step is a sequential pass that reads a table and writes the next one in the shared folder. Equal segments are told by 112
bits of hashes.

Defined results: a null text counts as empty; matches do not cross documents; texts are read whole; rows with equal ids count in
the order in which they are stored, rows without an id after all others; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyflow.llm.frames import documents, shuffle_partitions, written
from tallyflow.llm.shingles import _powers, mixed

CHUNK = 1 << 20
#: Texts beyond this are scanned in overlapping slices.
SLICE = 4 << 20
#: Anchors that a task holds before it sends them on.
BUFFER = 300_000
#: Different segments of one minimizer from which on it is split.
HOT = 100
STEP = 8
NO_ID = 2**63 - 1


def gram(length: int) -> int:
    return max(1, 2 * length // 5)


# chunks


def chunked(docs: DataFrame) -> DataFrame:
    """``chunk``, ``doc_ids``, ``sizes``, ``data`` (compressed bytes of the documents side by side)."""
    import zstandard

    def row(chunk: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        data = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(b"".join(texts))
        cols = [pa.array([chunk]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([data], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, ["chunk", "doc_ids", "sizes", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= CHUNK or len(ids) >= 20_000:
                    yield row(chunk, ids, texts)
                    chunk, ids, texts, size = chunk + 1, [], [], 0
        if ids:
            yield row(chunk, ids, texts)

    return docs.mapInArrow(run, "chunk long, doc_ids array<long>, sizes array<long>, data binary")


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)


# minimizers


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of each run of ``width`` values, by doubling."""
    at = np.arange(len(h), dtype=np.int32)

    def join(h: np.ndarray, at: np.ndarray, by: int) -> tuple[np.ndarray, np.ndarray]:
        right = h[by:] < h[:-by]
        return np.where(right, h[by:], h[:-by]), np.where(right, at[by:], at[:-by])

    have = 1
    while have * 2 <= width:
        h, at = join(h, at, have)
        have *= 2
    return join(h, at, width - have)[1] if have < width else at


def segments(raw: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of windows with one minimizer: first window ``pos``, windows ``n``, offset ``o`` of the minimizer, hashes ``h`` and ``seg``.

    ``ends``: where each document ends. Windows never reach over an end.
    """
    parts = []
    for at in range(0, max(1, len(raw)), SLICE):
        piece = raw[at : at + SLICE + length - 1]
        if len(piece) >= length:
            parts.append(_segments(piece, ends, at, length))
    if not parts:
        return {k: np.zeros(0, t) for k, t in (("pos", np.int64), ("n", np.int64), ("o", np.int64), ("h", np.uint64), ("seg", np.uint64))}
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _segments(raw: np.ndarray, ends: np.ndarray, base: int, length: int) -> dict[str, np.ndarray]:
    k = gram(length)
    power, inverse = _powers(1 << max(23, int(len(raw) + 1).bit_length()))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=total[1:])
    h = mixed((total[k:] - total[:-k]) * inverse[: len(raw) - k + 1]) >> np.uint64(16)
    at = _least(h, length - k + 1)
    windows = np.arange(len(at))
    end = ends[np.searchsorted(ends, windows + base, "right")] - base
    p = np.flatnonzero(windows + length <= end)
    if not len(p):
        p = p[:0]
    key, doc = at[p], end[p]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(p) else p
    n = np.diff(np.append(first, len(p)))
    begin = p[first]
    stop = begin + n - 1 + length
    seg = mixed((total[stop] - total[begin]) * inverse[begin] + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (key[first] - begin).astype(np.uint64))
    return {"pos": begin + base, "n": n, "o": (key[first] - begin).astype(np.int64), "h": h[key[first]], "seg": seg}


FIELDS = (("chunk", np.int64), ("doc", np.int64), ("pos", np.int64), ("n", np.int64), ("o", np.int64), ("h", np.uint64), ("seg", np.uint64))
#: Bytes a value takes on the way; hashes of minimizers have 48 bits.
_WIDTH = {"chunk": 8, "doc": 8, "pos": 8, "n": 2, "o": 2, "h": 6, "seg": 8}


def _packed(rows: dict[str, np.ndarray]) -> bytes:
    """Columns side by side, the ascending ones as differences, compressed."""
    import zstandard

    out = []
    for name, _ in FIELDS:
        v = rows[name]
        if name in ("chunk", "doc", "pos"):
            v = np.diff(v, prepend=v.dtype.type(0))
        out.append(np.ascontiguousarray(v.astype("<i8" if v.dtype == np.int64 else "<u8").view(np.uint8).reshape(-1, 8)[:, : _WIDTH[name]].T if name not in ("h", "seg") else v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _WIDTH[name]]).tobytes())
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(b"".join(out))


def _opened(blob: bytes) -> dict[str, np.ndarray]:
    raw = _unpacked(blob)
    n, at, rows = len(raw) // sum(_WIDTH.values()), 0, {}
    for name, kind in FIELDS:
        w = _WIDTH[name]
        part = raw[at : at + n * w]
        full = np.zeros((n, 8), np.uint8)
        full[:, :w] = part.reshape(n, w) if name in ("h", "seg") else part.reshape(w, n).T
        v = full.view("<u8").reshape(-1).astype(np.uint64) if kind is np.uint64 else full.view("<i8").reshape(-1).astype(np.int64)
        rows[name] = np.cumsum(v) if name in ("chunk", "doc", "pos") else v
        at += n * w
    return rows


def _take(rows: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[which] for k, v in rows.items()}


def _ordered(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """By minimizer, segment and place, and which rows are the first of equal segments."""
    rows = _take(rows, np.lexsort((rows["pos"], rows["chunk"], rows["doc"], rows["seg"], rows["h"])))
    first = np.ones(len(rows["h"]), bool)
    first[1:] = (rows["h"][1:] != rows["h"][:-1]) | (rows["seg"][1:] != rows["seg"][:-1])
    return rows, first


SENT = "bucket int, chunk long, blob binary, pos array<long>, size array<long>"


def sent(chunks: DataFrame, buckets: int, length: int) -> DataFrame:
    """Anchors of all chunks by bucket, and the repeats already known inside a task."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary()), ("pos", pa.list_(pa.int64())), ("size", pa.list_(pa.int64()))])

    def flush(held: list[dict]) -> Iterator[pa.RecordBatch]:
        rows, first = _ordered({k: np.concatenate([x[k] for x in held]) for k, _ in FIELDS})
        yield from _spans(_take(rows, ~first), length, schema)
        rows = _take(rows, first)
        bucket = (mixed(rows["h"]) % np.uint64(buckets)).astype(np.int64)
        rows = {**_take(rows, order := np.lexsort((rows["pos"], rows["chunk"], bucket))), "bucket": bucket[order]}
        cuts = np.flatnonzero(np.diff(rows["bucket"], prepend=-1))
        out = [(int(rows["bucket"][a]), _packed({k: rows[k][a:b] for k, _ in FIELDS})) for a, b in zip(cuts, np.append(cuts[1:], len(rows["bucket"])), strict=True)]
        if out:
            none = [None] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array(none, pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array(none, schema.field("pos").type), pa.array(none, schema.field("size").type)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for chunk, ids, sizes, data in zip(*(b.column(c).to_pylist() for c in ("chunk", "doc_ids", "sizes", "data")), strict=True):
                ends = np.cumsum(np.array(sizes, np.int64))
                rows = segments(_unpacked(data), ends, length)
                doc = np.array([NO_ID if i is None else i for i in ids], np.int64)[np.searchsorted(ends, rows["pos"], "right")]
                held.append(rows | {"doc": doc, "chunk": np.full(len(doc), chunk, np.int64)})
                size += len(doc)
                if size >= BUFFER:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return chunks.mapInArrow(run, SENT)


def _spans(rows: dict[str, np.ndarray], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Whole segments as repeats: one row for each chunk."""
    order = np.lexsort((rows["pos"], rows["chunk"]))
    chunk, pos, size = rows["chunk"][order], rows["pos"][order], rows["n"][order] + length - 1
    cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]])) if len(chunk) else np.zeros(0, np.int64)
    if not len(cuts):
        return
    off = pa.array(np.append(cuts, len(chunk)).astype(np.int32))
    values = {"chunk": pa.array(chunk[cuts]), "pos": pa.ListArray.from_arrays(off, pa.array(pos)), "size": pa.ListArray.from_arrays(off, pa.array(size))}
    yield pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(len(cuts), f.type)) for f in schema], schema=schema)


FOUND = "chunk long, pos array<long>, size array<long>, n array<long>, o array<long>, h array<long>, hot array<boolean>"


def sifted(rows: DataFrame, length: int) -> DataFrame:
    """Per chunk: repeats of whole segments (``size``), and segments that must be sorted (``n``, ``o``, ``h``, ``hot``)."""
    lists = [(c, pa.list_(pa.bool_() if c == "hot" else pa.int64())) for c in ("pos", "size", "n", "o", "h", "hot")]
    schema = pa.schema([("chunk", pa.int64()), *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            blobs = b.column("blob")
            held += [_opened(x) for x in blobs.drop_null().to_pylist()]
            known = b.filter(blobs.is_null())
            if known.num_rows:
                yield pa.RecordBatch.from_arrays([known.column(f.name) if f.name in ("chunk", "pos", "size") else pa.nulls(known.num_rows, f.type) for f in schema], schema=schema)
        if not held:
            return
        rows = {k: np.concatenate([x[k] for x in held]) for k, _ in FIELDS}
        held.clear()
        order = np.argsort(rows["h"], kind="stable")
        h = rows["h"][order]
        twice = np.zeros(len(h), bool)
        twice[1:] = h[1:] == h[:-1]
        twice[:-1] |= twice[1:]
        rows, first = _ordered(_take(rows, order[twice]))
        yield from _spans(_take(rows, ~first), length, schema)
        rows = _take(rows, first)
        _, inverse, count = np.unique(rows["h"], return_inverse=True, return_counts=True)
        many = count[inverse]
        rows = {**_take(rows, many > 1), "hot": many[many > 1] > HOT}
        rows = _take(rows, np.lexsort((rows["pos"], rows["chunk"])))
        chunk = rows["chunk"]
        if len(chunk):
            cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            off = pa.array(np.append(cuts, len(chunk)).astype(np.int32))
            values = {"chunk": pa.array(chunk[cuts])} | {c: pa.ListArray.from_arrays(off, pa.array(rows[c] if c != "h" else rows[c].view(np.int64))) for c in ("pos", "n", "o", "h", "hot")}
            yield pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(len(cuts), f.type)) for f in schema], schema=schema)

    return rows.mapInArrow(run, FOUND)


# sorting


def cut_out(chunks: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments to be sorted: ``key`` deals them out, ``o`` is where their minimizer lies."""
    lists = ("pos", "n", "o", "h", "hot")
    wanted = found.where("n is not null").groupBy("chunk").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in lists])
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("chunk", pa.int64()), ("pos", pa.int64()), ("o", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                raw = _unpacked(x["data"])
                text = raw.tobytes()
                ends = np.cumsum(np.array(x["sizes"], np.int64))
                ids = [NO_ID if i is None else i for i in x["doc_ids"]]
                pos, n, o, h = (np.array(x[c], np.int64) for c in ("pos", "n", "o", "h"))
                hot = np.array(x["hot"], bool)
                cold = [(int(k), int(p), int(m), int(q)) for k, p, m, q in zip(h[~hot], pos[~hot], n[~hot], o[~hot], strict=True)]
                rows = cold + [y for k, p, m, q in zip(h[hot], pos[hot], n[hot], o[hot], strict=True) for y in _shards(text, int(k), int(p), int(m), int(q), length)]
                if not rows:
                    continue
                key, p, m, q = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                doc = np.array(ids, np.int64)[np.searchsorted(ends, p, "right")]
                data = [text[a : a + k - 1 + length] for a, k in zip(p.tolist(), m.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(np.full(len(p), x["chunk"])), pa.array(p), pa.array(q), pa.array(data, pa.binary())], schema=schema)

    both = chunks.join(wanted, "chunk").select("chunk", "doc_ids", "sizes", "data", *lists)
    return both.mapInArrow(run, "key long, doc long, chunk long, pos long, o long, data binary")


def _shards(text: bytes, h: int, pos: int, n: int, o: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """A hot segment in pieces of windows at nearby offsets, dealt out by the bytes that all windows there have in common."""
    far = o // STEP
    for s in range(max(0, o - n + 1) // STEP, far + 1):
        high, low = min(o, STEP * s + STEP - 1), max(o - n + 1, STEP * s)  # offsets of the first and last window
        begin = pos + o - high
        core = pos + o - STEP * s
        shared = text[core : core - STEP + 1 + length]
        key = int.from_bytes(hashlib.blake2b(shared + bytes([s & 255]) + h.to_bytes(8, "little", signed=True), digest_size=8).digest(), "little", signed=True)
        yield key, begin, high - low + 1, high


def sorted_repeats(data: np.ndarray, off: np.ndarray, o: np.ndarray, order: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positional Burrows-Wheeler transform of segments aligned at their minimizers.

    ``order``: place of each segment among all, the smaller the earlier. Yields (segments, window numbers) that repeat, per column.
    """
    m = len(o)
    size = np.diff(off)
    left, right = -o, size - o  # columns of each segment
    line = np.zeros(0, np.int64)  # segments, sorted by their suffix from the last column on
    lcp = np.zeros(0, np.int64)  # common prefix of each with the one before
    by_right = np.argsort(-right, kind="stable")
    entered = 0
    for x in range(int(right.max()) - 1, int(left.min()) - 1, -1):
        # segments that end here enter with an empty suffix, those that have begun leave
        upto = int(np.searchsorted(-right[by_right], -x, "left"))
        new = by_right[entered:upto]
        entered = upto
        if len(new):
            line, lcp = np.concatenate([new, line]), np.concatenate([np.zeros(len(new), np.int64), lcp])
            if len(new) < len(lcp):
                lcp[len(new)] = 0
        stays = left[line] <= x
        if not stays.all():
            keep = np.flatnonzero(stays)
            if len(keep):
                spans = np.concatenate([[0], keep[:-1] + 1])
                lcp = np.minimum.reduceat(lcp[: keep[-1] + 1], spans)
                line = line[keep]
            else:
                line, lcp = line[:0], lcp[:0]
        if not len(line):
            continue
        symbol = data[off[line] + x - left[line]]
        to = np.argsort(symbol, kind="stable")
        sym = symbol[to]
        fresh = np.zeros(len(line), np.int64)
        same = np.flatnonzero(sym[1:] == sym[:-1]) + 1
        if len(same):
            fresh[same] = np.minimum(1 + _range_min(lcp, to[same - 1] + 1, to[same]), length)
        line, lcp = line[to], fresh
        # suffixes of one group share a whole window
        long = lcp >= length
        if long.any():
            head = np.flatnonzero(~long)
            group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(line))))
            earliest = np.minimum.reduceat(order[line], head)
            late = order[line] != earliest[group]
            yield line[late], (x - left[line[late]])


def _range_min(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of v[a..b] (both ends included) by tables of doubled widths."""
    width = b - a + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    out, table = np.empty(len(a), v.dtype), v
    for k in range(int(level.max()) + 1):
        use = np.flatnonzero(level == k)
        out[use] = np.minimum(table[a[use]], table[b[use] - (1 << k) + 1])
        if len(table) > (1 << k):
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def repeats(rows: DataFrame, length: int) -> DataFrame:
    """``chunk``, ``pos``, ``size``: windows that start earlier too, found by sorting what each task holds."""
    schema = pa.schema([("chunk", pa.int64()), ("pos", pa.list_(pa.int64())), ("size", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        key, doc, chunk, pos, o = (t.column(c).to_numpy() for c in ("key", "doc", "chunk", "pos", "o"))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        some = np.flatnonzero(count[inverse] > 1)
        if not len(some):
            return
        data = t.column("data").chunk(0).take(pa.array(some)).cast(pa.large_binary())
        raw = np.frombuffer(data.buffers()[2], np.uint8)
        off = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        doc, chunk, pos, o = (v[some] for v in (doc, chunk, pos, o))
        order = np.empty(len(some), np.int64)
        order[np.lexsort((pos, chunk, doc))] = np.arange(len(some))
        found = list(sorted_repeats(raw, off, o, order, length))
        if found:
            seg = np.concatenate([x[0] for x in found])
            at = pos[seg] + np.concatenate([x[1] for x in found])
            yield from _spans({"chunk": chunk[seg], "pos": at, "n": np.ones(len(at), np.int64)}, length, schema)

    return rows.mapInArrow(run, "chunk long, pos array<long>, size array<long>")


# result


def without(chunks: DataFrame, spans: DataFrame, texts: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, ``kept`` (the remaining bytes)."""
    names = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.binary())] * texts
    schema = pa.schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, sizes, data, pos, size in zip(*(b.column(c) for c in ("doc_ids", "sizes", "data", "pos", "size")), strict=True):
                raw = _unpacked(data.as_py())
                depth = np.zeros(len(raw) + 1, np.int64)
                if pos.is_valid:
                    p = pos.values.to_numpy()
                    depth += np.bincount(p, minlength=len(depth)) - np.bincount(p + size.values.to_numpy(), minlength=len(depth))
                gone = np.cumsum(depth[:-1]) > 0
                n = sizes.values.to_numpy()
                ends = np.cumsum(n)
                out: list[list] = [[] for _ in names]
                for i, a, e in zip(ids.as_py(), (ends - n).tolist(), ends.tolist(), strict=True):
                    g = gone[a:e]
                    removed = int(g.sum())
                    kept = raw[a:e][~g].tobytes() if removed else raw[a:e].tobytes()
                    starts = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if removed else 0
                    for c, v in zip(out, (i, e - a, removed, starts, hashlib.sha256(kept).hexdigest(), kept), strict=False):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(out, names, strict=True)], schema=schema)

    gathered = spans.groupBy("chunk").agg(F.flatten(F.collect_list("pos")).alias("pos"), F.flatten(F.collect_list("size")).alias("size"))
    return chunks.join(gathered, "chunk", "left").select("doc_ids", "sizes", "data", "pos", "size").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)


def remove_repeats(df: DataFrame, length: int = 100, texts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every byte covered by a ``length``-byte string that also starts earlier is taken out; one row for every row."""
    chunks = written(chunked(documents(df, id_col, text_col)), "chunks")
    size = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    # a task sorts the anchors of at most some 32 MB of text
    parts = max(shuffle_partitions(df.sparkSession), size // (32 << 20) + 1)
    dealt = sent(chunks, 4 * parts, length).withColumn("bucket", F.coalesce("bucket", (F.xxhash64("chunk") % (4 * parts)).cast("int")))
    found = written(sifted(dealt.repartition(parts, "bucket"), length), "sifted")
    more = written(repeats(cut_out(chunks, found, length).repartition(parts, "key"), length), "repeats")
    spans = found.where("size is not null").select("chunk", "pos", "size").unionByName(more)
    return without(chunks, spans, texts)

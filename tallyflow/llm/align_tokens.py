"""Alignment of two tokenizers on the same bytes (operator 13).

A: a byte-level BPE of the tokenizers library on a space and the text. B: a BPE with byte fallback of the sentencepiece library on the
text, before which it puts a space itself. Byte offsets where tokens of both end cut a text into groups; two tokens are linked where
their bytes overlap, and a pair of ids counts as often as it is linked in the whole corpus.

Neither tokenizer joins characters across a lone space between two other characters, so a text is cut there into units, and each distinct
unit of a block of documents is encoded and aligned once (``Aligner.values``), all new units side by side in flat arrays.

Identity map: for each A id the B id of the same bytes is computed beforehand. A group of one A and one B token that the map holds is
counted in a vector as long as the vocabulary, one per block; only the links of other groups enter the pair shuffle, as the distinct pairs
of a block, never as one row per document and pair. One pass over the texts writes documents, blocks and pairs; the pair counts are
summed, joined back to the pairs of each block, and turned into sums per unit and then per document.

To the driver come the counts of the identity pairs and the highest count of each B id: no more numbers than the vocabularies have ids.

Defined results: a text that is null, empty or not reproduced by both tokenizers byte for byte has no tokens: zeros and ''; texts are read
whole and may have any length; equal rows get equal results, each row its own; ties for the highest count all count as best; rows without an
id are aligned like all others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyflow.llm.frames import documents, written
from tallyflow.llm.piece_bpe import MARK, encode_batch, model
from tallyflow.llm.wordcache import WordCache

B_BITS = 24
B_MASK = (1 << B_BITS) - 1
BLOCK_CHARS = 2_000_000
CACHED = 300_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Every white-space character but space and line feed.
_OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_ASCII_SPACE = [c for c in _OTHER_SPACE if c.isascii()]

BLOCK, PAIR, SAME = 0, 1, 2
_LISTS = ["units", "same", "n_same", "pairs", "n_pairs"]
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("docs", pa.binary()), *[(c, pa.binary()) for c in _LISTS], ("key", pa.int64()), ("n", pa.int64())]
)
PARTS = f"kind int, block long, docs binary, {', '.join(f'{c} binary' for c in _LISTS)}, key long, n long"
RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def units(text: str) -> list[str]:
    """The text cut at lone spaces between two characters that are no white space."""
    if not text:
        return []
    odd = "  " in text or text[0] == " " or text[-1] == " " or " \n" in text or "\n " in text
    if odd or any([c in text for c in (_ASCII_SPACE if text.isascii() else _OTHER_SPACE)]):
        return _CUT.split(text)
    return text.split(" ")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of a byte-level vocabulary: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Side:
    """Bytes of the ids of one vocabulary, and their decimal names with the separators of a group."""

    def __init__(self, entries: list[bytes], inner: str, last: str):
        self.entries = entries
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(entries) + b"\0", np.uint8)
        self.inner = [f"{k}{inner}".encode() for k in range(len(entries))]
        self.last = [f"{k}{last}".encode() for k in range(len(entries))]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.blob[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[ids] - (ends - size), size)]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.b_path, self.pieces, self.tokenizer = b_path, model(b_path), Tokenizer.from_file(a_path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = next(((i, x.content) for i, x in sorted(self.tokenizer.get_added_tokens_decoder().items()) if x.special), None)
        letters, vocabulary = byte_alphabet(), self.tokenizer.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            entries[i] = bytes([letters[c] for c in token]) if all(c in letters for c in token) else token.encode()
        self.a = Side(entries, ",", "|")
        self.b = Side(list(self.pieces.out), ",", ";")
        self.same = identity(self.a.entries, self.b.entries, self.pieces.byte_id)

    def a_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, each behind a space, and how many each has: a special token between units is cut out before anything else."""
        self.tokenizer.encode_special_tokens = False
        number, marker = self.special
        flat, counts = [], []
        for at in range(0, len(parts), 4000):
            ids = np.array(self.tokenizer.encode_batch_fast([" " + (marker + " ").join(parts[at : at + 4000])], add_special_tokens=False)[0].ids, np.int64)
            between = ids == number
            edge = np.concatenate([[-1], np.flatnonzero(between), [len(ids)]])
            flat.append(ids[~between])
            counts.append(np.diff(edge) - 1)
        return np.concatenate(flat), np.concatenate(counts)

    def values(self, parts: list[str]) -> list[tuple | None]:
        """For each unit: groups as text, identity links (A ids), other links (pair keys), n_a, n_b, n_groups; None where bytes differ."""
        out: list[tuple | None] = [None] * len(parts)
        plain = [k for k, p in enumerate(parts) if self.special and "<" not in p and " " not in p and MARK not in p and len(p) < 1000]
        for at in range(0, len(plain), 50_000):
            some = plain[at : at + 50_000]
            words = [parts[k] for k in some]
            pieces = self.pieces.encode_words([MARK + w for w in words])
            width = self.pieces.dtype.itemsize
            b = np.frombuffer(b"".join(pieces), self.pieces.dtype).astype(np.int64), np.fromiter(map(len, pieces), np.int64, len(pieces)) // width
            self._fill(out, some, words, self.a_ids(words), b)
        rest = sorted(set(range(len(parts))).difference(plain))
        if rest:
            self.tokenizer.encode_special_tokens = True
            words = [parts[k] for k in rest]
            a = [e.ids for e in self.tokenizer.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
            b = list(encode_batch(words, self.b_path, 20_000))
            flat = lambda x: (np.concatenate([np.asarray(i, np.int64) for i in x]), np.array([len(i) for i in x], np.int64))
            self._fill(out, rest, words, flat(a), flat(b))
        return out

    def _fill(self, out: list[tuple | None], at: list[int], words: list[str], a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> None:
        """Values of units from their flat ids; units that either side does not reproduce are left None."""
        raw = [(" " + w).encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        (flat_a, n_a), (flat_b, n_b) = a, b
        held = lambda side, flat, n: between(side.size[flat], np.cumsum(n) - n, np.cumsum(n))
        good = (held(self.a, flat_a, n_a) == size) & (held(self.b, flat_b, n_b) == size)
        text = np.frombuffer(b"".join([r for r, ok in zip(raw, good.tolist(), strict=True) if ok]), np.uint8)
        flat_a, flat_b, at = flat_a[np.repeat(good, n_a)], flat_b[np.repeat(good, n_b)], [k for k, ok in zip(at, good.tolist(), strict=True) if ok]
        if not at:
            return
        size, n_a, n_b = size[good], n_a[good], n_b[good]
        end = np.cumsum(size)
        wrong = between((self.a.bytes_of(flat_a) != text) | (self.b.bytes_of(flat_b) != text), end - size, end)
        groups, same, pairs, counts = self.align(flat_a, flat_b, end)
        for k, bad, *value in zip(at, wrong.tolist(), groups, same, pairs, n_a.tolist(), n_b.tolist(), counts, strict=True):
            if not bad:
                out[k] = tuple(value)

    def align(self, flat_a: np.ndarray, flat_b: np.ndarray, unit_end: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes], list[int]]:
        """Groups and links of units that lie side by side; every unit's end is the end of a token on both sides."""
        end_a, end_b = np.cumsum(self.a.size[flat_a]), np.cumsum(self.b.size[flat_b])
        common = end_b[np.searchsorted(end_b, end_a)] == end_a
        cuts = end_a[common]
        group_a, group_b = np.cumsum(common) - common, np.searchsorted(cuts, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        # one elementary interval for each pair of overlapping tokens
        ends = np.sort(np.concatenate([end_a[~common], end_b]), kind="stable")
        link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        x, y, group = flat_a[link_a], flat_b[link_b], group_a[link_a]
        one = (n_a[group] == 1) & (n_b[group] == 1) & (self.same[x] == y)
        bound = np.searchsorted(ends, unit_end, "right")
        same_end, pair_end = np.concatenate([[0], np.cumsum(one)])[bound].tolist(), np.concatenate([[0], np.cumsum(~one)])[bound].tolist()
        same, pairs = x[one].astype("<u4").tobytes(), ((x << B_BITS) | y)[~one].astype("<i8").tobytes()
        # texts: the A ids of a group, then its B ids
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        names = [(self.a.last if z else self.a.inner)[i] for i, z in zip(flat_a.tolist(), last_a.tolist(), strict=True)]
        names += [(self.b.last if z else self.b.inner)[i] for i, z in zip(flat_b.tolist(), last_b.tolist(), strict=True)]
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        names = [names[i] for i in order.tolist()]
        token_end = (np.searchsorted(end_a, unit_end, "right") + np.searchsorted(end_b, unit_end, "right")).tolist()
        groups_end = np.searchsorted(cuts, unit_end, "right")
        starts = lambda e: [0, *e[:-1]]
        return (
            [b"".join(names[s:e]) for s, e in zip(starts(token_end), token_end, strict=True)],
            [same[4 * s : 4 * e] for s, e in zip(starts(same_end), same_end, strict=True)],
            [pairs[8 * s : 8 * e] for s, e in zip(starts(pair_end), pair_end, strict=True)],
            np.diff(groups_end, prepend=0).tolist(),
        )

    def block(self, ids: list[int | None], texts: list[str], number: int, cache: WordCache) -> Iterator[pa.RecordBatch]:
        """Rows of one block: its documents, its units, its distinct pairs, and its vector of identity links."""
        cut = [units(t) for t in texts]
        distinct_units = list(set().union(*cut))
        known = cache.fill(set(distinct_units))
        value = [known[w] for w in distinct_units]
        place = dict(zip(distinct_units, range(len(distinct_units)), strict=True))
        row_size = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), np.int64, int(row_size.sum()))
        del cut, place, known, distinct_units
        # a document with a unit that is not reproduced has no units
        bad = np.fromiter((v is None for v in value), bool, len(value))
        lost = between(bad[at], np.cumsum(row_size) - row_size, np.cumsum(row_size)) > 0
        at, row_size = at[np.repeat(~lost, row_size)], np.where(lost, 0, row_size)
        often = np.bincount(at, minlength=len(value))
        by = np.argsort(-often, kind="stable")[: np.count_nonzero(often)]  # frequent units get small numbers
        rank = np.zeros(len(value), np.int64)
        rank[by] = np.arange(len(by))
        value, at, often = [value[k] for k in by.tolist()], rank[at], often[by]
        row_end = np.cumsum(row_size)
        row_start = row_end - row_size
        texts_of = [v[0] for v in value]
        same, pairs = (np.frombuffer(b"".join([v[c] for v in value]), t).astype(np.int64) for c, t in ((1, "<u4"), (2, "<i8")))
        n_same, n_pairs = (np.array([len(v[c]) // w for v in value], np.int64) for c, w in ((1, 4), (2, 8)))
        sums = lambda per_unit: between(np.asarray(per_unit, np.int64)[at], row_start, row_end)
        docs = {"doc_id": pa.array(ids, pa.int64()), "size": pa.array(row_size)}
        docs |= {c: pa.array(sums(per_unit)) for c, per_unit in (("n_a", [v[3] for v in value]), ("n_b", [v[4] for v in value]), ("n_groups", [v[5] for v in value]), ("n_links", n_same + n_pairs))}
        digest = lambda s, e: hashlib.sha256(b"".join(map(texts_of.__getitem__, at[s:e].tolist()))[:-1]).digest() if e > s else None
        docs["groups"] = pa.array([digest(s, e) for s, e in zip(row_start.tolist(), row_end.tolist(), strict=True)], pa.binary())
        distinct, where = np.unique(pairs, return_inverse=True)
        yield _rows(kind=[BLOCK], block=[number], docs=[_written(pa.table(docs))], **{c: [squeezed(x)] for c, x in zip(_LISTS, (at, same, n_same, where, n_pairs), strict=True)})
        if len(distinct):
            times = np.bincount(where, np.repeat(often, n_pairs), len(distinct)).astype(np.int64)
            yield _rows(kind=np.full(len(distinct), PAIR), block=np.full(len(distinct), number), key=distinct, n=times)
        vector = np.bincount(same, np.repeat(often, n_same), len(self.same)).astype(np.int64)
        used = np.flatnonzero(vector)
        if len(used):
            yield _rows(kind=np.full(len(used), SAME), block=np.full(len(used), number), key=(used << B_BITS) | self.same[used], n=vector[used])


def squeezed(x: np.ndarray) -> bytes:
    """Whole numbers below 2^32, first bytes first, compressed: frequent small numbers leave long runs of zeros."""
    import zstandard

    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(planes.tobytes())


def unsqueezed(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _written(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def between(x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of the runs ``x[start:end]``, which may be empty."""
    total = np.concatenate([[0], np.cumsum(x)])
    return total[end] - total[start]


def _rows(**columns) -> pa.RecordBatch:
    n = len(columns["kind"])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def identity(a: list[bytes], b: list[bytes], byte_ids: np.ndarray) -> np.ndarray:
    """For each A id the B id of the same bytes, a piece before the id of a lone byte; -1 where there is none."""
    lone = set(byte_ids.tolist())
    of = {e: i for i, e in enumerate(b) if i in lone} | {e: i for i, e in enumerate(b) if e and i not in lone}
    return np.array([of.get(e, -1) if e else -1 for e in a], np.int64)


@lru_cache(2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    parts = written(documents(df, id_col, text_col).mapInArrow(lambda batches: _blocks(batches, a_path, b_path), PARTS), "aligned")
    counts = written(pair_counts(parts), "pair-counts")
    same_total, best = _vectors(counts, aligner(a_path, b_path))
    known = parts.where(F.col("kind") == PAIR).select(F.col("block").alias("in_block"), "key").join(counts, "key")
    own = parts.where(F.col("kind") == BLOCK).select("block", "docs", *_LISTS)
    same = aligner(a_path, b_path).same

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        return _scored(rows, found, same_total, best, same)

    return own.groupBy("block").cogroup(known.groupBy("in_block")).applyInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _blocks(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    one, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
    cache = WordCache(one.values, CACHED)  # it goes with the task: idle workers hold no words
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= BLOCK_CHARS:
                yield from one.block(ids, texts, number, cache)
                ids, texts, size, number = [], [], 0, number + 1
    if ids:
        yield from one.block(ids, texts, number, cache)


def pair_counts(parts: DataFrame) -> DataFrame:
    """``key`` (A id and B id), ``count``: links of the pair in the whole corpus, from the pairs and the vectors of all blocks."""
    return parts.where(F.col("kind") >= PAIR).groupBy("key").agg(F.sum("n").alias("count"))


def _vectors(counts: DataFrame, one: Aligner) -> tuple[np.ndarray, np.ndarray]:
    """Count of each A id's identity pair, and the highest count of each B id: bounded by the vocabularies."""
    held = np.flatnonzero(one.same >= 0)
    keys = counts.sparkSession.createDataFrame(pa.table({"key": (held << B_BITS) | one.same[held]}))
    got = counts.join(keys, "key").toArrow()
    same_total, best = np.zeros(len(one.same), np.int64), np.zeros(len(one.b.size), np.int64)
    same_total[got.column("key").to_numpy() >> B_BITS] = got.column("count").to_numpy()
    top = counts.groupBy(F.col("key").bitwiseAND(F.lit(B_MASK)).alias("b")).agg(F.max("count").alias("best")).toArrow()
    best[top.column("b").to_numpy()] = top.column("best").to_numpy()
    return same_total, best


def _scored(rows: pa.Table, found: pa.Table, same_total: np.ndarray, best: np.ndarray, same: np.ndarray) -> pa.Table:
    """Sums per unit of a block, then per document."""
    block = rows.to_pylist()[0]
    docs = pa.ipc.open_stream(block["docs"]).read_all()
    key = found.column("key").to_numpy()
    by = np.argsort(key)
    count = found.column("count").to_numpy()[by]
    is_best = (count == best[key[by] & B_MASK]).astype(np.int64)
    flat, same_id, n_same, pair, n_pairs = (unsqueezed(block[c]) for c in _LISTS)
    same_end, pair_end, size = np.cumsum(n_same), np.cumsum(n_pairs), docs.column("size").to_numpy()
    per_unit = lambda x, y: between(x, same_end - n_same, same_end) + between(y, pair_end - n_pairs, pair_end)
    sums = per_unit(same_total[same_id], count[pair])
    bests = per_unit((same_total[same_id] == best[same[same_id]]).astype(np.int64), is_best[pair])
    end = np.cumsum(size)
    new = {c: pa.array(between(x[flat], end - size, end)) for c, x in (("n_best", bests), ("count_sum", sums))}
    new["groups_sha256"] = pa.array([g.hex() if g else "" for g in docs.column("groups").to_pylist()], pa.string())
    return pa.table({c: new[c] if c in new else docs.column(c) for c in RESULT})

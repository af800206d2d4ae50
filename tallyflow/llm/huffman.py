"""Token ids as length-limited canonical Huffman files (operator 2).

Ids are counted over all documents; code lengths come from the package-merge method with a limit of 16 bits, codes are canonical,
so the lengths alone rebuild them. A file is a Parquet part whose rows are blocks of whole documents in ascending id order:

    doc_ids, n_tokens   the documents of the block and how many ids each has
    payload             the codes, first bit first
    lanes               bits that each run of ``LANE`` ids takes: their running sums are the bit offsets of the checkpoints
    total, ahead        ids of the block, and of the blocks before it in the same part

Beside ``blocks`` lies ``lengths``: the code length of each id, from which the codes are rebuilt. Any later process decodes the files
from their path alone. Every block is decoded alone, and inside a block all checkpoints at once: one table look-up of 16 bits per lane
and step.

Defined results: a null text counts as empty and has the end id only; a document of any length is one block at most; rows with
equal ids stand side by side in the order of their content; an empty table gives no files and an empty result; rows without an
id come first; rows with equal ids and equal texts are equal and keep a place each; columns other than id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyflow.llm.frames import documents, shuffle_partitions, written
from tallyflow.llm.wordcache import WordCache
from tallyflow.session import scratch_path

LIMIT = 16
LANE = 64
BLOCK_TOKENS = 1 << 16
SLICE_BYTES = 8 << 20
BLOCK = "doc_ids array<long>, n_tokens array<int>, payload binary, lanes binary, total long, ahead long"


# tokenizing


@lru_cache(2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    dtype = np.dtype("<u2" if t.get_vocab_size() <= 1 << 16 else "<u4")
    special = next(((i, a.content) for i, a in sorted(t.get_added_tokens_decoder().items()) if a.special), None)

    def whole(texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype).tobytes() for x in t.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(parts: list[str]) -> list[bytes]:
        """Many parts in one call: a special token between them is cut out by the library before anything else."""
        if special is None:
            return whole(parts)
        out: list[bytes] = []
        for at in range(0, len(parts), 4000):
            some = parts[at : at + 4000]
            ids = np.array(t.encode_batch_fast([special[1].join(some)], add_special_tokens=False)[0].ids, dtype)
            cuts = np.flatnonzero(ids == special[0])
            raw, width = ids.tobytes(), dtype.itemsize
            out += [raw[a * width : b * width] for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True)]
        return out

    def behind(lead: str, symbol: str) -> Callable[[list[str]], list[bytes]]:
        """Words, each behind a space or a line feed that they do not hold, in one text: a token that begins with it begins the next word."""
        first = np.zeros(t.get_vocab_size(), bool)
        first[[i for token, i in t.get_vocab().items() if token[0] == symbol]] = True

        def encode_words(words: list[str]) -> list[bytes]:
            out: list[bytes] = []
            for at in range(0, len(words), 40_000):
                ids = np.array(t.encode_batch_fast([lead + lead.join(words[at : at + 40_000])], add_special_tokens=False)[0].ids, dtype)
                start = np.flatnonzero(first[ids]) * dtype.itemsize
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip(start.tolist(), [*start[1:].tolist(), len(raw)], strict=True)]
            return out

        return encode_words

    spaced, lined = behind(" ", "Ġ"), behind("\n", "Ċ")
    return whole, dtype, WordCache(encode, 100_000), WordCache(spaced, 500_000), WordCache(lined, 100_000), _uncut(t)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1


def ids_of(texts: list[str] | pa.Array, path: str, end_id: int) -> Iterator[bytes]:
    """Little-endian ids of each text with the end id behind them.

    The pattern of a byte-level tokenizer starts a new part wherever ``_CUT`` says so, whatever stands around; so texts are cut there,
    and each distinct part goes through the library once. Texts with white space beyond ASCII, or with a special token's string, go
    through it whole.
    """
    encode_whole, dtype, _, _, _, uncut = _tokenizer(path)
    end = np.array([end_id], dtype).tobytes()
    column = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "").cast(pa.large_string())
    for part in _slices(column):
        odd = pc.match_substring_regex(part, uncut)
        whole, cut = iter(encode_whole(part.filter(odd).to_pylist())), iter(_cut_ids(part.filter(pc.invert(odd)), path))
        for is_odd in odd.to_pylist():
            yield next(whole if is_odd else cut) + end


def _cut_ids(texts: pa.Array, path: str) -> list[bytes]:
    """Ids of texts that may be cut: their parts are views of one buffer, told apart by a dictionary, and ids are gathered by it."""
    _, dtype, starts, spaced, lined, _ = _tokenizer(path)
    offsets, raw = _offsets(texts), np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    raw, edges = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    if not len(raw):
        return [b""] * len(texts)
    kind = _KIND[raw]
    new = np.concatenate([[True], _CUT[kind[:-1] * 6 + kind[1:]]])
    new[edges[:-1][edges[:-1] < len(raw)]] = True
    at = np.flatnonzero(new)
    parts = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(np.append(at, len(raw))), pa.py_buffer(raw)]).dictionary_encode()

    # distinct parts by what they begin with, and the ids of all of them in one row
    distinct, lead = parts.dictionary, np.array([_lead(x) for x in _strings(pc.utf8_slice_codeunits(parts.dictionary, 0, 2))], np.uint8)
    order, encoded = [], []
    for k, cache in enumerate((starts, spaced, lined)):
        some = distinct.filter(pa.array(lead == k))
        words = _strings(pc.utf8_slice_codeunits(some, 1) if k else some)
        encoded += map(cache.fill(set(words)).__getitem__, words)
        order.append(np.flatnonzero(lead == k))
    size = np.fromiter(map(len, encoded), np.int64, len(encoded)) // dtype.itemsize
    begin, length = np.zeros((2, len(size)), np.int64)
    begin[by := np.concatenate(order)], length[by] = np.cumsum(size) - size, size

    code = parts.indices.to_numpy()
    n = length[code]
    ends = np.cumsum(n)
    where = np.repeat(begin[code] - (ends - n), n)
    where += np.arange(len(where))
    ids = np.frombuffer(b"".join(encoded), dtype)[where].tobytes()
    cuts = np.append(0, ends)[np.searchsorted(at, edges)] * dtype.itemsize
    return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def _lead(begin: str) -> int:
    """1 or 2 for a part whose first character is a lone space or line feed before another kind of character."""
    return 0 if begin[1:] in _ASCII_SPACE else 1 if begin[0] == " " else 2 if begin[0] == "\n" else 0


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of at most ``SLICE_BYTES``, of one text at least."""
    offsets, at = _offsets(texts), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield texts.slice(at, to - at)
        at = to


def _uncut(t) -> str:
    """Pattern of the texts that must not be cut: all of them where the tokenizer has other rules than the plain byte-level ones."""
    import json

    if t.normalizer is not None or t.pre_tokenizer is None or json.loads(t.pre_tokenizer.__getstate__()) != _BYTE_LEVEL:
        return ""
    return "|".join([f"[{''.join(_OTHER_SPACE)}]", r"<\|", *(re.escape(a.content) for a in t.get_added_tokens_decoder().values())])


_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

_ASCII_SPACE = ("", " ", "\t", "\n", "\v", "\f", "\r")

#: Every other white-space character.
_OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in _ASCII_SPACE]

#: Kinds of bytes: 0 beyond ASCII, 1 letter, 2 digit, 3 other sign, 4 apostrophe, 5 white space.
_KIND = np.array([0 if c > 127 else 5 if chr(c) in _ASCII_SPACE else 4 if c == 39 else 2 if chr(c).isdigit() else 1 if chr(c).isalpha() else 3 for c in range(256)], np.uint8)

#: Kinds between which a new part starts for certain: letters, digits, signs and white space are never joined, but for white space
#: before something, an apostrophe before a letter, and characters beyond ASCII, which may be of any kind but white space.
_CUT = np.zeros((6, 6), bool)
_CUT[1, [2, 3, 4, 5]] = _CUT[2, [1, 3, 4, 5]] = _CUT[3, [1, 2, 5]] = _CUT[[0, 4], 5] = True
_CUT = _CUT.reshape(-1)


def tokenized(df: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n``, ``ids``: the ids as compressed little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _tokenizer(path)[1].itemsize
        for b in batches:
            raw = list(ids_of(b.column("text"), path, end_id))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) // width for x in raw], pa.int64()), pa.array([_pack(x) for x in raw], pa.binary())], ["doc_id", "n", "ids"]
            )

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, n long, ids binary")


def _pack(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(raw)


def _unpack(x: bytes, dtype: np.dtype) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype)


# codes


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Package-merge: the best prefix-code lengths of at most ``limit`` bits for symbols with a count; 0 for the others."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.float64)
    # per level the merged list holds (weight, is a leaf); only how many leaves lie among the first items is needed
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        weight = np.concatenate([coins, packages])
        leaf = np.concatenate([np.ones(len(coins), bool), np.zeros(len(packages), bool)])
        by = np.argsort(weight, kind="stable")
        weight, leaf = weight[by], leaf[by]
        levels.append(leaf)
        even = len(weight) // 2 * 2
        packages = weight[0:even:2] + weight[1:even:2]
    take = 2 * (len(coins) - 1)
    depth = np.zeros(len(coins), np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each symbol, and the decoding table: symbol and length for every ``LIMIT`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = np.int64(1) << (LIMIT - lengths[order].astype(np.int64))
    start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    codes = np.zeros(len(lengths), np.uint32)
    codes[order] = start >> (LIMIT - lengths[order].astype(np.int64))
    symbol, width = np.zeros(1 << LIMIT, np.uint32), np.ones(1 << LIMIT, np.uint8)
    filled = int(size.sum())
    symbol[:filled], width[:filled] = np.repeat(order, size), np.repeat(lengths[order], size)
    return codes, symbol, width


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Payload and lane sizes. Codes fill 32-bit words; every code touches two words at most and no bit twice, so sums place them."""
    width = lengths[ids].astype(np.int64)
    ends = np.cumsum(width)
    at = ends - width
    n_words = (int(ends[-1]) + 31) // 32 + 1
    wide = codes[ids].astype(np.uint64) << (64 - (at & 31) - width).astype(np.uint64)
    word = at >> 5
    out = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), n_words) + np.bincount(word + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
    payload = out.astype(np.uint64).astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8]
    return payload, np.add.reduceat(width, np.arange(0, len(ids), LANE)).astype("<u2").tobytes()


def decode_block(payload: bytes, lanes: bytes, total: int, symbol: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Ids of a block: all lanes step together, each with one look-up a step."""
    bits = np.frombuffer(lanes, "<u2").astype(np.int64)
    at = np.cumsum(bits) - bits
    raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    out = np.zeros((LANE, len(bits)), np.uint32)
    last = total - LANE * (len(bits) - 1)
    for step in range(LANE):
        if step == last:  # the last lane may be shorter
            at = at[:-1]
        if not len(at):
            break
        key = (window[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
        out[step, : len(at)] = symbol[key]
        at = at + width[key]
    return out.T.reshape(-1)[:total]


# files


def id_counts(tokens: DataFrame, vocabulary: int, dtype: str) -> np.ndarray:
    """How often each id occurs in all documents: one histogram per task, summed on the cluster; at most ``vocabulary`` rows return."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for x in b["ids"]:
                if len(x) > 4000:
                    total += np.bincount(_unpack(x, np.dtype(dtype)), minlength=vocabulary)
            small = [_unpack(x, np.dtype(dtype)) for x in b["ids"] if len(x) <= 4000]
            if small:
                total += np.bincount(np.concatenate(small), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    rows = tokens.select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(vocabulary, np.int64)
    out[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def write_files(tokens: DataFrame, vocabulary: int, dtype: str, path: str) -> None:
    """``path/blocks`` in ascending ``doc_id`` order and ``path/lengths``. An id beyond the vocabulary is an error."""
    spark = tokens.sparkSession
    lengths = code_lengths(id_counts(tokens, vocabulary, dtype))
    codes = canonical_codes(lengths)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = ahead = 0
        for b in batches:
            for doc, x in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                ids = _unpack(x, np.dtype(dtype))
                held.append((doc, ids))
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    yield block(held, ahead)
                    held, size, ahead = [], 0, ahead + size
        if held:
            yield block(held, ahead)

    def block(held: list[tuple], ahead: int) -> pa.RecordBatch:
        ids = np.concatenate([x for _, x in held])
        payload, lanes = encode_block(ids, codes, lengths)
        row = ([d for d, _ in held], [len(x) for _, x in held], payload, lanes, len(ids), ahead)
        types = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], ["doc_ids", "n_tokens", "payload", "lanes", "total", "ahead"])

    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(f"{path}/lengths")
    parts = tokens.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "ids")
    blocks = parts.select("doc_id", "ids").mapInArrow(run, BLOCK).withColumn("part", F.spark_partition_id())
    blocks.write.parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, decoded from the files alone.

    ``start`` needs the ids before each part: their totals (as many rows as parts) come to the driver, as do the code lengths (a byte
    for each id of the vocabulary).
    """
    blocks = spark.read.schema(f"{BLOCK}, part int").parquet(f"{path}/blocks")
    lengths = np.frombuffer(spark.read.schema("lengths binary").parquet(f"{path}/lengths").first()[0], np.uint8)
    ahead: dict[int, int] = {}
    run_total = 0
    for part, t in sorted((r["part"], r["t"]) for r in blocks.groupBy("part").agg(F.sum("total").alias("t")).collect()):
        ahead[part], run_total = run_total, run_total + t

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, symbol, width = canonical_codes(lengths)
        for b in batches:
            for doc_ids, n_tokens, payload, lanes, total, part, before in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                ids = decode_block(payload, lanes, total, symbol, width).astype("<u4")
                n = np.array(n_tokens, np.int64)
                ends = np.cumsum(n)
                start = ends - n
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(start.tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(doc_ids, pa.int64()), pa.array(start + ahead[part] + before), pa.array(n), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.select("doc_ids", "n_tokens", "payload", "lanes", "total", "part", "ahead").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(df: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    spark, vocabulary = df.sparkSession, vocabulary_size(path)
    folder = scratch_path(spark, "llm-huffman")
    write_files(written(tokenized(df, path, end_id), "tokens"), vocabulary, _tokenizer(path)[1].str, folder)
    return read_files(spark, folder)

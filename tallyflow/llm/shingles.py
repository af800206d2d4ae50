"""Sets of word shingles, hashed with numpy over the bytes of whole Arrow batches.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a text of fewer words than the shingle is one shingle of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

WORDS = 5
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_VALUE[_SEP] = 0
_PLACES = [np.uint64(pow(0xA0761D6478BD642F, k + 1, 1 << 64) | 1) for k in range(WORDS)]
#: Bytes that are hashed at a time, unless one text is longer.
CHUNK = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, side by side, and where each text begins and the last one ends."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``size`` bytes."""
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield at, to
        at = to


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes as ascending signed 64-bit numbers."""
    raw, off = text_bytes(column)
    for a, b in chunks(off):
        yield from _sets(raw[off[a] : off[b]], off[a : b + 1] - off[a])


def _sets(raw: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
    if not len(raw):
        yield from (np.zeros(0, np.int64) for _ in off[1:])
        return
    inside = ~_SEP[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = off[1:-1][off[1:-1] < len(raw)]
    begins[edge] = inside[edge]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = edge[edge > 0] - 1
    ends[edge] = inside[edge]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = 1 << max(20, int(len(raw) + 1).bit_length())
    power, inverse = _powers(size)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * power[: len(raw)], out=total[1:])
    word = mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _MUL)
    first = np.searchsorted(start, off)
    # five words from each position on; positions too near the end of their text are not read
    sums = np.zeros(max(0, len(word) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        sums += word[k : k + len(sums)] * _PLACES[k]
    sums = mixed(sums).view(np.int64)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            yield np.unique(sums[a : b - WORDS + 1])
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for k in range(b - a):
                whole += word[a + k : a + k + 1] * _PLACES[k]
            yield mixed(whole + np.uint64(b - a)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, whatever the order of their members."""
    u = s.view(np.uint64)
    with np.errstate(over="ignore"):
        return int(u.sum().view(np.int64)) if len(u) else 0, int(np.bitwise_xor.reduce(mixed(u * _MUL)).view(np.int64)) if len(u) else 0

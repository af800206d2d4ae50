"""SentencePiece BPE with byte fallback: encoding by vectorised merge rounds, decoding by a byte gather.

Operator 3. The model file is only read as data: pieces, scores and types. Texts are cut into words (a run of the space mark and
the characters up to the next one); no piece has a space mark behind another character, so words merge independently. The
distinct words of a batch become flat numpy arrays of symbols. In each round every word finds the best-ranked pair by a
segmented minimum, all words merge their leftmost pair of that rank at once, and finished words leave the arrays.

Defined results: a null text counts as empty; an empty text has no ids but the end id; the text may have any length; rows with
equal ids or texts are encoded row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallyflow.llm.frames import documents
from tallyflow.llm.wordcache import WordCache

MARK = "▁"
#: Words of more symbols are merged one by one with a heap: their rounds would cost length x length.
LONG_WORD = 64
NONE = np.int32(2**31 - 1)


class PieceModel:
    """Tables of one model: symbol ids, pair -> (rank, merged piece), bytes of each id."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.eos = sp.eos_id()
        self.byte_id = np.full(256, -1, np.int32)
        self.ids: dict[str, int] = {}
        self.out: list[bytes] = []
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.out.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.out.append(b"")
            else:
                self.ids[p] = i
                self.out.append(p.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece joins two words; words cannot be merged alone")
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback")
        # characters without a piece get ids behind the vocabulary; they never merge
        self.size = n
        score = {p: sp.get_score(i) for p, i in self.ids.items()}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    self.pairs[a, b] = (order[score[p]], i)
        keys = np.array([a * n + b for a, b in self.pairs], np.int64)
        rank = np.array([v[0] for v in self.pairs.values()], np.int32)
        merged = np.array([v[1] for v in self.pairs.values()], np.int32)
        self._table(keys, rank, merged)
        self.lengths = np.array([len(x) for x in self.out], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.blob = np.frombuffer(b"".join(self.out) + b"\0", np.uint8)
        self.names = [str(i) for i in range(n)]
        top = max(map(ord, "".join(self.ids)), default=0)
        self.char_id = np.full(top + 1, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i

    def _table(self, keys: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        """Open-addressed hash table of the pairs: a lookup is one gather for nearly all pairs."""
        self.bits = max(10, int(len(keys) * 4 - 1).bit_length())
        self.key, self.rank, self.merged = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32), np.zeros(1 << self.bits, np.int32)
        todo, slot, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            free = self.key[slot] < 0
            _, first = np.unique(slot, return_index=True)
            take = first[free[first]]
            self.key[slot[take]], self.rank[slot[take]], self.merged[slot[take]] = keys[todo[take]], rank[todo[take]], merged[todo[take]]
            keep = np.ones(len(todo), bool)
            keep[take] = False
            todo, slot, self.probes = todo[keep], (slot[keep] + 1) & ((1 << self.bits) - 1), self.probes + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE where there is none) and the slot that holds its merged piece."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left >= self.size) | (right >= self.size)] = -2
        slot = self._slot(keys)
        rank = np.where(self.key[slot] == keys, self.rank[slot], NONE)
        open_ = np.flatnonzero((self.key[slot] != keys) & (self.key[slot] >= 0) & (keys >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.key[slot[open_]]
            hit = found == keys[open_]
            rank[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return rank, slot

    # words -> ids

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 16-bit bytes (32-bit ones where the vocabulary needs them)."""
        out: list[bytes | None] = [None] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= LONG_WORD]
        for k in set(range(len(words))).difference(short) if len(short) < len(words) else ():
            out[k] = self._pack([x for s in self._heap(words[k]) for x in self._bytes(*s)])
        step = 200_000
        for at in range(0, len(short), step):
            part = short[at : at + step]
            for k, v in zip(part, self._rounds([words[k] for k in part]), strict=True):
                out[k] = v
        return out

    @property
    def dtype(self):
        return np.dtype("<u2" if self.size <= 1 << 16 else "<u4")

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        known = chars < len(self.char_id)
        ids = np.where(known, self.char_id[np.where(known, chars, 0)], -1)
        sym = np.where(ids >= 0, ids, chars + self.size).astype(np.int32)
        return sym, np.fromiter(map(len, words), np.int64, len(words))

    def _rounds(self, words: list[str]) -> list[bytes]:
        """All words at once. ``rank`` holds the rank of each symbol with its right neighbour; a round looks up only the pairs it changes."""
        sym, lengths = self._symbols(words)
        n, width = len(words), self.dtype.itemsize
        done_sym, done_word = [], []
        word = np.repeat(np.arange(n, dtype=np.int32), lengths)
        last = np.zeros(len(sym), bool)
        last[np.cumsum(lengths) - 1] = True
        rank, slot = self.lookup(sym, np.append(sym[1:], 0))
        rank[last] = NONE
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            # rank, then position: the segmented minimum is the leftmost pair of the best rank
            best = np.minimum.reduceat((rank.astype(np.int64) << 32) | np.arange(len(sym)), first)
            more = (best >> 32) < NONE
            if not more.all():  # words without a pair leave
                size = np.diff(np.append(first, len(sym)))
                stays = np.repeat(more, size)
                done_sym.append(sym[~stays])
                done_word.append(word[~stays])
                shift = np.repeat(np.cumsum(np.where(more, 0, size)), size)[first[more]] if more.any() else first[more]
                sym, word, last, rank, slot = sym[stays], word[stays], last[stays], rank[stays], slot[stays]
                at = (best[more] & 0xFFFFFFFF) - shift
            else:
                at = best & 0xFFFFFFFF
            if not len(sym):
                break
            sym[at] = self.merged[slot[at]]
            last[at] = last[at + 1]
            stays = np.ones(len(sym), bool)
            stays[at + 1] = False
            sym, word, last, rank, slot = sym[stays], word[stays], last[stays], rank[stays], slot[stays]
            at -= np.arange(len(at))  # one symbol of each word before has gone
            left = at[(at > 0) & (word[at - 1] == word[at])] - 1
            right = at[~last[at]]
            rank[at] = NONE
            new = np.concatenate([left, right])
            rank[new], slot[new] = self.lookup(sym[new], sym[new + 1])
        sym, word = np.concatenate(done_sym or [sym]), np.concatenate(done_word or [word])
        order = np.argsort(word, kind="stable")
        sym, word = self._fallback(sym[order], word[order])
        counts = np.bincount(word, minlength=n)
        flat = sym.astype(self.dtype).tobytes()
        ends = (np.cumsum(counts) * width).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _fallback(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the ids of their UTF-8 bytes."""
        odd = np.flatnonzero(sym >= self.size)
        if not len(odd):
            return sym, word
        chars = [self._bytes(int(s)) for s in sym[odd]]
        count = np.ones(len(sym), np.int64)
        count[odd] = [len(x) for x in chars]
        out, at = np.repeat(sym, count), np.cumsum(count) - count
        for k, x in zip(odd, chars, strict=True):
            out[at[k] : at[k] + len(x)] = x
        return out, np.repeat(word, count)

    def _bytes(self, s: int) -> list[int]:
        return [s] if s < self.size else [int(self.byte_id[b]) for b in chr(s - self.size).encode("utf-8", "surrogatepass")]

    def _heap(self, word: str) -> list[tuple[int]]:
        """One long word: the same merges with a heap and a linked list."""
        sym = self._symbols([word])[0].tolist()
        nxt, prv, alive = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1)), [True] * len(sym)
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < len(sym) and (hit := self.pairs.get((sym[i], sym[j]))):
                heapq.heappush(heap, (hit[0], i, sym[i], sym[j]))

        for i in range(len(sym)):
            push(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or sym[i] != a or j >= len(sym) or sym[j] != b:
                continue
            sym[i], alive[j] = self.pairs[a, b][1], False
            nxt[i] = nxt[j]
            if nxt[j] < len(sym):
                prv[nxt[j]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return [(s,) for s, ok in zip(sym, alive, strict=True) if ok]

    # ids -> text

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: piece bytes side by side, without the space put before the first word."""
        if not len(ids):
            return ""
        length = self.lengths[ids]
        ends = np.cumsum(length)
        at = np.arange(int(ends[-1])) + np.repeat(self.starts[ids] - (ends - length), length)
        raw = self.blob[at].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def words_of(text: str) -> list[str]:
    """Words of a text with the space mark in front, as the model's normalizer leaves them: one mark is put before the text."""
    if not text:
        return []
    if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    out, run = [], 0
    parts = text.replace(MARK, " ").split(" ")
    for p in parts:
        if p:
            out.append(MARK * run + p)
            run = 0
        else:
            run += 1
    return [*out, MARK * (run - 1)] if run else out


@lru_cache(2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(2)
def _cache(path: str, limit: int) -> WordCache:
    m = model(path)
    return WordCache(lambda words: m.encode_words([MARK + w for w in words]), limit)


def encode_batch(texts: list[str], path: str, limit: int = 300_000) -> Iterator[np.ndarray]:
    """Ids of each text, without begin or end ids."""
    cache, m = _cache(path, limit), model(path)
    step = 400
    for at in range(0, len(texts), step):
        split = [words_of(t) for t in texts[at : at + step]]
        known = cache.fill(set().union(*split))
        for words in split:
            yield np.frombuffer(b"".join([known[w] for w in words]), m.dtype)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` array<int> with the end id, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            ids = [np.append(x, m.eos).astype(np.int32) for x in encode_batch(b.column("text").to_pylist(), path)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: the ids are hashed and decoded where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            rows = ([], [], [])
            for x in encode_batch(b.column("text").to_pylist(), path):
                ids = np.append(x, np.array([m.eos], x.dtype))
                rows[0].append(len(ids))
                rows[1].append(hashlib.sha256(" ".join([m.names[i] for i in ids.tolist()]).encode()).hexdigest())
                rows[2].append(hashlib.sha256(m.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Token counts by the whole-token shortcut (operator 4).

Before any text is read, the vocabulary is proved: each piece that stands for a whole word is merged from its characters, and
those that come out as themselves need no merging when they turn up in a text. Words of a text that are among them count one
token at once; only the remaining distinct words are merged.

Defined results: a null text counts as empty and has no tokens; any length; equal rows are counted row by row; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyflow.llm.frames import documents
from tallyflow.llm.piece_bpe import MARK, model, words_of
from tallyflow.llm.wordcache import WordCache


@lru_cache(2)
def whole_tokens(path: str) -> frozenset[str]:
    """Words, without their space mark, whose marked form is proved to encode as one token."""
    m = model(path)
    marked = [p for p in m.ids if p.startswith(MARK) and len(p) > 1]
    width = m.dtype.itemsize
    return frozenset(p[1:] for p, ids in zip(marked, m.encode_words(marked), strict=True) if len(ids) == width)


@lru_cache(2)
def _cache(path: str, limit: int) -> WordCache:
    m, proved = model(path), whole_tokens(path)
    width = m.dtype.itemsize
    cache = WordCache(lambda words: [len(x) // width for x in m.encode_words([MARK + w for w in words])], limit)
    cache.proved = proved
    return cache


def count_batch(texts: list[str], path: str, limit: int = 400_000) -> list[int]:
    cache, out, step = _cache(path, limit), [], 400
    proved = cache.proved
    for at in range(0, len(texts), step):
        split, rest = [words_of(t) for t in texts[at : at + step]], []
        for words in split:
            rest.append([w for w in words if w not in proved])
        known = cache.fill(set().union(*rest))
        out += [len(words) - len(left) + sum([known[w] for w in left]) for words, left in zip(split, rest, strict=True)]
    return out


def count_tokens(df: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = np.array(count_batch(b.column("text").to_pylist(), path), np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    docs = documents(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)

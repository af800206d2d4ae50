"""Pieces, counts and Huffman files against the libraries."""

import hashlib
import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tallyflow.llm import huffman, piece_bpe, token_counts
from tests.llm.data import awkward, documents

MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n=3000):
    rng = random.Random(1)
    letters = "  ab thein▁\n\t\u0000😀ß</s><s><unk><0x41>éx ,.-_漢字 の<|endoftext|>'s't"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["a" * 3000, "ab" * 1500, " " * 100, "", "x", "▁", " ", "\n", "</s>", " a", " a ", "".join(rng.choice("theinandsir") for _ in range(2000))]


def test_pieces_equal_the_library():
    sp, m = sentencepiece.SentencePieceProcessor(model_file=MODEL), piece_bpe.model(MODEL)
    texts = odd_texts()
    want = sp.encode(texts, num_threads=1)
    got = [x.tolist() for x in piece_bpe.encode_batch(texts, MODEL, limit=50)]
    assert got == want
    assert [m.decode(np.array([*x, m.eos])) for x in got] == [sp.decode([*x, m.eos]) for x in want]
    assert token_counts.count_batch(texts, MODEL, limit=50) == [len(x) for x in want]


def test_whole_tokens_are_proved():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    some = sorted(token_counts.whole_tokens(MODEL))[::50]
    assert some and all(len(sp.encode(w)) == 1 for w in some)


def test_digests_and_counts_of_awkward_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = awkward()
    df = documents(spark, rows)
    want, counts = [], []
    for i, t in rows:
        ids = sp.encode(t or "", add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
        counts.append((i, len((t or "").encode()), len(ids) - 1, len(ids) - 1 > 100))
    assert sorted(map(tuple, piece_bpe.digests(df, MODEL).collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, token_counts.count_tokens(df, MODEL, 100).collect()), key=repr) == sorted(counts, key=repr)
    assert [r.ids for r in piece_bpe.encode(documents(spark, [(1, "a b")]), MODEL).collect()] == [sp.encode("a b", add_eos=True)]
    none = documents(spark, [])
    assert piece_bpe.digests(none, MODEL).count() == 0 and token_counts.count_tokens(none, MODEL).count() == 0


def test_code_lengths_are_best():
    rng = random.Random(3)
    for _ in range(100):
        counts = [rng.choice([0, 1, 2, 5, rng.randint(1, 1000)]) for _ in range(rng.randint(2, 60))]
        heap = [(c, i, [i]) for i, c in enumerate(counts) if c]
        if len(heap) < 2:
            continue
        heapq.heapify(heap)
        free, k = 0, len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            free, k = free + a[0] + b[0], k + 1
            heapq.heappush(heap, (a[0] + b[0], k, []))
        lengths = huffman.code_lengths(np.array(counts)).tolist()
        assert sum(c * x for c, x in zip(counts, lengths)) == free
    steep = huffman.code_lengths(np.array([2 ** min(i, 50) for i in range(40)]))
    assert steep.max() == huffman.LIMIT and sum(2.0 ** -int(x) for x in steep) <= 1
    assert huffman.code_lengths(np.array([0, 9, 0])).tolist() == [0, 1, 0] and not huffman.code_lengths(np.zeros(3, int)).any()


def test_blocks_round_trip():
    rng = np.random.default_rng(5)
    lengths = huffman.code_lengths(rng.zipf(1.3, 5000).clip(1, 10**9))
    codes, symbol, width = huffman.canonical_codes(lengths)
    for n in (1, 63, 64, 65, 1000, 70_000):
        ids = rng.integers(0, 5000, n)
        payload, lanes = huffman.encode_block(ids, codes, lengths)
        assert (huffman.decode_block(payload, lanes, n, symbol, width) == ids).all()


def test_ids_equal_the_library():
    t = Tokenizer.from_file(BYTES)
    texts = odd_texts()
    want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in huffman.ids_of(texts, BYTES, 0)] == [[*x, 0] for x in want]


def test_files_of_awkward_rows(spark):
    t = Tokenizer.from_file(BYTES)
    rows = [(i, x) for i, x in awkward() if i is not None]
    got = sorted(map(tuple, huffman.encode_and_read(documents(spark, rows), BYTES).collect()))
    at, want = 0, []
    for i, x in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert huffman.encode_and_read(documents(spark, []), BYTES).count() == 0
    assert huffman.encode_and_read(documents(spark, [(None, "a"), (None, None), (3, "b")]), BYTES).count() == 3


def test_files_are_read_by_another_process(spark, tmp_path):
    """Only the path is handed over; many blocks in a part."""
    import json
    import subprocess
    import sys

    rows = [(i, x) for i, x in awkward() if i is not None and i != 59]
    huffman_blocks, huffman.BLOCK_TOKENS = huffman.BLOCK_TOKENS, 500
    try:
        tokens = huffman.tokenized(documents(spark, rows), BYTES)
        huffman.write_files(tokens, huffman.vocabulary_size(BYTES), "<u2", str(tmp_path / "files"))
        want = sorted(map(list, huffman.read_files(spark, str(tmp_path / "files")).collect()))
    finally:
        huffman.BLOCK_TOKENS = huffman_blocks
    program = """
import json, sys
from tallyflow.llm.huffman import read_files
from tallyflow.session import build_session
print(json.dumps(sorted(map(list, read_files(build_session("local[1]", **{"spark.ui.enabled": "false"}), sys.argv[1]).collect()))))
"""
    done = subprocess.run([sys.executable, "-c", program, str(tmp_path / "files")], capture_output=True, text=True, timeout=300)
    assert json.loads(done.stdout.strip().splitlines()[-1]) == want and len(want) == len(rows)
    t, at = Tokenizer.from_file(BYTES), 0
    for (i, x), got in zip(sorted(rows), want, strict=True):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        assert got == [i, at, len(ids), zlib.crc32(ids.tobytes())]
        at += len(ids)


def test_words_in_one_text_equal_words_alone():
    t = Tokenizer.from_file(BYTES)
    rng = random.Random(9)
    words = list({"".join(rng.choice("abTé\n.-'s1漢ß😀") for _ in range(rng.randint(1, 9))).strip() for _ in range(5000)} - {""})
    spaced = huffman._tokenizer(BYTES)[3].encode
    assert [np.frombuffer(x, "<u2").tolist() for x in spaced(words)] == [e.ids for e in t.encode_batch([" " + w for w in words], add_special_tokens=False)]


def test_parts_beside_signs_go_through_the_library_once(monkeypatch):
    """However a word is followed up, it is one word to the library; texts are cut alike in slices of any size."""
    t = Tokenizer.from_file(BYTES)
    words = ["quomble" + "".join(random.Random(i).choices("bdfgklmnprst", k=6)) for i in range(200)]
    texts = [" ".join([f"({w}", w + ".", w + ",", w + "!!", w + "-9", w + "'s", w + "\n" + w, w, w + "$$$"]) for w in words]
    seen = []
    for cache in [x for x in huffman._tokenizer(BYTES) if isinstance(x, huffman.WordCache)]:
        encode = cache.encode
        monkeypatch.setattr(cache, "encode", lambda some, encode=encode: (seen.extend(some), encode(some))[1])
    want = [[*x.ids, 0] for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in huffman.ids_of(texts, BYTES, 0)] == want
    assert sum("quomble" in x for x in seen) <= 3 * len(words)  # behind a space, a line feed and a sign

    rng = random.Random(11)
    odd = ["".join(rng.choice("abs'tld 19.,_-\n\t é\u00a0漢½\x1c") for _ in range(rng.randint(0, 30))) for _ in range(4000)] + ["", "a <|endoftext|> b"]
    want = [[*x.ids, 0] for x in t.encode_batch(odd, add_special_tokens=False)]
    for size in (1, 300, 8 << 20):
        monkeypatch.setattr(huffman, "SLICE_BYTES", size, raising=False)
        assert [np.frombuffer(x, "<u2").tolist() for x in huffman.ids_of(odd, BYTES, 0)] == want


def test_texts_stay_whole_for_other_rules(tmp_path):
    from tokenizers import pre_tokenizers

    t = Tokenizer.from_file(BYTES)
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    t.save(path := str(tmp_path / "other.json"))
    texts = ["hello, the world. of", "", "a.b\nc", "x <|endoftext|>y"]
    want = [[*x.ids, 0] for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in huffman.ids_of(texts, path, 0)] == want

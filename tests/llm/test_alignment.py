"""Alignment of two tokenizers against a byte-by-byte version with both libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyflow.llm import align_tokens
from tallyflow.llm.frames import table
from tallyflow.llm.queries import QUERIES
from tests.llm.data import awkward, documents
from tests.llm.test_tokens import odd_texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    alphabet = align_tokens.byte_alphabet()
    a_bytes = lambda i: bytes(alphabet[c] for c in tok.id_to_token(i))
    b_bytes = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    counts, found = Counter(), []
    for doc_id, text in rows:
        a = b = []
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            raw = (" " + text).encode()
            if b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
                a = b = []
        own_a = [k for k, i in enumerate(a) for _ in a_bytes(i)]
        own_b = [k for k, i in enumerate(b) for _ in b_bytes(i)]
        links = [(a[x], b[y]) for x, y in sorted(set(zip(own_a, own_b)))]
        ends = [p + 1 for p in range(len(own_a)) if p + 1 == len(own_a) or (own_a[p] != own_a[p + 1] and own_b[p] != own_b[p + 1])]
        groups, s = [], 0
        for e in ends:
            groups.append(",".join(str(a[k]) for k in sorted(set(own_a[s:e]))) + "|" + ",".join(str(b[k]) for k in sorted(set(own_b[s:e]))))
            s = e
        counts.update(links)
        found.append((doc_id, len(a), len(b), links, groups))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        (str(i), na, nb, len(g), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, na, nb, links, g in found
    )


def found(df):
    return sorted((str(r[0]), *r[1:]) for r in df.select(*align_tokens.RESULT).collect())


@pytest.mark.parametrize("chars", [1, 300, 6_000_000])
def test_alignment_equals_both_libraries(spark, monkeypatch, chars):
    rows = list(enumerate(odd_texts(400 if chars < 1000 else 3000), 100)) + awkward() + [(90, "the <|endoftext|> of  it"), (91, "x<|endoftext|>"), (92, "\u001c a \u0085 b  c​ d"), (93, "a\n b \n c\n")]
    if chars == 1:
        rows = rows[::9]
    plain = align_tokens._blocks

    def cut(batches, a, b):
        align_tokens.BLOCK_CHARS = chars
        return plain(batches, a, b)

    monkeypatch.setattr(align_tokens, "_blocks", cut)
    assert found(align_tokens.align(documents(spark, rows), A, B)) == brute(rows)


def test_empty_table(spark):
    assert align_tokens.align(documents(spark, []), A, B).collect() == []
    assert found(align_tokens.align(documents(spark, [(1, None), (2, ""), (3, "▁")]), A, B)) == [(str(k), 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]


def test_units_join_to_the_text():
    rng = random.Random(5)
    for _ in range(2000):
        t = "".join(rng.choice("ab  \n\t é▁") for _ in range(rng.randint(1, 12)))
        assert " ".join(align_tokens.units(t)) == t


def test_identity_map():
    one = align_tokens.aligner(A, B)
    assert all(one.a.entries[i] == one.b.entries[j] for i, j in enumerate(one.same) if j >= 0)
    assert (one.same >= 0).sum() > 5000


def test_registered_query(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    assert found(QUERIES["op13_align_tokens"](spark, "/root/testdata/sf0.001")) == brute(rows)

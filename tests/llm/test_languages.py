"""Language codes: n-grams against a plain count, codewords, held-out accuracy, awkward rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyflow.llm import language_id as li
from tallyflow.llm.frames import table
from tallyflow.llm.queries import QUERIES
from tests.llm.data import awkward, documents

SF_DIR = "/root/testdata/sf0.01"


def plain_grams(text):
    """The same n-grams as strings, character by character."""
    out, t = [], " "
    for ch in text.lower():
        c = ch if li._letters()[ord(ch)] else " "
        t += c if c != " " or t[-1] != " " else ""
    t += "" if t[-1] == " " else " "
    for n in li.ORDERS:
        out += [g for i in range(len(t) - n + 1) if (g := t[i : i + n]) != " " and " " not in g[1:-1]]
    return out


def slot(gram):
    h = 0
    for ch in gram:
        h = (h * 0x100000001B3 & (1 << 64) - 1) ^ (0 if ch == " " else ord(ch))
    return ((h + len(gram)) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - li.SLOT_BITS


@pytest.mark.parametrize("block", [1, 2, 7, 1 << 18])
def test_grams_equal_a_plain_count(monkeypatch, block):
    monkeypatch.setattr(li, "BLOCK", block)
    rng = random.Random(block)
    texts = ["".join(rng.choice("aB é. 1ß漢́\n") for _ in range(rng.randint(0, 30))) for _ in range(300)] + ["", " ", "a", "1 2", "İ"]
    for t in texts:
        assert Counter(x for part in li.grams(t) for x in part.tolist()) == Counter(map(slot, plain_grams(t)))


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20, 120])
def test_codewords_are_apart(n):
    code = li.codewords(n).astype(int)
    bits = code.shape[1]
    apart = min((bits - code[i] @ code[j]) // 2 for i in range(n) for j in range(i))
    assert apart >= (1 if n < 4 else 2 ** (n - 2) if n <= li.EXHAUSTIVE else bits / 6)
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_one_wrong_bit_is_corrected():
    m = li.Model([f"l{k}" for k in range(5)])
    li.fit(m, np.random.default_rng(1).random((5, li.SLOTS)))
    for k in range(5):
        for b in range(m.code.shape[1]):
            margins = m.code[k].astype(float).copy()
            margins[b] *= -1
            assert m.losses(margins[None]).argmin() == k


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    rows = QUERIES["op11_language_id"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([truth[r.doc_id][0] == r.lang_pred for r in held]) >= 0.98
    assert {r.lang_pred for r in rows} <= {lang for lang, _ in truth.values()} | {"und"}
    # the model says the same row by row as in batches
    model = li.train(docs, per_language=100)
    for r in li.predict(docs.limit(50), model).collect():
        lang, score, close = model.predict([truth[r.doc_id][1]])
        assert (lang[0], close[0]) == (r.lang_pred, r.ambiguous) and abs(score[0] - r.score) < 1e-9


def test_held_out_labels_change_nothing(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    changed = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 3 = 1, 'xx', lang) as lang")
    a, b = li.train(docs), li.train(changed)
    assert a.languages == b.languages and (a.weights == b.weights).all() and (a.slope == b.slope).all() and a.heat == b.heat


def test_awkward_rows(spark):
    rows = awkward()
    df = documents(spark, rows).selectExpr("*", "case when doc_id % 2 = 0 then 'aa' when doc_id % 3 = 0 then 'bb' when doc_id = 25 then null else 'cc' end as lang")
    got = li.predict(df, li.train(df)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r, text in [(r, t) for r in got for i, t in rows if i == r.doc_id and i is not None and i != 59]:
        assert (r.lang_pred == "und") == (not text or not any(c.isalpha() for c in text))
        assert by_text.setdefault(text, (r.lang_pred, r.score)) == (r.lang_pred, r.score)
    assert li.predict(df.where("false"), li.train(df.where("false"))).collect() == []
    nothing = li.predict(df, li.train(df.where("doc_id is null"))).collect()
    assert len(nothing) == len(rows) and {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    single = li.predict(df, li.train(df.where("lang = 'aa'"))).collect()
    assert {r.lang_pred for r in single} == {"aa", "und"}


def test_close_codewords_are_flagged(spark):
    docs = table(spark, SF_DIR, "documents")
    text = {r.lang: r.text for r in docs.where("n_chars between 2000 and 3000").select("lang", "text").orderBy("doc_id").collect()}
    model = li.train(docs)
    pure = model.predict([text["en"], text["de"]])
    assert pure[0] == ["en", "de"] and pure[2] == [False, False]
    shares = [model.predict([text["en"][: 2000 - k] + " " + text["de"][:k]]) for k in range(0, 2001, 25)]
    assert any(s[2][0] for s in shares)

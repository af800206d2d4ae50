"""Near duplicates, repeats and embeddings against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyflow.llm import embedding_dedup, minhash, suffix_dedup
from tallyflow.llm.components import connected_components
from tallyflow.llm.shingles import shingle_sets
from tests.llm.data import awkward, documents, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_near(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if a is not None and b is not None and x and 100 * len(x & y) >= 75 * len(x | y)]
    root = components({i for i, _ in rows if i is not None}, links)
    return [(i, len(s), root.get(i) if i is not None else None, i is None or root[i] == i) for i, s in sets]


def test_shingle_sets_are_the_words():
    texts = [t or "" for _, t in awkward()] + ["A b\x0bC d e f", "\x0c", "a  b", "ä Ä b c d", "a b c d e"] * 2
    got = list(shingle_sets(pa.array(texts)))
    assert [len(g) for g in got] == [len(shingles(t)) for t in texts]
    assert (got[-5] == got[-10]).all() and len(np.intersect1d(*[next(shingle_sets(pa.array([t]))) for t in ("A B C D E", "a b c d e")])) == 1


@pytest.mark.parametrize("rounds", [0, 4])
def test_near_duplicates_of_awkward_rows(spark, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", rounds)
    rows = awkward()
    got = sorted(map(tuple, minhash.near_duplicates(documents(spark, rows)).collect()), key=repr)
    assert got == sorted(brute_near(rows), key=repr)


def test_near_duplicates_of_chains_and_crowds(spark):
    """Copies of copies that drift apart, a crowd of near copies, and short texts that share a line."""
    rng = random.Random(8)
    rows, text = [], prose(rng, 120).split()
    for k in range(25):
        rows.append((k, " ".join(text)))
        text[rng.randrange(120)] = f"new{k}"
        text[rng.randrange(120)] = f"other{k}"
    crowd, line = prose(rng, 100).split(), prose(rng, 12)
    for k in range(40):
        rows.append((100 + k, " ".join([*crowd[: rng.randrange(90)], f"x{k}", *crowd[rng.randrange(90) :]])))
        rows.append((200 + k, line + " " + prose(rng, rng.randrange(1, 20))))
    got = sorted(map(tuple, minhash.near_duplicates(documents(spark, rows)).collect()))
    assert got == sorted(brute_near(rows))


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 360)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == components({x for p in real for x in p}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            if s in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [0, 100])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 3000)
    rng = random.Random(5)
    letters = [(k, "".join(rng.choice("ab") for _ in range(rng.choice([0, 5, 30, 200])))) for k in range(60)]
    some = [r for r in awkward() if r[0] != 60]
    for rows, length in ((letters, 10), (some, 20), (some, 100)):
        got = sorted(map(tuple, suffix_dedup.remove_repeats(documents(spark, rows), length).collect()), key=repr)
        want = brute_repeats(rows, length)
        # equal ids have no order of their own but equal texts here; rows without an id come last in either order
        assert sorted(x[:3] for x in got if x[0] is not None) == sorted(x[:3] for x in want if x[0] is not None)
        assert [x for x in got if x[0] is not None] == sorted((x for x in want if x[0] is not None), key=repr)


def test_repeats_in_slices(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 700)
    rows = [(1, prose(random.Random(1), 400)), (2, prose(random.Random(1), 300) + " z"), (3, "ab" * 2000)]
    got = sorted(map(tuple, suffix_dedup.remove_repeats(documents(spark, rows), 50, texts=True).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert got == brute_repeats(rows, 50)
    assert suffix_dedup.remove_repeats(documents(spark, []), 50).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    rows = [(k, (centres[k % 12] + rng.normal(0, 0.07 * (k % 5), 16)).tolist()) for k in range(150)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, [x * 3 for x in rows[0][1]]), (203, None), (204, []), (205, [0.0] * 16), (206, [float("nan")] * 16), (207, [1.0, None]), (208, [float("inf")] * 16)]
    rows += [(209, [1.0, 2.0]), (210, [1.0, 2.001]), (None, rows[1][1]), (211, [1e200] * 16), (212, [1e200] * 16), (213, [-x for x in rows[0][1]])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, vec int, a int")

    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(x, y):
        x, y = np.array(x) / np.abs(x).max(), np.array(y) / np.abs(y).max()
        return x @ y / math.sqrt((x @ x) * (y @ y))

    links = [(a, b) for a, x in rows for b, y in rows if a is not None and b is not None and a != b and good(x) and good(y) and len(x) == len(y) and cosine(x, y) >= 0.95]
    root = components({i for i, _ in rows if i is not None}, links)
    want = sorted(((i, sum(a == i for a, _ in links), root.get(i), i is None or root[i] == i) for i, _ in rows), key=repr)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=repr) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0

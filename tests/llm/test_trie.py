"""Conversation trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyflow.llm import prefix_trie
from tallyflow.llm.frames import table
from tallyflow.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, seq int, shard int, depth int, kind int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, prefix_key(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in own.items():
        if rebuild:
            h = zlib.crc32(str(c).encode()) % 9
            turns = own.get(c - c % 5, [])[:h] + turns[h:]
        path = tuple(turns)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                kids[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in sorted(members, key=len, reverse=True):
        leaves[path] += not kids[path]
        saved[path] += (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        if path:
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def prefix_key(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest() + f"{len(text.encode()):08x}"


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def awkward(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(300):
        for t in range(rng.choice((0, 1, 1, 2, 3, 5, 8, 12))):
            rows.append((c, rng.choice((t, t, t, None, 0)), rng.choice(("user", "assistant", None)), rng.choice(("a", "b", "é", "", None, "ab"))))
    rows += [(c, t, "user", "same") for c in range(1000, 1400) for t in range(4)]  # one very common conversation
    rows += [(2000 + k, t, "user", str(t)) for k in range(6) for t in range(150 + k)]  # long ones with a common start
    rows += [(3000, 1, "user", "x" * 50_000), (3001, 1, "user", "x" * 50_000), (-7, 0, "user", "a"), (None, 0, "user", "a"), (3002, 0, None, None), (3002, 0, None, None)]
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_all_prefixes(spark, rebuild):
    rows = awkward()
    assert found(prefix_trie.trie(frame(spark, rows), rebuild)) == brute(rows, rebuild)


def test_many_shards(spark):
    """More shards than distinct conversations: most nodes span shards."""
    rows, before = awkward(2), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        assert found(prefix_trie.trie(frame(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_conversation_and_none(spark):
    assert found(prefix_trie.trie(frame(spark, []))) == []
    one = [(4, 0, "user", "x")]
    assert found(prefix_trie.trie(frame(spark, one))) == brute(one)
    turnless = [(6, 0, "user", "x")]  # its base is missing and h is at least 1
    assert zlib.crc32(b"6") % 9 >= 1
    assert found(prefix_trie.trie(frame(spark, turnless))) == brute(turnless) and len(brute(turnless)) == 1


def test_order_of_padded_rows():
    rng = random.Random(4)
    seqs = [[rng.randint(1, 3) for _ in range(rng.choice((0, 3, 8, 9, 16, 17, 30)))] for _ in range(400)]
    size = np.array([len(s) for s in seqs])
    flat, begin, conv = np.array([x for s in seqs for x in s]), np.cumsum(size) - size, np.array([rng.randint(0, 50) for _ in seqs])
    order = prefix_trie.lexorder(flat, begin, size, conv)
    assert [(seqs[i], conv[i]) for i in order] == sorted((s, c) for s, c in zip(seqs, conv))


def test_registered_query(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_prefix_trie"](spark, "/root/testdata/sf0.001")) == brute(rows)

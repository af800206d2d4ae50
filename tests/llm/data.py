"""Small documents that hold every awkward case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, doc int, chunk int, ids int, score int, n_tokens int, component int, v int, members int"


def documents(spark, rows):
    """Rows of (id, text) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 6, 7, 8) for i, t in rows], SCHEMA)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(("ath", "ore", "inly", "Under", "vers", "the", "of")) + rng.choice(("a", "ing", "est", "")) + str(rng.randrange(90)) for _ in range(n))


def awkward(seed: int = 3) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    line = prose(rng, 30)
    base = [prose(rng, 60) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(base)]
    for k, t in enumerate(base):  # near copies, exact copies, a shared passage
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        rows += [(10 + k, " ".join(w)), (20 + k, t), (30 + k, prose(rng, 20) + " " + line + " " + prose(rng, 20))]
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, "one"), (54, "ONE"), (55, "two words"), (56, "x" * 5000), (57, "ab " * 4000), (58, "  lead  and  trail  ")]
    rows += [(None, base[0]), (None, None), (59, "tie tie tie"), (59, "tie tie tie"), (60, prose(rng, 4000)), (61, "émoji 😀 \u0000 ▁ <|endoftext|> </s> ß\r\n")]
    return rows

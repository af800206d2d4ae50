"""Toxicity by a weighted finite-state pattern grammar (operator 6).

Five small transducers read the words of a clause: target (someone is addressed), negation and reported speech (scopes that
dampen), insult and threat (what is scored). Their product is one machine; it tells for every insult or threat in which reading
it stands. A document's score is a logistic of its readings, clause by clause.

Learned from labelled rows: the insult lexicon (word beginnings and whole words, each with its log-odds) and the weight of each
reading. At most ``max_toxic`` + ``max_clean`` labelled rows are used, those with the smallest hash of their id; labels whose id is held
out (crc32 mod 4 is 2) take part in nothing, class shares included. Words for targets, negation, reports and threats are fixed.

Defined results: a null text counts as empty; an empty text, and any text without a match, has the base score; texts are read
whole; equal rows, and ties of any kind, get equal scores; further columns are carried or ignored; an empty table gives an empty result; without labels of both kinds only threats count; a label
row with a null id or a null label is not used, and of several labels of one id the largest counts.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyflow.llm.frames import documents, slices, written

# The words of the closed classes, in English, German, French and Spanish.
TARGETS = "you your yours u ya du dich dir dein deine deiner ihr euch sie ihnen tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros su sus".split()
NEGATIONS = "not no never neither nor isn't aren't wasn't don't doesn't didn't without nicht kein keine keinen nie niemals ohne ne pas jamais aucun sans nunca jamás ningún sin".split()
REPORTS = "said says say called calls wrote writes reported quote quoted claims claimed sagte sagt nannte schrieb zitiert dit disait appelle écrit cité dijo dice llamó escribió citó".split()
THREATS = "kill killed hurt destroy beat burn shoot stab murder hang töten umbringen schlagen vernichten zerstören tuer tuerai frapper détruire matar mataré golpear destruir quemar".split()

TARGET, NEGATION, REPORT, THREAT, INSULT, OTHER = range(6)
_CLOSED = {w: c for c, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in words}
_WORD = re.compile(r"\w+(?:'\w+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")


# transducers


@dataclass(frozen=True)
class Transducer:
    """``step(state, word class)`` -> (next state, what it says about this word)."""

    start: int
    step: Callable[[int, int], tuple[int, int]]


def scope(opens: int, length: int) -> Transducer:
    """Says 1 for the ``length`` words behind a word of class ``opens``."""
    return Transducer(0, lambda state, c: (length if c == opens else max(0, state - 1), int(state > 0)))


def marks(c_: int) -> Transducer:
    """Says 1 at each word of a class."""
    return Transducer(0, lambda state, c: (0, int(c == c_)))


#: target within 4 words before, negation within 3, report anywhere before in the clause (up to 30 words)
GRAMMAR = {"insult": marks(INSULT), "threat": marks(THREAT), "target": scope(TARGET, 4), "negation": scope(NEGATION, 3), "report": scope(REPORT, 30)}


def compose(parts: dict[str, Transducer]) -> tuple[np.ndarray, np.ndarray]:
    """Product machine: next state and the reading of each (state, class). Reading 0: nothing; 1-8 insults, 9-16 threats.

    A threat needs a target on either side; the right side is a second reading that ``read`` adds.
    """
    first = tuple(t.start for t in parts.values())
    known, todo, nxt, says = {first: 0}, deque([first]), [], []
    while todo:
        state = todo.popleft()
        row, out = [], []
        for c in range(6):
            moves = [t.step(s, c) for s, t in zip(state, parts.values(), strict=True)]
            to = tuple(m[0] for m in moves)
            if to not in known:
                known[to] = len(known)
                todo.append(to)
            said = dict(zip(parts, (m[1] for m in moves), strict=True))
            mood = said["target"] + 2 * said["negation"] + 4 * said["report"]
            row.append(known[to])
            out.append(1 + mood if said["insult"] else 9 + mood if said["threat"] else 0)
        nxt.append(row)
        says.append(out)
    return np.array(nxt), np.array(says)


NEXT, SAYS = (x.tolist() for x in compose(GRAMMAR))
READINGS = 17
#: What a reading is worth before anything is learned: plain, targeted, negated, reported; threats count only with a target.
PRIOR = np.array([0] + [0.9 * (1.2 if m & 1 else 1) * (0.6 if m & 2 else 1) * (0.6 if m & 4 else 1) for m in range(8)] + [(2.0 if m & 1 else 0.1) * (0.3 if m & 6 else 1) for m in range(8)])


@dataclass
class Model:
    patterns: dict[str, float] = field(default_factory=dict)  # "abc" a beginning, "abc$" a whole word
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    bias: float = -2.2
    machine: object = None

    def __getstate__(self):
        return {**self.__dict__, "machine": None}

    def automaton(self):
        """Finds the places worth reading; all other text is only scanned."""
        if self.machine is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for p in [*self.patterns, *(w + "$" for w in THREATS)]:
                a.add_word(p.rstrip("$"), p)
            a.make_automaton()
            self.machine = a
        return self.machine

    def weight_of(self, word: str) -> float:
        best = self.patterns.get(word + "$", 0.0)
        for k in range(SHORTEST, min(LONGEST, len(word)) + 1):
            best = max(best, self.patterns.get(word[:k], 0.0))
        return best

    def read(self, text: str) -> np.ndarray:
        """Sum of lexicon weights in each reading; a clause counts each reading once, with its heaviest word."""
        total = np.zeros(READINGS)
        text = text.lower()
        hit = False
        for end, p in self.automaton().iter(text):
            at = end + 1 - len(p.rstrip("$"))
            if at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "_"):
                hit = True
                break
        if not hit:
            return total
        for clause in _CLAUSE.split(text):
            words = _WORD.findall(clause)
            weights = [self.weight_of(w) if w not in _CLOSED else 0.0 for w in words]
            classes = [INSULT if v > 0 else _CLOSED.get(w, OTHER) for w, v in zip(words, weights, strict=True)]
            if INSULT not in classes and THREAT not in classes:
                continue
            state, found = 0, {}
            for k, c in enumerate(classes):
                said, state = SAYS[state][c], NEXT[state][c]
                if said:
                    if TARGET in classes[k + 1 : k + 4] and not (said - 1) & 1:
                        said += 1
                    found[said] = max(found.get(said, 0.0), weights[k] or 1.0)
            for said, v in found.items():
                total[said] += v
        return total

    def score(self, readings: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + readings @ self.weights, -30, 30)))


# learning

SHORTEST, LONGEST = 4, 8


def usable(labels: DataFrame) -> DataFrame:
    """The only labels that anything is learned from or counted in: ``doc_id``, ``toxic``, one row per id, none that is held out."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return marked.where("doc_id is not null and toxic in (0, 1) and crc32(cast(doc_id as string)) % 4 <> 2").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def sample(docs: DataFrame, marked: DataFrame, max_toxic: int, max_clean: int) -> DataFrame:
    """Training rows of ``usable`` labels: ``text`` and ``toxic``; the hash of the id decides which, so a run repeats."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = marked.where("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(marked.where("toxic = 0").orderBy(*order).limit(max_clean))
    # at most max_toxic + max_clean rows of two numbers: a proven size
    return docs.join(F.broadcast(some), "doc_id").select("text", "toxic")


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    docs = [0, 0]
    for b in batches:
        for text, toxic in zip(b["text"], b["toxic"], strict=True):
            seen[toxic].update(set(_WORD.findall(text.lower())))
            docs[toxic] += 1
    words = list(seen[0].keys() | seen[1].keys())
    yield pd.DataFrame({"word": [*words, ""], "clean": [*(seen[0][w] for w in words), docs[0]], "bad": [*(seen[1][w] for w in words), docs[1]]})


def lexicon(rows: DataFrame, least: int = 3, odds: float = 3.0, chance: float = 0.001) -> dict[str, float]:
    """Beginnings and whole words that toxic rows hold far more often, each with its log-odds.

    ``odds`` bounds the log-odds from below. The log-likelihood ratio against equal shares must exceed the logarithm of the number of
    patterns compared over ``chance``, so that none of them, however many there are, is likely to enter by chance. Of a chain of beginnings that stand for the same rows the longest is kept, and a longer one below
    a kept one only if it says clearly more.
    """
    words = rows.mapInPandas(_word_counts, "word string, clean long, bad long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    words = written(words, "words")
    total = words.where("word = ''").first()
    if total is None or not total.bad or not total.clean:
        return {}
    starts = F.transform(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)), lambda k: F.when(k <= F.length("word"), F.substring("word", F.lit(1), k)))
    each = words.where("word <> ''").select("clean", "bad", F.explode(F.concat(starts, F.array(F.concat("word", F.lit("$"))))).alias("p")).where("p is not null")
    nb, nc = total.bad, total.clean
    share = nb / (nb + nc)
    sums = each.groupBy("p").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).where(F.col("bad") >= least)
    n = F.col("bad") + F.col("clean")
    gain = F.col("bad") * F.log(F.col("bad") / (n * share)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - share)))).otherwise(0.0)
    logit = F.log((F.col("bad") + 0.5) / (nb + 1)) - F.log((F.col("clean") + 0.5) / (nc + 1))
    sums = written(sums, "patterns")
    evidence = float(np.log(max(1, sums.count()) / chance))
    found = sums.withColumn("w", logit).where((logit >= odds) & (gain >= evidence)).orderBy(F.desc("bad"), "p").collect()
    counts = {r.p: r.bad for r in found}
    weight = {r.p: min(r.w, 7.0) for r in found}
    longer: Counter = Counter()
    for p in counts:
        stem = p.rstrip("$")
        for k in range(SHORTEST, len(stem) + (p != stem)):
            longer[stem[:k]] = max(longer[stem[:k]], counts[p])
    kept: dict[str, float] = {}
    for p in sorted(counts, key=lambda x: (len(x), x)):
        if longer[p] >= 0.95 * counts[p]:
            continue
        above = [kept[p[:k]] for k in range(SHORTEST, len(p)) if p[:k] in kept]
        if not above or weight[p] > max(above) + 1:
            kept[p] = weight[p]
    return kept


def fit(rows: DataFrame, model: Model, shares: tuple[float, float], pull: float = 2.0, rounds: int = 100) -> Model:
    """Weights of the readings by Newton steps on the sample's readings (a few numbers a row), pulled towards ``PRIOR``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"toxic": b["toxic"], "x": [model.read(t).tolist() for t in b["text"]]})

    got = rows.mapInPandas(run, "toxic int, x array<double>").toPandas()
    y = got["toxic"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return model
    x = np.column_stack([np.ones(len(y)), np.array(got["x"].tolist())])
    weight = np.where(y > 0, shares[1], shares[0])
    prior = np.concatenate([[model.bias], model.weights])
    hold = np.full(len(prior), pull)
    hold[0] = 1.0
    beta = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - hold * (beta - prior)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(hold)
        move = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)  # small steps: the classes may be separable
        beta = beta + move
        if np.abs(move).max() < 1e-6:
            break
    model.bias, model.weights = float(beta[0]), np.maximum(beta[1:], 0.0)
    return model


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = 4000, max_clean: int = 8000) -> Model:
    """The grammar with its lexicon and weights, from rows whose crc32(doc_id as text) mod 4 is not 2."""
    marked = written(usable(labels), "toxic-labels")
    rows = written(sample(documents(docs), marked, max_toxic, max_clean), "toxic-sample")
    model = Model(patterns=lexicon(rows))
    have = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    took = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    whole = sum(have.values()) or 1
    shares = tuple(have.get(c, 0) / whole * sum(took.values()) / max(1, took.get(c, 0)) for c in (0, 1))
    return fit(rows, model, shares)


def score(df: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row; the score reads nothing but the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            scores = model.score(np.array([model.read(t) for t in texts]).reshape(-1, READINGS))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    out = documents(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(df: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold. Batches are filtered as they pass; nothing is held beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                texts = b.column("text").cast(pa.string()).to_pylist()
                scores = model.score(np.array([model.read(t or "") for t in texts]).reshape(-1, READINGS))
                yield b.filter(pa.array(scores < threshold))

    return df.mapInArrow(run, df.schema)

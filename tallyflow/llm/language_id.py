"""Language of a text by error-correcting output codes (operator 11).

Every language has a codeword of -1 and +1. For each bit a binary classifier over character n-grams predicts on which side a text
lies: its weight for an n-gram is the log-odds of the languages with +1 against those with -1, its margin the mean weight of the n-grams
of a text, calibrated by a logistic curve. Decoding is loss-weighted: the language whose codeword has the least weighted logistic
loss, each bit weighted by how well it tells that language on rows set aside. A text whose two nearest codewords are close together is
flagged ambiguous.

Codes: all distinct splits for up to ``EXHAUSTIVE`` languages, otherwise the best of many random codes of 10 x log2(languages) bits by
least distance of rows, then of columns.

Learned from text and language of rows whose crc32(id as text) mod 3 is not 1: at most ``per_language`` rows of each language, those with
the smallest hash of their id; a quarter of them is set aside for calibration. Counts are summed on the cluster, one number per
language and n-gram slot reaches the driver, and a few margins per row set aside.

Defined results: ``und`` with score 0 for a text that is null or has no letter; texts are read whole, in blocks; equal texts get equal
results; a tie goes to the language first in order; with no row to learn from everything is ``und``; with a single language every text
with a letter is that language with score 1; a row without an id is predicted but never learned from, as is a row without text or
language; an empty table gives an empty result; further columns are ignored. Codewords need memory for each language, so more than
``MOST`` distinct languages raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyflow.llm.frames import documents, written

ORDERS = (1, 2, 3, 4)
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
EXHAUSTIVE = 6
MOST = 1000
BLOCK = 1 << 18
#: n-grams of evidence against which short texts are weighed
SHRINK = 4.0
CLOSE = 0.15


# n-grams


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters or marks that belong to them."""
    import unicodedata

    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)], bool)


def grams(text: str) -> Iterator[np.ndarray]:
    """Slots of the n-grams of a text, block by block: lower case, every run of other characters one space, none across a space.

    Nothing comes for a text without a letter.
    """
    letters, tail = _letters(), np.zeros(1, np.uint32)
    low = text.lower()
    for at in range(0, len(low), BLOCK):
        codes = np.frombuffer(low[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(letters[np.minimum(codes, 0x10FFFF)], codes, 0)
        keep = codes > 0
        keep[1:] |= codes[:-1] > 0
        keep[0] |= tail[-1] > 0
        codes = np.concatenate([tail, codes[keep]])
        if at + BLOCK >= len(low) and codes[-1] > 0:
            codes = np.append(codes, np.uint32(0))
        yield from _slots(codes, len(tail) if at else 0)
        tail = codes[-(ORDERS[-1] - 1) :]


def _slots(codes: np.ndarray, done: int) -> Iterator[np.ndarray]:
    """Slots of all n-grams that end behind the first ``done`` codes; a space may only be the first or the last character."""
    letter, hashed, fits = codes > 0, np.zeros(len(codes), np.uint64), np.ones(len(codes), bool)
    for n in range(1, min(ORDERS[-1], len(codes)) + 1):
        size = len(codes) - n + 1  # hashed[i] belongs to codes[i : i + n]
        hashed = (hashed[:size] * np.uint64(0x100000001B3)) ^ codes[n - 1 :]
        fits = fits[:size] & letter[n - 2 : n - 2 + size] if n > 2 else fits[:size]
        if n in ORDERS:
            first = max(0, done - n + 1)
            take = (letter if n == 1 else fits)[first:]
            mixed = (hashed[first:][take] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


# the model


def codewords(n: int) -> np.ndarray:
    """Rows of -1 and +1, one for each of ``n`` languages, no column constant, repeated or another's complement."""
    if n <= EXHAUSTIVE:
        masks = range(1, 1 << (n - 1))  # the last language is always -1
        return np.array([[1 if m >> k & 1 else -1 for m in masks] for k in range(n)], np.int8).reshape(n, -1)
    bits, rng, best, code = int(np.ceil(10 * np.log2(n))), np.random.default_rng(0), (-1, -1), None
    for _ in range(200 if n <= 100 else 10):
        c = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        if (np.abs(c.sum(axis=0, dtype=np.int64)) == n).any():
            continue
        between = (bits - c.astype(np.int32) @ c.T.astype(np.int32)) // 2 + np.eye(n, dtype=np.int32) * bits
        across = np.abs(c.T.astype(np.int32) @ c.astype(np.int32)) - np.eye(bits, dtype=np.int32) * n
        found = (int(between.min()), n - int(across.max()))
        if found > best:
            best, code = found, c
    return code


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    code: np.ndarray | None = None  # languages x bits
    weights: np.ndarray | None = None  # slots x bits
    slope: np.ndarray | None = None
    shift: np.ndarray | None = None
    trust: np.ndarray | None = None  # languages x bits, rows sum to the number of bits
    heat: float = 1.0

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean weight of each text's n-grams for every bit, shrunk for short texts; and the number of n-grams."""
        bits = self.weights.shape[1] if self.weights is not None else 0
        out, count = np.zeros((len(texts), bits)), np.zeros(len(texts), np.int64)
        pending, owner, held = [], [], 0

        def flush() -> None:
            nonlocal pending, owner, held
            slots, who = np.concatenate(pending), np.array(owner)
            sizes = np.array([len(p) for p in pending])
            start = np.cumsum(sizes) - sizes
            np.add.at(out, who, np.add.reduceat(self.weights[slots], start, axis=0, dtype=np.float64))
            pending, owner, held = [], [], 0

        for k, t in enumerate(texts):
            for part in grams(t) if t else ():
                if len(part):
                    count[k] += len(part)
                    if bits:
                        pending.append(part)
                        owner.append(k)
                        held += len(part)
                        if held >= BLOCK:
                            flush()
        if pending:
            flush()
        return out / (count + SHRINK)[:, None], count

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every text against every codeword."""
        z = margins * self.slope + self.shift
        agree, against = np.logaddexp(0, -z), np.logaddexp(0, z)
        up = self.trust * (self.code > 0)
        return agree @ up.T + against @ (self.trust - up).T

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, list[bool]]:
        """Language, score from 0 to 1 and whether the second nearest codeword is close, for each text."""
        margins, count = self.margins(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), [False] * len(texts)
        if len(self.languages) == 1:
            chance = np.ones((len(texts), 1))
        else:
            loss = self.losses(margins) * self.heat
            chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
            chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        score = np.where(count > 0, chance[np.arange(len(texts)), best], 0.0)
        ranked = np.sort(chance, axis=1)
        close = (count > 0) & (ranked[:, -1] - ranked[:, -2] < CLOSE) if len(self.languages) > 1 else np.zeros(len(texts), bool)
        return [self.languages[b] if c else "und" for b, c in zip(best.tolist(), count.tolist(), strict=True)], score, close.tolist()


# learning


def sample(df: DataFrame, per_language: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, list[str]]:
    """At most ``per_language`` rows of each language to learn from: ``lang`` (a number), ``aside``, ``text``; and the languages.

    Rows are first thinned by the hash of their id with each language's own share, so that only about twice the bound is ranked.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("doc_id is not null and lang is not null and text is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    counts = rows.groupBy("lang").count().orderBy("lang").limit(MOST + 1).collect()
    if len(counts) > MOST:
        raise ValueError(f"more than {MOST} languages")
    languages = [r.lang for r in counts]
    spark = df.sparkSession
    shares = spark.createDataFrame([(r.lang, k, min(1.0, 2 * per_language / r["count"])) for k, r in enumerate(counts)], "lang string, number int, share double")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # one row per language, at most MOST: a proven size
    thin = rows.join(F.broadcast(shares), "lang").where(draw < F.col("share"))
    few = thin.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")))).where(F.col("rank") <= per_language)
    return written(few.select(F.col("number").alias("lang"), (F.col("rank") % 4 == 0).alias("aside"), "text"), "language-sample"), languages


def train(df: DataFrame, per_language: int = 1000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Weights, calibration and trust from a sample of at most ``per_language`` rows of each language."""
    rows, languages = sample(df, per_language, id_col, text_col, lang_col)
    model = Model(languages)
    if len(languages) < 2:
        return model
    n = len(languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                parts = list(grams(text))
                size = sum(map(len, parts))
                if size:  # a very long text counts by the root of its length
                    own = np.bincount(np.concatenate(parts), minlength=SLOTS) / np.sqrt(size)
                    total[lang] = total[lang] + own if lang in total else own
        for lang, v in total.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lang, np.int32)), pa.array(at.astype(np.int32)), pa.array(np.round(v[at] * 1e6).astype(np.int64))], ["lang", "slot", "n"])

    sums = rows.where("not aside").select("lang", "text").mapInArrow(count, "lang int, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    have = np.zeros((n, SLOTS))
    have[sums.column("lang").to_numpy(), sums.column("slot").to_numpy()] = sums.column("n").to_numpy() / 1e6
    fit(model, have)
    if model.code.shape[1]:
        calibrate(model, *_margins_aside(rows, model))
    return model


def fit(model: Model, have: np.ndarray) -> None:
    """Log-odds of every slot for every bit; languages on one side of a bit weigh the same."""
    n = len(model.languages)
    model.code = codewords(n)
    smooth = 0.5 * have.sum(axis=1, keepdims=True) / SLOTS + 1e-9
    share = (have + smooth) / (have + smooth).sum(axis=1, keepdims=True)
    up = (model.code > 0).astype(float)
    plus, minus = (up / up.sum(axis=0)).T @ share, ((1 - up) / (1 - up).sum(axis=0)).T @ share
    model.weights = np.log(plus / minus).T.astype(np.float32)
    bits = model.code.shape[1]
    model.slope, model.shift, model.trust = np.full(bits, 4.0), np.zeros(bits), np.ones(model.code.shape)


def _margins_aside(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    bits = model.weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, count = model.margins(b.column("text").to_pylist())
            some = count > 0
            yield pa.RecordBatch.from_arrays([b.column("lang").filter(pa.array(some)), pa.array(m[some].tolist(), pa.list_(pa.float64()))], ["lang", "m"])

    got = rows.where("aside").select("lang", "text").mapInArrow(run, "lang int, m array<double>").toArrow()
    return np.array(got.column("m").to_pylist(), float).reshape(-1, bits), got.column("lang").to_numpy().astype(np.int64)


def calibrate(model: Model, margins: np.ndarray, lang: np.ndarray, rounds: int = 50) -> None:
    """A logistic curve for each bit, how far each bit is to be trusted for each language, and the sharpness of the scores."""
    code, n = model.code, len(model.languages)
    for b in range(code.shape[1]):
        y = code[lang, b] > 0
        if y.all() or not y.any():
            continue
        weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum()) * len(y)
        beta, prior, hold = np.array([4.0, 0.0]), np.array([4.0, 0.0]), np.array([0.05, 1.0])
        x = np.column_stack([margins[:, b], np.ones(len(y))])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            grad = x.T @ (weight * (y - p)) - hold * (beta - prior)
            step = np.clip(np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(hold), grad), -2, 2)
            beta = beta + step
            if np.abs(step).max() < 1e-6:
                break
        model.slope[b], model.shift[b] = max(beta[0], 0.1), beta[1]
    right = ((margins * model.slope + model.shift > 0) == (code[lang] > 0)).astype(float)
    for k in range(n):
        own = right[lang == k]
        trust = (own.sum(axis=0) + 1) / (len(own) + 2)
        model.trust[k] = trust / trust.sum() * code.shape[1]
    # the bits are not independent: the sharpness that makes the rows set aside likeliest
    if not len(lang):
        return
    loss = model.losses(margins)
    best = None
    for heat in 2.0 ** np.arange(-5, 2.1, 0.5):
        e = heat * (loss.min(axis=1, keepdims=True) - loss)
        nll = float((np.log(np.exp(e).sum(axis=1)) - e[np.arange(len(lang)), lang]).mean())
        if best is None or nll < best:
            best, model.heat = nll, float(heat)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``ambiguous`` of every row; nothing but the text is read for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, close = model.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(close, pa.bool_())], ["doc_id", "lang_pred", "score", "ambiguous"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    out = documents(df, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")

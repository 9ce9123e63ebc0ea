"""Language of a text from averaged hashed subword embeddings.

Every character 2- to 4-gram of a word, word edges included, has a row of an
embedding table by its hash. A text is the mean of its rows, and a linear softmax
reads the language from it. Table and softmax are trained by stochastic gradient
descent in numpy on a bounded sample of labelled documents (``PER_LANGUAGE`` of
each language, by a hash of the id), each as a whole and as one of its lines. A
part of the sample is held back: it sets the temperature of the probabilities
and the score below which an answer is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxspark.llm.common import per_slice

BUCKETS, WIDTH, PER_LANGUAGE, EPOCHS, RATE = 1 << 15, 16, 1500, 8, 0.3
_STEP = 1 << 16
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(text: str, is_letter: np.ndarray):
    """Buckets of all subwords, in blocks; whatever is no letter is a word edge."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, max(len(code) - 1, 0), _STEP):
        block = code[at : at + _STEP + 3]
        own = is_letter[block]
        block = np.where(own, block, np.uint32(32))
        m, n = len(block), min(_STEP, len(code) - at)
        out = []
        for k in (2, 3, 4):
            if m < k:
                break
            count = min(m - k + 1, n)
            h = np.full(count, k * 0x51ED270B & 0xFFFFFFFF, np.uint32)
            inside = np.ones(count, bool)
            for j in range(k):
                h = (h ^ block[j : j + count]) * _FACTORS[j]
                h ^= h >> np.uint32(15)
                if 0 < j < k - 1:
                    inside &= own[j : j + count]
            if k == 2:
                inside = own[:count] | own[1 : count + 1]
            out.append(h[inside])
        yield (np.concatenate(out) & np.uint32(BUCKETS - 1)).astype(np.int32) if out else np.empty(0, np.int32)


@dataclass(frozen=True)
class Model:
    """names of the languages, and the softmax input of one occurrence of each bucket."""

    names: list
    table: np.ndarray
    bias: np.ndarray
    heat: float
    reject: float


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column, per_language: int) -> DataFrame:
    """id, text, lang of up to ``per_language`` usable documents of each language, smallest hash of the id first."""
    known = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = known.select("id", "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    return known.join(F.broadcast(chosen.select("id").distinct()), "id")


def _examples(sample: DataFrame) -> DataFrame:
    """pick, lang, buckets, counts: two examples of each document, the whole and one line."""

    def work():
        is_letter = letters()

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            picks, lang, buckets, counts = [], [], [], []
            for name, pick, text in zip(*(part.column(c).to_pylist() for c in ("lang", "pick", "text"))):
                lines = text.split("\n")
                for example in (text, lines[pick % len(lines)]):
                    b, c = np.unique(np.concatenate([*subwords(example, is_letter), np.empty(0, np.int32)]), return_counts=True)
                    if len(b):
                        lang.append(name), picks.append(pick), buckets.append(b.astype(np.int32)), counts.append(c.astype(np.int32))
            ints = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(picks, pa.int64()), pa.array(lang, pa.string()), pa.array(buckets, ints), pa.array(counts, ints)],
                ["pick", "lang", "buckets", "counts"])

        return step

    picked = sample.select(F.col("lang").cast("string"), F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("pick"), "text")
    return per_slice(picked, work, "pick long, lang string, buckets array<int>, counts array<int>")


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column, per_language: int = PER_LANGUAGE) -> Model:
    rows = _examples(labelled_sample(docs, id_col, text_col, lang_col, usable, per_language)).toArrow()
    rows = rows.sort_by([("pick", "ascending"), ("lang", "ascending")])
    names = sorted(set(rows["lang"].to_pylist()))
    if not names:
        return Model([], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 1.0, 0.0)
    y = np.array([names.index(x) for x in rows["lang"].to_pylist()])
    fold = rows["pick"].to_numpy() // 7 % 4
    bags = [(np.asarray(b.values), (c := np.asarray(n.values)) / c.sum()) for b, n in zip(rows["buckets"], rows["counts"])]
    rng = np.random.default_rng(3)
    embed = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((len(names), WIDTH), np.float32), np.zeros(len(names), np.float32)
    order = np.flatnonzero(fold != 0)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(order):
            b, share = bags[i]
            mean = share @ embed[b]
            p = _softmax(out @ mean + bias)
            p[y[i]] -= 1
            grad = p @ out
            out -= rate * np.outer(p, mean).astype(np.float32)
            bias -= np.float32(0.1 * rate) * p.astype(np.float32)
            # the mean shrinks each row's share of the gradient; a text moves its rows as one
            embed[b] -= (rate * len(b) * share[:, None] * grad).astype(np.float32)
    table = embed @ out.T
    held = np.flatnonzero(fold == 0)
    held = held if len(held) else np.arange(len(y))
    logits = np.array([bags[i][1] @ table[bags[i][0]] + bias for i in held])
    heat = min((2.0**k for k in np.arange(-4, 4.25, 0.25)), key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).sum())
    p = _softmax(logits / heat)
    return Model(names, table, bias, float(heat), _rejection(p.max(axis=1), p.argmax(axis=1) == y[held]))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _rejection(score: np.ndarray, right: np.ndarray, wanted: float = 0.99) -> float:
    """The lowest score from which on at least ``wanted`` of the held-back answers are right."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= wanted)
    return float(score[order][good[-1]]) if len(good) else 1.0


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, accepted for every row, from its whole text alone.

    A null text, or one without a letter, is ``und`` with score 0 and not
    accepted; so is everything if nothing was learned. Ids may be null or repeat.
    """
    plain = docs.sparkSession.sparkContext.broadcast((model.names, model.table, model.bias, model.heat, model.reject))

    def work():
        names, table, bias, heat, reject = plain.value
        is_letter = letters()

        def one(text: str | None):
            if not text or not names:
                return "und", 0.0, False
            total, n = np.zeros(len(names)), 0
            for b in subwords(text, is_letter):
                total += table[b].sum(axis=0, dtype=np.float64)
                n += len(b)
            if not n:
                return "und", 0.0, False
            p = _softmax((total / n + bias) / heat)
            best = int(p.argmax())
            return names[best], float(p[best]), bool(p[best] >= reject)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            lang, score, ok = zip(*map(one, part.column("text").to_pylist()))
            return pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ok, pa.bool_())],
                ["id", "lang_pred", "score", "accepted"])

        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return per_slice(rows, work, f"id {dict(rows.dtypes)['id']}, lang_pred string, score double, accepted boolean")

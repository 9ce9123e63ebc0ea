"""Log-probabilities of whole texts from a log-bilinear model trained with noise contrast.

Words are counted over all training documents. The ``SHORT`` most frequent words
and ``CLASSES`` classes of all other words (by their ending) are the outcomes
of a log-bilinear network over the ``CONTEXT`` words before. It is trained in
numpy by noise-contrastive estimation: every learner takes its share of the
documents through minibatches, and the learners' parameters are averaged,
``ROUNDS`` times, each document serving in one round. A document's learner
follows from its id and text, not from the partition it lies in. Scoring multiplies blocks
of contexts with all outcomes and normalises, so that the probabilities of all
known words and of one unknown word per class add up to one; inside a class a
word has its share of the counts.

The model and the counts of the ``FREQUENT`` most frequent words have fixed size
bounds and travel to the tasks. Counts of all other words stay distributed and
are joined by the 64-bit hash of the word.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from voxspark.llm.common import SLICE, Memo, in_slices, per_slice, tidy
from voxspark.session import settle

SHORT, CLASSES, CONTEXT, WIDTH = 512, 64, 3, 16
FREQUENT = 1 << 18
#: Training tokens of one learner, over all rounds.
LEARNER_TOKENS = 1 << 21
NOISE, BATCH, RATE, ROUNDS = 32, 512, 0.15, 2
OUTCOMES = SHORT + CLASSES
START = OUTCOMES
#: The end of a text, as a word that no text contains.
END = b""
FANOUT = 32


def words_of(text: str) -> list[bytes]:
    """A-Z in lower case, cut at ASCII blanks, then one end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def class_of(word: bytes) -> int:
    """The class of a word outside the short list, by its last bytes."""
    return xxhash.xxh3_64_intdigest(word.rstrip(b".,;:!?")[-3:] or word) % CLASSES


def word_counts(texts: DataFrame) -> DataFrame:
    """h, class and n of every word of ``text``, ends included."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            got = list(counts)
            part = pa.RecordBatch.from_arrays([
                pa.array([word_hash(w) for w in got], pa.int64()), pa.array([class_of(w) for w in got], pa.int32()),
                pa.array(list(counts.values()), pa.int64())], ["h", "class", "n"])
            counts.clear()
            return part

        for part in in_slices(batches):
            for text in part.column("text").to_pylist():
                counts.update(words_of(text))
            if len(counts) > 400_000:
                yield out()
        if counts:
            yield out()

    return texts.select("text").mapInArrow(run, "h long, class int, n long").groupBy("h", "class").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Exact totals over all training words, and the counts of the frequent ones by hash."""

    tokens: int
    types: int
    frequent: dict
    short: dict
    class_base: np.ndarray
    outcome_share: np.ndarray

    def code(self, word: bytes) -> int:
        """The outcome of a word, and above it its count or, for one that is not frequent, 0."""
        h = word_hash(word)
        at = self.short.get(h)
        return self.frequent.get(h, 0) << 16 | (SHORT + class_of(word) if at is None else at)


def vocabulary(counts: DataFrame) -> Vocabulary:
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = sorted(((r[0], r[1], r[2]) for r in counts.groupBy(level.alias("level")).agg(F.count("*"), F.sum("n")).collect()), reverse=True)
    kept, least = 0, 0
    for at, types, _ in levels:  # whole levels of counts, at most FREQUENT words
        if kept + types > FREQUENT:
            least = at + 1
            break
        kept += types
    top = counts.where(level >= least).select("h", "n").toArrow().sort_by([("n", "descending"), ("h", "ascending")])
    frequent = dict(zip(top["h"].to_pylist(), top["n"].to_pylist()))
    short = {h: i for i, h in enumerate(top["h"].slice(0, SHORT).to_pylist())}
    rest = {r[0]: (r[1], r[2]) for r in counts.where(~F.col("h").isin(list(short) or [0])).groupBy("class").agg(F.sum("n"), F.count("*")).collect()}
    share = np.ones(OUTCOMES)
    share[: len(short)] += top["n"].slice(0, SHORT).to_numpy()
    base = np.zeros(CLASSES)
    for k in range(CLASSES):
        n, types = rest.get(k, (0, 0))
        share[SHORT + k] += n
        base[k] = math.log(n + types + 1)
    return Vocabulary(sum(x[2] for x in levels), sum(x[1] for x in levels), frequent, short, base, share / share.sum())


@dataclass
class Params:
    """Input rows, output rows, output biases and a diagonal matrix for each context place."""

    inputs: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray
    place: np.ndarray

    @classmethod
    def first(cls, share: np.ndarray) -> Params:
        rng = np.random.default_rng(1)
        return cls(
            rng.normal(0, 0.1, (OUTCOMES + 1, WIDTH)).astype(np.float32), rng.normal(0, 0.1, (OUTCOMES, WIDTH)).astype(np.float32),
            np.log(share).astype(np.float32), np.ones((CONTEXT, WIDTH), np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (self.inputs, self.outputs, self.bias, self.place)])

    @classmethod
    def of(cls, flat: np.ndarray, copy: bool = True) -> Params:
        shapes = [(OUTCOMES + 1, WIDTH), (OUTCOMES, WIDTH), (OUTCOMES,), (CONTEXT, WIDTH)]
        ends = np.cumsum([0, *(math.prod(s) for s in shapes)])
        flat = flat.copy() if copy else flat
        return cls(*(flat[a:b].reshape(s) for a, b, s in zip(ends, ends[1:], shapes)))

    def predicted(self, context: np.ndarray) -> np.ndarray:
        r = (self.inputs * self.place[0]).take(context[:, 0], axis=0)
        for j in range(1, CONTEXT):
            r += (self.inputs * self.place[j]).take(context[:, j], axis=0)
        return r

    def log_probabilities(self, context: np.ndarray, outcome: np.ndarray, rows: int = 512) -> np.ndarray:
        """Normalised log-probabilities, from matrix products of the distinct contexts with all outcomes."""
        key = context[:, 0].astype(np.int64)
        for j in range(1, CONTEXT):
            key = key * (OUTCOMES + 1) + context[:, j]
        _, at, which = np.unique(key, return_index=True, return_inverse=True)
        r = self.predicted(context[at])
        # the bias as one more column of the product
        left, right = np.column_stack([r, np.ones(len(r), np.float32)]), np.vstack([self.outputs.T, self.bias])
        total, ones = np.empty(len(r), np.float64), np.ones(OUTCOMES, np.float32)
        # by the norms, no score can leave this range; if one might, the largest is taken out first
        reach = np.sqrt((r * r).sum(axis=1).max(initial=0) * (self.outputs**2).sum(axis=1).max()) + np.abs(self.bias).max()
        for a in range(0, len(r), rows):
            scores, top = left[a : a + rows] @ right, 0.0
            if reach > 60:
                top = scores.max(axis=1)
                scores -= top[:, None]
            np.exp(scores, out=scores)
            total[a : a + rows] = np.log(scores @ ones) + top
        own = np.einsum("ij,ij->i", r.take(which, axis=0), self.outputs.take(outcome, axis=0)).astype(np.float64)
        return own + self.bias[outcome] - total[which]


def contexts(outcome: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The CONTEXT outcomes before each position, START beyond the start of its text.

    ``first`` is the place where the text of each position starts.
    """
    n = len(outcome)
    starts = np.flatnonzero(first == np.arange(n))
    sizes = np.diff(np.append(starts, n))
    out = np.full((CONTEXT, n), START, np.int32)
    for j in range(CONTEXT):
        out[j, j + 1 :] = outcome[: max(n - j - 1, 0)]
        for i in range(j + 1):
            out[j, starts[sizes > i] + i] = START
    return out.T


class Trainer:
    """Noise-contrastive minibatches with Adagrad."""

    def __init__(self, params: Params, share: np.ndarray, seed: int):
        self.rng = np.random.default_rng(seed)
        self.flat = params.flat()
        self.p = Params.of(self.flat, copy=False)  # views of the flat parameters
        self.square = np.full(len(self.flat), 1e-3, np.float32)
        self.noise_edges = np.cumsum(share)
        self.log_noise = (np.log(share) + math.log(NOISE)).astype(np.float32)
        self.cells = np.arange(WIDTH)

    def _rows(self, index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        at = (index[:, None] * WIDTH + self.cells).reshape(-1)
        return np.bincount(at, values.reshape(-1), n * WIDTH)

    def batch(self, context: np.ndarray, outcome: np.ndarray) -> None:
        p, m = self.p, len(outcome)
        noise = np.minimum(np.searchsorted(self.noise_edges, self.rng.random(NOISE)), OUTCOMES - 1)
        index = context.T.reshape(-1)
        own = p.inputs.take(index, axis=0).reshape(CONTEXT, m, WIDTH)
        r = (own * p.place[:, None, :]).sum(axis=0)
        q, q_noise = p.outputs.take(outcome, axis=0), p.outputs[noise]
        true = (r * q).sum(axis=1) + (p.bias - self.log_noise).take(outcome)
        false = r @ q_noise.T + (p.bias - self.log_noise)[noise]
        with np.errstate(over="ignore"):
            g = 1 / (1 + np.exp(true))  # pull towards the word
            h = -1 / (1 + np.exp(-false))  # push from the noise
        to_r = g[:, None] * q + h @ q_noise
        outputs = self._rows(outcome, g[:, None] * r, OUTCOMES)
        np.add.at(outputs.reshape(OUTCOMES, WIDTH), noise, h.T @ r)
        bias = np.bincount(outcome, g, OUTCOMES) + np.bincount(noise, h.sum(axis=0), OUTCOMES)
        place = (to_r * own).sum(axis=1).reshape(-1)
        inputs = self._rows(index, to_r * p.place[:, None, :], OUTCOMES + 1)
        grad = np.concatenate([inputs, outputs, bias, place]).astype(np.float32)
        grad /= np.float32(math.sqrt(m))
        self.square += grad * grad
        grad /= np.sqrt(self.square)
        grad *= np.float32(RATE)
        self.flat += grad


def _coded(texts: list[str], codes: Memo):
    """All words of the texts, their codes, and for each the place where its text starts."""
    rows = [words_of(t) for t in texts]
    sizes = np.array([len(r) for r in rows])
    words = [w for r in rows for w in r]
    code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    return words, code, np.repeat(starts, sizes), sizes


def train(coded: DataFrame, vocab: Vocabulary) -> Params:
    """From ``id`` and ``codes`` (packed outcomes) of all training documents.

    Documents are dealt to learners by a hash of their id and outcomes, sorted by
    it, and each serves in one round. How many learners there are follows from
    the number of tokens alone, so the partitioning of the table changes nothing.
    """
    params = Params.first(vocab.outcome_share)
    spark, learners = coded.sparkSession, -(-vocab.tokens // LEARNER_TOKENS) or 1
    share = spark.sparkContext.broadcast(vocab.outcome_share)
    place = F.xxhash64("id", "codes")
    dealt = coded.select(
        F.pmod(F.xxhash64(F.lit("learner"), "id", "codes"), F.lit(learners)).alias("learner"), place.alias("place"),
        F.pmod(F.xxhash64(F.lit("turn"), "id", "codes"), F.lit(ROUNDS)).alias("turn"), "codes")
    for turn in range(ROUNDS):
        now = spark.sparkContext.broadcast(params.flat())

        def run(batches):
            for learner, groups in groupby(_documents(batches), itemgetter(0)):
                trainer, seen = Trainer(Params.of(now.value), share.value, learner), 0
                docs = (np.frombuffer(codes, "<u2") for _, codes in groups)
                while some := list(islice(docs, SLICE)):
                    outcome = np.concatenate(some).astype(np.int64)
                    sizes = np.array([len(d) for d in some])
                    context = contexts(outcome, np.repeat(np.cumsum(sizes) - sizes, sizes))
                    for at in range(0, len(outcome), BATCH):
                        trainer.batch(context[at : at + BATCH], outcome[at : at + BATCH])
                    seen += len(outcome)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([learner], pa.int64()), pa.array([float(seen)]), pa.array([trainer.p.flat().tobytes()], pa.binary())], ["part", "n", "params"])

        own = dealt.where(F.col("turn") == turn).select("learner", "place", "codes")
        own = own.repartition(learners, "learner").sortWithinPartitions("learner", "place", "codes").select("learner", "codes")
        models = own.mapInArrow(tidy(run), "part long, n double, params binary")
        left = learners
        while left > FANOUT:  # average in a tree: no task or driver takes more than FANOUT models
            left = -(-left // FANOUT)
            models = models.groupBy(F.floor(F.col("part") / FANOUT).alias("part")).applyInPandas(_average, "part long, n double, params binary")
        got = models.toPandas()
        if len(got):
            params = Params.of(_mean(got.sort_values("part")))
    return params


def _documents(batches):
    """(learner, codes) row by row."""
    for part in in_slices(batches):
        yield from zip(part.column("learner").to_pylist(), part.column("codes").to_pylist())


def _mean(rows) -> np.ndarray:
    share = rows["n"].to_numpy() / rows["n"].sum()
    return sum(s * np.frombuffer(p, np.float32) for s, p in zip(share, rows["params"])).astype(np.float32)


def _average(key, rows):
    import pandas as pd

    rows = rows.sort_values("part")
    return pd.DataFrame({"part": [key[0]], "n": [rows["n"].sum()], "params": [_mean(rows).tobytes()]})


def _encoded(texts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """id, learn, codes (packed outcomes), n_tokens, the sums over frequent words, and the hashes and counts of the other words."""
    shared = texts.sparkSession.sparkContext.broadcast((vocab.frequent, vocab.short, vocab.class_base))

    def work():
        frequent, short, base = shared.value
        coder = Vocabulary(0, 0, frequent, short, base, np.zeros(0))
        codes = Memo(coder.code)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            words, code, first, sizes = _coded(part.column("text").to_pylist(), codes)
            n, owner = part.num_rows, np.repeat(np.arange(part.num_rows), sizes)
            outcome, count = code & 0xFFFF, code >> 16
            packed, ends = outcome.astype("<u2").tobytes(), np.cumsum(sizes) * 2
            share = np.log1p(count)
            inside = np.where(outcome >= SHORT, share - base[np.maximum(outcome - SHORT, 0)], 0.0)
            rare = np.flatnonzero(count == 0)
            hashes: list[Counter] = [Counter() for _ in range(n)]
            for i, doc in zip(rare.tolist(), owner[rare].tolist()):
                hashes[doc][word_hash(words[i])] += 1
            ten = math.log(10)
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays([
                part.column("id"), part.column("learn"), pa.array([packed[b - 2 * k : b] for b, k in zip(ends.tolist(), sizes.tolist())], pa.binary()),
                pa.array(sizes, pa.int64()), pa.array(np.bincount(owner, count > 0, n).astype(np.int64)),
                pa.array(np.bincount(owner, share, n) / ten), pa.array(np.bincount(owner, inside, n) / ten),
                pa.array([list(x) for x in hashes], longs), pa.array([list(x.values()) for x in hashes], longs),
            ], ["id", "learn", "codes", "n_tokens", "n_known", "log_counts", "log_inside", "rare", "times"])

        return step

    kind = dict(texts.dtypes)["id"]
    return per_slice(
        texts, work, f"id {kind}, learn boolean, codes binary, n_tokens long, n_known long, log_counts double, log_inside double, "
        "rare array<long>, times array<long>", 128)


def _modelled(coded: DataFrame, params: Params) -> DataFrame:
    """``coded`` with log_model, the model's log10 probability of the outcomes, in place of ``codes``."""
    shared = coded.sparkSession.sparkContext.broadcast(params.flat())
    names = [c for c in coded.columns if c != "codes"]

    def work():
        model = Params.of(shared.value)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [np.frombuffer(c, "<u2") for c in part.column("codes").to_pylist()]
            sizes = np.array([len(r) for r in rows])
            outcome = np.concatenate(rows).astype(np.int64)
            logp = model.log_probabilities(contexts(outcome, np.repeat(np.cumsum(sizes) - sizes, sizes)), outcome)
            total = np.bincount(np.repeat(np.arange(len(rows)), sizes), logp, len(rows)) / math.log(10)
            return pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(total)], [*names, "log_model"])

        return step

    schema = coded.select(*names, F.lit(None).cast("double").alias("log_model")).schema
    return per_slice(coded.select(*names, "codes"), work, schema, 128)


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` says which rows to learn from. A null text is empty: its only token
    is the end. Rows are scored one by one, so ids may be null or repeat; other
    columns are not read. Without training rows every word is unknown. Word
    hashes of 64 bits stand for the words. Neither the order nor the partitioning
    of the rows changes a score by more than rounding.
    """
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = settle(word_counts(texts.where("learn")))
    vocab = vocabulary(counts)
    # each text is encoded once, for training and for scoring
    coded = settle(_encoded(texts, vocab).withColumn("row", F.monotonically_increasing_id()))
    params = train(coded.where("learn"), vocab)
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("h"), "w.times")
    # frequent words were counted in the tasks; these are the others
    known = rare.join(counts.select("h", "n"), "h").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    each = math.log10(vocab.tokens + vocab.types + 1)
    rows = _modelled(coded.drop("learn", "rare", "times"), params)
    return rows.join(known, "row", "left").select(
        "id", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + logs - F.col("n_tokens") * each).alias("base_score"),
        (F.col("log_model") + F.col("log_inside") + logs).alias("score"))

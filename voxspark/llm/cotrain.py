"""Document quality by co-training of two views.

The text view sees which words, word ends and repeated words a document has (hashed); the
metadata view sees its source, language, size and layout figures. Each is a
sparse logistic model fitted in numpy. They start from a bounded sample of
labelled documents and then take turns on all other documents, where they lie:
in every round each task scores its documents with both views, and what one view
is sure of, by its calibrated probability, becomes training data for the other.
A task returns sums by feature only: the gradient of the pseudo-labels at the
current weights, and a bound of their curvature. The next fit adds this upper
bound of the pool's mean loss to the mean loss of the labelled rows, so no
document is left out at any size. Labelled rows held back calibrate each view
and fit the combination.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from voxspark.llm.common import Memo, in_slices, tidy
from voxspark.session import settle

TEXT_SIZE, META_SIZE, BINS, FIGURES = 1 << 17, 1 << 10, 12, 9
LABELLED, ROUNDS, SURE = 16000, 3, 0.97
#: Weight of the pool's mean loss against the labelled rows' mean loss.
POOL_SHARE = 0.5
_LETTERS = string.ascii_letters.encode() + bytes(range(128, 256))
_SIGNS = string.punctuation


def _bucket(name: str, size: int) -> int:
    return xxhash.xxh3_64_intdigest(name) % size


def _word_features(word: str) -> tuple[int, ...]:
    """The word without signs at its ends, and the signs at its end if there are several."""
    bare = word.strip(_SIGNS)
    tail = word[len(word.rstrip(_SIGNS)) :]
    names = [f"w:{bare}"] if bare else []
    if len(tail) > 1 or not bare:
        names.append(f"s:{tail[:3]}")
    return tuple(_bucket(n, TEXT_SIZE) for n in names)


class TextView:
    def __init__(self):
        self.words = Memo(_word_features)

    def __call__(self, text: str) -> np.ndarray:
        words = text.lower().split()
        found = set().union(*map(self.words.__getitem__, set(words)))
        found |= {_bucket("again:" + a, TEXT_SIZE) for a in _runs(words)}
        return np.fromiter(found, np.int32, len(found))


def _runs(words: list[str]) -> tuple[str, ...]:
    """Whether a word comes three times in a row."""
    return ("run",) if any(a == b == c for a, b, c in zip(words, words[1:], words[2:])) else ()


def layout(text: str) -> list[float]:
    """Size and layout figures of a text, each of them a number."""
    raw = text.encode("utf-8", "surrogatepass")
    n, words = max(len(raw), 1), raw.split()
    kinds = [len(raw) - len(raw.translate(None, drop)) for drop in (_LETTERS, string.digits.encode(), string.ascii_uppercase.encode(), _SIGNS.encode())]
    lines = raw.count(b"\n") + 1
    return [
        math.log1p(len(raw)), math.log(lines), math.log1p(len(raw) / lines), kinds[0] / n, kinds[1] / n,
        kinds[2] / max(kinds[0], 1), kinds[3] / n, len(set(words)) / max(len(words), 1), kinds[3] / max(len(words), 1),
    ]


@dataclass
class Pull:
    """A quadratic upper bound of the pool's mean loss around the weights it was taken at."""

    weight: np.ndarray
    bias: float
    slope: np.ndarray
    curve: np.ndarray
    slope_bias: float
    curve_bias: float


@dataclass
class Logit:
    """A sparse logistic model over sets of features, and its calibration."""

    weight: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def fit(cls, bags: list[np.ndarray], y: np.ndarray, size: int, pool: Pull | None = None, l1: float = 1e-3, rounds: int = 150) -> Logit:
        """Adagrad over all rows at once, with a shrinkage that leaves weak features at zero."""
        model = cls(np.zeros(size))
        if pool is not None:
            model.weight, model.bias = pool.weight.copy(), pool.bias
        n, ends = len(bags), np.cumsum([0, *map(len, bags)])
        flat = np.concatenate([*bags, np.empty(0, np.int32)])
        owner = np.repeat(np.arange(n), np.diff(ends))
        square, square_bias = np.full(size, 1e-8), 1e-8
        for _ in range(rounds):
            p = sigmoid(np.bincount(owner, model.weight[flat], n) + model.bias)
            g = (p - y) / n
            grad, grad_bias = np.bincount(flat, g[owner], size), g.sum()
            if pool is not None:
                grad += POOL_SHARE * (pool.slope + pool.curve * (model.weight - pool.weight))
                grad_bias += POOL_SHARE * (pool.slope_bias + pool.curve_bias * (model.bias - pool.bias))
            square += grad**2
            rate = 0.3 / np.sqrt(square)
            w = model.weight - rate * grad
            model.weight = np.sign(w) * np.maximum(0, np.abs(w) - rate * l1)
            square_bias += grad_bias**2
            model.bias -= 0.3 / math.sqrt(square_bias) * grad_bias
        return model

    def raws(self, bags: list[np.ndarray]) -> np.ndarray:
        """Log-odds of each bag, before calibration."""
        lengths = np.array([len(b) for b in bags], np.int64)
        flat = np.concatenate([*bags, np.empty(0, np.int32)])
        return np.bincount(np.repeat(np.arange(len(bags)), lengths), self.weight[flat], len(bags)) + self.bias

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        """Log-odds after calibration."""
        return self.slope * raw + self.shift


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _line(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of y on a few columns and a constant, by Newton's method with a small penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (p - y) + 1e-2 * w)
    return w


@dataclass
class Model:
    text: Logit
    meta: Logit
    edges: np.ndarray
    mix: np.ndarray

    def meta_bags(self, sources: list, langs: list, figures: np.ndarray, memo: Memo) -> list[np.ndarray]:
        """The features of each row: source, language, and the bin of each figure."""
        cols = [np.array([memo[f"source:{v}"] for v in sources]), np.array([memo[f"lang:{v}"] for v in langs])]
        for i, edges in enumerate(self.edges):
            names = np.array([memo[f"{i}:{k}"] for k in range(len(edges) + 1)])
            cols.append(names[np.searchsorted(edges, figures[:, i])])
        return [np.unique(row).astype(np.int32) for row in np.stack(cols, axis=1)]

    def scores(self, text_raw, meta_raw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.calibrated(text_raw), self.meta.calibrated(meta_raw)
        return sigmoid(a), sigmoid(b), sigmoid(np.column_stack([a, b]) @ self.mix[:2] + self.mix[2])


def _learnable(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, good_col: str, labelled: int) -> DataFrame:
    """id, y, source, lang, bag, figures of all documents; y is null but for the labelled sample."""
    y = labels.groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(good_col)).alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    chosen = y.join(ids, "id").orderBy(F.xxhash64("id"), "id").limit(labelled).select("id", F.col("y").cast("double").alias("y"))
    rows = docs.select(F.col(id_col).alias("id"), *_meta(docs), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a sample of at most ``labelled`` ids
    return settle(_features(rows.join(F.broadcast(chosen), "id", "left").select("id", "y", "source", "lang", "text")))


def _meta(docs: DataFrame) -> list:
    """source and lang as text, null where the table has none."""
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in ("source", "lang")]


def _features(rows: DataFrame) -> DataFrame:
    def run(batches):
        view = TextView()
        for part in in_slices(batches):
            texts = part.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("id", "y", "source", "lang")), pa.array([view(t) for t in texts], pa.list_(pa.int32())),
                 pa.array([layout(t) for t in texts], pa.list_(pa.float64()))],
                ["id", "y", "source", "lang", "bag", "figures"])

    return rows.mapInArrow(tidy(run), f"id {dict(rows.dtypes)['id']}, y double, source string, lang string, bag array<int>, figures array<double>")


def _pulls(pool: DataFrame, model: Model, weights: list[Logit]) -> list[Pull | None]:
    """For each view the pull of all pool documents that the other view is sure of; None if there are none."""
    shared = pool.sparkSession.sparkContext.broadcast((weights, model.edges))

    def run(batches):
        views, edges = shared.value
        own, memo = Model(views[0], views[1], edges, np.zeros(3)), Memo(lambda name: _bucket(name, META_SIZE))
        sizes = (TEXT_SIZE, META_SIZE)
        # by feature, then one place for the bias and one for the number of documents
        slope, curve = ([np.zeros(s + 2) for s in sizes] for _ in range(2))
        for part in in_slices(batches):
            bags = [
                [np.asarray(b.values) for b in part.column("bag")],
                own.meta_bags(part.column("source").to_pylist(), part.column("lang").to_pylist(), _matrix(part.column("figures")), memo)]
            raws = [v.raws(b) for v, b in zip(views, bags)]
            for k in (0, 1):
                other = sigmoid(views[1 - k].calibrated(raws[1 - k]))
                sure = np.flatnonzero((other >= SURE) | (other <= 1 - SURE))
                gap = sigmoid(raws[k][sure]) - (other[sure] >= 0.5)
                lengths = np.array([len(bags[k][i]) for i in sure], np.int64)
                flat = np.concatenate([*(bags[k][i] for i in sure), np.empty(0, np.int32)])
                slope[k][:-2] += np.bincount(flat, np.repeat(gap, lengths), sizes[k])
                # (sum over a row's features and the bias) squared <= their number times the sum of squares
                bend = (lengths + 1) / 4
                curve[k][:-2] += np.bincount(flat, np.repeat(bend, lengths), sizes[k])
                slope[k][-2] += gap.sum()
                curve[k][-2] += bend.sum()
                curve[k][-1] += len(sure)
        for k in (0, 1):
            some = np.flatnonzero(curve[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)), pa.array(slope[k][some]), pa.array(curve[k][some])],
                ["view", "feature", "slope", "curve"])

    sums = pool.select("source", "lang", "bag", "figures").mapInArrow(tidy(run), "view int, feature int, slope double, curve double")
    # at most one row for each feature
    got = sums.groupBy("view", "feature").agg(F.sum("slope").alias("slope"), F.sum("curve").alias("curve")).toPandas()
    out = []
    for k, size in enumerate((TEXT_SIZE, META_SIZE)):
        slope, curve, mine = np.zeros(size + 2), np.zeros(size + 2), got[got["view"] == k]
        slope[mine["feature"]], curve[mine["feature"]] = mine["slope"], mine["curve"]
        n = curve[-1]
        w = weights[k]
        out.append(Pull(w.weight, w.bias, slope[:-2] / n, curve[:-2] / n, slope[-2] / n, curve[-2] / n) if n else None)
    return out


def _matrix(figures) -> np.ndarray:
    flat = (figures.combine_chunks() if isinstance(figures, pa.ChunkedArray) else figures).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(figures), -1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_col: str = "good", labelled: int = LABELLED) -> Model | None:
    """The two views after ``ROUNDS`` of exchange; None without labels of both kinds.

    The labelled sample has the ``labelled`` smallest hashes of ids. An id with
    several labels takes the smallest; null ids and null labels say nothing.
    Rows that share an id are documents of their own with the same label. All
    rows without a label in the sample, null ids and empty texts too, are the pool.
    """
    every = _learnable(docs, labels, id_col, text_col, good_col, labelled)
    rows = every.where("y IS NOT NULL").toArrow()
    rows = rows.take(pa.array(np.lexsort((np.array([xxhash.xxh3_64_intdigest(b.values.to_numpy().tobytes()) for b in rows["bag"]], np.uint64),
                                          np.array([xxhash.xxh3_64_intdigest(str(i)) for i in rows["id"].to_pylist()], np.uint64)))))
    y = np.array(rows["y"].to_pylist(), float)
    if len(set(y)) < 2:
        return None
    pick = np.array([xxhash.xxh3_64_intdigest(str(i)) % 4 for i in rows["id"].to_pylist()])
    held = pick == 0
    learn = ~held
    if len(set(y[held])) < 2 or len(set(y[learn])) < 2:
        held = learn = np.full(len(y), True)
    cuts = [i / BINS for i in range(1, BINS)]
    edges = every.agg(*(F.percentile_approx(F.col("figures")[i], cuts, 10_000) for i in range(FIGURES))).first()
    model = Model(Logit(np.zeros(1)), Logit(np.zeros(1)), np.array([list(e) for e in edges]), np.zeros(3))
    bags = [
        [np.asarray(b.values) for b in rows["bag"]],
        model.meta_bags(rows["source"].to_pylist(), rows["lang"].to_pylist(), _matrix(rows["figures"]), Memo(lambda name: _bucket(name, META_SIZE))),
    ]
    pulls, pool = [None, None], every.where("y IS NULL")
    for turn in range(ROUNDS):
        views, raws = [], []
        for k, size in enumerate((TEXT_SIZE, META_SIZE)):
            view = Logit.fit([bags[k][i] for i in np.flatnonzero(learn)], y[learn], size, pulls[k])
            raws.append(view.raws(bags[k]))
            view.slope, view.shift = _line(raws[k][held], y[held])
            views.append(view)
        if turn < ROUNDS - 1:
            pulls = _pulls(pool, model, views)
    model.text, model.meta = views
    both = np.column_stack([v.calibrated(r) for v, r in zip(views, raws)])
    model.mix = _line(both[held], y[held])
    return model


def score(docs: DataFrame, model: Model | None, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """``docs`` with _text_score, _meta_score, _score and _keep (``_score`` at least ``cut``).

    Every row is scored from its whole text; a null text counts as empty, a null
    or missing source or language is a value of its own. Without a model (no
    labels of both kinds) all scores are 0.5 and all rows are kept. All columns
    pass through, repeated rows included.
    """
    extra = [("_text_score", pa.float64()), ("_meta_score", pa.float64()), ("_score", pa.float64()), ("_keep", pa.bool_())]
    plain = None
    if model is not None:
        parts = [(m.weight.astype(np.float32), m.bias, m.slope, m.shift) for m in (model.text, model.meta)]
        plain = docs.sparkSession.sparkContext.broadcast((parts, model.edges, model.mix))
    width = len(docs.columns)
    at = docs.columns.index(text_col)

    def run(batches):
        view, own, memo = TextView(), None, Memo(lambda name: _bucket(name, META_SIZE))
        if plain is not None:
            parts, edges, mix = plain.value
            own = Model(Logit(*parts[0]), Logit(*parts[1]), edges, mix)
        for part in in_slices(batches):
            n = part.num_rows
            if own is None:
                text = meta = both = np.full(n, 0.5)
            else:
                texts, sources, langs = (part.column(i).to_pylist() for i in (at, width, width + 1))
                figures = np.array([layout(t or "") for t in texts])
                text, meta, both = own.scores(
                    own.text.raws([view(t or "") for t in texts]), own.meta.raws(own.meta_bags(sources, langs, figures, memo)))
            new = [pa.array(text), pa.array(meta), pa.array(both), pa.array(both >= cut)]
            yield pa.RecordBatch.from_arrays([*part.columns[:width], *new], names=[*part.schema.names[:width], *(k for k, _ in extra)])

    schema = docs.select("*", *(F.lit(0.0).alias(k) if k != "_keep" else F.lit(True).alias(k) for k, _ in extra)).schema
    return docs.select("*", *(c.alias(f"_{i}") for i, c in enumerate(_meta(docs)))).mapInArrow(tidy(run), schema)


def good_labels(labels: DataFrame) -> DataFrame:
    """doc_id, good: 1 for quality without toxicity, 0 for either fault; null if nothing is said."""
    fault = (F.col("quality") == 0) | (F.col("toxic") == 1)
    good = (F.col("quality") == 1) & F.coalesce(F.col("toxic") == 0, F.lit(True))
    return labels.select("doc_id", F.when(fault, 0).when(good, 1).alias("good"))

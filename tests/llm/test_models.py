"""The trained operators: exact counts, normalised probabilities, held-out quality, edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_samples import sample_texts
from pyspark.sql import functions as F

from voxspark.llm import cotrain, language, lm
from voxspark.llm.common import Memo, crc_mod


def base_scores(rows, learn):
    counts = Counter()
    for i, t in rows:
        if learn(i):
            counts.update(lm.words_of(t or ""))
    total, types = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = lm.words_of(t or "")
        out.append((i, len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10((counts[x] + 1) / (total + types + 1)) for x in w)))
    return sorted(out, key=str)


def check_base(frame, learn, column):
    got = lm.score(frame, column).collect()
    want = base_scores([(r[0], r[1]) for r in frame.select("doc_id", "text").collect()], learn)
    got = sorted(((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9) and g[5] < 0 and math.isfinite(g[5])
    return got


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_lm_counts_with_and_without_rare_words(spark, monkeypatch):
    docs = spark.createDataFrame(sample_texts(120), "doc_id long, text string").repartition(3)
    column = crc_mod(F.col("doc_id"), 7) != 2
    one = check_base(docs, lambda i: not held(i), column)
    monkeypatch.setattr(lm, "FREQUENT", 600)  # most words now come through the join
    two = check_base(docs, lambda i: not held(i), column)
    # which counts travel does not change the scores
    assert [x[5] for x in one] == pytest.approx([x[5] for x in two], rel=1e-6)


def test_lm_edge_cases(edge_docs, no_docs):
    check_base(edge_docs, lambda i: not held(i), crc_mod(F.col("doc_id"), 7) != 2)
    check_base(edge_docs, lambda i: False, F.lit(False))
    assert lm.score(no_docs, F.lit(True)).count() == 0


def test_lm_score_whatever_the_partitioning(spark, monkeypatch):
    """Several learners, dealt by document: the same scores from 2 and from 7 partitions."""
    monkeypatch.setattr(lm, "LEARNER_TOKENS", 1000)
    rows = [*sample_texts(150), (None, "null id"), (None, None), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = []
    for parts, order in ((2, "doc_id"), (7, F.xxhash64("text"))):
        got = lm.score(docs.repartition(parts).sortWithinPartitions(order), F.col("doc_id") % 5 != 0).collect()
        scores.append(sorted(((str(r["id"]), r["n_tokens"], r["base_score"], r["score"]) for r in got)))
    assert [x[:2] for x in scores[0]] == [x[:2] for x in scores[1]]
    assert [x[3] for x in scores[0]] == pytest.approx([x[3] for x in scores[1]], rel=1e-6)


def test_lm_score_against_one_learner_by_hand(spark):
    """The whole score, word by word, from the parameters that one learner ends with."""
    texts = [(i, t) for i, t in sample_texts(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    counts = lm.settle(lm.word_counts(docs))
    vocab = lm.vocabulary(counts)
    params = lm.train(lm._encoded(docs.select(F.col("doc_id").alias("id"), "text", F.lit(True).alias("learn")), vocab), vocab)
    known, _ = vocabulary_of([t for _, t in texts])
    inside = Counter()
    for w, c in known.items():
        if lm.word_hash(w) not in vocab.short:
            inside[lm.class_of(w)] += c + 1
    got = {r["id"]: r["score"] for r in lm.score(docs, F.lit(True)).collect()}
    weights = np.column_stack([params.outputs, params.bias]).astype(float)
    for i, text in texts[:12]:
        before, total = [lm.START] * lm.CONTEXT, 0.0
        for w in lm.words_of(text):
            at = vocab.short.get(lm.word_hash(w))
            out = lm.SHORT + lm.class_of(w) if at is None else at
            r = sum(params.inputs[c].astype(float) * params.place[j] for j, c in enumerate(before))
            z = weights @ np.append(r, 1)
            total += z[out] - np.log(np.exp(z).sum())
            if at is None:
                total += math.log(known[w] + 1) - math.log(inside[lm.class_of(w)] + 1)
            before = [out, *before[:-1]]
        assert got[i] == pytest.approx(total / math.log(10), rel=1e-4)


def vocabulary_of(texts):
    counts = Counter(w for t in texts for w in lm.words_of(t))
    top = sorted(counts, key=lambda w: (-counts[w], w))
    short = {lm.word_hash(w): i for i, w in enumerate(top[: lm.SHORT])}
    share, n, types = np.ones(lm.OUTCOMES), np.zeros(lm.CLASSES), np.zeros(lm.CLASSES)
    for w, c in counts.items():
        at = short.get(lm.word_hash(w))
        if at is None:
            n[lm.class_of(w)] += c
            types[lm.class_of(w)] += 1
        share[lm.SHORT + lm.class_of(w) if at is None else at] += c
    return counts, lm.Vocabulary(sum(counts.values()), len(counts), {lm.word_hash(w): c for w, c in counts.items()}, short, np.log(n + types + 1), share / share.sum())


def coded(texts, vocab):
    _, code, first, _ = lm._coded(texts, Memo(vocab.code))
    outcome = code & 0xFFFF
    return lm.contexts(outcome, first), outcome


def test_probabilities_add_up():
    _, vocab = vocabulary_of([t for _, t in sample_texts(40)])
    params = lm.Params.first(vocab.outcome_share)
    context, outcome = coded(["one two three four"], vocab)
    for scale in (1, 30):  # also where scores are large
        params.outputs *= scale
        for row in context:
            every = params.log_probabilities(np.repeat(row[None], lm.OUTCOMES, 0), np.arange(lm.OUTCOMES))
            assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)


def test_training_beats_the_start_on_held_out_texts():
    texts = [t for _, t in sample_texts(200)]
    learn, test = [t for i, t in enumerate(texts) if i % 5], [t for i, t in enumerate(texts) if i % 5 == 0]
    _, vocab = vocabulary_of(learn)
    trainer = lm.Trainer(lm.Params.first(vocab.outcome_share), vocab.outcome_share, 0)
    context, outcome = coded(test, vocab)
    before = lm.Params.first(vocab.outcome_share).log_probabilities(context, outcome).mean()
    x, y = coded(learn, vocab)
    for at in range(0, len(y), lm.BATCH):
        trainer.batch(x[at : at + lm.BATCH], y[at : at + lm.BATCH])
    assert trainer.p.log_probabilities(context, outcome).mean() > before + 0.05


def test_contexts_stay_in_their_text():
    got = lm.contexts(np.array([5, 6, 7, 8]), np.array([0, 0, 2, 2]))
    s = lm.START
    assert got.tolist() == [[s, s, s], [5, s, s], [s, s, s], [7, s, s]]


def quality_data(spark, n=600):
    rng = random.Random(7)
    good = [f"{a}{b}" for a in ("lo", "mi", "ta", "re", "su") for b in ("ra", "ne", "vo", "di", "ka")]
    rows, labels = [], []
    for i in range(n):
        words, kind = rng.choices(good, k=rng.randint(15, 60)), i % 4
        if kind == 2:
            words = [w + rng.choice(["%%%", "$$$", "&&&"]) for w in words]
        if kind == 3:
            for w in rng.sample(["awful1", "nasty2", "rotten3", "vile4"], 3):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), "en", f"s{i % 5}", 0))
        if i % 3:
            labels.append((i, int(kind != 2), int(kind == 3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.repartition(3), cotrain.good_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_cotraining_on_documents_without_labels(spark):
    docs, labels = quality_data(spark)
    got = cotrain.score(docs, cotrain.train(docs, labels)).where("doc_id % 3 = 0").collect()
    right = [r["_keep"] == (r["doc_id"] % 4 < 2) for r in got]
    assert len(got) == 200 and sum(right) >= 196
    assert all(0 <= r[c] <= 1 for r in got for c in ("_text_score", "_meta_score", "_score"))


def test_cotraining_edge_cases(spark, edge_docs, no_docs):
    docs, labels = quality_data(spark, 200)
    model = cotrain.train(docs, labels)
    done = cotrain.score(edge_docs, model)
    assert done.columns[: len(edge_docs.columns)] == edge_docs.columns and done.count() == edge_docs.count()
    assert cotrain.score(no_docs, model).count() == 0
    assert cotrain.train(docs, labels.limit(0)) is None and cotrain.train(no_docs, labels) is None
    assert {(r["_score"], r["_keep"]) for r in cotrain.score(edge_docs, None).collect()} == {(0.5, True)}
    bare = docs.select("doc_id", "text")  # no metadata columns at all
    assert cotrain.score(bare, cotrain.train(bare, labels)).count() == 200
    mixed = edge_docs.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(
        docs.select(*docs.columns, *(F.lit(None).cast(t).alias(c) for c, t in edge_docs.dtypes if c not in docs.columns)))
    assert cotrain.train(mixed, labels) is not None


def test_labels_to_good(spark):
    rows = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 1), (5, None, None), (6, 1, None)], "doc_id long, quality int, toxic int")
    assert {r[0]: r[1] for r in cotrain.good_labels(rows).collect()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: None, 6: 1}


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs, "doc_id", "text", "lang", crc_mod(F.col("doc_id"), 4) != 2)
    got = language.predict(docs, model).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").where(crc_mod(F.col("id"), 4) == 2).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.9 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_language_edge_cases(spark, edge_docs, no_docs):
    model = language.train(edge_docs, "doc_id", "text", "lang", F.lit(True))
    got = language.predict(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    assert {r["id"]: r["lang_pred"] for r in got if r["id"] in (3, 4, 5)} == {3: "und", 4: "und", 5: "und"}
    assert {r["lang_pred"] for r in got} <= {"en", "de", "fr", "es", "ja", "und"}
    assert language.predict(no_docs, model).count() == 0
    nothing = language.train(no_docs, "doc_id", "text", "lang", F.lit(True))
    assert {r["lang_pred"] for r in language.predict(edge_docs, nothing).collect()} == {"und"}


def test_long_texts_are_read_to_the_end():
    """Blocks of a long text give the subwords of the whole."""
    is_letter = language.letters()
    text = "añb cd, " * 20_000
    whole = np.concatenate(list(language.subwords(text, is_letter)))
    step, language._STEP = language._STEP, 1 << 22
    try:
        assert np.array_equal(np.sort(whole), np.sort(np.concatenate(list(language.subwords(text, is_letter)))))
    finally:
        language._STEP = step


def test_rejection_keeps_sure_answers():
    score, right = np.array([0.9, 0.8, 0.7, 0.4]), np.array([True, True, True, False])
    assert language._rejection(score, right) == 0.7
    assert language._rejection(np.array([0.5]), np.array([False])) == 1.0

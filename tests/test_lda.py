"""Topic models against a plain dense implementation, and the rule-based text operators against known answers."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxspark.functions import stemming
from voxspark.operators import lda, pages, sentiment, vocabulary


def test_gamma_functions():
    for x in (0.01, 0.3, 1.0, 2.5, 17.0, 900.0):
        h = 1e-5 * max(1, x)
        assert lda.log_gamma(x) == pytest.approx(math.lgamma(x), abs=1e-9)
        assert lda.digamma(x) == pytest.approx((math.lgamma(x + h * x) - math.lgamma(x - h * x)) / (2 * h * x), rel=1e-4, abs=1e-4)
        assert lda.trigamma(x) == pytest.approx(float(lda.digamma(x + 1e-4 * x) - lda.digamma(x - 1e-4 * x)) / (2e-4 * x), rel=1e-5)


def plain_model(docs, ids, point, lam, passes):
    """One point, document by document, all in one dense table."""
    words = sorted(ids)
    at = {w: i for i, w in enumerate(words)}
    lam = np.array([lam[w] for w in words])
    eta = np.full(len(words), 1 / point.k if point.eta is None else point.eta)

    def fit(d, beta):
        counts = Counter(d)
        rows, n = beta[[at[w] for w in counts]], np.array(list(counts.values()), float)
        gamma, theta = np.ones(point.k), np.full(point.k, math.exp(lda.digamma(1.0) - lda.digamma(float(point.k))))
        for _ in range(lda.ROUNDS):
            new = point.prior + theta * ((n / (rows @ theta))[:, None] * rows).sum(0)
            moved, gamma = np.abs(new - gamma).mean(), new
            theta = np.exp(lda.digamma(gamma) - lda.digamma(gamma.sum()))
            if moved < lda.CLOSE:
                break
        return counts, n, rows, gamma, theta

    for step in range(passes):
        beta, stats = np.exp(lda.digamma(lam) - lda.digamma(lam.sum(0))), np.zeros_like(lam)
        for d in filter(None, docs):
            counts, n, rows, _, theta = fit(d, beta)
            for w, x in zip(counts, theta * rows * (n / (rows @ theta))[:, None]):
                stats[at[w]] += x
        lam = eta[:, None] + stats
        if point.eta is None:
            mean = (lda.digamma(lam) - lda.digamma(lam.sum(0))).mean(1)
            g = point.k * (lda.digamma(eta.sum()) - lda.digamma(eta) + mean)
            q, c = -point.k * lda.trigamma(eta), point.k * lda.trigamma(eta.sum())
            new = eta - (1.0 + step) ** -0.5 * (g - (g / q).sum() / (1 / c + (1 / q).sum())) / q
            eta = new if (new > 0).all() else eta
    log_beta = lda.digamma(lam) - lda.digamma(lam.sum(0))
    bound = ((eta[:, None] - lam) * log_beta + lda.log_gamma(lam) - lda.log_gamma(eta)[:, None]).sum()
    bound += point.k * lda.log_gamma(eta.sum()) - lda.log_gamma(lam.sum(0)).sum()
    for d in filter(None, docs):
        _, n, rows, gamma, theta = fit(d, np.exp(log_beta))
        log_theta = lda.digamma(gamma) - lda.digamma(gamma.sum())
        bound += (n * np.log(rows @ theta)).sum() + ((point.prior - gamma) * log_theta + lda.log_gamma(gamma) - lda.log_gamma(point.prior)).sum()
        bound += lda.log_gamma(point.prior * point.k) - lda.log_gamma(gamma.sum())
    return dict(zip(words, lam)), dict(zip(words, eta)), bound / sum(map(len, docs))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    topics = [list("abcdefgh"), list("ghijklmn"), list("opqrstuv")]
    docs = [[str(x) for x in rng.choice(topics[i % 3], rng.integers(1, 25))] for i in range(40)] + [[], ["a"]]
    return docs, spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(99, None)], "doc long, t array<string>")


@pytest.mark.parametrize("parts,block", [(1, 1 << 16), (5, 60)])
def test_all_points_equal_the_plain_model(spark, corpus, monkeypatch, parts, block):
    docs, df = corpus
    df = df.repartition(parts)
    points = [lda.Point(3, None, None), lda.Point(2, 0.3, 0.7), lda.Point(3, None, 1 / 3)]
    bags = lda.word_bags(df, "doc", "t", block)
    bags = bags.withColumn("block", F.pmod(F.xxhash64("doc"), F.lit(parts)))
    model = lda.fit(df, "doc", "t", points, 5, bags=bags)
    got = {r.word: (r.id, r.lam, r.eta) for r in model.table.collect()}
    assert got.keys() == {w for d in docs for w in d}
    ids = np.array([v[0] for v in got.values()])
    first = dict(zip(got, lda.first_weights(ids, 8, 42)))
    bounds = lda.bound_per_token(bags, model)
    for i, p in enumerate(points):
        a, b = model.starts[i], model.starts[i + 1]
        lam, eta, bound = plain_model(docs, {w: v[0] for w, v in got.items()}, p, {w: x[a:b] for w, x in first.items()}, 5)
        for w, (_, l, e) in got.items():
            assert l[a:b] == pytest.approx(lam[w], rel=1e-6) and e[i] == pytest.approx(eta[w], rel=1e-6)
        assert bounds[i] == pytest.approx(bound, rel=1e-6)
    assert any(v[2][0] != pytest.approx(1 / 3) for v in got.values())


def test_shares_words_and_grid(spark, corpus):
    docs, df = corpus
    model, best, table = lda.grid(df, "doc", "t", (2, 3), (None, 0.3), (None, 0.7), passes=4, n_words=4)
    rows = table.collect()
    assert len(rows) == 8 and best is not None and max(r.coherence for r in rows) == rows_of(table, model, best)
    bags = lda.word_bags(df, "doc", "t")
    i = [k for k, p in enumerate(model.points) if p.k == 3][0]
    shares = {r.doc: r for r in lda.assign(bags, model, i).collect()}
    assert len(shares) == len(docs) + 1
    for r in shares.values():
        own = [r[f"lda_{j}"] for j in range(3)]
        assert 0.96 < sum(own) <= 1 + 1e-9 and all(x == 0 or x >= lda.MIN_SHARE for x in own) and own[r.lda_first_topic] == max(own)
    words = lda.topic_words(model, 4)
    assert words.count() == 4 * sum(p.k for p in model.points)
    weights = model.table.select(F.explode(F.transform(model.weights(i), lambda w, j: F.struct(j.alias("j"), w.alias("w")))).alias("x"))
    assert [r[1] for r in weights.groupBy("x.j").agg(F.sum("x.w")).collect()] == pytest.approx([1.0] * 3)


def rows_of(table, model, best):
    p = model.points[best]
    same = [r for r in table.collect() if (r.n, r.alpha, r.beta) == (p.k, p.alpha, p.eta)]
    return same[0].coherence


def test_a_pass_moves_a_row_per_part_and_block(spark, corpus):
    """Not a row per word and block."""
    _, df = corpus
    points = [lda.Point(3)]
    model = lda.fit(df, "doc", "t", points, 1)
    parts, blocks = model.dealt.n_parts, model.dealt.n_blocks
    back = lda._expected(model.dealt, model.tables[0], points, model.sums)
    assert model.table.count() == 22 and model.tables[0].count() <= parts and back.count() <= parts * blocks < 22


def test_points_in_groups_are_the_points_of_one_run(spark, corpus, monkeypatch):
    _, df = corpus
    points = [lda.Point(3, None, None), lda.Point(2, 0.3, 0.7), lda.Point(3, 0.3, None)]
    bags = lda.word_bags(df, "doc", "t")
    runs = []
    for most in (100, 5):
        monkeypatch.setattr(lda, "GROUP", most)
        monkeypatch.setattr(lda, "WEIGHTS", 0)
        model = lda.fit(df, "doc", "t", points, 3, bags=bags)
        shares = {r.doc: r[1:] for r in lda.assign(bags, model, 2).collect()}
        runs.append((model, {r.word: [*r.lam, *r.eta] for r in model.table.collect()}, shares, lda.topic_words(model, 4).orderBy("point", "topic", "rank").collect()))
    (one, rows, shares, words), (other, rows2, shares2, words2) = runs
    assert len(one.groups) == 1 and len(other.groups) == 2 and rows.keys() == rows2.keys()
    assert all(rows[w] == pytest.approx(rows2[w], rel=1e-9) for w in rows) and all(shares[d] == pytest.approx(shares2[d], rel=1e-9) for d in shares)
    assert [r[:4] for r in words] == [r[:4] for r in words2]


def test_null_words_are_no_words(spark):
    df = spark.createDataFrame([(1, ["a", None, "b", "a"]), (2, [None]), (3, None)], "doc long, t array<string>")
    got = {r.doc: sorted(r.ns) for r in lda.word_bags(df, "doc", "t").collect()}
    assert got == {1: [1, 2], 2: [], 3: []} and lda.fit(df, "doc", "t", [lda.Point(2)], 1).table.count() == 2


def test_no_words(spark):
    df = spark.createDataFrame([(1, []), (2, None)], "doc long, t array<string>")
    bags = lda.word_bags(df, "doc", "t")
    model = lda.fit(df, "doc", "t", [lda.Point(2)], 1, bags=bags)
    assert model.table.count() == 0 and lda.assign(bags, model).count() == 2


# --- suffix reduction -----------------------------------------------------------------------------------------
STEMS = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing
conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ
vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust
defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll is is"""


def test_published_stems(spark):
    pairs = STEMS.split()
    want = dict(zip(pairs[::2], pairs[1::2]))
    df = spark.createDataFrame([(w,) for w in [*want, *want]] + [(None,)], "w string")
    got = {r.form: r.canonical for r in stemming.stems(df, "w").collect()}
    assert {w: (got[w], s) for w, s in want.items() if got[w] != s} == {} and len(got) == len(want)


def test_stems_run_on_distinct_words(spark):
    df = spark.createDataFrame([(1, ["running", "cats", "running", "é"]), (2, None), (3, [])], "doc long, t array<string>")
    got = {r.doc: r.reduced for r in vocabulary.stem_tokens(df, "doc", "t").collect()}
    assert got == {1: ["run", "cat", "run", "é"], 2: [], 3: []}
    plan = stemming.stems(df.select(F.explode("t").alias("w")), "w")._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") > plan.index("canonical") and "Python" not in plan


# --- sentiment rules ------------------------------------------------------------------------------------------
def scored(spark, texts):
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5), (":)", 2.0)], "token string, valence double")
    boosters = spark.createDataFrame([("very", 0.293), ("barely", -0.293)], "token string, scalar double")
    negations = spark.createDataFrame([("not",)], "token string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    out = sentiment.rule_sentiment(df, "doc", "text", lexicon, boosters, negations, "but", "s_")
    return {texts[r.doc]: (r.s_neg, r.s_neu, r.s_pos, r.s_compound) for r in out.collect()}


def compound(v):
    return round(v / math.sqrt(v * v + 15), 4)


def test_words_in_context(spark):
    want = {
        "good": 1.9, "very good": 1.9 + 0.293, "very x good": 1.9 + 0.95 * 0.293, "very x y good": 1.9 + 0.9 * 0.293, "very x y z good": 1.9,
        "barely bad": -2.5 + 0.293, "not good": 1.9 * -0.74, "not very good": (1.9 + 0.293) * -0.74, "not x y z good": 1.9,
        "GOOD day": 1.9 + 0.733, "GOOD": 1.9, "VERY good": 1.9 + 0.293 + 0.733, "(good), x": 1.9, "good :)": 3.9,
        "good but bad": 0.5 * 1.9 + 1.5 * -2.5, "good!!": 1.9 + 2 * 0.292, "good!!!!!!": 1.9 + 4 * 0.292, "bad??": -2.5 - 0.36, "bad?": -2.5,
        "good????": 1.9 + 0.96, "nothing": 0.0, "": 0.0,
    }
    got = scored(spark, [*want, None])
    assert {t: (got[t][3], compound(v)) for t, v in want.items() if got[t][3] != pytest.approx(compound(v), abs=1e-4)} == {}
    assert got["x"] if "x" in got else True
    assert got[None] == got[""] == (0.0, 0.0, 0.0, 0.0)
    assert got["nothing"] == (0.0, 1.0, 0.0, 0.0)
    assert got["good but bad"][:3] == pytest.approx([round(x / 7.7, 3) for x in (4.75, 1, 1.95)], abs=1e-3)


# --- element trees --------------------------------------------------------------------------------------------
def test_elements_end_where_they_end(spark):
    cases = {
        '<div class="a">x<div>y</div>z</div>out': "x<div>y</div>z",
        '<div><p class="a">one<p>two</div>out': "one<p>two",
        '<DIV class="a"><br><img src="x"/>t</DIV>out': '<br><img src="x"/>t',
        '<span class="a"><script>var s="</span>";</script><!-- </span> -->t</span>out': '<script>var s="</span>";</script><!-- </span> -->t',
        '<i class="a">1</b>2</i>3': "1</b>2",
        '<p class="a">never closed': "never closed",
        '<p class="b">no</p>': None, '<p class="a"></p>': None, "": None, None: None,
        '<b><b class="a">in</b>side</b>': "in",
        '<ul><li class="a">1<ul><li>2</li></ul></li><li>3</li></ul>': "1<ul><li>2</li></ul>",
    }
    df = spark.createDataFrame([(h, w) for h, w in cases.items()], "html string, want string")
    got = df.select("html", "want", pages.element_html("html", "a").alias("got")).collect()
    assert all(r.want == r.got for r in got), [(r.html, r.want, r.got) for r in got if r.want != r.got]

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from voxspark.operators import chunks, clusters, joins, ordering, overlap, profile, relational as R
from voxspark.operators import sentiment, summaries, topics, vectors, vocabulary
from voxspark.session import settle

QUIET = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third and more of the rows belong to one key; values repeat."""
    rnd = random.Random(7)
    data = [
        ("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(6)}", i, float(rnd.randrange(50)))
        for i in range(600)
    ]
    return data, spark.createDataFrame(data, "k string, id long, v double").repartition(5).cache()


def by_key(data):
    out = defaultdict(list)
    for k, i, v in data:
        out[k].append((i, v))
    return out


@pytest.mark.parametrize("n, salts", [(1, None), (3, None), (40, None), (5, 7)])
def test_top_n_per_group(skewed, n, salts):
    data, df = skewed
    got = ordering.top_n_per_group(df, ["k"], [F.desc("v"), "id"], n, rank="rank", salts=salts)
    want = sorted(
        (k, i, r + 1)
        for k, items in by_key(data).items()
        for r, (i, _) in enumerate(sorted(items, key=lambda x: (-x[1], x[0]))[:n])
    )
    assert rows(got, "k", "id", "rank") == want


def test_top_n_beyond_the_early_cut(skewed, monkeypatch):
    _, df = skewed
    args = (df, ["k"], [F.desc("v"), "id"], 5)
    want = rows(ordering.top_n_per_group(*args, rank="rank"), "k", "id", "rank")
    monkeypatch.setattr(ordering, "EARLY_CUT", 4)
    got = ordering.top_n_per_group(*args, rank="rank")
    assert rows(got, "k", "id", "rank") == want and dict(got.dtypes)["rank"] == "int"
    assert rows(ordering.top_n_per_group(*args), "k", "id") == [w[:2] for w in want]


def test_hot_key_spreads_over_partitions(skewed, spark, monkeypatch):
    """Half of the rows belong to one key and still lie in several partitions."""
    _, df = skewed
    written = []
    monkeypatch.setattr(ordering, "settle", lambda d: written.append(settle(d)) or written[-1])
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # so little data would all be merged
    try:
        ordering.with_row_number(df, ["k"], ["id"], "n")
    finally:
        spark.conf.unset(merging)
    sizes = [r["count"] for r in written[0].where("k = 'hot'").groupBy("_part").count().collect()]
    assert len(sizes) >= 2 and max(sizes) < 0.8 * sum(sizes)


def test_dedupe_first_is_idempotent_and_keeps_missing_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 4), (None, 3)], "k string, o int")
    once = ordering.dedupe_first(df, ["k"], ["o"])
    assert sorted((r.k or "", r.o) for r in once.collect()) == [("", 3), ("a", 1)]
    assert ordering.dedupe_first(once, ["k"], ["o"]).count() == 2


def test_running_total(skewed):
    data, df = skewed
    got = ordering.with_running_total(df, ["k"], ["id"], F.col("v"), "t")
    want = []
    for k, items in by_key(data).items():
        total = 0.0
        for i, v in sorted(items):
            total += v
            want.append((k, i, total))
    assert rows(got, "k", "id", "t") == sorted(want)


def test_row_number_per_key(skewed):
    data, df = skewed
    got = ordering.with_row_number(df, ["k"], [F.desc("v"), "id"], "n")
    want = sorted(
        (k, i, n + 1)
        for k, items in by_key(data).items()
        for n, (i, _) in enumerate(sorted(items, key=lambda x: (-x[1], x[0])))
    )
    assert rows(got, "k", "id", "n") == want


def test_row_numbers_without_key(skewed):
    data, df = skewed
    got = ordering.with_row_number(df, [], ["id"], "n")
    assert rows(got, "n", "id") == [(n + 1, i) for n, (_, i, _) in enumerate(sorted(data, key=lambda d: d[1]))]


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_exact_percentiles_on_both_paths(skewed, limit):
    data, df = skewed
    got = ordering.exact_percentiles(df, ["k"], "v", [0.25, 0.5, 0.9], limit)
    for k, f, p in rows(got, "k", "fraction", "percentile"):
        assert p == pytest.approx(np.percentile([v for _, v in by_key(data)[k]], f * 100))


def test_group_median_leaves_missing_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 4.0), (None, 9.0)], "k string, v double")
    assert rows(profile.group_median(df, "k", ["v"]), "k", "v") == [("a", 2.5)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(skewed, spark, how):
    _, df = skewed
    dim = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), ("zz", 4)], "k string, d int")
    assert joins.hot_keys(df, ["k"])[0] == ("hot",)
    want = rows(df.join(dim, ["k"], how).na.fill(-1), "id", "d")
    assert rows(joins.salted_join(df, dim, ["k"], how).na.fill(-1), "id", "d") == want
    assert rows(joins.lookup_join(df, dim, "k", how, max_rows=2).na.fill(-1), "id", "d") == want
    assert rows(joins.lookup_join(df, dim, "k", how).na.fill(-1), "id", "d") == want


def test_broadcast_check_measures_rows_and_bytes(spark):
    df = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=9)
    assert not joins.fits_broadcast(df, max_bytes=5_000)


def test_checked_key(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, v int")
    assert rows(joins.key_violations(df, ["k"]), "k", "n_rows") == [("a", 2)]
    with pytest.raises(Exception, match="is not unique"):
        joins.checked_key(df, ["k"]).collect()
    assert rows(joins.checked_key(df, ["v"]), "k", "v") == rows(df, "k", "v")
    assert joins.checked_key(df.select("v"), ["v"]).count() == 3


def test_salted_join_refuses_what_it_would_repeat(spark):
    fact = spark.createDataFrame([(1,)] * 5, "k int")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "k int, t string")
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            joins.salted_join(fact, dim, ["k"], how)
        assert joins.lookup_join(fact, dim, "k", how, small=False).count() == 6


def test_dictionary_and_lexicon_must_be_unique(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"])], "id int, t array<string>")
    twice = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0)], "form string, canonical string, valence double")
    with pytest.raises(Exception, match="is not unique"):
        vocabulary.reduce_tokens(df, "id", "t", twice).collect()
    with pytest.raises(Exception, match="is not unique"):
        sentiment.lexicon_sentiment(df, "id", "t", twice.withColumnRenamed("form", "token")).collect()


def test_semi_and_anti_joins(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    assert [r.k for r in joins.keep_in(a, b, "k").collect()] == [2, 2]
    assert sorted(str(r.k) for r in joins.keep_not_in(a, b, "k").collect()) == ["1", "None"]
    assert joins.contains_all(a.where("k = 2"), b, "k") and not joins.contains_all(a, b, "k")


def test_duplicates_report_includes_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4), ("b", 5)], "k string, id int")
    assert rows(R.duplicates_report(df, ["k"]), "id") == [(2,), (3,), (4,), (5,)]


def test_relational_helpers(spark):
    df = spark.createDataFrame([(1, "x", 5.0), (2, None, None)], "id int, t string, v double")
    assert R.select_matching(df, "^t$|^v").columns == ["t", "v"]
    flags = R.text_flags(df, ["t"]).orderBy("id").collect()
    assert [(r.has_t, r.t_na) for r in flags] == [(True, False), (False, True)]
    casts = R.cast_columns(spark.createDataFrame([("1",), ("x",)], "c string"), {"c": "double"})
    assert [r.c for r in casts.collect()] == [1.0, None]
    bands = R.banded(spark.createDataFrame([(99,), (100,), (1000,), (None,)], "n int"), "n", [100, 1000])
    assert [r.band for r in bands.collect()] == ["lt100", "gte100_lt1000", "gte1000", None]
    got = R.consolidate({2: df, 3: df.where("id = 1").withColumn("t", F.lit("new"))}, "id")
    assert sorted((r.id, r.version, r.t) for r in got.collect()) == [(1, 3, "new"), (2, 2, None)]
    assert df.select(R.argmax(F.array(F.lit(1), F.lit(3), F.lit(3))).alias("a")).head().a == 1
    wide = R.assemble([df.select("id", "t"), spark.createDataFrame([(3, 1)], "id int, w int")], "id")
    assert rows(wide.select("id"), "id") == [(1,), (2,), (3,)]
    s = spark.range(50)
    assert rows(R.sample_n(s, "id", 9), "id") == rows(R.sample_n(s.repartition(7), "id", 9), "id")


def test_entity_summary_null_rules(spark):
    df = spark.createDataFrame(
        [("h", 1, None, "t"), ("h", 2, "x", None), ("h", 3, "y", "u"), (None, 4, "z", "v")],
        "name string, o int, a string, b string",
    )
    spec = {"a": ("a", "first"), "n": ("b", "count"), "last": ("o", "max")}
    assert rows(profile.entity_summary(df, "name", spec, ["o"]), "name", "a", "n", "last") == [("h", "x", 2, 3)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0,), (999,), (1000,), (4000,), (4001,), (-1,)], "n int")
    got = rows(profile.histogram(df, "n", [0, 1000, 2000, 3000, 4000]), "low", "n")
    assert got == [(0.0, 2), (1000.0, 1), (2000.0, 0), (3000.0, 1)]


def test_value_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    assert [tuple(r) for r in profile.value_counts(df, ["c"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in profile.value_counts(df, ["c"], dropna=False).collect()] == [("a", 2), (None, 1)]


def test_entity_document_parts_are_the_whole_document(skewed):
    data, df = skewed
    texts = df.withColumn("t", F.concat(F.lit("t"), F.col("id").cast("string"))).withColumn("w", F.array("t"))
    whole = profile.entity_document(texts, ["k"], ["id"], {"doc": "t"}, {"all": "w"})
    parts = profile.entity_document(texts, ["k"], ["id"], {"doc": "t"}, {"all": "w"}, part_bytes=40)
    want = {k: [f"t{i}" for i, _ in sorted(v)] for k, v in by_key(data).items()}
    assert {r.k: r.doc.split("\n") for r in whole.collect()} == want
    got, sizes = defaultdict(list), []
    for r in parts.orderBy("k", "part").collect():
        got[r.k] += r.all
        sizes.append(len(r.doc.replace("\n", "")))
    assert dict(got) == want and max(sizes) <= 40 + 4
    totals = profile.entity_totals(df, ["k"], {"low": (F.col("v") < 10).cast("int")})
    assert {(r.k, r.n_rows, r.low) for r in totals.collect()} == {
        (k, len(v), sum(x < 10 for _, x in v)) for k, v in by_key(data).items()}


# --- chunks and packs ------------------------------------------------------------------------------
def greedy(sizes, budget):
    number, open_, out = -1, None, []
    for s in sizes:
        if open_ is None or open_ + s > budget:
            number, open_ = number + 1, s
        else:
            open_ += s
        out.append(number)
    return out


@QUIET
@given(
    sizes=st.lists(st.integers(0, 30), min_size=1, max_size=60),
    budget=st.integers(1, 40), block=st.integers(1, 9),
)
def test_pack_in_blocks_equals_greedy(spark, sizes, budget, block):
    data = [("hot", i, s) for i, s in enumerate(sizes)] + [("x", 0, 3)]
    df = spark.createDataFrame(data, "k string, o long, n long")
    got = rows(chunks.pack(df, ["k"], ["o"], "n", budget, block), "k", "o", "pack_no")
    assert got == [("hot", i, p) for i, p in enumerate(greedy(sizes, budget))] + [("x", 0, 0)]


def test_chunks(spark):
    df = spark.createDataFrame([(1, "a b  c d e"), (2, ""), (3, "x")], "id int, t string")
    assert rows(chunks.chunk(df, "id", "t", 2), "id", "chunk_no", "n_tokens", "chunk") == [
        (1, 0, 2, "a b"), (1, 1, 2, "c d"), (1, 2, 1, "e"), (3, 0, 1, "x"),
    ]


# --- scores -------------------------------------------------------------------------------------------
def test_word_points(spark):
    df = spark.createDataFrame(
        [("h", 1, ["a", "b", "a"]), ("h", 2, ["a"]), ("g", 3, ["a"]), ("g", 4, [])],
        "k string, id int, t array<string>",
    )
    counts = vocabulary.group_word_counts(df, "k", "t")
    assert rows(counts, "k", "token", "n_group") == [("g", "a", 1), ("h", "a", 3), ("h", "b", 1)]
    got = rows(vocabulary.word_points(df, "k", "id", "t", counts), "id", "text_points")
    assert got == [(1, 7), (2, 3), (3, 1), (4, 0)]


def test_reduce_tokens(spark):
    df = spark.createDataFrame([(1, ["quartos", "bons", "quartos"]), (2, [])], "id int, t array<string>")
    dictionary = spark.createDataFrame([("quartos", "quarto")], "form string, canonical string")
    assert rows(vocabulary.reduce_tokens(df, "id", "t", dictionary), "id", "reduced") == [
        (1, ["quarto", "bons", "quarto"]), (2, []),
    ]


def test_lexicon_sentiment(spark):
    df = spark.createDataFrame([(1, ["bom", "hotel"]), (2, ["ruim", "ruim"]), (3, [])], "id int, t array<string>")
    lexicon = spark.createDataFrame([("bom", 2.0), ("ruim", -1.5)], "token string, valence double")
    got = {r.id: r for r in sentiment.lexicon_sentiment(df, "id", "t", lexicon).collect()}
    assert got[1].vader_pos == round(3 / 4, 3) and got[1].vader_neu == 0.25 and got[1].vader_neg == 0.0
    assert got[1].vader_compound == round(2 / math.sqrt(4 + 15), 4)
    assert got[2].vader_neg == 1.0 and got[2].vader_compound == round(-3 / math.sqrt(9 + 15), 4)
    assert (got[3].vader_compound, got[3].vader_neu) == (0.0, 0.0)


def test_sentence_summary_moves_blocks_instead_of_words(spark, monkeypatch):
    """Many blocks give what plain counting gives, with missing keys and ids, and no word becomes a row."""
    monkeypatch.setattr(summaries, "BLOCK", 7)
    texts = ["a b. c c d", "b b. a b", "é x. y", "", None, "c c d. zz a", "1 2. a b", "d. e. f"]
    rows_ = [("k" if i % 3 else "m", i, t) for i, t in enumerate(texts * 2)] + [(None, 99, "a a a a"), ("n", None, "q r"), ("o", 100, ". \n")]
    df = spark.createDataFrame(rows_, "k string, id long, t string").repartition(3)
    out = summaries.sentence_summary(df, "k", "id", "t", 2, ["zz"])
    plan = out._jdf.queryExecution().toString()
    assert "Generate" not in plan[plan.index("== Physical Plan ==") :]
    want = {}
    for key in "km":
        found = [(i, pos, x.strip()) for k, i, t in rows_ if k == key for pos, x in enumerate(y for y in (t or "").split(".") if y.strip())]
        words = {x: [w for w in x.split() if w.isalpha() and w != "zz"] for _, _, x in found}
        count = {}
        for _, _, x in found:
            for w in words[x]:
                count[w] = count.get(w, 0) + 1
        first = {x: (i, pos) for i, pos, x in sorted(found, reverse=True)}
        best = sorted(first, key=lambda x: (-sum(count[w] for w in words[x]), first[x]))[:2]
        want[key] = (len(best), "\n".join(best))
    assert {r.k: (r.n_parts, r.summary) for r in out.collect()} == want


def test_sentence_summary_adds_up_documents_that_come_twice(spark):
    """Rows with the same key, id and place make one candidate, whether they come from one block or from two."""
    rows_ = [("k", 1, "a b. c"), ("k", 1, "a b. d"), ("k", 2, "c c c"), ("k", 3, "a b")]
    for parts in (1, 4):
        df = spark.createDataFrame(rows_, "k string, id long, t string").repartition(parts)
        got = summaries.sentence_summary(df, "k", "id", "t", 1, []).collect()
        # "a b" has 3 + 3 in each of two rows, "c c c" 3 * 4: equal, so the first place wins, with both of its rows
        assert [(r.n_parts, r.summary) for r in got] == [(2, "a b\na b")]


def test_sentence_summary_counts_a_repeated_sentence_once(spark):
    df = spark.createDataFrame(
        [("h", 1, "aa bb. cc. aa bb"), ("h", 2, "aa bb.dd"), ("g", 3, "uu")], "k string, id int, t string"
    )
    got = rows(summaries.sentence_summary(df, "k", "id", "t", 2, []), "k", "summary")
    assert got == [("g", "uu"), ("h", "aa bb\ncc")]


def test_score_summary(spark):
    data = [
        ("h", 1, "t1", 5.0, 0, 0.9), ("h", 2, "t2", 9.0, 1, 0.1), ("h", 3, "t3", 9.0, 1, -0.5),
        ("h", 4, "t4", 1.0, 0, 0.9), ("g", 5, "t5", None, None, None),
    ]
    df = spark.createDataFrame(data, "k string, id int, t string, p double, topic int, s double")
    got = rows(summaries.score_summary(df, "k", "id", "t", "p", "topic", "s"), "k", "summary")
    assert got == [("g", "t5"), ("h", "t1\nt2\nt3")]


def test_rouge_against_counters(spark):
    pairs = [(1, "o gato comeu o peixe", "o gato o peixe"), (2, "x", ""), (3, "", "a b")]
    df = spark.createDataFrame(pairs, "id int, r string, h string")

    def grams(t, n):
        w = t.split()
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

    got = {(r.id, r.n): r for r in overlap.rouge(df, "id", "r", "h").collect()}
    assert len(got) == 9
    for i, ref, hyp in pairs:
        for n in (1, 2, 3):
            a, b = grams(ref, n), grams(hyp, n)
            m = sum((a & b).values())
            p = m / sum(b.values()) if b else 0.0
            q = m / sum(a.values()) if a else 0.0
            assert got[(i, n)].precision == pytest.approx(p)
            assert got[(i, n)].recall == pytest.approx(q)
            assert got[(i, n)].fmeasure == pytest.approx(2 * p * q / (p + q) if p + q else 0.0)


def test_rouge_swaps_with_sides(spark):
    df = spark.createDataFrame([(1, "a b c a", "a b d")], "id int, r string, h string")
    a = {r.n: r for r in overlap.rouge(df, "id", "r", "h").collect()}
    b = {r.n: r for r in overlap.rouge(df, "id", "h", "r").collect()}
    assert all(a[n].precision == b[n].recall and a[n].recall == b[n].precision for n in (1, 2, 3))


def test_bleu(spark):
    data = [
        (1, "hello there general kenobi", ["hello there general kenobi", "hello there !"]),
        (2, "foo bar foobar", ["foo bar foobar"]),
    ]
    df = spark.createDataFrame(data, "id int, h string, rs array<string>")
    got = overlap.bleu(df, "id", "rs", "h").head()
    assert (got.bleu, got.translation_length, got.reference_length) == (pytest.approx(1.0), 7, 6)
    none = overlap.bleu(spark.createDataFrame([(1, "a b", ["c d"])], df.schema), "id", "rs", "h").head()
    assert none.bleu == 0.0


# --- vectors and clusters --------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def vecs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)).astype("float32")
    x[10] = x[4]  # a tie
    df = spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(x)], "id long, g int, v array<float>")
    q = rng.normal(size=(5, 6)).astype("float32")
    queries = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(q)], "q string, qv array<float>")
    return x.astype("float64"), q.astype("float64"), df.repartition(4).cache(), queries


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("max_queries", [4096, 2])
def test_search_equals_sorting_everything(vecs, metric, max_queries):
    x, q, df, queries = vecs
    out = vectors.search(
        df, queries, id="id", vector="v", query_id="q", query_vector="qv", metric=metric, n=7,
        where=F.col("g") != 1, max_queries=max_queries,
    )
    got = defaultdict(list)
    for r in out.orderBy("q", "rank").collect():
        got[r.q].append(r.id)
    keep = [i for i in range(len(x)) if i % 3 != 1]
    for j in range(len(q)):
        cost = -x @ q[j] if metric == "ip" else ((x - q[j]) ** 2).sum(axis=1)
        assert got[f"q{j}"] == sorted(keep, key=lambda i: (round(cost[i], 9), i))[:7]


def test_search_without_queries_or_rows(vecs):
    _, _, df, queries = vecs
    args = dict(id="id", vector="v", query_id="q", query_vector="qv")
    assert vectors.search(df, queries.where("false"), **args).count() == 0
    assert vectors.search(df.where("false"), queries, **args).count() == 0


def test_search_within_equals_search_per_group(vecs, monkeypatch):
    x, q, df, queries = vecs
    asked = queries.crossJoin(df.select("g").distinct())
    args = dict(on="g", id="id", vector="v", query_id="q", query_vector="qv", n=3)
    want = sorted(
        (g, f"q{j}", i)
        for g in range(3) for j in range(len(q))
        for i in sorted((i for i in range(len(x)) if i % 3 == g), key=lambda i: (round(-(x[i] @ q[j]), 9), i))[:3]
    )
    assert rows(vectors.search_within(df, asked, **args), "g", "q", "id") == want
    monkeypatch.setattr(vectors, "MAX_QUERIES", 1)
    assert rows(vectors.search_within(df, asked, **args), "g", "q", "id") == want


def test_norms_and_index(vecs, spark, tmp_path):
    _, _, df, _ = vecs
    assert vectors.norm_report(df, "v").head().n_not_unit == 300
    unit = vectors.normalize_vectors(df, "v")
    assert vectors.norm_report(unit, "v").head().n_not_unit == 0
    assert vectors.same_index(df, df, "id", "v").isEmpty()
    path = str(tmp_path / "index")
    vectors.build_index(df.withColumn("t", F.lit("x")), path, id="id", vector="v", text="t", shard_rows=100)
    index = vectors.load_index(spark, "unknown", {"main": path}, default="main")
    assert rows(index.groupBy("shard").count(), "shard", "count") == [(0, 100), (1, 100), (2, 100)]
    assert index.select("metadata.g").distinct().count() == 3


def test_cluster_paths_agree_and_are_nearest(spark):
    rng = np.random.default_rng(5)
    data = []
    for k, n in (("a", 40), ("b", 3), ("c", 1)):
        for i in range(n):
            c = rng.integers(0, 4) * 10
            data.append((k, i, *(float(z) for z in rng.normal(c, 0.5, 3))))
    data.append(("a", 99, None, 1.0, 1.0))
    df = spark.createDataFrame(data, "k string, id int, x double, y double, z double")
    features = ["x", "y", "z"]
    small = clusters.cluster_representatives(df, "k", "id", features, 4)
    large = clusters.cluster_representatives(df, "k", "id", features, 4, group_rows=0)
    assert rows(small, "k", "cluster", "id") == rows(large, "k", "cluster", "id")
    per_key = Counter(k for k, _, _ in rows(small, "k", "cluster", "id"))
    assert per_key["b"] <= 3 and per_key["c"] == 1 and per_key["a"] <= 4
    assert 99 not in [i for _, _, i in rows(small, "k", "cluster", "id")]
    texts = df.withColumn("t", F.col("id").cast("string"))
    summary = clusters.cluster_summary(texts, "k", "id", "t", small)
    assert rows(summary.where("k = 'c'"), "summary") == [("0",)]


# --- topics ------------------------------------------------------------------------------------------------
def test_topics(spark):
    a, b = ["praia", "mar", "sol", "areia"], ["café", "pão", "suco", "fruta"]
    data = [(i, (a if i % 2 else b) * 2) for i in range(40)]
    df = spark.createDataFrame(data, "id int, t array<string>")
    model = topics.fit_lda(df, "t", 2, passes=20, seed=1)
    out = topics.assign_topics(df, model, {0: "zero", 1: "one"})
    got = out.select("id", "lda_0", "lda_1", "lda_first_topic", "lda_first_topic_name").collect()
    for r in got:
        assert r.lda_first_topic == (0 if r.lda_0 >= r.lda_1 else 1)
        assert r.lda_first_topic_name == ("zero", "one")[r.lda_first_topic]
        assert min(r.lda_0, r.lda_1) == 0.0 or min(r.lda_0, r.lda_1) >= topics.MIN_SHARE
    words = topics.topic_words(spark, model, 4)
    assert words.count() == 8
    assert topics.letters_only(words).count() == 2
    with pytest.raises(ValueError):
        topics.corpus(df, "t", max_vocabulary=3)


def test_coherence_against_plain_count(spark):
    docs = [["a", "b", "a"], ["a"], ["b", "c"], ["a", "b", "c"], []]
    df = spark.createDataFrame([(d,) for d in docs], "t array<string>").repartition(3)
    words = spark.createDataFrame(
        [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "c"), (1, 1, "a")], "topic int, rank int, word string"
    )
    n, sets = len(docs), [set(d) for d in docs]

    def pair(wi, wj):
        both = sum(wi in s and wj in s for s in sets) / n
        return math.log((both + 1e-12) / (sum(wj in s for s in sets) / n))

    got = {r.topic: r.coherence for r in topics.coherence_umass(df, "t", words).collect()}
    assert got[0] == pytest.approx(np.mean([pair("b", "a"), pair("c", "a"), pair("c", "b")]))
    assert got[1] == pytest.approx(pair("a", "c"))

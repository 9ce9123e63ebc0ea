"""Steps whose work must grow with the input: what their plans and tasks may hold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from voxspark.operators import lda, overlap, pages, profile, sentiment, vocabulary
from voxspark.sources import readers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_elements_are_cut_in_one_batch_pass(spark):
    """The fold over the tags of a block took most of the time of a review page."""
    deep = "<ul>" * 3000 + '<p class="a">in<br></ul>' + "</ul>" * 2999
    df = spark.createDataFrame([(deep,), (None,)], "html string")
    cut = df.select(pages.elements("html", {"x": pages.by_attribute("a"), "y": pages.by_attribute("b")}).alias("e"))
    assert [(r.e.x, r.e.y) if r.e else None for r in cut.collect()] == [("in<br>", None), None]
    plan = plan_of(cut)
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan


def test_stems_are_made_once_per_distinct_word(spark):
    """The filter on changed words moved below the distinct, so that every token of the table was stemmed."""
    df = spark.createDataFrame([(1, ["running", "é"] * 2000 + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}s" for i in range(600)]), (2, []), (3, None)], "doc long, t array<string>")
    out = vocabulary.stem_tokens(df, "doc", "t", min_len=1)
    got = {r.doc: r.reduced for r in out.collect()}
    assert got[1][:4] == ["run", "é", "run", "é"] and got[1][4000] == "waa" and len(got[1]) == 4600 and got[2] == got[3] == []
    plan = plan_of(out)
    assert "regexp_count" not in plan and "try_element_at" not in plan


def test_sentiment_rules_do_not_depend_on_lots(spark, monkeypatch):
    """The fold looked every word up in a map, entry by entry; long texts took the square of their words."""
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    boosters, negations = spark.createDataFrame([("very", 0.293)], "token string, scalar double"), spark.createDataFrame([("not",)], "token string")
    texts = [None, "", "very good", "not very good", "x " * 3000 + "good", "GOOD but bad", "good"]
    df = spark.createDataFrame([(None if i == 6 else i, t) for i, t in enumerate(texts)], "doc int, text string").coalesce(1)

    def scores():
        out = sentiment.rule_sentiment(df, "doc", "text", lexicon, boosters, negations, "but", "s_")
        assert "ArrowEvalPython" in plan_of(out) and "try_element_at" not in plan_of(out)
        return sorted((str(r.doc), r.s_neg, r.s_neu, r.s_pos, r.s_compound) for r in out.collect())

    whole = scores()
    monkeypatch.setattr(sentiment, "LOT", 2)
    assert scores() == whole and whole[-1] == ("None", 0.0, 0.0, 1.0, 0.4404)


def test_overlap_is_compared_in_lots():
    """Whole batches of 10,000 rows were compared at once, whose memory grew with the texts."""
    h = pa.array([[1] * 5, [], [2] * 400_000, [3], [4]], pa.list_(pa.int64()))
    rs = pa.array([[[1]], [], [[2], [2]], [[3]], [[4] * 300_000]], pa.list_(pa.list_(pa.int64())))
    lots = list(overlap._lots(pa.RecordBatch.from_arrays([h, rs], ["_h", "_rs"])))
    assert [x.num_rows for x in lots] == [2, 2, 1] and pa.concat_arrays([x.column("_h") for x in lots]) == h
    assert list(overlap._lots(lots[0].slice(0, 0))) == []


def test_documents_are_fitted_as_before():
    """Per topic and on contiguous arrays; converged documents stay as they are."""
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 40, 60)
    doc, n, beta = np.repeat(np.arange(60), sizes), rng.integers(1, 4, sizes.sum()).astype(float), rng.random((sizes.sum(), 4))
    gamma, _ = lda.fit_documents(doc, n, beta, 0.25)
    for d in range(60):
        rows, count, g, share = beta[doc == d], n[doc == d], np.ones(4), np.full(4, np.exp(lda.digamma(1.0) - lda.digamma(4.0)))
        for _ in range(lda.ROUNDS):
            fresh = 0.25 + share * ((count / (rows @ share + 1e-100)) @ rows)
            moved, g, share = np.abs(fresh - g).mean(), fresh, np.exp(lda.digamma(fresh) - lda.digamma(fresh.sum()))
            if moved < lda.CLOSE:
                break
        assert np.allclose(gamma[d], g, rtol=1e-9)
    assert lda.BLOCK >= 1 << 20


def test_place_meta_in_lines(spark, tmp_path):
    """A file per place took most of the time of writing and reading."""
    (tmp_path / "a.json").write_text('{"place_name": "x", "n_reviews": -1}\n{"place_name": "y", "n_reviews": 3}\n')
    rows = readers.read_place_meta(spark, str(tmp_path), lines=True).collect()
    assert sorted((r.place_name, r.n_reviews, r.file_name) for r in rows) == [("x", None, "a"), ("y", 3, "a")]


def test_only_sizes_are_sorted_for_a_document(spark):
    """Texts and tokens were sorted, written and grouped, three times their bytes."""
    rows = [("a", 2, "xx"), ("a", 1, "yy"), (None, 1, "zz"), (None, None, "w"), ("a", 1, "vv")]
    df = spark.createDataFrame(rows, "k string, id int, t string")
    out = profile.entity_document(df, ["k"], ["id"], {"doc": "t"}, part_bytes=100)
    assert {(r.k, r.n_rows, r.doc) for r in out.collect()} == {("a", 3, "vv\nyy\nxx"), (None, 2, "w\nzz")}
    plan = plan_of(out)
    assert "rangepartitioning" not in plan and "Window" not in plan

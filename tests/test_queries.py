"""Every registered query on the smallest tables, next to its SQL; and its plans."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.check import compare, duck
from voxspark.functions import text as X
from voxspark.operators import ordering, profile, vocabulary

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
#: 27 models; ``test_lda`` covers the grid on a small corpus.
SLOW = {"topic_grid"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if name == "topic_assignment":
        shares = got[[f"lda_{i}" for i in range(6)]]
        assert ((shares == 0) | (shares >= 0.01)).all().all() and (shares.sum(axis=1) > 0.9).all()
        assert (shares.to_numpy().argmax(axis=1) == got["lda_first_topic"]).all()
    if name == "topic_coherence":
        assert len(got) == 6 and (got["coherence"] < 1e-9).all()
    if name == "topic_words":
        assert len(got) == 6 and got["words"].str.fullmatch("[a-zA-Z ]+").all()
    if sql is None:
        assert len(got)
    else:
        assert compare(got, con.execute(sql).df()) == ""


def test_topics_without_a_fitting_review(spark):
    """Only the larger tables have hotels without a review of one polarity."""
    folder = SF.replace("0.001", "0.01")
    got = entry.queries()["topic_prompts"](spark, folder).toPandas()
    assert (got["n_blocks"] == 0).any() and compare(got, duck(folder).execute(entry.oracle_sql()["topic_prompts"]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_top_n_is_cut_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_of(ordering.top_n_per_group(orders, ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], 3))
    physical = plan[plan.index("== Physical Plan ==") :]
    final, exchange, partial = (physical.index(s) for s in ("Final", "Exchange", "Partial"))
    assert final < exchange < partial


def test_scan_reads_only_what_is_used(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    spec = {"n": ("o_orderkey", "count")}
    plan = plan_of(profile.entity_summary(orders, "o_custkey", spec, ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan


def test_bag_of_words_needs_no_shuffle_and_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", X.tokenize("text", ["the"]).alias("t"))
    plan = plan_of(vocabulary.bag_of_words(docs, "doc_id", "t"))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["rouge", "search_within_entity", "word_points", "duplicates_report", "topic_table", "eval_prompts"])
def test_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

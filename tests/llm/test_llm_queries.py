"""Registered queries next to their SQL, and the pipeline stage by stage."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tools.check import compare, duck
from voxspark.llm import queries, secrets

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", queries.SQL)
def test_query_matches_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert compare(got, duck(SF).execute(queries.SQL[name]).df()) == ""


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_query_covers_its_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES[name](spark, SF)
    assert sorted(r[0] for r in got.select("doc_id").distinct().collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.dtypes == docs.dtypes, name
        ids = {r[0] for r in before.select("doc_id").collect()}
        now = [r[0] for r in after.select("doc_id").collect()]
        assert set(now) <= ids and len(set(now)) == len(now)
        if name in ("repeated_lines", "hidden_secrets"):
            assert set(now) == ids
        if name == "hidden_secrets":
            assert not any(secrets.base_spans(r[0]) for r in after.select("text").collect())
        assert after.where(F.col("n_chars") != F.length("text")).count() == 0
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert pieces.select("doc_id").distinct().count() == before.count()


def test_pipeline_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF)
        assert (pieces.count() > 0) == (docs is edge_docs)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None

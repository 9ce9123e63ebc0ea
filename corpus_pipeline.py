"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage
before it kept. All but the last return the columns of ``documents``; the last
returns the pieces of the packed sequences, with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxspark.llm import cotrain, line_dedup, minhash, packing, secrets
from voxspark.operators.ordering import with_row_number
from voxspark.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    labels = cotrain.good_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = cotrain.score(docs, cotrain.train(docs, labels))
    return scored.where("_keep").select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a document with a smaller id has too."""
    done = line_dedup.dedup_lines(docs)
    return _with_text(docs, done, F.when(F.col("text").isNotNull(), F.col("_kept_text")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest id, then the smallest hash of its text and of its columns.

    Rows are compared by their texts, also where they share an id. Of the texts
    without words one row of each id stays. Rows without an id are never
    compared and all stay.
    """
    order = ["doc_id", F.xxhash64("text"), F.xxhash64(*docs.columns)]
    named = with_row_number(docs.where("doc_id IS NOT NULL"), [], order, "_row")
    left = minhash.near_duplicates(named, "_row").where("kept").select(F.col("id").alias("_row"), "n_shingles")
    blank = F.when(F.col("n_shingles") > 0, F.col("_row"))
    stay = named.select("_row", "doc_id").join(left, "_row").groupBy("doc_id", blank.alias("_own")).agg(F.min("_row").alias("_row"))
    return named.join(stay.select("_row"), "_row", "left_semi").select(*docs.columns).union(docs.where("doc_id IS NULL"))


def hidden_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each secret replaced by a mark."""
    done = secrets.redact(docs)
    return _with_text(docs, done, F.col("text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, one row each."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def _with_text(docs: DataFrame, done: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` with a new text, and its length where that is a column."""
    done = done.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        done = done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return done.select(*docs.columns)


STAGES = [
    ("quality", quality), ("repeated_lines", repeated_lines), ("near_copies", near_copies),
    ("hidden_secrets", hidden_secrets), ("packed", packed),
]

#: SQL can express neither the classifier nor the tokenizer; tests check each stage by itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Vocabulary tables: bag of words, word counts, points, token reduction."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from voxspark.functions import stemming, text as X
from voxspark.operators.joins import checked_key, hot_keys, lookup_join, salted_join
from voxspark.session import settle


def bag_of_words(df: DataFrame, doc: str, tokens: str) -> DataFrame:
    """(doc, token, n) for one row per document, counted inside the row."""
    return df.select(doc, F.inline(X.token_counts(tokens))).withColumn("n", F.col("n").cast("bigint"))


def vocabulary(df: DataFrame, tokens: str) -> DataFrame:
    """(token, n_docs, n_tokens) over the corpus.

    A document brings one row per distinct token, so its document frequency is a
    plain count and needs no distinct aggregate.
    """
    return (
        df.select(F.inline(X.token_counts(tokens)))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_tokens"))
    )


def group_word_counts(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, token, n_group): how often an entity uses a word."""
    return (
        df.where(F.col(key).isNotNull())
        .select(key, F.inline(X.token_counts(tokens)))
        .groupBy(key, "token")
        .agg(F.sum("n").alias("n_group"))
    )


def word_points(
    df: DataFrame, key: str, doc: str, tokens: str, counts: DataFrame | None = None, points: str = "text_points"
) -> DataFrame:
    """(key, doc, points): sum over a text's tokens of its entity's count of each.

    Tokens are counted inside the row and the bag is written once; the entity's
    counts come from it unless they are given. The join carries one row per
    distinct word of a text, and words the entity does not count add 0. The
    counts tell which words of which entity are hot; those are salted.
    """
    bag = settle(df.select(key, doc, F.inline_outer(X.token_counts(tokens))))
    if counts is None:
        known = bag.where(F.col(key).isNotNull() & F.col("token").isNotNull())
        counts = known.groupBy(key, "token").agg(F.sum("n").alias("n_group"))
    counts = settle(counts)
    hot = hot_keys(bag, [key, "token"], counts=counts, n="n_group")
    matched = salted_join(bag, counts, [key, "token"], "left", hot=hot)
    return matched.groupBy(key, doc).agg(
        F.coalesce(F.sum(F.col("n") * F.col("n_group")), F.lit(0)).cast("bigint").alias(points)
    )


def reduce_tokens(
    df: DataFrame, doc: str, tokens: str, dictionary: DataFrame, out: str = "reduced"
) -> DataFrame:
    """Replace word forms by the dictionary's (form, canonical), in place and order.

    Only the distinct forms of a document meet the dictionary; its tokens are
    then looked up among the forms found, a batch of documents at a time, so that
    a long document costs no more per token than a short one. A form the
    dictionary lacks stays as it is, and one that it holds twice is an error.
    """
    entries = checked_key(dictionary.select("form", "canonical"), ["form"])
    # outer, because Spark would compute the tokens two more times to leave out empty arrays
    forms = df.select(doc, F.explode_outer(F.array_distinct(tokens)).alias("form")).where("form IS NOT NULL")
    found = lookup_join(forms, entries, "form", "inner").where("canonical IS NOT NULL")
    known = found.groupBy(doc).agg(F.collect_list("form").alias("_forms"), F.collect_list("canonical").alias("_canonicals"))
    return df.join(known, doc, "left").withColumn(out, _rewritten(tokens, "_forms", "_canonicals")).drop("_forms", "_canonicals")


def _rewritten(tokens: str, forms: str, canonicals: str) -> Column:
    """The tokens, those among ``forms`` replaced by the value beside it; a null array is empty."""

    def run(t: pa.Array, form: pa.Array, canonical: pa.Array) -> pa.Array:
        flat = t.flatten()
        at = pc.index_in(flat, value_set=form.flatten())
        ends = np.concatenate([[0], np.cumsum(t.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pc.coalesce(canonical.flatten().take(at), flat))

    return F.arrow_udf(run, "array<string>")(tokens, forms, canonicals)


def stem_tokens(
    df: DataFrame, doc: str, tokens: str, steps: Sequence[Sequence[stemming.Rule]] = stemming.PORTER, min_len: int = 0, out: str = "reduced"
) -> DataFrame:
    """Replace each token by its stem, in place and order, and leave out stems shorter than ``min_len``.

    The suffix rules run once per distinct word of the table, which is written
    for it; the documents then meet their own words only. A null array is empty.
    """
    forms = df.select(F.explode_outer(tokens).alias("token"))
    # written before it is filtered: a filter on the stems would move below the distinct, to every token
    changed = settle(stemming.stems(forms, "token", steps)).where("form <> canonical")
    reduced = reduce_tokens(df, doc, tokens, changed, out)
    return reduced.withColumn(out, F.filter(out, lambda t: F.length(t) >= min_len)) if min_len else reduced

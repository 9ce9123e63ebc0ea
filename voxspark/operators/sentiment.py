"""Sentiment of texts: lexicon sums, and the published rules for words in context."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from voxspark.functions import text as X
from voxspark.operators.joins import checked_key, lookup_join
from voxspark.session import settle

# Fixed value: normalisation constant of the published compound score.
ALPHA = 15


def lexicon_sentiment(
    df: DataFrame, doc: str, tokens: str, lexicon: DataFrame, prefix: str = "vader_"
) -> DataFrame:
    """(doc, neg, neu, pos, compound) from a (token, valence) lexicon.

    Tokens are counted inside the row, so the join carries one row per distinct
    word of a text. The lexicon is broadcast after its size is checked; a token
    that it holds twice is an error.
    """
    entries = checked_key(lexicon.select("token", "valence"), ["token"])
    bag = df.select(doc, F.inline_outer(X.token_counts(tokens)))
    v, n = F.col("valence"), F.col("n")
    neutral = F.col("token").isNotNull() & F.coalesce(v == 0, F.lit(True))
    per_doc = (
        lookup_join(bag, entries, "token", "left")
        .groupBy(doc)
        .agg(
            F.coalesce(F.sum(v * n), F.lit(0.0)).alias("_s"),
            F.coalesce(F.sum(F.when(v > 0, (v + 1) * n)), F.lit(0.0)).alias("_p"),
            F.coalesce(F.sum(F.when(v < 0, (1 - v) * n)), F.lit(0.0)).alias("_n"),
            F.coalesce(F.sum(F.when(neutral, n)), F.lit(0)).alias("_z"),
        )
    )
    total = F.col("_p") + F.col("_n") + F.col("_z")

    def share(c: str):
        return F.round(F.coalesce(F.try_divide(F.col(c), total), F.lit(0.0)), 3)

    return per_doc.select(
        doc,
        share("_n").alias(f"{prefix}neg"),
        share("_z").alias(f"{prefix}neu"),
        share("_p").alias(f"{prefix}pos"),
        F.round(F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + ALPHA), 4).alias(
            f"{prefix}compound"
        ),
    )


# Fixed values of the published rules: what capitals add, the factor of a
# negation, the weight of a booster by its distance, the weights before and
# after a contrast, and what exclamation and question marks add.
CAPITALS = 0.733
NEGATION = -0.74
DISTANCE = (1.0, 0.95, 0.9)
BEFORE, AFTER = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MOST_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]+"""

#: Words that a task compares at once.
LOT = 1 << 18


def sentiment_words(text: str) -> Column:
    """Words between blanks, without punctuation around them unless at most two signs would be left (emoticons)."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\r\f\x0B]+"), lambda w: w != "")

    def bare(w: Column) -> Column:
        inner = F.regexp_replace(w, f"^{PUNCTUATION}|{PUNCTUATION}$", "")
        return F.when(F.length(inner) > 2, inner).otherwise(w)

    return F.transform(words, bare)


def rule_sentiment(
    df: DataFrame, doc: str, text: str, lexicon: DataFrame, boosters: DataFrame, negations: DataFrame,
    contrast: str = "mas", prefix: str = "vader_",
) -> DataFrame:
    """(doc, neg, neu, pos, compound) by the published rules for valence in context.

    ``lexicon`` (token, valence), ``boosters`` (token, scalar) and ``negations``
    (token) are tables of lower-case words; one that repeats a token is an
    error. A word's valence grows with capitals (where the text is not all in
    capitals), with boosters among the three words before it, and turns with a
    negation there; words of the lexicon in between change nothing. What stands
    before the first ``contrast`` word counts half, what follows it one and a
    half times. Exclamation and question marks strengthen the sum.

    Only a text's distinct words meet the tables; the rules then run over the
    words of many texts at once, in Arrow batches. Words are told apart by
    64-bit hashes there. A null text is empty.
    """
    words = df.select(F.col(doc).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"), sentiment_words(text).alias("_words"))
    lower = words.select("_doc", _marks().alias("_marks"), F.transform("_words", _capital).alias("_capital"), F.transform("_words", F.lower).alias("_low"))
    rows = settle(lower.select(
        "_doc", "_marks", "_capital", F.array_position("_low", contrast).alias("_turn"), F.transform("_low", lambda w: F.xxhash64(w)).alias("_ids"),
        F.array_distinct("_low").alias("_forms")))
    nothing = F.lit(None).cast("double")
    entries = (
        checked_key(lexicon.select("token", "valence"), ["token"]).select("token", "valence", nothing.alias("scalar"), F.lit(False).alias("negates"))
        .union(checked_key(boosters.select("token", "scalar"), ["token"]).select("token", nothing, "scalar", F.lit(False)))
        .union(checked_key(negations.select("token"), ["token"]).select("token", nothing, nothing, F.lit(True)))
        .groupBy("token").agg(F.max("valence").alias("valence"), F.max("scalar").alias("scalar"), F.max("negates").alias("negates")))
    forms = rows.select("_doc", F.explode_outer("_forms").alias("token")).where("token IS NOT NULL")
    found = lookup_join(forms, entries, "token", "inner")
    entry = F.struct(F.xxhash64("token").alias("id"), "valence", "scalar", "negates")
    known = found.groupBy(F.col("_doc").alias("_of")).agg(F.collect_list(entry).alias("_known"))
    met = rows.drop("_forms").join(known, F.col("_doc").eqNullSafe(F.col("_of")), "left")
    state = met.select("_doc", "_marks", _in_context("_ids", "_capital", "_turn", "_known").alias("_s")).select("_doc", "_marks", "_s.*")
    state = state.select(
        "_doc", "neu", (F.col("total") + F.signum("total") * F.col("_marks")).alias("total"),
        (F.col("pos") + F.when(F.col("pos") > F.abs("neg"), F.col("_marks")).otherwise(0.0)).alias("pos"),
        (F.abs("neg") + F.when(F.col("pos") < F.abs("neg"), F.col("_marks")).otherwise(0.0)).alias("neg"))
    whole = F.col("pos") + F.col("neg") + F.col("neu")

    def share(c: str) -> Column:
        return F.round(F.coalesce(F.try_divide(F.col(c), whole), F.lit(0.0)), 3).alias(f"{prefix}{c}")

    compound = F.round(F.col("total") / F.sqrt(F.col("total") * F.col("total") + ALPHA), 4)
    return state.select(F.col("_doc").alias(doc), share("neg"), share("neu"), share("pos"), compound.alias(f"{prefix}compound"))


def _capital(w: Column) -> Column:
    return (F.upper(w) == w) & (F.lower(w) != w)


def _count(sign: str) -> Column:
    return F.length("_text") - F.length(F.replace("_text", F.lit(sign), F.lit("")))


def _marks() -> Column:
    marks = F.least(_count("!"), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION
    asked = _count("?")
    return marks + F.when(asked <= 1, 0.0).when(asked <= MOST_QUESTIONS, asked * QUESTION).otherwise(MANY_QUESTIONS)


def _in_context(*columns: str) -> Column:
    """(total, pos, neg, neu) of each text from its words' hashes and capitals, its turn and the entries of its words."""
    names = ("total", "pos", "neg", "neu")

    def run(ids: pa.Array, capital: pa.Array, turn: pa.Array, known: pa.Array) -> pa.Array:
        sizes = ids.value_lengths().to_numpy()
        lots = np.flatnonzero(np.diff(np.cumsum(sizes) // LOT, prepend=-1))
        parts = [_sums(ids[a:b], capital[a:b], turn[a:b], known[a:b]) for a, b in zip(lots, [*lots[1:], len(sizes)])]
        sums = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0))
        return pa.StructArray.from_arrays([pa.array(x) for x in sums], names=list(names))

    return F.arrow_udf(run, ", ".join(f"{n} double" for n in names))(*columns)


def _sums(ids: pa.Array, capital: pa.Array, turn: pa.Array, known: pa.Array) -> np.ndarray:
    """The rules for the words of some texts, which lie one after another; sums are added word by word, in order."""
    n, sizes = len(ids), ids.value_lengths().to_numpy()
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    loud = capital.flatten().to_numpy(zero_copy_only=False).astype(bool)
    loud_in = np.bincount(row, loud, n)
    mixed = ((loud_in > 0) & (loud_in < sizes))[row]
    entry = known.flatten()
    keys, first = np.unique(entry.field("id").to_numpy(zero_copy_only=False).astype(np.int64), return_index=True)

    # one entry more, for words that no table holds
    def field(name: str, none) -> np.ndarray:
        return np.append(pc.fill_null(entry.field(name), none).to_numpy(zero_copy_only=False)[first], none)

    flat = ids.flatten().to_numpy()
    place = np.searchsorted(keys, flat)
    place[np.append(keys, 0)[place] != flat] = len(keys)
    base, has_valence = field("valence", 0.0)[place], np.append(entry.field("valence").is_valid().to_numpy(zero_copy_only=False)[first], False)[place]
    scalar, has_scalar = field("scalar", 0.0)[place], np.append(entry.field("scalar").is_valid().to_numpy(zero_copy_only=False)[first], False)[place]
    negates = field("negates", False).astype(bool)[place]
    v = base + np.where(loud & mixed, np.sign(base) * CAPITALS, 0.0)
    for k, weight in enumerate(DISTANCE, 1):
        # the word k places before bends a valence, unless the lexicon knows it
        i = np.flatnonzero(at >= k)
        i = i[~has_valence[i - k]]
        j, now = i - k, v[i]
        louder = np.where(loud[j] & mixed[i], np.where(now > 0, CAPITALS, -CAPITALS), 0.0)
        boost = np.where(has_scalar[j], (scalar[j] * np.where(now < 0, -1.0, 1.0) + louder) * weight, 0.0)
        v[i] = np.where(negates[j], (now + boost) * NEGATION, now + boost)
    turns = turn.to_numpy(zero_copy_only=False).astype(np.int64)[row]
    v = np.where(~has_valence | has_scalar, 0.0, v) * np.where((turns == 0) | (at == turns - 1), 1.0, np.where(at < turns - 1, BEFORE, AFTER))
    return np.stack([np.bincount(row, x, n) for x in (v, np.where(v > 0, v + 1, 0.0), np.where(v < 0, v - 1, 0.0), v == 0)])

"""Raw files to the prepared review table and the index table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from voxspark import schemas as S
from voxspark.functions import parsers as P, text as X
from voxspark.operators import profile
from voxspark.operators.joins import checked_key, lookup_join
from voxspark.operators.ordering import dedupe_first
from voxspark.operators.relational import consolidate, select_rename

# The per-place aggregates of the collection report.
_FIRST = (
    "name_input", "sort_by", "hl", "url", "n_reviews_max", "city", "estado", "capital", "regiao",
    "category", "subtypes", "stars", "feature_id", "retrieval_date_metadata", "place_name",
    "address", "overall_rating", "n_reviews", "topics", "file_name",
)
_COUNT = (
    "review_id", "relative_date", "other_ratings", "trip_type_travel_group", "user_name",
    "user_reviews", "user_photos", "user_url", "text", "response_text", "response_relative_date",
)
PLACE_REPORT = {
    **{c: (c, "first") for c in _FIRST},
    **{c: (c, "count") for c in _COUNT},
    "retrieval_date": ("retrieval_date", "max"),
    "rating": ("rating", "mean"),
    "likes": ("likes", "sum"),
    "user_is_local_guide": ("user_is_local_guide", "sum"),
}

# The per-place aggregates of the text report.
TEXT_REPORT = {
    "place_name": ("place_name", "first"),
    **{c: (c, "count") for c in ("review_id", "text", "response_text")},
    **{c: (c, "sum") for c in ("words_len", "tokens_len")},
}


def join_sources(inputs: DataFrame, meta: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review rows with the columns of their place.

    Places without metadata or reviews fall out. ``url`` must be unique in the
    input list and ``file_name`` in the metadata.
    """
    renamed = inputs.withColumnsRenamed({"name": "name_input", "n_reviews": "n_reviews_input"})
    hotels = checked_key(renamed, ["url"]).join(meta, "url", "inner")
    return lookup_join(reviews, checked_key(hotels, ["file_name"]), "file_name", "inner")


def first_reviews(df: DataFrame) -> DataFrame:
    """One row per review id: the earliest retrieval, ties by file and token."""
    return dedupe_first(
        df, ["review_id"], [F.asc_nulls_last("retrieval_date"), "file_name", "token", "text"]
    )


def prepare(df: DataFrame) -> DataFrame:
    """Parse the free-form review fields into typed columns."""
    ratings = P.other_ratings("other_ratings")
    hl = F.coalesce(F.col("hl"), F.lit("pt-br")) if "hl" in df.columns else "pt-br"
    return df.withColumns({
        "likes": P.likes("likes"),
        "user_is_local_guide": P.flag_number("user_is_local_guide"),
        "trip_type_travel_group": P.trip_types("trip_type_travel_group"),
        "review_date": P.relative_date("relative_date", "retrieval_date", hl),
        "response_date": P.relative_date("response_relative_date", "retrieval_date", hl),
        **{c: ratings[c] for c in ("rooms", "locale", "service", "highlights")},
        "user_id": P.user_id("user_url"),
    })


def place_report(df: DataFrame) -> DataFrame:
    """Counts, first values, means and coverage per place name.

    A column that the table lacks counts as empty: its counts are 0, its other
    aggregates NULL.
    """
    absent = {c: F.lit(None).cast("double") for c in dict.fromkeys(c for c, _ in PLACE_REPORT.values()) if c not in df.columns}
    per_place = profile.entity_summary(df.withColumns(absent), "name", PLACE_REPORT, ["retrieval_date", "review_id"])
    return profile.coverage(per_place, "n_reviews", "review_id", "text")


def index_table(versions: Mapping[int, DataFrame], min_words: int = 10) -> DataFrame:
    """Newest version per review, long enough texts, under the 22 index names."""
    rows = consolidate(versions, "review_id", ["retrieval_date"])
    rows = rows.withColumns({
        "avaliacao_recente": P.is_recent("review_date"),
        "text_n_words": X.word_count("text"),
        "review_date": P.day_text("review_date"),
    })
    return select_rename(rows.where(F.col("text_n_words") >= min_words), S.INDEX_COLUMNS)


def text_table(df: DataFrame, columns: tuple = ("text", "response_text"), stopwords=None) -> DataFrame:
    """Cleaned, normalised and tokenised text columns, with their sentence counts."""
    for c in columns:
        df = df.withColumn(f"has_{c}", F.col(c).isNotNull()).withColumn(
            c, X.clean(F.coalesce(F.col(c), F.lit("")))
        )
        df = df.withColumn(f"{c}_normalized", X.normalize(c))
        df = df.withColumn(f"{c}_tokens", X.sentence_tokens(f"{c}_normalized", stopwords))
        df = df.withColumn(f"{c}_n_sentences", F.size(f"{c}_tokens"))
    if "highlights" in df.columns:
        df = df.withColumn("highlights", X.joined("highlights"))
        df = df.withColumn("highlights_normalized", X.normalize("highlights"))
        df = df.withColumn(
            "highlights_tokens", F.array(X.tokenize("highlights_normalized", stopwords))
        )
    return df


def hotel_counts(df: DataFrame) -> DataFrame:
    """Reviews, and those with text and with a response, per hotel: one row each."""
    return profile.entity_totals(df, ["name"], {
        "review_count": F.col("review_id").isNotNull().cast("int"),
        "text_count": F.col("has_text").cast("int"),
        "response_text_count": F.col("has_response_text").cast("int"),
    })


def text_report(df: DataFrame, order: tuple = ("review_date", "review_id")) -> DataFrame:
    """Place name, reviews, texts, responses, words and tokens per hotel."""
    return profile.entity_summary(df, "name", TEXT_REPORT, list(order))


def hotel_documents(df: DataFrame, order: tuple = ("review_date", "review_id"), **options) -> DataFrame:
    """All prepared texts and tokens per hotel (see ``entity_document`` for its parts)."""
    texts = {f"{c}_sum": c for c in (
        "text", "text_normalized", "response_text", "response_text_normalized", "highlights",
    ) if c in df.columns}
    tokens = {f"{c}_sum": c for c in (
        "text_tokens", "response_text_tokens", "highlights_tokens",
    ) if c in df.columns}
    docs = profile.entity_document(df, ["name"], order, texts, tokens, **options)
    return docs.withColumns({c: X.space_marks(c) for c in texts})

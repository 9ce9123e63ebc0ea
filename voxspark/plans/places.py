"""The place list: filter exports, enrich with states, merge with the older list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from voxspark import schemas as S
from voxspark.functions import parsers as P
from voxspark.operators.joins import fits_broadcast, lookup_join
from voxspark.operators.ordering import dedupe_first
from voxspark.operators.relational import best_per_key, union_all, with_constants


def operational_places(df: DataFrame, order: Sequence[str], min_reviews: int = 5) -> DataFrame:
    """One open place per name, the one with most reviews.

    The first row per place id is taken before the status is looked at: a place
    whose first row is closed is gone even if a later row is open.
    """
    first = dedupe_first(df, ["place_id"], order)
    open_ = first.where((F.col("business_status") == "OPERATIONAL") & (F.col("reviews") >= min_reviews))
    return best_per_key(open_, ["name"], "reviews", ["place_id"])


def enrich_by_state(df: DataFrame, states: DataFrame, state: str = "state") -> DataFrame:
    """Add sigla, estado, capital, regiao.

    A two-letter state is a code already; longer ones are looked up by their
    upper-case name.
    """
    small = fits_broadcast(states)
    names = states.select(F.col("estado").alias("_name"), F.col("sigla").alias("_sigla"))
    coded = lookup_join(df.withColumn("_name", F.upper(F.col(state))), names, "_name", "left", small=small)
    coded = coded.withColumn("sigla", P.state_code(state, "_sigla")).drop("_name", "_sigla")
    full = states.select("sigla", "estado", "capital", "regiao")
    return lookup_join(coded, full, "sigla", "left", small=small)


def _input_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.PLACE_INPUT.fields])


def new_places(df: DataFrame, states: DataFrame, year: int) -> DataFrame:
    """Place input rows out of filtered exports."""
    rows = enrich_by_state(df.drop("sigla", "estado", "capital", "regiao"), states)
    rows = rows.withColumns({
        "stars": P.stars("range"), "n_reviews_max": F.col("reviews").cast("bigint"),
        "url": F.col("location_link"),
    })
    rows = with_constants(rows, {
        "done": 0, "n_reviews": -1, "sort_by": "newest", "hl": "pt-br", "dt_selection": year,
    })
    if "google_id" not in rows.columns:
        rows = rows.withColumn("google_id", P.feature_id("url"))
    return _input_columns(rows)


def old_places(df: DataFrame, states: DataFrame, year: int) -> DataFrame:
    """Place input rows out of an earlier list, whose state is a code."""
    codes = states.select(F.col("sigla").alias("state"), "sigla", "estado", "capital", "regiao")
    bare = df.drop("region", "sigla", "estado", "capital", "regiao")
    rows = lookup_join(bare, codes, "state", "left")
    rows = with_constants(rows, {
        "city": "", "category": "", "subtypes": "", "sort_by": "newest", "done": 0, "dt_selection": year,
    })
    return _input_columns(rows.withColumn("google_id", P.feature_id("url")))


def merged_places(lists: Sequence[DataFrame]) -> DataFrame:
    """The newest selection per place id over all lists."""
    return best_per_key(union_all(lists), ["google_id"], "dt_selection", ["name", "url"])

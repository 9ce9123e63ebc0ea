"""Projections, filters, set operations and sampling."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from voxspark.functions.text import col
from voxspark.operators.joins import checked_key
from voxspark.operators.ordering import dedupe_first, join_on_keys, top_n_per_group


def select_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns only, under their new names."""
    return df.select(*[F.col(k).alias(v) for k, v in mapping.items()])


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[c for c in df.columns if re.search(pattern, c)])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast where possible; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def text_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """has_<c>: the text is present; <c>_na: it is missing or empty."""
    flags: dict[str, Column] = {}
    for c in columns:
        flags[f"has_{c}"] = F.col(c).isNotNull()
        flags[f"{c}_na"] = F.col(c).isNull() | (F.col(c) == "")
    return df.withColumns(flags)


def best_per_key(
    df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str], ascending: bool = False
) -> DataFrame:
    """The row with the largest (or smallest) value per key, missing values last."""
    first = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return dedupe_first(df, keys, [first, *tie])


def duplicates_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once.

    The keys are counted with a map-side combine and joined back, so the rows of
    a hot key are never gathered; Spark splits its partition of the semi join.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return join_on_keys(df, repeated, keys, "left_semi")


def top_union(
    df: DataFrame, keys: Sequence[str], criteria: Sequence[Sequence[Column | str]], id_col: str
) -> DataFrame:
    """Distinct (keys, id) of the best row per key under each criterion."""
    picks = [
        top_n_per_group(df, keys, [*order, id_col], 1).select(*keys, id_col) for order in criteria
    ]
    return union_all(picks).distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column some frames lack is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def consolidate(
    versions: Mapping[int, DataFrame], key: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Tagged union of versions, the newest row per key."""
    tagged = union_all([df.withColumn("version", F.lit(v)) for v, df in versions.items()])
    return dedupe_first(tagged, [key], [F.desc("version"), *tie])


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the key: the same on every run and layout."""
    mixed = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(mixed, F.col(key)).limit(n)


def argmax(c: Column | str) -> Column:
    """0-based position of the largest array element, the first one on ties."""
    return (F.array_position(col(c), F.array_max(col(c))) - 1).cast("int")


def assemble(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Side-by-side features of one entity, joined on its stable key."""
    return reduce(lambda a, b: a.join(b, key, "full"), [checked_key(f, [key]) for f in frames])


def without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def banded(df: DataFrame, c: str, edges: Sequence[float], name: str = "band") -> DataFrame:
    """Half-open bands between edges, labelled lt<e>, gte<e>; missing stays missing."""
    band = F.when(F.col(c) < edges[0], F.lit(f"lt{edges[0]}"))
    for low, high in zip(edges, edges[1:]):
        band = band.when(F.col(c) < high, F.lit(f"gte{low}_lt{high}"))
    return df.withColumn(name, band.when(F.col(c) >= edges[-1], F.lit(f"gte{edges[-1]}")))

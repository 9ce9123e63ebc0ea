"""Counts, profiles and per-entity aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from voxspark.functions.text import col
from voxspark.operators.joins import fits_broadcast
from voxspark.operators.ordering import (
    exact_percentiles, top_n_per_group, with_running_total,
)
from voxspark.session import settle

PART_BYTES = 16 << 20


def _first_present(c: str, order: Sequence[str]) -> Column:
    """Value of the first row, in the given order, in which ``c`` is present."""
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), by))


_AGGREGATES = {"count": F.count, "sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}


def entity_summary(
    df: DataFrame, key: str, spec: Mapping[str, tuple[str, str]], order: Sequence[str]
) -> DataFrame:
    """One row per entity; ``spec`` maps the new name to (column, aggregate).

    Aggregates are count (of present values), sum, mean, max, min and first (the
    first present value in ``order``). Rows without an entity are left out.
    """
    aggs = [
        (_first_present(c, order) if how == "first" else _AGGREGATES[how](c)).alias(name)
        for name, (c, how) in spec.items()
    ]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def coverage(df: DataFrame, expected: str, found: str, with_text: str) -> DataFrame:
    """Missing reviews and share of reviews with text per entity."""
    return df.withColumns({
        "n_reviews_diff": F.col(expected) - F.col(found),
        "text_percentage": F.try_divide(F.col(with_text), F.col(found)),
    })


def coverage_totals(df: DataFrame, found: str, with_text: str) -> DataFrame:
    return df.agg(
        F.avg("text_percentage").alias("text_percentage"),
        F.sum(with_text).alias(with_text),
        F.sum(found).alias(found),
    )


def value_counts(df: DataFrame, columns: Sequence[str], dropna: bool = True) -> DataFrame:
    """Rows per value combination, most frequent first."""
    if dropna:
        df = df.na.drop("any", subset=list(columns))
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *columns)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of every column: (column_name, value, n, rank)."""
    columns = list(columns or df.columns)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    )
    counts = (
        long.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_n_per_group(counts, ["column_name"], [F.desc("n"), "value"], k, rank="rank")


def pivot_count(df: DataFrame, row: str, column: str, values: Sequence, c: str) -> DataFrame:
    """Count of present ``c`` per row and column value, 0 where there is none.

    With the column values given, the pivot needs no extra job.
    """
    return df.groupBy(row).pivot(column, list(values)).agg(F.count(c)).na.fill(0)


def group_median(df: DataFrame, key: str, columns: Sequence[str], limit: int = 1_000_000) -> DataFrame:
    """Exact median of numeric columns per group, one column each."""
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [key], list(columns), "_column", "_value"
    )
    medians = exact_percentiles(
        long.where(F.col(key).isNotNull()), [key, "_column"], "_value", [0.5], limit
    )
    return medians.groupBy(key).agg(
        *[F.max(F.when(F.col("_column") == c, F.col("percentile"))).alias(c) for c in columns]
    )


def ranked_entities(counts: DataFrame, key: str, n: int = 100, count: str = "count_") -> DataFrame:
    """The ``n`` entities with most present values, largest first, ties by key."""
    return counts.orderBy(F.desc(count), key).limit(n)


def entity_counts(
    df: DataFrame, key: str, c: str, min_count: int = 10, big: int = 1000
) -> DataFrame:
    """Present values per entity, entities below ``min_count`` left out, big ones flagged."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(c).alias("count_"))
        .where(F.col("count_") >= min_count)
        .withColumn("big", F.col("count_") >= big)
    )


def entity_totals(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    """(keys, n_rows, counts): one row per entity, combined before the shuffle."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(v), F.lit(0)).alias(n) for n, v in counts.items()]
    )


def entity_document(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], texts: Mapping[str, str],
    tokens: Mapping[str, str] | None = None, sep: str = "\n", part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(keys, part, n_rows, texts, tokens): the ordered document of every entity.

    All texts (joined) and token lists (concatenated), in order. A row belongs to
    the part in whose ``part_bytes`` bytes of the entity's texts it begins, so a
    part never holds more than the budget and one row. The same rule holds for
    every entity; nothing is cut, and the parts in order are the document. Part
    numbers rise from 0 and skip what a longer row covers. ``order`` must
    identify a row within the entity.
    """
    keys, order, tokens = list(keys), list(order), dict(tokens or {})
    used = [*dict.fromkeys([*order, *texts.values(), *tokens.values()])]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in dict.fromkeys(texts.values())), F.lit(0)).cast("bigint")
    # sizes alone are sorted and written; the texts meet their part by key and order, and move once more to be joined
    sizes = df.select(*keys, *order, size.alias("_size"))
    begins = with_running_total(sizes, keys, order, F.col("_size"), "_upto").select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate([*keys, *order])], F.floor((F.col("_upto") - F.col("_size")) / part_bytes).alias("part"))
    # rows that an order does not tell apart begin together
    parts = settle(begins.groupBy(*begins.columns[:-1]).agg(F.min("part").alias("part")))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*keys, *order])])
    pieces = df.select(*keys, *used).join(F.broadcast(parts) if fits_broadcast(parts) else parts, same)
    row = F.struct(
        *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
        *[F.col(c).alias(f"x_{n}") for n, c in {**texts, **tokens}.items()],
    )
    grouped = pieces.groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(row)).alias("_rows"), F.count(F.lit(1)).alias("n_rows"),
    )
    return grouped.select(
        *keys, "part", "n_rows",
        *[F.array_join(F.col(f"_rows.x_{n}"), sep).alias(n) for n in texts],
        *[F.flatten(F.col(f"_rows.x_{n}")).alias(n) for n in tokens],
    )


def macro_average(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Mean over entities of numerator / denominator."""
    return df.agg(
        *[F.avg(F.try_divide(F.col(a), F.col(b))).alias(n) for n, (a, b) in ratios.items()]
    )


def histogram(df: DataFrame, c: str, edges: Sequence[float]) -> DataFrame:
    """Rows per bin, empty bins included; the last bin is closed, values outside are left out."""
    last = len(edges) - 2
    slot = F.when((F.col(c) >= edges[last]) & (F.col(c) <= edges[last + 1]), last)
    for i in range(last):
        slot = slot.when((F.col(c) >= edges[i]) & (F.col(c) < edges[i + 1]), i)
    per_bin = [F.count_if(slot == i) for i in range(last + 1)]
    bins = F.array(*[
        F.struct(
            F.lit(float(edges[i])).alias("low"), F.lit(float(edges[i + 1])).alias("high"),
            per_bin[i].alias("n"),
        )
        for i in range(last + 1)
    ])
    return df.agg(bins.alias("_bins")).select(F.inline("_bins"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per numeric column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_percentiles(long, ["column_name"], "value", [0.25, 0.5, 0.75])
    wide = quartiles.groupBy("column_name").agg(*[
        F.max(F.when(F.col("fraction") == f, F.col("percentile"))).alias(n)
        for f, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    return moments.join(wide, "column_name", "left")


def corpus_stats(df: DataFrame, entity: str, text: str, sentence_tokens: str) -> DataFrame:
    """Entities, non-empty texts, their sentences (empty ones included), and all tokens."""
    present = F.col(text).isNotNull() & (F.col(text) != "")
    return df.agg(
        F.countDistinct(entity).alias("n_entities"),
        F.count_if(present).alias("n_texts"),
        F.sum(F.when(present, F.size(sentence_tokens))).cast("bigint").alias("n_sentences"),
        F.sum(F.aggregate(
            F.transform(F.col(sentence_tokens), lambda s: F.size(s)), F.lit(0), lambda a, b: a + b
        )).cast("bigint").alias("n_tokens"),
    )


def run_summary(
    reviews: DataFrame, meta: DataFrame, inputs: DataFrame, key: str, errors: Column | str
) -> DataFrame:
    """Expected, asked-for and collected reviews and errors per place.

    ``inputs`` carries (key, n_reviews); ``meta`` (key, place_name, n_reviews).
    Reviews are counted per place before the joins.
    """
    done = reviews.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_scraped"), F.sum(col(errors)).cast("bigint").alias("n_errors")
    )
    return (
        inputs.select(key, F.col("n_reviews").alias("n_input"))
        .join(meta.select(key, "place_name", F.col("n_reviews").alias("n_max")), key, "left")
        .join(done, key, "left")
        .na.fill(0, ["n_scraped", "n_errors"])
    )

"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from voxspark.operators.ordering import row_salt
from voxspark.session import settle

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 64
SALTS = 64
#: Joins whose result holds no dimension row that did not match.
SALTED = ("inner", "left", "left_outer", "leftouter", "left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti")


def _width(field: T.StructField) -> Column:
    """Bytes a value takes, roughly and rather too many than too few."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 64
    return F.lit(16)


def fits_broadcast(
    dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measured check of rows and bytes; stops reading beyond ``max_rows``."""
    width = reduce(lambda a, b: a + b, [_width(f) for f in dim.schema.fields])
    size = dim.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).head()
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE, counts: DataFrame | None = None,
    n: str = "_n",
) -> list[tuple]:
    """Keys holding more than 1/share of the rows; there are fewer than ``share``.

    ``counts`` may bring (keys, n) where it exists already, so that the rows
    need not be read for it.
    """
    if counts is None:
        # one row per key, written so that the rows are read once
        counts = settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)))
    biggest = counts.orderBy(F.desc(n)).limit(share).collect()
    if not biggest:
        return []
    total = counts.agg(F.sum(n)).head()[0]
    return [tuple(r[k] for k in keys) for r in biggest if r[n] * share > total]


def salted_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", salts: int = SALTS,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Shuffle join in which the hot keys of ``fact`` are spread over ``salts`` parts.

    Only the dimension rows of hot keys are repeated, so the right side grows by
    less than HOT_SHARE * salts rows. Joins that keep unmatched rows of the
    dimension are refused: each copy would come out.
    """
    if how not in SALTED:
        raise ValueError(f"a salted join cannot be {how}")
    on = list(on)
    hot = [k for k in (hot_keys(fact, on) if hot is None else hot) if None not in k]
    if not hot:
        return fact.join(dim, on, how)
    types = [fact.schema[k].dataType for k in on]
    is_hot = F.coalesce(
        reduce(or_, [
            reduce(and_, [F.col(k) == F.lit(v).cast(t) for k, v, t in zip(on, key, types)])
            for key in hot
        ]),
        F.lit(False),
    )
    left = fact.withColumn("_salt", F.when(is_hot, row_salt(fact, salts)).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    right = dim.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
    max_rows: int = BROADCAST_ROWS, small: bool | None = None,
) -> DataFrame:
    """Join a table of unique keys to a large one.

    Broadcast when the dimension's measured size is within bounds, otherwise a
    salted shuffle join. ``small`` brings a measurement made before. A right or
    full join is a plain shuffle join.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in SALTED:
        return fact.join(dim, on, how)
    if fits_broadcast(dim, max_rows) if small is None else small:
        return fact.join(F.broadcast(dim), on, how)
    return salted_join(fact, dim, on, how)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def checked_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with a check in its plan: reading it fails if ``keys`` do not identify its rows.

    The rows are combined by key, which a join on these keys needs anyway, so
    nothing is computed or shuffled twice.
    """
    keys, rest = list(keys), [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest) if rest else F.lit(1)).alias("_row"))
    message = F.concat(F.lit(f"{keys} is not unique: "), F.to_json(F.struct(*keys)))
    whole = one.where(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return whole.select(*[f"_row.{c}" if c in rest else c for c in df.columns])


def unique_join(a: DataFrame, b: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """One-to-one join; reading it fails when either side repeats a key."""
    return checked_key(a, [on]).join(checked_key(b, [on]), on, how)


def contains_all(df: DataFrame, other: DataFrame, on: str) -> bool:
    """Does every ``on`` value of ``df`` occur in ``other``?"""
    return keep_not_in(df, other, on).isEmpty()


def _keys_of(other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Each key once, combined before the shuffle: a repeated key sends one row per task."""
    return other.select(*([on] if isinstance(on, str) else on)).distinct()


def keep_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(_keys_of(other, on), on, "left_semi")


def keep_not_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(_keys_of(other, on), on, "left_anti")

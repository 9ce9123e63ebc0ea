"""Order-dependent work that never puts a whole hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from voxspark.functions.text import col
from voxspark.session import settle

Keys = Sequence[str]
# Spark's default limit for cutting groups before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
EARLY_CUT = 1000


def _rank(partition: list, order: list) -> Column:
    return F.row_number().over(W.partitionBy(*partition).orderBy(*order))


def row_salt(df: DataFrame, salts: int) -> Column:
    """Salt from the row's own plain values.

    A salt must not depend on row order: a map task that runs again after a lost
    executor has to send every row to the same place as before.
    """
    plain = [
        f.name for f in df.schema.fields
        if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))
    ]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(salts)).cast("int")


def top_n_per_group(
    df: DataFrame, keys: Keys, order: Sequence[Column | str], n: int, rank: str | None = None,
    salts: int | None = None,
) -> DataFrame:
    """First ``n`` rows per key; ``order`` must end in a unique column.

    Spark cuts every input partition to ``n`` rows per key before the shuffle,
    so a hot key sends at most ``n`` rows per map task. For larger ``n`` that is
    still a lot for one reducer, so a salted round cuts it down once more. Beyond
    ``EARLY_CUT`` Spark makes no early cut, and rows are numbered over range
    partitions instead.
    """
    if n > EARLY_CUT:
        numbered = with_row_number(df, keys, order, "_rank").where(F.col("_rank") <= n)
        return (
            numbered.withColumn("_rank", F.col("_rank").cast("int")).withColumnRenamed("_rank", rank)
            if rank else numbered.drop("_rank")
        )
    if salts is None:
        salts = 1 if n <= 32 else 32
    order = [col(o) for o in order]
    keys = [F.col(k) for k in keys]
    if salts > 1:
        salted = df.withColumn("_salt", row_salt(df, salts))
        df = (
            salted.withColumn("_rank", _rank([*keys, F.col("_salt")], order))
            .where(F.col("_rank") <= n)
            .drop("_rank", "_salt")
        )
    out = df.withColumn("_rank", _rank(keys, order)).where(F.col("_rank") <= n)
    return out.withColumnRenamed("_rank", rank) if rank else out.drop("_rank")


def dedupe_first(df: DataFrame, keys: Keys, order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order. Missing keys form one group."""
    return top_n_per_group(df, keys, order, 1)


def join_on_keys(df: DataFrame, grouped: DataFrame, keys: Keys, how: str) -> DataFrame:
    """Semi or anti join with a grouped result in which missing keys match too."""
    renamed = grouped.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(renamed, on, how)


def split_by_size(
    df: DataFrame, keys: Keys, limit: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of keys with at most ``limit`` rows, rows of larger keys or None).

    Counting reads the key columns only and combines before the shuffle. The
    common case without a large key costs that one count and no join.
    """
    large = settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit))
    if large.isEmpty():
        return df, None
    return join_on_keys(df, large, keys, "left_anti"), join_on_keys(df, large, keys, "left_semi")


def _starts(sums: DataFrame, keys: list[str], *carry: str) -> DataFrame:
    """Per key and partition: the sum of ``_sum`` over the key's earlier partitions."""
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), *carry,
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
    )


def _with_starts(ranged: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return ranged.join(starts, on, "left").drop("_p", *[f"_k{i}" for i in range(len(keys))])


def with_row_number(
    df: DataFrame, keys: Keys, order: Sequence[Column | str], number: str = "row_number"
) -> DataFrame:
    """1-based position of a row within its key; without keys within the table.

    Rows are range-partitioned and sorted by key and order, so a hot key spreads
    over many partitions, and written with their position in the partition. One
    small row per key and partition then tells where each partition starts. These
    rows are joined back: by broadcast while they are few, else by a shuffle.
    Without keys their sums are one window over a row per partition. ``order`` must be unique per key.
    """
    keys = list(keys)
    by = [*[F.col(k) for k in keys], *[col(o) for o in order]]
    ranged = settle(
        df.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    sums = ranged.groupBy(*keys, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_sum")
    )
    return (
        _with_starts(ranged, _starts(sums, keys, "_first"), keys)
        .withColumn(number, F.col("_at") - F.col("_first") + F.col("_start") + 1)
        .drop("_part", "_at", "_first", "_start")
    )


def with_running_total(
    df: DataFrame, keys: Keys, order: Sequence[Column | str], weight: Column, total: str
) -> DataFrame:
    """Running total of ``weight`` per key, over range partitions like the row number.

    Each piece of a key in a partition is added up on its own.
    """
    keys = list(keys)
    order = [col(o) for o in order]
    ranged = settle(
        df.withColumn("_w", weight)
        .repartitionByRange(*[F.col(k) for k in keys], *order)
        .withColumn("_part", F.spark_partition_id())
    )
    sums = ranged.groupBy(*keys, "_part").agg(F.sum("_w").alias("_sum"))
    within = (
        W.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    local = ranged.withColumn("_local", F.sum("_w").over(within))
    return (
        _with_starts(local, _starts(sums, keys), keys)
        .withColumn(total, F.col("_local") + F.col("_start"))
        .drop("_w", "_part", "_start", "_local")
    )


def exact_percentiles(
    df: DataFrame, keys: Keys, value: str, fractions: Sequence[float], limit: int = 1_000_000
) -> DataFrame:
    """Interpolated percentiles per key, one row (keys, fraction, percentile) each.

    Keys with up to ``limit`` rows use the built-in exact percentile, which holds
    a key's distinct values in one task. For larger ones equal values are counted
    first and the counts are ranked over range partitions.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    rows = rows.where(~F.isnan("_v"))
    fr = F.array(*[F.lit(float(f)) for f in fractions])
    small, large = split_by_size(rows, keys, limit)
    out = (
        small.groupBy(*keys)
        .agg(F.percentile("_v", fr).alias("_ps"))
        .select(*keys, F.explode(F.arrays_zip(fr.alias("f"), F.col("_ps").alias("p"))).alias("_z"))
        .select(*keys, F.col("_z.f").alias("fraction"), F.col("_z.p").alias("percentile"))
    )
    if large is None:
        return out
    large = large.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = with_running_total(large, keys, ["_v"], F.col("_n"), "_upto")
    sizes = upto.groupBy(*keys).agg(F.max("_upto").alias("_size"))
    wanted = (
        sizes.withColumn("fraction", F.explode(fr))
        .withColumn("_at", F.col("fraction") * (F.col("_size") - 1))
        .select(
            *keys, "fraction", "_at",
            F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_pos"),
        )
    )
    # a value covers the 0-based positions [_upto - _n, _upto)
    hits = upto.join(wanted, keys).where(
        (F.col("_pos") >= F.col("_upto") - F.col("_n")) & (F.col("_pos") < F.col("_upto"))
    )
    low, high = F.min("_v"), F.max("_v")
    interpolated = hits.groupBy(*keys, "fraction").agg(
        (low + (high - low) * (F.first("_at") - F.floor(F.first("_at")))).alias("percentile")
    )
    return out.unionByName(interpolated)

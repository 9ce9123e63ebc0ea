"""Cluster representatives per entity."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from voxspark.operators.joins import keep_in, lookup_join
from voxspark.operators.ordering import dedupe_first, split_by_size, top_n_per_group
from voxspark.operators.summaries import joined_in_order
from voxspark.operators.vectors import squared_l2
from voxspark.session import settle

GROUP_ROWS = 100_000


def cluster_representatives(
    df: DataFrame, key: str, id: str, features: Sequence[str], k: int = 5, max_iter: int = 300,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(key, cluster, id, distance): the row nearest to each of ``k`` centres per entity.

    Lloyd's algorithm with a deterministic start: the first centre is the row
    with the smallest id, each further one the row farthest from those chosen.
    Rows with a missing feature are left out; fewer distinct rows than ``k`` give
    fewer clusters. Entities with up to ``group_rows`` rows are clustered in one
    task each; larger ones by joint rounds of assignment and combined sums.
    """
    data = df.where(F.col(key).isNotNull()).na.drop("any", subset=list(features)).select(
        key, id, F.array(*[F.col(f).cast("double") for f in features]).alias("_f")
    )
    small, large = split_by_size(data, [key], group_rows)
    out = T.StructType([
        df.schema[key], T.StructField("cluster", T.IntegerType()), df.schema[id],
        T.StructField("distance", T.DoubleType()),
    ])
    result = small.groupBy(key).applyInPandas(_cluster_group(key, id, k, max_iter), out)
    if large is not None:
        result = result.unionByName(_cluster_rounds(settle(large), key, id, k, max_iter))
    return result


def _cluster_group(key: str, id: str, k: int, max_iter: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(id).reset_index(drop=True)
        x = np.stack(pdf["_f"].to_numpy())
        centres = [x[0]]
        gap = ((x - x[0]) ** 2).sum(axis=1)
        while len(centres) < k and gap.max() > 0:
            centres.append(x[int(gap.argmax())])
            gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(axis=1))
        c = np.stack(centres)
        label = None
        for _ in range(max_iter):
            cost = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
            new = cost.argmin(axis=1)
            if label is not None and (new == label).all():
                break
            label = new
            c = np.stack([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
        cost = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        label = cost.argmin(axis=1)
        rows = []
        for j in range(len(c)):
            mine = np.flatnonzero(label == j)
            if len(mine):
                best = mine[int(np.argmin(cost[mine, j]))]
                rows.append((pdf[key].iloc[0], j, pdf[id].iloc[best], float(cost[best, j])))
        return pd.DataFrame(rows, columns=[key, "cluster", id, "distance"])

    return run


def _nearest(data: DataFrame, centres: DataFrame, key: str) -> DataFrame:
    """Add ``_j`` and ``_cost``: the nearest centre of the row's entity."""
    joined = lookup_join(data, centres, key, "inner")
    costs = F.transform(F.col("_c"), lambda c: squared_l2(F.col("_f"), c))
    return (
        joined.withColumn("_costs", costs)
        .withColumn("_cost", F.array_min("_costs"))
        .withColumn("_j", (F.array_position("_costs", F.col("_cost")) - 1).cast("int"))
        .drop("_costs")
    )


def _cluster_rounds(data: DataFrame, key: str, id: str, k: int, max_iter: int) -> DataFrame:
    """Clusters of entities too large for one task; ``data`` is settled."""
    centres = settle(
        dedupe_first(data, [key], [id]).select(key, F.array("_f").alias("_c"))
    )
    for _ in range(k - 1):
        far = dedupe_first(_nearest(data, centres, key), [key], [F.desc("_cost"), id])
        grown = F.when(F.col("_cost") > 0, F.concat("_c", F.array("_f"))).otherwise(F.col("_c"))
        centres = settle(far.select(key, grown.alias("_c")))
    for _ in range(max_iter):
        assigned = _nearest(data, centres, key)
        sums = (
            assigned.select(key, "_j", F.posexplode("_f").alias("_i", "_x"))
            .groupBy(key, "_j", "_i")
            .agg(F.avg("_x").alias("_m"))
            .groupBy(key, "_j")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias("_v"))
            .groupBy(key)
            .agg(F.map_from_entries(F.collect_list(F.struct("_j", "_v"))).alias("_new"))
        )
        moved = settle(centres.join(sums, key).select(
            key,
            F.col("_c").alias("_old"),
            F.transform("_c", lambda c, j: F.coalesce(F.try_element_at("_new", j), c)).alias("_c"),
        ))
        centres = moved.drop("_old")
        if moved.where(F.col("_c") != F.col("_old")).isEmpty():
            break
    final = _nearest(data, centres, key)
    return top_n_per_group(final, [key, "_j"], ["_cost", id], 1).select(
        key, F.col("_j").alias("cluster"), id, F.col("_cost").alias("distance")
    )


def cluster_summary(
    df: DataFrame, key: str, id: str, text: str, representatives: DataFrame
) -> DataFrame:
    """Texts of an entity's representatives in id order, joined by newline."""
    picked = keep_in(df.select(key, id, text), representatives.select(key, id), [key, id])
    return joined_in_order(picked, key, [id], text)

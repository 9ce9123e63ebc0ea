"""Connected components of links that may number as many as the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voxspark.session import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: each linked node and the smallest node it can reach.

    Alternating large and small stars: nodes are tied to the smallest neighbour
    until only stars are left, which takes a logarithmic number of rounds. Each
    round is written to the shared folder, so that lineage stays short; only a
    flag comes back to the driver. Loops and repeated links do no harm; no links
    give no rows.
    """
    up = settle(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    while not _stars(up):
        both = up.union(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        up = settle(small.union(low.select("u", F.col("m").alias("v"))).distinct())
    tops = up.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return up.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)


def _stars(up: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has one itself."""
    ends = up.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        up.select(F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    odd = ends.groupBy("n").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return odd.where("child > 1 OR (child > 0 AND parent > 0)").isEmpty()

"""Near-duplicate vectors within a label, by counting collisions on projections.

Every vector is projected on ``LINES`` random directions. Two vectors collide on
a direction if one lies in a window around the other. For a pair at the
threshold each direction is a coin of known bias, so the number of collisions is
binomial; pairs with at least the count that a pair at the threshold fails to
reach with a chance of ``MISS`` are verified by their cosine.

Vectors of a label are sorted by their first projection into blocks of bounded
size, and pairs of blocks are compared in tasks of their own, each against its
sorted projections. Block pairs whose value ranges cannot collide often enough,
or that lie further apart on a direction than a link can, are left out before.
A task returns link counts and a spanning forest, never all pairs. Equal vectors
are one class with a multiplicity.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from voxspark.llm.graph import components
from voxspark.session import settle

LINES, MISS, BLOCK = 64, 1e-7, 2048
#: Half the window, in standard deviations of a pair at the threshold.
REACH = 1.0


def directions(dim: int) -> np.ndarray:
    """Unit directions, the same for all vectors of a dimension."""
    d = np.random.default_rng(dim).normal(size=(dim, LINES))
    return d / np.linalg.norm(d, axis=0)


def _collision_chance(dim: int, distance: float, window: float) -> float:
    """That a random unit direction brings two points at ``distance`` within the window."""
    if dim == 2:  # the density has no bound at its ends
        return 2 / math.pi * math.asin(min(window / distance, 1)) if distance else 1.0
    u = np.linspace(-1, 1, 20001)
    weight = np.maximum(1 - u * u, 0) ** max((dim - 3) / 2, 0) if dim > 1 else np.where(np.abs(u) == 1, 1.0, 0.0)
    return float(weight[np.abs(u) * distance <= window].sum() / weight.sum())


def calibrated(dim: int, cosine: float) -> tuple[float, float, int]:
    """Largest distance of a link, half window, and least number of collisions."""
    distance = math.sqrt(max(2 - 2 * cosine, 0))
    window = REACH * distance / math.sqrt(dim)
    p = _collision_chance(dim, distance, window)
    below, least = 0.0, 0
    while least < LINES:
        below += math.comb(LINES, least) * p**least * (1 - p) ** (LINES - least)
        if below > MISS:
            break
        least += 1
    return distance + 1e-9, window + 1e-9, least


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _with_first_projection(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            first = [
                float(np.asarray(v, np.float64) @ directions(len(v))[:, 0] / np.linalg.norm(v)) for v in batch.column("vector").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.float64())], names=[*batch.schema.names, "first"])

    return classes.mapInArrow(run, "label string, node long, many long, dim int, vector array<double>, first double")


def _blocks(classes: DataFrame) -> DataFrame:
    """block, label, dim, nodes, many, units (packed doubles), low and high of each projection."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        key, held = None, []

        def out():
            nonlocal number, held
            v = np.array([x[2] for x in held])
            unit = v / np.linalg.norm(v, axis=1)[:, None]
            lines = unit @ directions(key[1])
            row = [number, *key, np.array([x[0] for x in held], np.int64).tobytes(), np.array([x[1] for x in held], np.int64).tobytes(),
                   unit.tobytes(), lines.min(axis=0).tolist(), lines.max(axis=0).tolist()]
            number, held = number + 1, []
            doubles = pa.list_(pa.float64())
            kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.binary()] * 3, doubles, doubles]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["block", "label", "dim", "nodes", "many", "units", "low", "high"])

        for batch in batches:
            for label, node, many, dim, vector in zip(*(batch.column(c).to_pylist() for c in ("label", "node", "many", "dim", "vector"))):
                if held and (key != (label, dim) or len(held) == BLOCK):
                    yield out()
                key = (label, dim)
                held.append((node, many, vector))
        if held:
            yield out()

    sorted_ = _with_first_projection(classes).repartitionByRange("label", "dim", "first").sortWithinPartitions("label", "dim", "first")
    return sorted_.mapInArrow(
        run, "block long, label string, dim int, nodes binary, many binary, units binary, low array<double>, high array<double>")


def block_links(units_a, units_b, same: bool, dim: int, cosine: float):
    """Index pairs (i, j) with a cosine of at least ``cosine``, each unordered pair once if ``same``."""
    _, window, least = calibrated(dim, cosine)
    d = directions(dim)
    lines_a, lines_b = units_a @ d, units_b @ d
    order = np.argsort(lines_b, axis=0, kind="stable")
    ranked = np.take_along_axis(lines_b, order, axis=0)
    lo = np.stack([np.searchsorted(ranked[:, p], lines_a[:, p] - window) for p in range(LINES)], axis=1)
    hi = np.stack([np.searchsorted(ranked[:, p], lines_a[:, p] + window, side="right") for p in range(LINES)], axis=1)
    columns = [np.ascontiguousarray(order[:, p]) for p in range(LINES)]
    n = len(units_b)
    for i in range(len(units_a)):
        hits = np.bincount(np.concatenate([c[a:b] for c, a, b in zip(columns, lo[i].tolist(), hi[i].tolist())]), minlength=n)
        near = np.flatnonzero(hits >= least)
        near = near[near > i] if same else near
        if len(near):
            near = near[units_b[near] @ units_a[i] >= cosine]
            if len(near):
                yield i, near


def _compare(pairs: DataFrame, cosine: float) -> DataFrame:
    """kind 'n': node a has b more links; kind 'e': nodes a and b are connected."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                dim, same = row["dim"], row["block_a"] == row["block_b"]
                (na, ma, ua), (nb, mb, ub) = (
                    (np.frombuffer(row[f"nodes_{s}"], np.int64), np.frombuffer(row[f"many_{s}"], np.int64), np.frombuffer(row[f"units_{s}"]).reshape(-1, dim))
                    for s in "ab")
                count_a, count_b = np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64)
                # a forest over both blocks: an edge only where it joins two trees
                tree = np.arange(len(na) + (0 if same else len(nb)))
                shift, edges = 0 if same else len(na), []

                def root(x):
                    while tree[x] != x:
                        tree[x] = tree[tree[x]]
                        x = tree[x]
                    return x

                for i, near in block_links(ua, ub, same, dim, cosine):
                    count_a[i] += mb[near].sum()
                    count_b[near] += ma[i]
                    for j in near.tolist():
                        x, y = root(i), root(j + shift)
                        if x != y:
                            tree[x] = y
                            edges.append((int(na[i]), int(nb[j])))
                if same:
                    count_a += count_b
                    rows = [("n", int(k), int(c)) for k, c in zip(na, count_a) if c]
                else:
                    rows = [("n", int(k), int(c)) for k, c in [*zip(na, count_a), *zip(nb, count_b)] if c]
                rows += [("e", a, b) for a, b in edges]
                kind, a, b = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"])

    return pairs.mapInArrow(run, "kind string, a long, b long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null, their lengths agree and
    their cosine in double precision reaches ``cosine``. A vector that is null,
    empty, zero or has a null or non-finite component, and one with a null label
    or id, links with nothing and is its own component. Rows with equal vectors
    and labels link with each other, whatever their ids; classes that share their
    smallest id are one node. Other columns are not read; an empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("ok", _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    classes = settle(rows.where("ok").groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").alias("many")).select(
        "label", "node", "many", F.size("vector").alias("dim"), "vector"))
    blocks = settle(_blocks(classes))
    sides = {s: blocks.select(*(F.col(c).alias(f"{c}_{s}") for c in blocks.columns)) for s in "ab"}
    facts = {s: sides[s].drop(*(f"{c}_{s}" for c in ("nodes", "many", "units"))) for s in "ab"}
    pairs = facts["a"].join(facts["b"], (F.col("label_a") == F.col("label_b")) & (F.col("dim_a") == F.col("dim_b")) & (F.col("block_a") <= F.col("block_b")))
    limits = {r[0]: calibrated(r[0], cosine) for r in blocks.select("dim").distinct().collect()}
    gap = F.zip_with(
        F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y))
    may = F.lit(False)
    for dim, (distance, window, least) in limits.items():
        can = (F.array_max(gap) <= distance) & (F.aggregate(gap, F.lit(0), _within(window)) >= least)
        may = may | ((F.col("dim_a") == dim) & can)
    pairs = settle(pairs.where(may).select("block_a", "block_b", F.col("dim_a").alias("dim")))
    data = {s: sides[s].select(f"block_{s}", f"nodes_{s}", f"many_{s}", f"units_{s}") for s in "ab"}
    joined = pairs.join(data["a"], "block_a").join(data["b"], "block_b")
    found = settle(_compare(joined.repartition(joined.sparkSession.sparkContext.defaultParallelism * 4, F.xxhash64("block_a", "block_b")), cosine))
    counts = found.where("kind = 'n'").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    parts = components(found.where("kind = 'e'"))
    named = classes.select("label", "vector", "node", "many").join(counts, "node", "left").join(parts, "node", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"), F.coalesce("component", "node").alias("component"))
    good = rows.where("ok").join(named, ["label", "vector"]).select("id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.union(alone).withColumn("kept", F.col("id").isNull() | (F.col("id") == F.col("component_id")))


def _within(window: float):
    return lambda n, g: n + F.when(g <= window, 1).otherwise(0)

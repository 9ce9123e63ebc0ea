"""Exact top-k by inner product with vector-approximation files.

Rows are written in blocks that hold two things: the exact integer vectors, and
an approximation with ``BITS`` bits per component, which says in which cell of
the block's value range a component lies. A task meets a block of rows with a
block of queries. It first scans the cells only, for a lower and an upper bound
of each score; then it reads exact vectors in the order of their upper bounds
until no bound left reaches the k-th best score, so the result is certain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxspark.session import settle

BITS, BLOCK, QUERIES, CHUNK = 4, 4096, 512, 64


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale))


def approximate(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each component, lowest value and cell width of each dimension."""
    low = exact.min(axis=0)
    width = (exact.max(axis=0) - low) // (1 << BITS) + 1
    return ((exact - low) // width).astype(np.uint8), low, width


def bounds(cells: np.ndarray, low: np.ndarray, width: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that each row (column) can have with each query (row)."""
    least = (low + cells * width).astype(np.float64)
    most = least + (width - 1)
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    slack = 1e-9 * (np.abs(queries).astype(np.float64) @ np.maximum(np.abs(least), np.abs(most)).max(axis=0))[:, None]
    return up @ least.T + down @ most.T - slack, up @ most.T + down @ least.T + slack


def certain_top(exact: np.ndarray, ids: np.ndarray, query: np.ndarray, lowest: np.ndarray, highest: np.ndarray, k: int):
    """(score, id) of the k best rows, ties to the smaller id; rows with a highest bound of -inf take no part."""
    rows = np.flatnonzero(highest > -np.inf)
    if not len(rows):
        return []
    floor = np.partition(lowest[rows], len(rows) - k)[len(rows) - k] if len(rows) > k else -np.inf
    rows = rows[highest[rows] >= floor]
    rows = rows[np.argsort(-highest[rows], kind="stable")]
    best: list[tuple[int, int]] = []
    for at in range(0, len(rows), CHUNK):
        if len(best) == k and highest[rows[at]] < -best[-1][0]:
            break
        part = rows[at : at + CHUNK]
        best = sorted([*best, *zip((-(exact[part] @ query)).tolist(), ids[part].tolist())])[:k]
    return [(-s, i) for s, i in best]


def _packed(rows: DataFrame, size: int, approximations: bool) -> DataFrame:
    """block, dim, ids and exact vectors in packed rows of at most ``size`` vectors, with their approximation if wanted."""

    def run(batches):
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, {}

        def out(dim):
            nonlocal number
            ids, own, values = zip(*held.pop(dim))
            exact = np.array(values, np.int64).reshape(len(ids), dim)
            cols = [number, dim, np.array(ids, np.int64).tobytes(), np.array(own, np.int64).tobytes(), exact.tobytes()]
            if approximations:
                cells, low, width = approximate(exact)
                cols += [cells.tobytes(), low.tobytes(), width.tobytes()]
            number += 1
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * (len(cols) - 2)]
            names = ["block", "dim", "ids", "own", "exact", "cells", "low", "width"]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds)], names[: len(cols)])

        for batch in batches:
            for i, o, v in zip(*(batch.column(c).to_pylist() for c in ("id", "own", "v"))):
                rows_ = held.setdefault(len(v), [])
                rows_.append((i, o, v))
                if len(rows_) == size:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    more = ", cells binary, low binary, width binary" if approximations else ""
    return rows.where(F.size("v") > 0).select("id", "own", "v").mapInArrow(run, "block long, dim int, ids binary, own binary, exact binary" + more)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), id, score: the k rows with the highest inner product.

    Both tables hold id (long) and v (array of whole numbers). Rows that share a
    query's id are its own and take no part for it; ties go to the smaller id.
    Equal ids among the queries are one query each. Only vectors of equal
    length meet. Null ids and null vectors take no part; a query without any
    candidate has no row, and empty tables give no rows.
    """
    spark = rows.sparkSession
    valid = "id IS NOT NULL AND v IS NOT NULL"
    asked = settle(queries.where(valid).select("id", "v").withColumn("query", F.monotonically_increasing_id()))
    names = asked.select("query", F.col("id").alias("query_id"))
    files = settle(_packed(rows.where(valid).select("id", F.col("id").alias("own"), "v"), BLOCK, True).drop("own"))
    numbered = asked.select(F.col("query").alias("id"), F.col("id").alias("own"), "v").repartition(asked.count() // QUERIES + 1)
    lots = settle(_packed(numbered, QUERIES, False).select(
        F.col("block").alias("lot"), "dim", F.col("ids").alias("queries"), "own", F.col("exact").alias("wanted")))
    # the stated query set against all rows, as pairs of block numbers
    meet = files.select("block", "dim").join(lots.select("lot", "dim"), "dim")
    joined = meet.join(lots.drop("dim"), "lot").join(files.drop("dim"), "block")

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                dim = r["dim"]
                asked_, ids, own = (np.frombuffer(r[c], np.int64) for c in ("queries", "ids", "own"))
                vectors, exact = np.frombuffer(r["wanted"], np.int64).reshape(-1, dim), np.frombuffer(r["exact"], np.int64).reshape(-1, dim)
                lowest, highest = bounds(
                    np.frombuffer(r["cells"], np.uint8).reshape(-1, dim), np.frombuffer(r["low"], np.int64), np.frombuffer(r["width"], np.int64), vectors)
                same = own[:, None] == ids[None, :]
                lowest[same] = highest[same] = -np.inf
                got = [(int(q), i, s) for q, v, lo, hi in zip(asked_, vectors, lowest, highest) for s, i in certain_top(exact, ids, v, lo, hi, k)]
                q, i, s = zip(*got) if got else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, i, s)], ["query", "id", "score"])

    spread = joined.repartition(spark.sparkContext.defaultParallelism * 4, F.xxhash64("block", "lot"))
    found = spread.mapInArrow(run, "query long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")

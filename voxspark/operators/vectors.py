"""Exact vector search, norms and the sharded index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from voxspark.fixed_values import INDEX_SHARD_ROWS
from voxspark.functions.text import col
from voxspark.operators.joins import lookup_join, salted_join
from voxspark.operators.ordering import split_by_size, top_n_per_group, with_row_number
from voxspark.operators.relational import union_all
from voxspark.session import settle

MAX_QUERIES = 4_096
# Scores are compared after rounding, so that ties do not depend on the order
# in which a sum was taken.
SCORE_DIGITS = 9


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two arrays in double precision."""
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def squared_l2(a: Column | str, b: Column | str) -> Column:
    gaps = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(
        col(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    ))


def normalize_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Unit-length vectors; a zero vector stays as it is."""
    length = norm(vector)
    return df.withColumn(
        vector,
        F.when(
            length > 0, F.transform(F.col(vector), lambda x: (x.cast("double") / length).cast("float"))
        ).otherwise(F.col(vector)),
    )


def norm_report(df: DataFrame, vector: str, by: Sequence[str] = (), tolerance: float = 1e-4) -> DataFrame:
    """Vectors, dimensions and vectors off unit length, per group."""
    off = F.abs(norm(vector) - 1) >= tolerance
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.min(F.size(vector)).alias("min_dim"),
        F.max(F.size(vector)).alias("max_dim"),
        F.count_if(off).alias("n_not_unit"),
    )


class _Nearest:
    """The best ``n`` documents of each query of one lot, fed batch by batch.

    About ``n`` candidates per query are held; a row that is worse than the n-th
    best so far is never kept.
    """

    CELLS = 4_000_000

    def __init__(self, numbers: pa.Array, names: pa.Array, matrix: np.ndarray, metric: str, n: int):
        self.numbers, self.names, self.matrix, self.metric, self.n = numbers, names, matrix, metric, n
        self.squares = (matrix * matrix).sum(axis=1)
        self.limit = np.full(len(matrix), np.inf)
        self.query, self.cost, self.ids = np.empty(0, np.int64), np.empty(0), None

    def add(self, ids: pa.Array, docs: np.ndarray) -> None:
        step = max(1, self.CELLS // max(len(self.matrix), 1))
        for at in range(0, len(docs), step):
            part = docs[at : at + step]
            cost = part @ self.matrix.T
            if self.metric == "ip":
                cost = -cost
            else:
                cost = np.maximum((part * part).sum(axis=1)[:, None] + self.squares[None, :] - 2 * cost, 0)
            cost = np.round(cost, SCORE_DIGITS)
            row, query = np.nonzero(cost <= self.limit[None, :])
            fresh = ids.take(pa.array(row + at))
            self.ids = fresh if self.ids is None else pa.concat_arrays([self.ids, fresh])
            self.query, self.cost = np.concatenate([self.query, query]), np.concatenate([self.cost, cost[row, query]])
            if len(self.query) > 4 * len(self.matrix) * self.n:
                self._cut()

    def _cut(self) -> None:
        rank = pc.rank(self.ids, sort_keys="ascending", tiebreaker="first").to_numpy()
        order = np.lexsort((rank, self.cost, self.query))
        query = self.query[order]
        place = np.arange(len(order)) - np.searchsorted(query, query, side="left")
        order, place = order[place < self.n], place[place < self.n]
        self.query, self.cost, self.ids = self.query[order], self.cost[order], self.ids.take(pa.array(order))
        last = place == self.n - 1
        self.limit[self.query[last]] = self.cost[last]

    def rows(self) -> pa.RecordBatch | None:
        if self.ids is None:
            return None
        self._cut()
        at = pa.array(self.query)
        return pa.RecordBatch.from_arrays([self.numbers.take(at), self.names.take(at), self.ids, pa.array(self.cost)], ["_no", "_query", "_id", "_cost"])


def _nearest(metric: str, n: int):
    """Task function over rows sorted by lot, salt and kind: the queries of a lot come first, then documents."""

    def run(batches):
        key, asked, best = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("_lot", "_salt", "_kind")])
            cuts = np.flatnonzero(np.append(True, (marks[:, 1:] != marks[:, :-1]).any(axis=0))) if batch.num_rows else []
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                if key != (marks[0, a], marks[1, a]):
                    if best is not None and (out := best.rows()) is not None:
                        yield out
                    key, asked, best = (marks[0, a], marks[1, a]), [], None
                part = batch.slice(a, b - a)
                vectors = part.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1)
                if marks[2, a] == 0:
                    asked.append((part.column("_no"), part.column("_query"), vectors))
                    continue
                if not asked:
                    continue
                if best is None:
                    numbers, names, rows = zip(*asked)
                    best = _Nearest(pa.concat_arrays(numbers), pa.concat_arrays(names), np.concatenate(rows), metric, n)
                best.add(part.column("_id"), vectors)
        if best is not None and (out := best.rows()) is not None:
            yield out

    return run


def search(
    docs: DataFrame, queries: DataFrame, *, id: str, vector: str, query_id: str,
    query_vector: str, metric: str = "ip", n: int = 5, where: Column | None = None,
    max_queries: int = MAX_QUERIES,
) -> DataFrame:
    """The ``n`` nearest rows per query: (query_id, id, score, rank).

    The filter runs before ranking, so the result is exact and no fetch size has
    to grow. Inner products are ranked descending, squared distances ascending,
    ties by id. Queries are numbered and cut into lots of ``max_queries``; no
    query vector comes to the driver, and the documents are scanned once however
    many lots there are. Each lot meets the documents in salted groups, where
    whole Arrow batches are multiplied by the lot's matrix and ``n`` rows per
    query are kept.
    """
    if metric not in ("ip", "l2"):
        raise ValueError(f"unknown metric: {metric}")
    spark = docs.sparkSession
    asked = queries.select(F.col(query_id).alias("_query"), F.col(query_vector).cast("array<double>").alias("_v")).where("_v IS NOT NULL")
    asked = settle(with_row_number(asked, [], ["_query"], "_no"))
    lots = -(-asked.count() // max_queries) or 1
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-2 * tasks // lots))
    kept = docs if where is None else docs.where(where)
    kept = kept.where(F.col(vector).isNotNull()).select(F.col(id).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    id_type, query_type = kept.schema["_id"].dataType, asked.schema["_query"].dataType
    sides = asked.select(
        F.floor((F.col("_no") - 1) / max_queries).cast("int").alias("_lot"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        F.lit(0).alias("_kind"), F.col("_no").cast("long").alias("_no"), "_query", F.lit(None).cast(id_type).alias("_id"), "_v",
    ).union(kept.select(
        F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("_lot"), F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"),
        F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_no"), F.lit(None).cast(query_type).alias("_query"), "_id", "_v"))
    dealt = sides.repartition(tasks, "_lot", "_salt").sortWithinPartitions("_lot", "_salt", "_kind")
    out = T.StructType([
        T.StructField("_no", T.LongType()), T.StructField("_query", query_type), T.StructField("_id", id_type), T.StructField("_cost", T.DoubleType())])
    best = dealt.mapInArrow(_nearest(metric, n), out)
    ranked = top_n_per_group(best, ["_no"], ["_cost", "_id"], n, rank="rank")
    score = -F.col("_cost") if metric == "ip" else F.col("_cost")
    return ranked.select(F.col("_query").alias(query_id), F.col("_id").alias(id), score.alias("score"), "rank")


def search_within(
    docs: DataFrame, queries: DataFrame, *, on: str, id: str, vector: str, query_id: str,
    query_vector: str, metric: str = "ip", n: int = 5, keep: Column | None = None,
    carry: Sequence[str] = (), query_carry: Sequence[str] = (),
) -> DataFrame:
    """Nearest rows of an entity for each of the entity's own queries.

    An entity usually has a handful of queries; up to ``MAX_QUERIES`` of them
    travel as one array per entity, and a document is scored inside its row. More
    are joined row by row. ``keep`` is a further condition on a (document, query)
    pair. Result: (on, query_id, id, carry, score, rank).
    """
    measure = dot if metric == "ip" else squared_l2
    rows = docs.where(F.col(vector).isNotNull()).select(on, id, vector, *carry)
    asked = queries.select(on, query_id, *query_carry, F.col(query_vector).alias("_qv"))
    few, many = split_by_size(asked, [on], MAX_QUERIES)
    packed = few.groupBy(on).agg(
        F.collect_list(F.struct(query_id, *query_carry, "_qv")).alias("_qs")
    )

    def scored(q: Column) -> Column:
        kept = [q[c].alias(c) for c in (query_id, *query_carry)]
        return F.struct(*kept, F.round(measure(vector, q["_qv"]), SCORE_DIGITS).alias("score"))

    # the vector stays in its row; only (query, score) is repeated
    pairs = lookup_join(rows, packed, on, "inner").select(on, id, *carry, F.inline(F.transform("_qs", scored)))
    if many is not None:
        joined = salted_join(rows, many, [on], "inner")
        joined = joined.withColumn("score", F.round(measure(vector, "_qv"), SCORE_DIGITS))
        pairs = pairs.unionByName(joined.drop(vector, "_qv"))
    if keep is not None:
        pairs = pairs.where(keep)
    order = F.desc("score") if metric == "ip" else F.asc("score")
    return top_n_per_group(pairs, [on, query_id], [order, id], n, rank="rank")


def with_shards(df: DataFrame, id: str, shard_rows: int = INDEX_SHARD_ROWS) -> DataFrame:
    """``shard``: consecutive runs of ``shard_rows`` rows in id order."""
    numbered = with_row_number(df, [], [id], "_row")
    return numbered.withColumn("shard", F.floor((F.col("_row") - 1) / shard_rows).cast("int")).drop("_row")


def build_index(
    df: DataFrame, path: str, *, id: str, vector: str, text: str, shard_rows: int = INDEX_SHARD_ROWS
) -> None:
    """Write the index: id, text, vector, the other columns as metadata, one folder per shard."""
    meta = [c for c in df.columns if c not in (id, vector, text)]
    rows = df.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col(vector).alias("embedding"),
        F.struct(*meta).alias("metadata"),
    )
    shards = with_shards(rows, "id", shard_rows)
    shards.repartition("shard").write.mode("errorifexists").partitionBy("shard").parquet(path)


def load_index(
    spark: SparkSession, index: str | Sequence[str], names: Mapping[str, str] | None = None,
    default: str | None = None,
) -> DataFrame:
    """All shards of one or several indexes. An unknown name means the default one."""
    if isinstance(index, str):
        names = names or {}
        index = [names.get(index, names.get(default, index) if default else index)]
    return union_all([spark.read.parquet(p) for p in index])


def same_index(a: DataFrame, b: DataFrame, id: str, vector: str) -> DataFrame:
    """Rows that differ between two indexes of the same documents: (id, in_a, in_b)."""
    left = a.select(id, F.col(vector).alias("_va"), F.lit(True).alias("in_a"))
    right = b.select(id, F.col(vector).alias("_vb"), F.lit(True).alias("in_b"))
    both = left.join(right, id, "full")
    return both.where(~F.col("_va").eqNullSafe(F.col("_vb"))).select(
        id, F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b")
    )

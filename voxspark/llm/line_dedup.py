"""Lines that repeat across documents, found by levelled sorted runs of line hashes.

Documents arrive in batches of ascending ids. The line keys of a batch meet the
runs written so far in merge joins; keys not yet known become a new run. A run
is a table bucketed and sorted by the 128-bit line hash, so a batch is shuffled
once and the runs never are. When a level holds ``fanout`` runs, they are merged
into one run of the next level, as in a log-structured store.

Everything is DataFrame code: no Python runs on the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxspark.llm.common import LOWER, UPPER
from voxspark.session import scratch_path, settle

BLANKS = " \t\n\x0b\x0c\r"
#: A document's dropped lines are looked up in this many small sets.
CELLS = 256


def line_key(line: Column) -> Column:
    return F.btrim(F.translate(line, UPPER, LOWER), F.lit(BLANKS))


def _hash_a(key: Column) -> Column:
    return F.xxhash64(key)


def _hash_b(key: Column) -> Column:
    return F.xxhash64(F.lit("second"), key)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 10) -> DataFrame:
    """id, a, b: the hashes of each document's distinct keys of at least ``min_chars`` code points."""
    keys = F.filter(
        F.transform(F.split(F.translate(F.col(text_col), UPPER, LOWER), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS))),
        lambda x: F.length(x) >= min_chars,
    )
    return (
        docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.explode(F.array_distinct(keys)).alias("key"))
        .select("id", _hash_a(F.col("key")).alias("a"), _hash_b(F.col("key")).alias("b"))
    )


class LineRuns:
    """Known line hashes as levelled sorted runs in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def _sorted_table(self, df: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            df.repartition(self.buckets, "a", "b")
            .write.bucketBy(self.buckets, "a", "b").sortBy("a", "b")
            .option("path", scratch_path(self.spark, "line-run")).format("parquet").saveAsTable(name)
        )
        return self.spark.table(name)

    def _keep(self, run: DataFrame, level: int = 0) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged, self.levels[level] = self.levels[level], []
            whole = merged[0]
            for other in merged[1:]:
                whole = whole.union(other)
            self._keep(self._sorted_table(whole), level + 1)

    def add(self, lines: DataFrame, last: bool = False) -> DataFrame:
        """Take in a batch (id, a, b) and return its repeated keys (a, b, owner).

        ``owner`` is the smallest id of the batch that has the line, or null if
        an earlier batch has it. Repeating a batch's rows changes nothing.
        """
        found = lines.groupBy("a", "b").agg(F.min("id").alias("owner"), F.max("id").alias("other"))
        known = F.lit(False)
        for n, run in enumerate(r for level in self.levels for r in level):
            seen = run.select("a", "b", F.lit(True).alias(f"in_{n}"))
            found = found.join(seen, ["a", "b"], "left")
            known = known | F.coalesce(F.col(f"in_{n}"), F.lit(False))
        batch = self._sorted_table(found.select("a", "b", "owner", "other", known.alias("known")))
        if not last:
            self._keep(batch.where(~F.col("known")).select("a", "b"))
        return batch.where(F.col("known") | (F.col("owner") < F.col("other"))).select(
            "a", "b", F.when(~F.col("known"), F.col("owner")).alias("owner"),
        )


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """id, a, b of every line that a document must drop: a smaller id has it too."""
    spark = docs.sparkSession
    lines = line_hashes(docs, id_col, text_col, min_chars)
    cuts = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), [i / batches for i in range(1, batches)])).first()[0]
    cuts = sorted(set(cuts or []))
    number = sum((F.when(F.col("id") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    lines = settle(lines.withColumn("batch", number.cast("int")))
    runs, out = LineRuns(spark, fanout), None
    for n in range(len(cuts) + 1):
        own = lines.where(F.col("batch") == n).select("id", "a", "b")
        repeated = runs.add(own, last=n == len(cuts))
        drops = own.join(repeated, ["a", "b"]).where(F.col("owner").isNull() | (F.col("id") != F.col("owner"))).select("id", "a", "b")
        out = drops if out is None else out.union(drops)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with three more columns: _kept_text, _n_lines and _n_dropped.

    A line goes if a document with a smaller id holds the same key. Keys under
    ``min_chars`` code points never go. Null or empty text is one empty line.
    Rows with a null id stay as they are and are compared with nothing. Rows
    that share an id are one document. All other columns pass through; an empty
    table gives an empty table.
    """
    drops = (
        repeated_lines(docs, id_col, text_col, min_chars, batches, fanout)
        .groupBy("id", F.pmod("a", F.lit(CELLS)).alias("cell")).agg(F.collect_set("a").alias("gone"))
        .groupBy(F.col("id").alias("_drop_id")).agg(F.map_from_entries(F.collect_list(F.struct("cell", "gone"))).alias("_gone"))
    )
    joined = docs.join(drops, docs[id_col].cast("long") == drops["_drop_id"], "left")

    def stays(line: Column) -> Column:
        key = line_key(line)
        a = _hash_a(key)
        gone = F.array_contains(F.try_element_at(F.col("_gone"), F.pmod(a, F.lit(CELLS))), a)
        return (F.length(key) < min_chars) | ~F.coalesce(gone, F.lit(False))

    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    return (
        joined.withColumn("_lines", lines)
        .withColumn("_stay", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays)))
        .withColumns({
            "_kept_text": F.array_join("_stay", "\n"), "_n_lines": F.size("_lines").cast("long"),
            "_n_dropped": (F.size("_lines") - F.size("_stay")).cast("long"),
        })
        .select(*(docs[c] for c in docs.columns), "_kept_text", "_n_lines", "_n_dropped")
    )

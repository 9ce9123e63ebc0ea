"""Continuous ingest of review files and running counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from voxspark import schemas as S
from voxspark.functions.text import col
from voxspark.operators.relational import union_all
from voxspark.sources.readers import _CSV, raw_reviews


def review_stream(spark: SparkSession, path: str) -> DataFrame:
    """Arriving review files, typed like the batch reader.

    The event time is a zoned timestamp, which watermarks need.
    """
    options = {**_CSV, "header": "false", "pathGlobFilter": "*.csv"}
    rows = spark.readStream.schema(S.RAW_REVIEW).options(**options).csv(path)
    rows = rows.select("*", F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias("file_name"))
    return raw_reviews(rows).withColumn("retrieved_at", F.col("retrieval_date").cast("timestamp"))


def once_per_id(
    stream: DataFrame, id: str, event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """First arrival of every id.

    Without a delay every id is remembered, for as long as the query lives. With
    one, ids are forgotten after it and later rows are dropped, which bounds the
    state.
    """
    if delay is None:
        return stream.dropDuplicates([id])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id])


def ingest(
    stream: DataFrame, out: str, checkpoint: str, id: str, event_time: str | None = None,
    delay: str | None = None,
) -> StreamingQuery:
    """Write each id once to Parquet, reading all that is there and then stopping.

    Without a delay the file sink itself gives exactly-once output, and every id
    is remembered. With one, which a long-lived stream should have, the state is
    bounded but may have forgotten an id, so every batch is also checked against
    the ids already written: the sink is partitioned by ``event_day``, and only
    days within the delay of the batch are read. A batch that runs again finds
    its own rows there.
    """
    first = once_per_id(stream, id, event_time, delay)
    writer = first.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if delay is None:
        return writer.format("parquet").option("path", out).outputMode("append").start()
    dated = first.withColumn("event_day", F.to_date(event_time)).schema

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        reach = batch.agg(F.to_date(F.min(F.col(event_time)) - F.expr(f"INTERVAL {delay}"))).head()[0]
        if reach is None and batch.isEmpty():
            return
        # the folder exists after this, so that the first batch can read it too
        spark.createDataFrame([], dated).write.mode("append").partitionBy("event_day").parquet(out)
        near = F.col("event_day").isNull() | (F.col("event_day") >= F.lit(reach))
        known = spark.read.schema(dated).parquet(out).where(near).select(id)
        fresh = batch.withColumn("event_day", F.to_date(event_time)).join(known, id, "left_anti")
        fresh.hint("rebalance", "event_day").write.mode("append").partitionBy("event_day").parquet(out)

    return writer.foreachBatch(append).start()


def running_summary(stream: DataFrame, key: str, errors: Column | str, at: str) -> DataFrame:
    """Reviews, errors and last retrieval per place, for update or complete mode."""
    return stream.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_scraped"),
        F.sum(col(errors)).alias("n_errors"),
        F.max(at).alias("last_retrieval"),
    )


#: Batches whose changes are merged into one table of all keys.
MERGE_EVERY = 16


def run_to_folder(stream: DataFrame, key: str, out: str, checkpoint: str, merge_every: int = MERGE_EVERY) -> DataFrame:
    """Run an aggregate over all that is there; one row per ``key``, the latest.

    A batch writes the keys that it changed, in a folder of its own, so one that
    runs again after a failure replaces only itself. Every ``merge_every``-th
    batch merges all changes with the last table of all keys, and what went into
    the new table is removed once that is complete. A restart without new rows
    returns what was there before.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if (number + 1) % merge_every or number in _numbers(spark, out, "base"):
            return
        _latest(spark, stream.schema, key, out).write.mode("overwrite").parquet(f"{out}/base={number}")
        for kind in ("base", "batch"):
            for n in _numbers(spark, out, kind):
                if n < number or (kind == "batch" and n == number):
                    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{kind}={n}")
                    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    query = (
        stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    return _latest(spark, stream.schema, key, out)


def _latest(spark: SparkSession, schema, key: str, out: str) -> DataFrame:
    """Each key's row of the newest folder that has it: the last complete table and the changes after it."""
    base = max(_numbers(spark, out, "base"), default=-1)
    folders = [(base, f"{out}/base={base}")] if base >= 0 else []
    folders += [(n, f"{out}/batch={n}") for n in _numbers(spark, out, "batch") if n > base]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = union_all([spark.read.schema(schema).parquet(p).select(F.lit(n).alias("_at"), F.struct("*").alias("_row")) for n, p in folders])
    return rows.groupBy(F.col(f"_row.{key}").alias("_key")).agg(F.max_by("_row", "_at").alias("_row")).select("_row.*")


def _numbers(spark: SparkSession, out: str, kind: str) -> list[int]:
    """Numbers of the folders of a kind that carry their success mark."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{kind}=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

"""Session helpers: local sessions for tests and the reliable lineage cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "voxspark", memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would lose its files together with the executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten.

    All paths of an application share one folder, which is deleted when it ends.
    """
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/voxspark-{app}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    Used where a later step must see the very same rows and partitions again
    (range-partitioned data, iteration state). It survives lost executors, and
    the columnar file keeps column pruning for what follows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unsettle(df: DataFrame) -> None:
    """Delete the files of a settled table that nothing reads any more, so that rounds do not add up on disk."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for CPU-heavy work.

    An input of a few unsplittable files would keep most cores idle; one with
    enough partitions is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by unique keys ahead of a step that multiplies the rows.

    The small rows are shuffled instead of the many made from them, and all
    aggregates keyed by these columns need no further shuffle. The partition
    count is given, because merging by today's size would misjudge tomorrow's.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)

"""Files out. Nothing is overwritten, and empty tables write nothing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from voxspark.operators.relational import banded


# Texts keep their outer blanks; the CSV writer would trim them.
_CSV = {
    "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _stamped(folder: str, name: str, ts: str | None) -> str:
    return f"{folder}/{name}_{ts or datetime.now().strftime('%Y-%m-%d_%H-%M-%S_%f')}"


def save_df(df: DataFrame, folder: str, name: str, ts: str | None = None) -> str | None:
    """Parquet folder with the time in its name; its path, or None if ``df`` is empty."""
    if df.isEmpty():
        return None
    path = _stamped(folder, name, ts)
    df.write.mode("errorifexists").parquet(path)
    return path


def write_report(df: DataFrame, folder: str, name: str, ts: str | None = None) -> str | None:
    """CSV report with a header; its path, or None if ``df`` is empty."""
    if df.isEmpty():
        return None
    path = _stamped(folder, name, ts)
    df.write.mode("errorifexists").options(**_CSV, header="true").csv(path)
    return path


def append_csv(df: DataFrame, path: str) -> None:
    """Append review rows with every field quoted; no header lines among the data."""
    df.write.mode("append").options(**_CSV, quoteAll="true").csv(path)


def write_banded(df: DataFrame, c: str, edges: Sequence[float], path: str) -> None:
    """One folder per size band of ``c``.

    Rows go to the writers as they lie: a task writes at most one file per band,
    and no band is gathered anywhere.
    """
    banded(df, c, edges).write.mode("errorifexists").partitionBy("band").parquet(path)


def write_per_entity(df: DataFrame, c: str, path: str) -> None:
    """One folder per entity; the partition value is escaped by the writer.

    The rebalance hint puts an entity's rows together and lets Spark split an
    entity that is too large for one task over several files.
    """
    df.hint("rebalance", F.col(c)).write.mode("append").partitionBy(c).parquet(path)


def write_named_texts(df: DataFrame, name: str, text: str, path: str) -> None:
    """Texts keyed by name as JSON lines."""
    df.select(F.col(name).alias("name"), F.col(text).alias("text")).write.mode("errorifexists").json(path)

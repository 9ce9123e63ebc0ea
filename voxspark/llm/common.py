"""Small helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows turned into Python objects at a time, so that a batch of long texts stays small.
SLICE = 256


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``id`` (long) and ``text`` (null becomes empty), whatever else the table holds."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def per_slice(df: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType, rows: int = SLICE) -> DataFrame:
    """Apply ``work()`` (made once per task, so that it may hold caches) to slices of each Arrow batch."""

    def run(batches):
        step = work()
        for part in in_slices(batches, rows):
            yield step(part)

    return df.mapInArrow(tidy(run), schema)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` with its memory given back to the system at its end: workers are reused, and caches of one task would stay."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return whole


class Memo(dict):
    """A cache of ``make(key)`` that is emptied when it holds ``most`` keys."""

    def __init__(self, make: Callable, most: int = 300_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.make(key)
        return value

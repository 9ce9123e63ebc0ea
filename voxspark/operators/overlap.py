"""ROUGE and BLEU from n-gram counts, compared in batches by 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from voxspark.functions import text as X


#: Tokens that a task compares at once; a longer pair is compared alone.
LOT = 1 << 18


def rouge_tokens(c: Column | str) -> Column:
    """Lower-case ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(X.col(c)), F.lit("([a-z0-9]+)"), 1)


def bleu_tokens(c: Column | str) -> Column:
    """Words, and every other visible sign on its own."""
    return F.regexp_extract_all(X.col(c), F.lit(rf"({X.WORD}|[^\s\p{{L}}\p{{N}}_])"), 1)


def _hashes(tokens: Column) -> Column:
    return F.coalesce(F.transform(tokens, lambda t: F.xxhash64(t)), F.array().cast("array<bigint>"))


def _grams(values: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(list number, 64-bit hash) of every n-gram of lists that lie one after another."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(values))
    at = np.flatnonzero(left >= n)
    out = np.zeros(len(at), np.uint64)
    for j in range(n):
        out = (out ^ values[at + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return owner[at], out


def _counted(owner: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, gram, count) of the distinct pairs, in order."""
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1]))) if len(order) else order
    return owner[first], grams[first], np.diff(np.append(first, len(order)))


def _lots(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``LOT`` tokens."""
    rs = batch.column("_rs")
    in_refs = np.concatenate([[0], np.cumsum(rs.flatten().value_lengths().to_numpy())])
    last = np.cumsum(rs.value_lengths().to_numpy())
    upto = np.cumsum(batch.column("_h").value_lengths().to_numpy().astype(np.int64)) + in_refs[last]
    starts = np.flatnonzero(np.diff(upto // LOT, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def _clipped(df: DataFrame, orders: Sequence[int]) -> DataFrame:
    """Replace ``_h`` (token hashes) and ``_rs`` (arrays of them) by ``_m``: per order, the n-grams of ``_h`` that a reference has too.

    Each n-gram counts as often as in ``_h``, and at most as often as in the
    reference that has it most. Many rows are compared at once in a task, as long
    as they hold no more than ``LOT`` tokens, so that its memory is bounded.
    """
    kept = [f for f in df.schema.fields if f.name not in ("_h", "_rs")]
    orders = tuple(orders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (lot for whole in batches for lot in _lots(whole)):
            h, rs = batch.column("_h"), batch.column("_rs")
            texts = rs.flatten()
            row_of = np.repeat(np.arange(batch.num_rows), rs.value_lengths().to_numpy())
            flat = [(x.flatten().to_numpy().view(np.uint64), x.value_lengths().to_numpy().astype(np.int64)) for x in (h, texts)]
            found = np.zeros((batch.num_rows, len(orders)), np.int64)
            for k, n in enumerate(orders):
                own, gram, count = _counted(*_grams(*flat[0], n))
                ref, known, most = _counted(*_grams(*flat[1], n))
                # the largest count of a row's references, then the smaller one of both sides
                order = np.lexsort((known, row_of[ref]))
                row, known, most = row_of[ref][order], known[order], most[order]
                row, gram_, n_own = np.concatenate([row, own]), np.concatenate([known, gram]), np.concatenate([most, count])
                side = np.repeat([0, 1], [len(known), len(gram)])
                order = np.lexsort((side, gram_, row))
                row, gram_, n_own, side = row[order], gram_[order], n_own[order], side[order]
                first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (gram_[1:] != gram_[:-1]))) if len(row) else row
                if not len(first):
                    continue
                best = np.maximum.reduceat(np.where(side == 0, n_own, 0), first)
                mine = np.maximum.reduceat(np.where(side == 1, n_own, 0), first)
                np.add.at(found[:, k], row[first], np.minimum(best, mine))
            ends = np.arange(0, found.size + 1, len(orders), dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, found.ravel())
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], lists], [*[f.name for f in kept], "_m"])

    schema = T.StructType([*kept, T.StructField("_m", T.ArrayType(T.LongType()))])
    return df.mapInArrow(run, schema)


def rouge(
    df: DataFrame, pair: str, reference: str, summary: str, orders: tuple = (1, 2, 3)
) -> DataFrame:
    """(pair, n, precision, recall, fmeasure) of summary against reference.

    ``pair`` identifies a row. N-grams are counted and compared inside the
    task, so nothing is shuffled. A missing text has no n-grams.
    """
    hashed = df.select(pair, _hashes(rouge_tokens(summary)).alias("_h"), F.array(_hashes(rouge_tokens(reference))).alias("_rs"))
    sized = hashed.withColumns({"_nh": F.size("_h"), "_nr": F.size(F.col("_rs")[0])})
    compared = _clipped(sized, orders)

    def order(n: int, k: int) -> Column:
        def share(size: str) -> Column:
            return F.coalesce(F.try_divide(F.col("_m")[k], F.greatest(F.col(size) - (n - 1), F.lit(0))), F.lit(0.0))

        return F.struct(F.lit(n).alias("n"), share("_nh").alias("precision"), share("_nr").alias("recall"))

    p, r = F.col("precision"), F.col("recall")
    return compared.select(pair, F.inline(F.array(*[order(n, k) for k, n in enumerate(orders)]))).withColumn(
        "fmeasure", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    )


def bleu(
    df: DataFrame, pair: str, references: str, prediction: str, max_order: int = 4,
    by: list[str] | None = None,
) -> DataFrame:
    """Corpus BLEU of predictions against arrays of references.

    One row, or one per ``by`` group: clipped precisions of order 1..4, brevity
    penalty against the shortest reference, and their product. N-grams are
    clipped inside the task; only sums are shuffled. ``pair`` identifies a row.
    """
    by = list(by or [])
    orders = range(1, max_order + 1)

    rows = df.select(
        *by, _hashes(bleu_tokens(prediction)).alias("_h"),
        F.coalesce(F.transform(F.col(references), lambda r: _hashes(bleu_tokens(r))), F.array().cast("array<array<bigint>>")).alias("_rs"))
    sized = rows.withColumns({"_nh": F.size("_h"), "_nr": F.array_min(F.transform("_rs", lambda r: F.size(r)))})
    both = _clipped(sized, orders).groupBy(*by).agg(
        F.sum("_nh").alias("translation_length"), F.sum("_nr").alias("reference_length"),
        *[F.sum(F.greatest(F.col("_nh") - (n - 1), F.lit(0))).alias(f"possible_{n}") for n in orders],
        *[F.coalesce(F.sum(F.col("_m")[n - 1]), F.lit(0)).alias(f"match_{n}") for n in orders],
    )
    precisions = [
        F.coalesce(F.try_divide(F.col(f"match_{n}"), F.col(f"possible_{n}")), F.lit(0.0))
        for n in orders
    ]
    ratio = F.try_divide(F.col("translation_length"), F.col("reference_length"))
    out = both.select(
        *by, "translation_length", "reference_length",
        *[p.alias(f"precision_{n}") for n, p in zip(orders, precisions)],
        F.coalesce(F.when(ratio > 1, F.lit(1.0)).otherwise(
            F.when(ratio > 0, F.exp(1 - F.try_divide(F.lit(1.0), ratio)))
        ), F.lit(0.0)).alias("brevity_penalty"),
    )
    ps = [F.col(f"precision_{n}") for n in orders]
    mean = F.exp(reduce(lambda a, b: a + b, [F.ln(p) for p in ps]) / max_order)
    return out.withColumn(
        "bleu", F.when(F.least(*ps) > 0, mean * F.col("brevity_penalty")).otherwise(F.lit(0.0))
    )

"""Splitting texts into chunks and packing texts into budgets."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from voxspark.functions import text as X
from voxspark.operators.ordering import split_by_size, with_row_number


def chunk(df: DataFrame, doc: str, text: str, n: int) -> DataFrame:
    """(doc, chunk_no, n_tokens, chunk): consecutive runs of ``n`` blank-separated tokens."""
    tokens = df.select(doc, X.words(text).alias("_t")).where(F.size("_t") > 0)
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_t") - 1) / n)),
        lambda i: F.slice(F.col("_t"), (i * n + 1).cast("int"), F.lit(n)),
    )
    return tokens.select(doc, F.posexplode(pieces).alias("chunk_no", "_p")).select(
        doc, "chunk_no", F.size("_p").alias("n_tokens"), F.array_join("_p", " ").alias("chunk")
    )


def _greedy(budget: int):
    """(successors, opened): the packing rule over one ordered run of sizes.

    Returned as inner functions, so that tasks receive them by value.
    """

    def successors(sizes: np.ndarray) -> np.ndarray:
        """For a pack opened at row i, the row at which the next pack opens."""
        upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        reach = np.searchsorted(upto, upto[:-1] + budget, side="right") - 1
        return np.maximum(reach, np.arange(len(sizes)) + 1)

    def opened(sizes: np.ndarray, already: int) -> np.ndarray:
        """Packs opened up to each row, entering with a pack of ``already`` tokens.

        A negative ``already`` means that no pack is open; a pack above the budget
        takes nothing more.
        """
        n = len(sizes)
        upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        at = 0
        if 0 <= already <= budget:
            at = int(np.searchsorted(upto, budget - already, side="right")) - 1
        nxt, starts = successors(sizes), []
        while at < n:
            starts.append(at)
            at = int(nxt[at])
        return np.searchsorted(np.asarray(starts, dtype=np.int64), np.arange(n), side="right")

    return successors, opened


def pack(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str, budget: int = 4000,
    block_rows: int = 100_000,
) -> DataFrame:
    """Add ``pack_no``: rows of an entity, in order, fill packs up to ``budget`` tokens.

    A row that does not fit opens the next pack; a row above the budget is a
    pack of its own. Where a pack starts depends on all rows before it, so an
    entity with more than ``block_rows`` rows is cut into numbered blocks. Every
    block reports, for each way a pack can be open on entry, how it ends; the
    reports are chained per entity, and each block is then numbered on its own.
    """
    keys, order = list(keys), list(order)
    small, large = split_by_size(df, keys, block_rows)
    out_schema = T.StructType([*df.schema.fields, T.StructField("pack_no", T.LongType())])
    one_block = small.groupBy(*keys).applyInPandas(_number_whole(order, size, budget), out_schema)
    if large is None:
        return one_block

    numbered = with_row_number(large, keys, order, "_row").withColumn(
        "_block", F.floor((F.col("_row") - 1) / block_rows)
    )
    key_fields = [df.schema[k] for k in keys]
    report_schema = T.StructType([
        *key_fields, T.StructField("_block", T.LongType()), T.StructField("_room", T.ArrayType(T.LongType())),
        T.StructField("_opens", T.ArrayType(T.LongType())), T.StructField("_last", T.ArrayType(T.LongType())),
        T.StructField("_sum", T.LongType()),
    ])
    reports = (
        numbered.select(*keys, "_block", "_row", size)
        .groupBy(*keys, "_block")
        .applyInPandas(_report(keys, size, budget), report_schema)
    )
    entry_schema = T.StructType([
        *key_fields, T.StructField("_block", T.LongType()),
        T.StructField("_already", T.LongType()), T.StructField("_before", T.LongType()),
    ])
    entries = reports.groupBy(*keys).applyInPandas(_chain(keys, budget), entry_schema)
    on = [*keys, "_block"]
    blocks = numbered.groupBy(*on).cogroup(entries.groupBy(*on)).applyInPandas(
        _number_block(size, budget, df.columns), out_schema
    )
    return one_block.unionByName(blocks)


def _number_whole(order, size, budget):
    _, opened = _greedy(budget)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        return pdf.assign(pack_no=opened(pdf[size].fillna(0).to_numpy("int64"), -1) - 1)

    return run


def _report(keys, size, budget):
    successors, _ = _greedy(budget)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row")
        sizes = pdf[size].fillna(0).to_numpy("int64")
        n = len(sizes)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        nxt = successors(sizes)
        # how a block ends when a pack opens at row i, from the back
        opens = np.zeros(n + 1, dtype="int64")
        last = np.full(n + 1, -1, dtype="int64")
        for i in range(n - 1, -1, -1):
            j = int(nxt[i])
            opens[i] = opens[j] + 1
            last[i] = last[j] if j < n else upto[n] - upto[i]
        # the first new pack can only open among the rows that fit one budget
        reach = min(n, int(np.searchsorted(upto, budget, side="right")))
        row = pdf.iloc[0]
        return pd.DataFrame({
            **{k: [row[k]] for k in keys}, "_block": [row["_block"]],
            "_room": [upto[: reach + 1].tolist()], "_opens": [opens[: reach + 1].tolist()],
            "_last": [last[: reach + 1].tolist()], "_sum": [int(upto[n])],
        })

    return run


def _chain(keys, budget):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        already, before, rows = -1, 0, []
        for r in pdf.itertuples(index=False):
            rows.append((already, before))
            room = np.asarray(r[len(keys) + 1])
            opens, last, total = r[len(keys) + 2], r[len(keys) + 3], r[len(keys) + 4]
            at = 0
            if 0 <= already <= budget:
                at = int(np.searchsorted(room, budget - already, side="right")) - 1
            ended = int(last[at])
            before += int(opens[at])
            already = ended if ended >= 0 else already + int(total)
        return pdf[[*keys, "_block"]].assign(
            _already=[a for a, _ in rows], _before=[b for _, b in rows]
        )

    return run


def _number_block(size, budget, columns):
    _, opened = _greedy(budget)

    def run(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row").reset_index(drop=True)
        already, before = int(entry["_already"].iloc[0]), int(entry["_before"].iloc[0])
        numbers = opened(pdf[size].fillna(0).to_numpy("int64"), already)
        return pdf[list(columns)].assign(pack_no=numbers + before - 1)

    return run


def pack_texts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, budget: int = 4000,
    sep: str = "\n\n",
) -> DataFrame:
    """(keys, pack_no, n_rows, n_tokens, packed): one merged text per pack.

    A text counts at least one token, so the rows of a pack are bounded as well.
    """
    keys, order = list(keys), list(order)
    sized = df.select(*keys, *order, text).withColumn(
        "_tokens", F.greatest(X.word_count(text), F.lit(1)).cast("bigint")
    )
    numbers = pack(sized.select(*keys, *order, "_tokens"), keys, order, "_tokens", budget)
    merged = sized.drop("_tokens").join(numbers, [*keys, *order])
    return merged.groupBy(*keys, "pack_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_tokens").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t")))).alias("_s"),
    ).withColumn("packed", F.array_join(F.col("_s._t"), sep)).drop("_s")

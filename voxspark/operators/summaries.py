"""Extractive summaries chosen by word frequency or by scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from voxspark.functions import text as X
from voxspark.operators.joins import keep_in
from voxspark.operators.ordering import top_n_per_group
from voxspark.operators.packed import keys, met, numbers, packed
from voxspark.operators.relational import union_all
from voxspark.session import settle

#: Words of a block of sentences. A block asks for each of its words once, so that large ones send less.
BLOCK = 1 << 21


def joined_in_order(picks: DataFrame, key: str, order: list[str], text: str) -> DataFrame:
    """Texts of a few picked rows per entity, joined by newline."""
    return picks.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t")))).alias("_s"),
        F.count(F.lit(1)).alias("n_parts"),
    ).select(key, "n_parts", F.array_join(F.col("_s._t"), "\n").alias("summary"))


def sentence_summary(
    df: DataFrame, key: str, doc: str, text: str, n: int = 2, stopwords=None, min_len: int = 1,
    separators: str = r"[.\n]+",
) -> DataFrame:
    """The ``n`` distinct sentences per entity with the highest sum of word counts.

    Ties go to the sentence seen first by (doc, position); the summary lists the
    best sentence first. Sentences are told apart by a 128-bit digest, words of an
    entity by a 64-bit hash. The words lie in blocks as places in the block's list
    of distinct words, and only this list asks for counts; the texts of the chosen
    sentences are read again.
    """
    rows = df.where(F.col(key).isNotNull())
    found = F.transform(X.sentences(text, separators), lambda s: F.struct(
        F.unhex(F.md5(s)).alias("d"),
        F.transform(X.tokenize(s, stopwords, min_len), lambda t: F.xxhash64(F.col(key), t)).alias("ids")))
    kinds = dict(rows.dtypes)
    parts = keys(df.sparkSession, max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    held = f"block bigint, part bigint, ids binary, ns binary, at binary, size binary, pos binary, d binary, row binary, keys array<{kinds[key]}>, docs array<{kinds[doc]}>"
    blocks = settle(rows.select(F.col(key).alias("key"), F.col(doc).alias("doc"), found.alias("s")).mapInArrow(_in_blocks(parts), held))
    asks = blocks.where("part IS NOT NULL").select("block", "part", "ids", "ns").repartition(len(parts), "part")
    told = asks.groupBy("part").applyInArrow(_word_counts, "block bigint, part bigint, x binary")
    sentences = blocks.where("part IS NULL").drop("part", "ids", "ns")
    scored = met("block", max(1, sentences.count()), sentences, told).applyInArrow(
        _sentence_scores, f"key {kinds[key]}, doc {kinds[doc]}, pos int, d binary, m bigint, s bigint")
    # rows of a document that comes twice add up, as the words of its sentences do
    seen = scored.repartition("key", "d").groupBy("key", "d", "doc", "pos").agg(F.sum("m").alias("m"), F.max("s").alias("s"))
    first = seen.groupBy("key", "d").agg(F.min(F.struct("doc", "pos", "m", "s")).alias("f")).select("key", "f.*")
    points = first.groupBy("key", "doc", "pos").agg(F.sum(F.col("m") * F.col("s")).alias("score"))
    best = top_n_per_group(points, ["key"], [F.desc("score"), "doc", "pos"], n, rank="rank")
    best = best.select(F.col("key").alias(key), F.col("doc").alias(doc), "pos", "rank")
    picked = df.select(key, doc, text).join(best, [key, doc]).select(
        key, "rank", F.get(X.sentences(text, separators), F.col("pos")).alias("s")
    )
    return joined_in_order(picked, key, ["rank"], "s")


def _in_blocks(parts: np.ndarray):
    """(block, part, ids, ns) of the distinct words of about ``BLOCK`` words, and a row without a part for the sentences."""

    def block(number: int, lots: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(lots).combine_chunks()
        of_doc = t.column("s").combine_chunks()
        count = pc.fill_null(pc.list_value_length(of_doc), 0).to_numpy()
        found = of_doc.flatten()
        words = found.field("ids")
        size = pc.list_value_length(words).to_numpy().astype(np.int32)
        ids, at, ns = np.unique(words.flatten().to_numpy(), return_inverse=True, return_counts=True)
        part = parts[np.mod(ids, len(parts))]
        order = np.argsort(part, kind="stable")
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids), dtype=np.int32)
        heads, first = np.unique(part[order], return_index=True)
        asked, n = (np.split(x[order], first[1:]) if len(ids) else [] for x in (ids, ns.astype(np.int64)))
        begin = np.cumsum(count) - count
        pos = (np.arange(len(found)) - np.repeat(begin, count)).astype(np.int32)
        row = np.repeat(np.arange(len(count), dtype=np.int32), count)
        whole = {"at": place[at], "size": size, "pos": pos, "d": np.frombuffer(b"".join(found.field("d").to_pylist()), np.uint8), "row": row}
        one, none = pa.nulls(1, pa.binary()), pa.nulls(len(asked), pa.binary())
        listed = {
            c: pa.ListArray.from_arrays(pa.array([0, t.num_rows, *[t.num_rows] * len(asked)], pa.int32()), t.column(n).combine_chunks())
            for c, n in (("keys", "key"), ("docs", "doc"))}
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number] * (1 + len(asked)), pa.int64()), "part": pa.array([None, *heads.tolist()], pa.int64()),
            "ids": pa.concat_arrays([one, packed(asked)]), "ns": pa.concat_arrays([one, packed(n)]),
            **{c: pa.concat_arrays([packed([x]), none]) for c, x in whole.items()}, **listed})

    def run(batches):
        number, lots, held = TaskContext.get().partitionId() << 32, [], 0
        for t in batches:
            lots.append(t)
            held += len(t.column("s").flatten().field("ids").flatten())
            if held >= BLOCK:
                yield block(number, lots)
                number, lots, held = number + 1, [], 0
        if lots:
            yield block(number, lots)

    return run


def _word_counts(asks: pa.Table) -> pa.Table:
    """The counts of all blocks together for every word that a block asks for."""
    ids, ns = numbers(asks.column("ids"), np.int64), numbers(asks.column("ns"), np.int64)
    known, at = np.unique(np.concatenate(ids), return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, at, np.concatenate(ns))
    told = np.split(total[at], np.cumsum([len(x) for x in ids])[:-1])
    return pa.table({"block": asks.column("block"), "part": asks.column("part"), "x": packed(told)})


def _sentence_scores(sentences: pa.Table, told: pa.Table) -> pa.Table:
    """For each entity's distinct sentences in a block: the first place, the number of rows there and the sum of word counts."""
    out = []
    counts = np.concatenate([np.zeros(0, np.int64), *numbers(told.sort_by("part").column("x"), np.int64)])
    for i in range(sentences.num_rows):
        at, size, pos, row = (numbers(sentences.column(c)[i : i + 1], np.int32)[0] for c in ("at", "size", "pos", "row"))
        digest = numbers(sentences.column("d")[i : i + 1], np.uint8)[0].reshape(-1, 16)
        key, doc = (sentences.column(c)[i].values for c in ("keys", "docs"))
        sums = np.concatenate([[0], np.cumsum(counts[at])])
        ends = np.cumsum(size, dtype=np.int64)
        score = sums[ends] - sums[ends - size]
        # equal documents have the same rank, missing ones the first
        rank = pc.rank(doc, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()[row]
        name = key.dictionary_encode().indices.to_numpy()[row]
        halves = np.ascontiguousarray(digest).view(np.int64)
        order = np.lexsort((pos, rank, halves[:, 1], halves[:, 0], name))
        same = np.stack([name, halves[:, 0], halves[:, 1], rank, pos])[:, order]
        new = np.concatenate([[True], (same[:3, 1:] != same[:3, :-1]).any(0)])[: len(order)]
        place = np.concatenate([[True], (same[:, 1:] != same[:, :-1]).any(0)])[: len(order)]
        starts = np.flatnonzero(place)
        first = new[starts]
        m, kept = np.diff(np.append(starts, len(order)))[first], order[starts[first]]
        out.append(pa.table({
            "key": key.take(pa.array(row[kept])), "doc": doc.take(pa.array(row[kept])), "pos": pa.array(pos[kept]),
            "d": pa.array([x.tobytes() for x in digest[kept]], pa.binary()), "m": pa.array(m, pa.int64()), "s": pa.array(score[kept], pa.int64())}))
    return pa.concat_tables(out)


def score_summary(
    df: DataFrame, key: str, doc: str, text: str, points: str, topic: str, sentiment: str
) -> DataFrame:
    """Best text by points, best per first topic, best and worst by sentiment.

    Every criterion is one ``min_by`` with map-side combine; no entity is
    sorted. A text chosen twice appears once; texts follow ``doc`` order. Topics
    an entity lacks are skipped.
    """
    least = float("-inf")
    narrow = df.where(F.col(key).isNotNull()).select(key, doc, points, topic, sentiment)
    down_points = -F.coalesce(F.col(points).cast("double"), F.lit(least))
    up = F.coalesce(F.col(sentiment).cast("double"), F.lit(float("inf")))
    down = -F.coalesce(F.col(sentiment).cast("double"), F.lit(least))
    overall = narrow.groupBy(key).agg(
        F.array(
            F.min_by(doc, F.struct(down_points, F.col(doc))),
            F.min_by(doc, F.struct(down, down_points, F.col(doc))),
            F.min_by(doc, F.struct(up, down_points, F.col(doc))),
        ).alias("_ids")
    ).select(key, F.explode("_ids").alias(doc))
    per_topic = (
        narrow.where(F.col(topic).isNotNull())
        .groupBy(key, topic)
        .agg(F.min_by(doc, F.struct(down_points, F.col(doc))).alias(doc))
        .select(key, doc)
    )
    chosen = union_all([overall, per_topic]).distinct()
    return joined_in_order(keep_in(df.select(key, doc, text), chosen, [key, doc]), key, [doc], text)

"""Training sequences filled with lexically related documents.

Documents become token ids once and are written to the shared folder, cut into
whole windows and one shorter rest. Pieces are range-partitioned by a min-hash
of their rarer tokens, so that related texts lie together, and each partition is
worked through in shards of bounded size. A shard is an inverted index with BM25
weights. A seed document takes its unused neighbours, best first, as long as
they fit; the last gap is filled with the first part of the best neighbour left.
What a shard leaves of a window moves on to the next shard, so only the last
sequence of a partition is padded.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from voxspark.llm.common import tidy
from voxspark.session import settle

K1, B = 1.2, 0.75
#: Letters that Unicode composition leaves alone, and the ASCII signs without the apostrophe.
_PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!-&(-/:-@\[-`{-~]*)$"
#: Bytes of text that are encoded together.
LOT = 16 << 20


def merger(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The vocabulary's merges for whole words, one on each line, and the id of each rank.

    The vocabulary writes bytes as visible characters and marks the last one of
    a word. Here the mark is a byte of its own, and joining it to the last byte
    comes before all merges.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    # fixed rule of byte-level vocabularies: visible bytes are their own character, the others follow from 256 on
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in visible)}
    byte = {c: b for b, c in char.items()}
    end = model["end_of_word_suffix"]

    def raw(token: str) -> bytes:
        last = token.endswith(end)
        return bytes(byte[c] for c in (token[: -len(end)] if last else token)) + (b"\0" if last else b"")

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 256 + b for b in range(256)}
    ids = [model["vocab"][char[b]] for b in range(256)] + [model["vocab"][char[b] + end] for b in range(256)]
    for pair in model["merges"]:
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        ranks[raw(a) + raw(b)] = len(ids)
        ids.append(model["vocab"][a + b])
    return tiktoken.Encoding("words", pat_str=r"[^\n]+|\n", mergeable_ranks=ranks, special_tokens={}), np.array(ids, np.int32)


@cache
def encoders(path: str) -> tuple[Tokenizer, tiktoken.Encoding, np.ndarray]:
    """The whole tokenizer, and ``merger`` of its vocabulary: read once per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return whole, *merger(path)


def _picked(flat: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` numbered ``at``, one after the other."""
    n = size[at]
    shift = start[at] - (np.cumsum(n) - n)
    return flat[np.repeat(shift, n) + np.arange(n.sum())]


class WordTokens:
    """Token ids of whole texts by the word tokenizer, for each blank-separated chunk of a lot of texts once.

    No token crosses a blank. A chunk of plain letters and trailing signs has two
    parts, as the tokenizer's own pattern cuts it; these need no normalising and
    are merged by ``merger``, all distinct ones of the lot in one call. Any other
    chunk goes through the tokenizer whole. Nothing is kept from lot to lot.
    """

    def __init__(self, path: str):
        self.whole, self.merges, self.id_of = encoders(path)

    def _merged(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain parts, one after the other, and how many each has."""
        # one piece for each line; a word ends in the mark that its last byte is merged with
        marked = pc.if_else(pc.equal(parts, ""), "", pc.binary_join_element_wise(parts, "", "\0"))
        lines = pc.binary_join_element_wise(marked, "", "\n")
        text = lines.buffers()[2].slice(0, pc.sum(pc.binary_length(lines)).as_py()).to_pybytes() if len(lines) else b""
        ranks = np.array(self.merges.encode_ordinary(text.decode("utf-8")), np.int64)
        ends = np.flatnonzero(ranks == ord("\n"))
        return self.id_of[ranks[ranks != ord("\n")]], np.diff(ends, prepend=-1) - 1

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, one after the other, and how many each has."""
        cut = pc.extract_regex(chunks, _PLAIN)
        plain = cut.is_valid().to_numpy(zero_copy_only=False)
        cut = cut.drop_null()
        words, signs = pc.utf8_lower(cut.field("word")).dictionary_encode(), cut.field("signs").dictionary_encode()
        flat, size = self._merged(pa.concat_arrays([words.dictionary, signs.dictionary]))
        other = self.whole.encode_batch_fast(chunks.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)
        whole = [e.ids for e in other]
        # parts by number: words, signs, whole chunks, and one that is empty
        size = np.concatenate([size, np.fromiter(map(len, whole), np.int64, len(whole)), [0]])
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(whole), np.int32)])
        pairs = np.full((len(chunks), 2), len(size) - 1)
        pairs[plain, 0] = words.indices.to_numpy()
        pairs[plain, 1] = signs.indices.to_numpy() + len(words.dictionary)
        pairs[~plain, 0] = len(size) - 1 - len(whole) + np.arange(len(whole))
        return _picked(flat, np.cumsum(size) - size, size, pairs.reshape(-1)), size[pairs].sum(axis=1)

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        rows = pc.ascii_split_whitespace(texts)
        chunks = rows.flatten().dictionary_encode()
        at = chunks.indices.to_numpy()
        flat, size = self._chunks(chunks.dictionary)
        ends = np.concatenate([[0], np.cumsum(size[at])])[np.cumsum(rows.value_lengths().to_numpy())]
        return _picked(flat, np.cumsum(size) - size, size, at), np.diff(ends, prepend=0)

    def __call__(self, text: str) -> np.ndarray:
        return self.many(pa.array([text]))[0]


def lots(batches: Iterator[pa.RecordBatch], most: int = LOT) -> Iterator[pa.RecordBatch]:
    """Slices of the batches: one row, and further ones of at most so many bytes of text."""
    for batch in batches:
        if batch.num_rows:
            number = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)) // most
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                yield batch.slice(lo, hi - lo)


def id_type(size: int) -> np.dtype:
    """The shortest unsigned type for ids below ``size``."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def token_pieces(docs: DataFrame, path: str, id_col: str, text_col: str, window: int, end_id: int) -> DataFrame:
    """Each document cut into whole windows and a rest: id, doc_tokens, start, n, ids (packed), near.

    ``near`` holds two min-hashes of the document's tokens. Tokens with large
    ids come late in the vocabulary and are rare, so they get the small hashes.
    Besides, one row for each task has in ``tokens`` and ``counts`` how many of
    its documents have each token and in ``chars`` the length of its texts; its
    other columns are null.
    """

    def run(batches):
        encode = WordTokens(path)
        size = max(encode.whole.get_vocab_size(), end_id + 1)
        kind = id_type(size)
        dice = (np.random.default_rng(5).exponential(size=(2, size)) / np.square(np.arange(1, size + 1))).astype(np.float32)
        order = np.argsort(dice, axis=1, kind="stable").astype(kind)
        rank = np.argsort(order, axis=1, kind="stable").astype(kind)
        seen, chars, id_kind = np.zeros(size, np.int64), 0, pa.int64()
        for part in lots(batches):
            id_kind = part.column("id").type
            chars += pc.sum(pc.utf8_length(part.column("text"))).as_py()
            flat, count = encode.many(part.column("text"))
            flat = np.insert(flat, np.cumsum(count), end_id).astype(kind)
            count += 1
            first = np.cumsum(count) - count
            # equal tokens lie together, in the order of their documents
            sort = np.argsort(flat, kind="stable")
            token, doc = flat[sort], np.repeat(np.arange(len(count)), count)[sort]
            new = np.append(True, (token[1:] != token[:-1]) | (doc[1:] != doc[:-1]))
            seen += np.bincount(token[new], minlength=size)
            near = np.stack([o[np.minimum.reduceat(r[flat], first)] for o, r in zip(order, rank)], axis=1).astype(np.int32)
            pieces = -(-count // window)
            doc = np.repeat(np.arange(len(count)), pieces)
            start = window * (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            n = np.minimum(window, count[doc] - start)
            ends = (np.append(0, np.cumsum(n)) * kind.itemsize).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
            lists = pa.ListArray.from_arrays(np.arange(0, 2 * len(n) + 1, 2, dtype=np.int32), near[doc].reshape(-1))
            none = [pa.nulls(len(n), k) for k in (ints, longs, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(doc)), pa.array(count[doc]), pa.array(start), pa.array(n), ids, lists, *none], names)
        some = np.flatnonzero(seen)
        if len(some):
            none = [pa.nulls(1, k) for k in (id_kind, pa.int64(), pa.int64(), pa.int64(), pa.binary(), ints)]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([some.tolist()], ints), pa.array([seen[some].tolist()], longs), pa.array([chars])], names)

    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    names = ["id", "doc_tokens", "start", "n", "ids", "near", "tokens", "counts", "chars"]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = dict(texts.dtypes)["id"]
    return texts.mapInArrow(
        tidy(run),
        f"id {kind}, doc_tokens long, start long, n long, ids binary, near array<int>, tokens array<int>, counts array<long>, chars long")


class Shard:
    """A BM25 index over the pieces that still have to be placed."""

    def __init__(self, pieces: list[list], idf: np.ndarray, mean_len: float):
        self.pieces = pieces
        self.left = np.array([len(p[3]) for p in pieces], np.int64)
        bags = [np.unique(p[3], return_counts=True) for p in pieces]
        sizes = [len(b[0]) for b in bags]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        terms, code = np.unique(np.concatenate([b[0] for b in bags]), return_inverse=True)
        tf = np.concatenate([b[1] for b in bags])
        weight = idf[terms][code] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * self.left[owner] / mean_len))
        self.codes = np.split(code, np.cumsum(sizes)[:-1])  # the terms of each piece, by their number
        self.terms = len(terms)
        order = np.argsort(code, kind="stable")
        order = order[weight[order] > 0]  # terms without weight change no score
        self._keep(code[order], owner[order], weight[order])

    def _keep(self, code: np.ndarray, owner: np.ndarray, weight: np.ndarray) -> None:
        self.code, self.owner, self.weight = code, owner, weight
        self.first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=self.terms))])

    def scores(self, seed: int) -> np.ndarray:
        lo = self.first[self.codes[seed]]
        n = self.first[self.codes[seed] + 1] - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.owner[at], self.weight[at], len(self.pieces))

    def shrink(self) -> None:
        """Forget the postings of pieces that are used up."""
        some = self.left[self.owner] > 0
        self._keep(self.code[some], self.owner[some], self.weight[some])


def fill(pieces: list[list], window: int, idf: np.ndarray, mean_len: float, last: bool):
    """Windows as lists of [id, doc_tokens, start, ids], and the pieces of the window left open."""
    shard = Shard(pieces, idf, mean_len)
    left, done = shard.left, 0
    for seed in np.argsort(-left, kind="stable"):
        if not left[seed]:
            continue
        row, space, ranked = [], window, None
        take = seed
        while True:
            n = min(left[take], space)
            doc, total, start, ids = pieces[take]
            row.append([doc, total, start, ids[:n]])
            pieces[take] = [doc, total, start + n, ids[n:]]
            left[take] -= n
            space -= n
            if not space:
                break
            if ranked is None:
                ranked = np.argsort(-shard.scores(seed), kind="stable")
            ranked = ranked[left[ranked] > 0]
            if not len(ranked):
                break
            whole = left[ranked] <= space
            take = ranked[whole.argmax()]
        if space and not last:
            yield None, row
            return
        yield row, None
        done += 1
        if done % 32 == 0:
            shard.shrink()
    yield None, []


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1,
    shard_tokens: int = 1 << 18, partition_chars: int = 32_000_000, with_ids: bool = True,
) -> DataFrame:
    """Pieces of sequences: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, unless left out, ids.

    Every id of every document lies in one piece, whatever repeats: rows are
    packed one by one, so equal rows or equal ids are packed as often as they
    come. A null or empty text is its end id alone, and a null id is passed on.
    Ties in a score go to the piece that comes first in its partition. An empty
    table gives no sequences; other columns are not read.
    """
    spark = docs.sparkSession
    written = settle(token_pieces(docs, path, id_col, text_col, window, end_id))
    pieces = written.where("n IS NOT NULL")
    facts = pieces.agg(F.count("*"), F.sum("n"), F.count(F.when(F.col("start") == 0, 1))).first()
    mean_len = (facts[1] or 1) / max(facts[0], 1)
    # one row per token of the vocabulary at most, which bounds what the driver takes
    per_task = written.select(F.explode(F.arrays_zip("tokens", "counts")).alias("t")).select("t.*")
    seen = per_task.groupBy("tokens").agg(F.sum("counts").alias("docs")).toPandas()
    idf = np.zeros(int(seen["tokens"].max()) + 1 if len(seen) else 1)
    idf[seen["tokens"].to_numpy(int)] = np.maximum(0, np.log((facts[2] - seen["docs"] + 0.5) / (seen["docs"] + 0.5)))
    kind = id_type(max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1))
    known = spark.sparkContext.broadcast(idf)
    chars = written.where("tokens IS NOT NULL").agg(F.sum("chars")).first()[0] or 0
    parts = int(chars // partition_chars) + 1

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32

        def table(rows):
            nonlocal number
            cols = [[] for _ in range(8)]
            for row in rows:
                at = 0
                for doc, total, start, ids in row:
                    for c, v in zip(cols, (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, number, at, ids)):
                        c.append(v)
                    at += len(ids)
                number += 1
            kinds = [id_kind, *[pa.int64()] * 6, pa.list_(pa.int32())]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            out = [pa.array(c, k) for c, k in zip(cols, kinds)]
            return pa.RecordBatch.from_arrays(out[: 8 if with_ids else 7], names[: 8 if with_ids else 7])

        held, size, id_kind = [], 0, pa.int64()

        def flush(last):
            nonlocal held, size
            ready, rest = [], []
            for row, open_ in fill(held, window, known.value, mean_len, last):
                if row is None:
                    # the open window's pieces and everything not yet placed go on
                    rest = [p for p in [*open_, *held] if len(p[3])]
                else:
                    ready.append(row)
            held, size = rest, sum(len(p[3]) for p in rest)
            return table(ready)

        for batch in batches:
            id_kind = batch.column("id").type
            whole = []
            for doc, total, start, packed in zip(*(batch.column(c).to_pylist() for c in ("id", "doc_tokens", "start", "ids"))):
                piece = [doc, total, start, np.frombuffer(packed, kind).astype(np.int32)]
                if len(piece[3]) == window:
                    whole.append([piece])
                else:
                    held.append(piece)
                    size += len(piece[3])
                    if size >= shard_tokens:
                        yield flush(False)
            if whole:
                yield table(whole)
        if held:
            yield flush(True)

    dealt = pieces.repartitionByRange(parts, "near", F.xxhash64("id", "start")).sortWithinPartitions("near", F.xxhash64("id", "start"))
    schema = f"id {dict(pieces.dtypes)['id']}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.select("id", "doc_tokens", "start", "ids").mapInArrow(tidy(run), schema + (", ids array<int>" if with_ids else ""))

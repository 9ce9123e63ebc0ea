"""Alignment of two tokenizations of the same text, by the byte offsets where their tokens end.

Texts are encoded by the public libraries, each distinct word once a task. Two
arrays of end offsets are aligned by diagonal run skipping. Which pairs of ids
are linked in how many documents is first counted in blocks of documents; the
blocks then ask only for the counts of their own pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from voxspark.llm.common import SLICE, id_and_text, in_slices
from voxspark.session import settle

#: A block of documents is closed at so many documents or entries of pairs.
BLOCK_DOCS, BLOCK_PAIRS = 2048, 1 << 19
#: Longest word that is kept in a task's cache, and the bytes of the cache.
WORD, CACHE = 64, 96 << 20
# A space between two signs that are no blanks: no token of either kind crosses it from the left.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Byte-level BPE of a ``tokenizers`` file; each word is encoded with a space before it.

    With the ``pattern`` that cuts pre-tokens given, and ids in the order of the
    merges, the same ids come from ``tiktoken``, which takes a quarter of the time.
    """

    def __init__(self, file: bytes, pattern: str | None = None):
        coder = Tokenizer.from_str(file.decode())
        coder.encode_special_tokens = True
        letters, vocabulary = byte_letters(), coder.get_vocab()
        self.bytes = [b""] * coder.get_vocab_size()
        for token, i in vocabulary.items():
            # special tokens are never met, as their strings are plain text
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        if set(letters) - set(vocabulary):
            raise ValueError("a byte-level vocabulary has a letter for every byte")
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in json.loads(file)["model"]["merges"]]
        ranks = {self.bytes[vocabulary[m]]: vocabulary[m] for m in merged} | {bytes([b]): vocabulary[c] for c, b in letters.items()}
        if pattern and sorted(ranks.values()) == list(range(256 + len(merged))) and [vocabulary[m] for m in merged] == list(range(256, 256 + len(merged))):
            encode = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.encode = lambda texts: list(map(encode, texts))
        else:
            self.encode = lambda texts: [e.ids for e in coder.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, words: list[str]) -> list[list[int]]:
        return self.encode([" " + w for w in words])


class Pieces:
    """A ``sentencepiece`` model, which puts the space itself."""

    def __init__(self, file: bytes):
        self.coder = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.bytes = []
        for i in range(self.coder.get_piece_size()):
            piece = self.coder.id_to_piece(i)
            one = _BYTE_PIECE.fullmatch(piece)
            self.bytes.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())

    def __call__(self, words: list[str]) -> list[list[int]]:
        return self.coder.encode(words, num_threads=1)


class Pair:
    """Both encoders of one task, with a cache of words: ids and sizes in bytes of their tokens, or None where bytes get lost."""

    def __init__(self, a: Callable, b: Callable):
        self.a, self.b = a, b
        self.sizes = [np.array([len(x) for x in coder.bytes], np.int32) for coder in (a, b)]
        # a piece with a space after something else would join words; A cuts words by its own pattern
        self.words = not any(b" " in x.lstrip(b" ") for x in b.bytes)
        self.cache, self.held = {}, 0

    def _encode(self, words: list[str]) -> Iterator[tuple | None]:
        """Bytes of the two id arrays of each word. A, which has a letter for every byte, loses none; B is read back."""
        piece = self.b.bytes.__getitem__
        for word, x, y in zip(words, self.a(words), self.b(words)):
            same = b"".join(map(piece, y)) == (" " + word).encode()
            yield (array("i", x).tobytes(), array("i", y).tobytes()) if same else None

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(ids of A, ids of B) of space and text, or None for an empty text and one whose bytes differ."""
        split = [(_CUT.split(t) if self.words else [t]) if t else [] for t in texts]
        if self.held > CACHE:
            self.cache, self.held = {}, 0
        fresh = list(set().union(*split).difference(self.cache))
        self.cache.update(zip(fresh, self._encode(fresh)))
        out, known = [], self.cache.__getitem__
        for words in split:
            got = list(map(known, words))
            if not got or None in got:
                out.append(None)
                continue
            first, second = zip(*got)
            out.append((np.frombuffer(b"".join(first), np.int32), np.frombuffer(b"".join(second), np.int32)))
        for word in fresh:
            if len(word) > WORD:
                del self.cache[word]
            else:
                self.held += 320 + 8 * len(word)
        return out


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two rising arrays (int32) with the same last value.

    Returns the numbers of the A and of the B tokens that end a group, and the
    A and B numbers of each link. At the present index shift a stretch of equal
    ends is probed in steps that double, its end is found by halving, and the
    whole stretch is jumped. Between stretches the token that ends first is
    passed until both end together, which changes the shift.
    """
    n, m = len(ends_a), len(ends_b)
    raw_a, raw_b, at_a, at_b = ends_a.tobytes(), ends_b.tobytes(), ends_a.tolist(), ends_b.tolist()
    runs, odd_a, odd_b, close_a, close_b = [], [], [], [], []
    i = j = 0
    while i < n:
        if at_a[i] == at_b[j]:
            k, most = 1, min(n - i, m - j)
            while k < most and raw_a[4 * (i + k) : 4 * (i + min(2 * k, most))] == raw_b[4 * (j + k) : 4 * (j + min(2 * k, most))]:
                k = min(2 * k, most)
            step = min(k, most - k)
            while step > 1:
                half = step // 2
                if raw_a[4 * (i + k) : 4 * (i + k + half)] == raw_b[4 * (j + k) : 4 * (j + k + half)]:
                    k, step = k + half, step - half
                else:
                    step = half
            runs.append((i, j, k))
            i, j = i + k, j + k
            continue
        while at_a[i] != at_b[j]:
            odd_a.append(i)
            odd_b.append(j)
            if at_a[i] < at_b[j]:
                i += 1
            else:
                j += 1
        odd_a.append(i)
        odd_b.append(j)
        close_a.append(i)
        close_b.append(j)
        i, j = i + 1, j + 1
    start_a, start_b, size = (np.array(x, np.int64) for x in zip(*runs)) if runs else (np.empty(0, np.int64),) * 3
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    run_a, run_b = np.repeat(start_a, size) + within, np.repeat(start_b, size) + within
    both = lambda x, y: np.concatenate([x, np.array(y, np.int64)])
    return np.sort(both(run_a, close_a)), np.sort(both(run_b, close_b)), both(run_a, odd_a), both(run_b, odd_b)


class Writer:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``: every id with the sign that follows it, from one table."""

    def __init__(self, ids: int):
        self.table = [f"{i}{sign}" for i in range(ids) for sign in ",|;"]

    def __call__(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
        after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after_a[group_a], after_b[group_b] = 1, 2
        # a token of A stands behind the B tokens of earlier groups, one of B behind the A tokens of its own group too
        ends_a, ends_b = np.append(-1, group_a), np.append(-1, group_b)
        group_of_a = np.searchsorted(group_a, np.arange(len(a)))
        group_of_b = np.searchsorted(group_b, np.arange(len(b)))
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + ends_b[group_of_a] + 1] = a.astype(np.int64) * 3 + after_a
        out[np.arange(len(b)) + ends_a[group_of_b + 1] + 1] = b.astype(np.int64) * 3 + after_b
        return "".join(map(self.table.__getitem__, out.tolist()))[:-1]


_ROW = "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, block string, codes array<int>, times array<int>"


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *rows]).astype(np.int32))


def _aligned(texts: DataFrame, file_a: bytes, file_b: bytes, size_b: int, pattern: str | None) -> DataFrame:
    """One row per document, and after each block one (``n_a`` null) that counts the block's documents per pair."""

    files = texts.sparkSession.sparkContext.broadcast((file_a, file_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair = Pair(ByteLevel(files.value[0], pattern), Pieces(files.value[1]))
        writer = Writer(max(len(pair.a.bytes), len(pair.b.bytes)))
        task, block, docs, entries, held, empty = TaskContext.get().partitionId(), 0, 0, 0, [], np.empty(0, np.int32)

        def counted() -> tuple[np.ndarray, np.ndarray]:
            codes, n = np.unique(np.concatenate(held), return_counts=True) if held else (empty, empty)
            return codes, n

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "codes", "times"]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)] + [_lists(cols[7]), _lists(cols[8])], names)

        for part in in_slices(batches, SLICE):
            rows, ids = [], part.column("id").to_pylist()
            for i, got in zip(ids, pair(part.column("text").to_pylist())):
                name = f"{task}-{block}"
                if got is None:
                    rows.append((i, 0, 0, 0, 0, "", name, empty, empty))
                else:
                    a, b = got
                    group_a, group_b, link_a, link_b = align(
                        np.cumsum(pair.sizes[0][a], dtype=np.int32), np.cumsum(pair.sizes[1][b], dtype=np.int32))
                    digest = hashlib.sha256(writer(a, b, group_a, group_b).encode()).hexdigest()
                    codes, times = np.unique(a[link_a] * np.int32(size_b) + b[link_b], return_counts=True)
                    rows.append((i, len(a), len(b), len(group_a), len(link_a), digest, name, codes, times))
                    held.append(codes)
                    entries += len(codes)
                docs += 1
                if docs >= BLOCK_DOCS or entries >= BLOCK_PAIRS:
                    rows.append((None, None, None, None, None, None, name, *counted()))
                    block, docs, entries = block + 1, 0, 0
                    held.clear()
            yield out(rows)
        yield out([(None, None, None, None, None, None, f"{task}-{block}", *counted())])

    return texts.mapInArrow(run, _ROW)


def _looked_up(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The sums of one block's documents over the counts of the block's pairs."""
    code = counts.column("code").to_numpy()
    order = np.argsort(code)
    code = code[order]
    best, total = counts.column("best").to_numpy()[order].astype(np.int64), counts.column("n_docs").to_numpy()[order]
    codes, times = (docs.column(c).combine_chunks() for c in ("codes", "times"))
    ends = codes.offsets.to_numpy().astype(np.int64) - codes.offsets[0].as_py()
    at, n = np.searchsorted(code, codes.flatten().to_numpy()), times.flatten().to_numpy().astype(np.int64)
    sums = [np.concatenate([[0], np.cumsum(x[at] * n)]) if len(code) else np.zeros(len(n) + 1, np.int64) for x in (best, total)]
    kept = docs.select(["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    for name, s in zip(("n_best", "count_sum"), sums):
        kept = kept.append_column(name, pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()))
    return kept


def align_tokens(
    docs: DataFrame, path_a: str, path_b: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row.

    A is a byte-level BPE file (``pattern``: what cuts its pre-tokens, see
    ``ByteLevel``), B a piece model; both encode a space and the
    whole text without special tokens. Groups are cut where tokens of both end;
    a link is a pair of tokens whose bytes overlap. ``count_sum`` adds up, over
    a row's links, how many rows of the table hold the id pair linked;
    ``n_best`` counts the links whose number is the largest of their A id. A
    null or empty text, and one that either side does not give back byte by
    byte, has zeros and an empty digest. Ids may be null or repeat, every row
    counts by itself; no rows give none; no other column is read.
    """
    file_a, file_b = (Path(p).read_bytes() for p in (path_a, path_b))
    size_b = len(Pieces(file_b).bytes)
    if size_b * len(ByteLevel(file_a).bytes) >= 1 << 31:
        raise ValueError("id pairs of these vocabularies do not fit 31 bits")
    rows = settle(_aligned(id_and_text(docs, id_col, text_col), file_a, file_b, size_b, pattern))
    blocks = rows.where("n_a IS NULL").select(F.col("block").alias("asking"), F.inline(F.arrays_zip(F.col("codes").alias("code"), F.col("times").alias("n"))))
    totals = blocks.groupBy("code").agg(F.sum("n").alias("n_docs"))
    # an A id has at most as many pairs as B has ids
    by_a = Window.partitionBy(F.floor(F.col("code") / size_b))
    totals = totals.withColumn("best", F.col("n_docs") == F.max("n_docs").over(by_a))
    counts = blocks.select("asking", "code").join(totals, "code")
    return rows.where("n_a IS NOT NULL").groupBy("block").cogroup(counts.groupBy("asking")).applyInArrow(
        _looked_up, "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint")

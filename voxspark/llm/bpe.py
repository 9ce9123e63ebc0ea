"""Byte-level BPE in two tiers, from a public rank file.

Whole pre-tokens that are in the vocabulary are resolved by a minimal perfect
hash. The others are merged with a heap over linked bytes. Blanks bind to what
follows, so a text is cut before each single space that a non-blank follows and
every distinct cut is encoded once per task.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxspark.llm.common import Memo, per_slice

#: A space starts a new piece exactly if no blank follows it and the text goes on.
_SPLITTABLE = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
# Fixed value: the pattern of byte-level vocabularies whose cuts are known without it for letters and signs.
_COMMON = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class MinimalHash:
    """Hash and displace: every one of n keys has its own slot of n.

    Buckets are placed from the largest; the keys of buckets with one member
    fill what is left over. A key outside the set lands on some slot too, so the
    caller compares it with the key kept there.
    """

    def __init__(self, slots: list[bytes], shift: list[int]):
        self.slots, self.shift, self.n, self.buckets = slots, shift, len(slots), len(shift)

    @classmethod
    def build(cls, keys: list[bytes]) -> MinimalHash:
        self = cls([None] * len(keys), [0] * (len(keys) // 2 + 1))
        groups: dict[int, list[tuple[int, int, bytes]]] = {}
        for key in keys:
            bucket, f, g = self._parts(key)
            groups.setdefault(bucket, []).append((f, g, key))
        slots, free = self.slots, 0
        for bucket, group in sorted(groups.items(), key=lambda x: -len(x[1])):
            if len(group) > 1:
                d = 0
                while True:
                    at = [self._slot(f, g, d) for f, g, _ in group]
                    if len(set(at)) == len(at) and all(slots[i] is None for i in at):
                        break
                    d += 1
            else:
                while slots[free] is not None:
                    free += 1
                at, d = [free], -1 - free
            self.shift[bucket] = d
            for i, (_, _, key) in zip(at, group):
                slots[i] = key
        return self

    def _parts(self, key: bytes) -> tuple[int, int, int]:
        x = xxhash.xxh3_128_intdigest(key)
        return (x >> 64) % self.buckets, x & 0xFFFFFFFF, x >> 32 & 0xFFFFFFFF

    def _slot(self, f: int, g: int, d: int) -> int:
        return ((f + d * g) & 0xFFFFFFFF) * self.n >> 32

    def find(self, key: bytes) -> int:
        """The slot of ``key``, or -1 if it is not one of the keys."""
        bucket, f, g = self._parts(key)
        d = self.shift[bucket]
        at = -1 - d if d < 0 else self._slot(f, g, d)
        return at if self.slots[at] == key else -1


class TwoTier:
    """The coder of one task, with caches of the cuts and pre-tokens it has met."""

    def __init__(self, table: MinimalHash, ranks: dict[bytes, int], pattern: str):
        self.table, self.ranks = table, ranks
        self.id_at = [ranks[key] for key in table.slots]
        self.findall = regex.compile(pattern).findall
        self.pieces = Memo(self._piece)
        self.chunks = Memo(self._chunk)
        self.known_cuts = pattern == _COMMON
        keys = sorted(ranks, key=ranks.get)
        size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        size[[ranks[k] for k in keys]] = [len(k) for k in keys]
        # all tokens in one array, by rank, and where each begins
        self.raw, self.size, self.start = np.frombuffer(b"".join(keys), np.uint8), size, np.cumsum(size) - size

    def _piece(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8")
        at = self.table.find(raw)
        return [self.id_at[at]] if at >= 0 else self.merge(raw)

    def merge(self, raw: bytes) -> list[int]:
        """Join the neighbours of lowest rank, leftmost first, until no pair is a token."""
        n, rank_of = len(raw), self.ranks.get
        after, before = list(range(1, n + 2)), list(range(-1, n))
        rank = [rank_of(raw[i : i + 2], -1) if i < n - 1 else -1 for i in range(n)]
        heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if rank[i] != r:
                continue
            gone = after[i]
            end = after[gone]
            after[i], rank[gone] = end, -2
            if end < n:
                before[end] = i
                rank[i] = rank_of(raw[i : after[end]], -1)
                if rank[i] >= 0:
                    heapq.heappush(heap, rank[i] << 32 | i)
            else:
                rank[i] = -1
            p = before[i]
            if p >= 0:
                rank[p] = rank_of(raw[p:end], -1)
                if rank[p] >= 0:
                    heapq.heappush(heap, rank[p] << 32 | p)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[raw[i : after[i]]])
            i = after[i]
        return ids

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk. Letters with signs behind are two pieces (an apostrophe may begin a piece of its own kind)."""
        word = chunk.rstrip(_SIGNS)
        if self.known_cuts and word.lstrip(" ").isalpha() and len(word) - len(word.lstrip(" ")) < 2:
            ids = self.pieces[word] if len(word) == len(chunk) else self.pieces[word] + self.pieces[chunk[len(word) :]]
        else:
            ids = [x for piece in self.findall(chunk) for x in self.pieces[piece]]
        return array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if _SPLITTABLE.search(text):
            parts = [text[a:b] for a, b in _bounds(text)]
        else:
            first, *rest = text.split(" ")
            parts = [first, *[" " + x for x in rest]]
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, parts)), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes, gathered from one array."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.raw[np.repeat(self.start[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


def _bounds(text: str):
    at = 0
    for m in _CUT.finditer(text):
        yield at, m.start()
        at = m.start()
    yield at, len(text)


def _shared(spark: SparkSession, path: str, pattern: str):
    """Makes the coder in a task; the vocabulary travels as plain values, once per executor."""
    ranks = read_ranks(path)
    table = MinimalHash.build(list(ranks))
    plain = spark.sparkContext.broadcast((table.slots, table.shift, ranks))

    def make() -> TwoTier:
        slots, shift, ranks = plain.value
        return TwoTier(MinimalHash(slots, shift), ranks, pattern)

    return make


def encode_texts(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False,
) -> DataFrame:
    """id, ids (array of int) for every row; a null or empty text has no ids.

    With ``decoded`` the ids are decoded again in the same pass, see ``decode_ids``.

    Ids may be null or repeat and are only passed on; no other column is read.
    Special tokens are not recognised: their strings are ordinary text.
    """
    make = _shared(docs.sparkSession, path, pattern)

    def work():
        coder = make()

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [coder.encode(t) for t in part.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            out = [part.column("id"), pa.ListArray.from_arrays(ends, np.concatenate(rows))]
            if decoded:
                out.append(pa.array(map(coder.decode, rows), pa.binary()))
            return pa.RecordBatch.from_arrays(out, ["id", "ids", "decoded"][: len(out)])

        return step

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = dict(texts.dtypes)["id"]
    return per_slice(texts, work, f"id {kind}, ids array<int>, decoded binary" if decoded else f"id {kind}, ids array<int>")


def decode_ids(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """id, ids and ``decoded``, the bytes of the ids; null ids decode to nothing."""
    make = _shared(rows.sparkSession, path, pattern)

    def work():
        coder = make()

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            ids = part.column("ids").fill_null([]) if part.column("ids").null_count else part.column("ids")
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *(len(x) for x in ids)])
            out = [coder.decode(flat[a:b]) for a, b in zip(ends, ends[1:])]
            return pa.RecordBatch.from_arrays([part.column("id"), part.column("ids"), pa.array(out, pa.binary())], ["id", "ids", "decoded"])

        return step

    return per_slice(rows.select("id", "ids"), work, f"id {dict(rows.dtypes)['id']}, ids array<int>, decoded binary")

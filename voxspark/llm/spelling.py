"""Spelling variants: words one edit apart, found with search schemes over FM-indexes.

Two words that differ by one edit agree exactly on the first or on the second
half of either. So every word is sent to the shards that hold the words with its
first half, and to those with its second half. A shard indexes its words, set
apart by delimiters, matches the exact half letter by letter and extends across
the other half, allowing one error. The state of a search is the range of
suffixes that begin with what was matched so far.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voxspark.llm.common import id_and_text, in_slices
from voxspark.operators.joins import lookup_join
from voxspark.session import by_key, settle

#: Words of a shard, and words with one half that are kept together; more are dealt out by a hash.
SHARD, TOGETHER = 1 << 14, 1 << 13
#: Distinct words held by a counting task before they are passed on.
HELD = 1 << 18


def count_runs(docs: DataFrame, pattern: str, id_col: str = "doc_id", text_col: str = "text", typo_every: int = 0) -> DataFrame:
    """word, n: the maximal runs of ``pattern`` in whole texts with A-Z in lower case, and how often each occurs.

    With ``typo_every`` set, a run of a document loses one code point where that
    number divides crc32 of ``<id>:<run>``: the one at crc32 modulo its length.
    Null and empty texts hold no words; repeated rows count each time; a null
    id is written as nothing. A task passes its counts on whenever it holds
    ``HELD`` words, and they are summed by word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = re.compile(pattern).findall, Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for part in in_slices(batches):
            for i, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                found = find(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                if not typo_every:
                    counts.update(found)
                    continue
                start = zlib.crc32(b":" if i is None else b"%d:" % i)
                for word, n in Counter(found).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % typo_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    counts[word] += n
            if len(counts) >= HELD:
                yield flush()
        yield flush()

    texts = id_and_text(docs, id_col, text_col)
    return texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """An FM-index over the cyclic text ``w1$w2$..wk$``, letters as small numbers and 0 for the delimiter.

    The positions of the transform are kept sorted by letter. Those of one
    letter lie together, so a binary search counts the ones before a position,
    and that count is also the step to the suffix one letter longer.
    """

    def __init__(self, codes: np.ndarray, letters: int):
        self.order = _suffixes(codes)
        self.bwt = codes[self.order - 1]
        self.n, self.letters = len(codes), letters
        self.keys = np.sort(self.bwt * self.n + np.arange(self.n))

    def step(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges after one more letter to the left."""
        at = letter * self.n
        return np.searchsorted(self.keys, at + lo), np.searchsorted(self.keys, at + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(range number, letter) of the letters to the left of each range: read from short ranges, all of them for long ones."""
        size, states = hi - lo, np.arange(len(lo))
        short = size <= self.letters
        s = np.repeat(states[short], size[short])
        within = np.arange(len(s)) - np.repeat(np.cumsum(size[short]) - size[short], size[short])
        read = np.unique(s * self.letters + self.bwt[np.repeat(lo[short], size[short]) + within])
        every = (states[~short][:, None] * self.letters + np.arange(self.letters)).ravel()
        both = np.concatenate([read, every])
        return both // self.letters, both % self.letters


def _suffixes(codes: np.ndarray) -> np.ndarray:
    """The order of all cyclic suffixes, by doubling; different words tell them apart."""
    n, k = len(codes), 1
    rank = codes
    while True:
        key = rank * (n + 1) + np.roll(rank, -k)
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


def _points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)


def near_pairs(texts: list[str], queries: list[str], free: np.ndarray) -> np.ndarray:
    """(query, text) numbers, in rows, of words one edit apart, the edit within the query's first ``free`` letters.

    ``texts`` are distinct. The rest of a query is matched exactly, from its
    end. One edit in a run of equal letters is tried at the end of the run and
    at the middle of the word only, so that long runs make no more states.
    """
    points, sizes = _points(texts), np.array([len(w) for w in texts], np.int64)
    alphabet = np.unique(points)
    ends = np.cumsum(sizes + 1) - 1
    codes = np.zeros(len(points) + len(texts), np.int64)
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = np.searchsorted(alphabet, points) + 1
    index = Vocabulary(codes, len(alphabet) + 1)
    follows = np.full(len(codes), -1, np.int64)
    follows[np.roll(ends, 1)] = np.arange(len(texts))

    asked, m = _points(queries), np.array([len(w) for w in queries], np.int64)
    code = np.minimum(np.searchsorted(alphabet, asked), len(alphabet) - 1)
    # a letter that no text has gets a number that is never found
    code, base = np.where(alphabet[code] == asked, code + 1, len(alphabet) + 1), np.cumsum(m) - m

    def go_on(q, left, lo, hi):
        lo, hi = index.step(lo, hi, code[base[q] + left - 1])
        on = hi > lo
        return q[on], left[on] - 1, lo[on], hi[on]

    # a state: query, number of letters not yet matched, suffix range
    q = np.arange(len(queries))
    right = (q, m, *index.step(np.zeros_like(q), np.full_like(q, index.n), np.zeros_like(q)))
    wrong, found = (q[:0],) * 4, []
    while len(right[0]) or len(wrong[0]):
        q, left, lo, hi = (x[right[1] <= free[right[0]]] for x in right)
        before, first = code[base[q] + left], left == free[q]
        now = np.where(left > 0, code[base[q] + np.maximum(left - 1, 0)], -1)
        drop = (left > 0) & (first | (now != before))
        s, c = index.branches(lo, hi)
        s, c = s[c > 0], c[c > 0]
        a, b = index.step(lo[s], hi[s], c)
        some = b > a
        swap = some & (left[s] > 0) & (c != now[s])
        put = some & (first[s] | (c != before[s]))
        born = [
            (q[drop], left[drop] - 1, lo[drop], hi[drop]), (q[s[swap]], left[s[swap]] - 1, a[swap], b[swap]),
            (q[s[put]], left[s[put]], a[put], b[put])]
        over = wrong[1] == 0
        q, _, lo, hi = (x[over] for x in wrong)
        a, b = index.step(lo, hi, np.zeros_like(q))
        # between delimiters there is one word at most
        found.append(np.stack([q[b > a], follows[index.order[a[b > a]]]], axis=1))
        wrong = go_on(*(x[~over] for x in wrong))
        wrong = tuple(np.concatenate(x) for x in zip(wrong, *born))
        right = go_on(*(x[right[1] > 0] for x in right))
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)


def _search(table: pa.Table) -> pa.Table:
    """Near pairs within one shard, whose words are read backwards if their first halves are the equal ones."""
    forward = table.column("front")[0].as_py()
    turn = (lambda w: w[::-1]) if forward else (lambda w: w)
    word, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    asks = table.column("asks").to_numpy()
    texts = {word[i]: int(n[i]) for i in np.flatnonzero(~asks)}
    queries = list(dict.fromkeys(word[i] for i in np.flatnonzero(asks)))
    pairs = np.empty((0, 2), np.int64)
    if texts and queries:
        size = np.array([len(w) for w in queries], np.int64)
        pairs = near_pairs(list(map(turn, texts)), list(map(turn, queries)), size - size // 2 if forward else size // 2)
    names, counts = pa.array(list(texts), pa.string()), pa.array(list(texts.values()), pa.int64())
    return pa.table({
        "word": pa.array(queries, pa.string()).take(pa.array(pairs[:, 0])), "near": names.take(pa.array(pairs[:, 1])),
        "near_n": counts.take(pa.array(pairs[:, 1]))})


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: all pairs of the distinct ``words`` (word, n) that differ by one code point inserted, deleted or replaced.

    Both orders of a pair come out. Words of fewer than two code points are not
    compared, nor are null ones. ``words`` should be a written table, it is read several times.
    """
    size, tasks = F.length("word"), max(1, -(-2 * words.count() // SHARD))
    words = words.where(size > 1)

    def placed(front: bool, asks: bool) -> DataFrame:
        """Queries by their own half, texts by the halves that a word of one letter less, as many or one more would have."""
        others = F.array(size) if asks else F.filter(F.array(size - 1, size, size + 1), lambda m: m > 1)
        half = F.explode(F.array_distinct(F.transform(others, lambda m: (F.floor(m / 2) if front else m - F.floor(m / 2)).cast("int"))))
        key = F.left("word", F.col("half")) if front else F.right("word", F.col("half"))
        return words.select("word", "n", half.alias("half")).select(
            "word", "n", F.lit(front).alias("front"), F.lit(asks).alias("asks"), F.xxhash64(F.lit(front), key).alias("key"))

    texts, asked = placed(True, False).union(placed(False, False)), placed(True, True).union(placed(False, True))
    many = texts.groupBy("key").count().where(F.col("count") > TOGETHER).select("key", F.ceil(F.col("count") / TOGETHER).cast("int").alias("lots"))
    rows = lookup_join(texts.union(asked), settle(many), "key").withColumn("lots", F.coalesce("lots", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("word"), F.col("lots")).cast("int"))
    lot = F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("lots") - 1)).otherwise(own))
    dealt = rows.withColumn("lot", lot).select(
        "word", "n", "front", "asks", F.pmod(F.xxhash64("key", "lot"), F.lit(tasks)).alias("shard"))
    pairs = dealt.groupBy("front", "shard").applyInArrow(_search, "word string, near string, near_n bigint")
    return by_key(pairs, "word").dropDuplicates(["word", "near"])


def variants(words: DataFrame, least_ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n, root for distinct ``words`` (word, n).

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if that is at least ``least_ratio`` times the word's own, else null.
    ``root`` follows the forms to the last. As n grows by that ratio with every
    step, a chain has no cycle and few steps, which are doubled each round. No
    words give no rows.
    """
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    strong = -F.col("best.n") >= least_ratio * F.col("n")
    formed = settle(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.n")).alias("form_n")))
    up, moved = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), True
    while moved:
        higher = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        up = settle(up.join(higher, "root", "left").select(
            "word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")))
        moved = not up.where("moved").isEmpty()
        up = up.select("word", "root")
    return formed.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))

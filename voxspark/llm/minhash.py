"""Near-duplicate documents by b-bit MinHash.

Each text gives ``HASHES`` minima. Rows of minima make band keys, which find
candidates; of a mixed hash of each minimum only the low ``BITS`` bits are kept,
packed into longs. For a candidate pair, equal lanes are counted with bit
operations and the similarity is estimated with the chance agreement of b bits
taken out. Pairs whose estimate could belong to a true link are confirmed on
their full sets. Sets below ``SMALL`` shingles are never estimated: their pairs
are compared on the full sets at once.

At a similarity of 0.75 a pair shares a band with a chance of 1 - 5e-6, and a
true pair of larger sets falls below the estimate's floor (five standard
deviations) with a chance of about 1e-6. Exact copies form one class and never
meet as pairs. Each member of a band's bucket is first compared with one pivot.
What is still unconnected is compared with all of the bucket's other components,
so nothing is lost, but members of one component never meet again: a large group
of near copies costs pairs in proportion to its size and to what stays outside.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxspark.llm.common import id_and_text, per_slice
from voxspark.llm.graph import components
from voxspark.llm.shingles import Shingler, mixed
from voxspark.session import settle

HASHES, BAND_ROWS, BITS = 128, 4, 2
BANDS = HASHES // BAND_ROWS
#: One-bit minima of the finer signature, made only for documents that are still in question.
FINE = 1024
#: Pairs of sets that are both smaller are compared exactly, without a signature.
SMALL = 86
#: Bits of the filter that keeps texts in their place when no candidate needs them: half a million longs at most.
FILTER = 1 << 25
_ODD_LANES = 0x5555555555555555


class Signer:
    def __init__(self, hashes: int = HASHES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, hashes, dtype=np.uint32)[:, None]
        self.salt = rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)
        self.lane_salt = rng.integers(0, 1 << 63, hashes, dtype=np.uint64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        step = max(1, (1 << 18) // len(self.a))
        for at in range(0, len(x), step):
            np.minimum(low, (x[at : at + step] * self.a + self.b).min(axis=1), out=low)
        return low

    def lanes(self, minima: np.ndarray) -> np.ndarray:
        """(documents, hashes) bits of a mixed hash; the low bits of a minimum itself only repeat those of its shingle."""
        return (mixed(minima.astype(np.uint64) + self.lane_salt) >> np.uint64(8)).astype(np.uint32)

    def bands(self, minima: np.ndarray) -> np.ndarray:
        """(documents, BANDS) keys of the full minima."""
        rows = minima.reshape(len(minima), BANDS, BAND_ROWS).astype(np.uint64)
        key = np.broadcast_to(self.salt, rows.shape[:2]).copy()
        for j in range(BAND_ROWS):
            key = mixed(key + rows[:, :, j])
        return key.view(np.int64)


def _packed(minima: np.ndarray, bits: int) -> np.ndarray:
    """(documents, hashes * bits / 64) longs of the minima's low bits."""
    lanes = 64 // bits
    low = (minima & np.uint32((1 << bits) - 1)).astype(np.uint64).reshape(len(minima), -1, lanes)
    return (low << (np.arange(lanes, dtype=np.uint64) * np.uint64(bits))).sum(axis=2, dtype=np.uint64).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    """A list array from the rows of a matrix."""
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, values.reshape(-1))


def signatures(texts: DataFrame, width: int = 5) -> DataFrame:
    """id, n (set size), d1 and d2 (digest of the set), sig and bands (both null without words)."""

    def work():
        shingler, signer = Shingler(width), Signer()

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingler(t) for t in part.column("text").to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            none = n == 0
            minima = np.stack([signer.minima(s) for s in sets])
            digest = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets])
            sig, bands = _lists(_packed(signer.lanes(minima), BITS)), _lists(signer.bands(minima))
            return pa.RecordBatch.from_arrays([
                part.column("id"), pa.array(n), pa.array(digest[:, 0], mask=none), pa.array(digest[:, 1], mask=none),
                sig, bands,
            ], ["id", "n", "d1", "d2", "sig", "bands"])

        return step

    return per_slice(texts, work, "id long, n long, d1 long, d2 long, sig array<long>, bands array<long>")


def shingle_sets(texts: DataFrame, width: int = 5) -> DataFrame:
    """id, d1, d2 and the sorted distinct shingle hashes; further columns of longs are passed on."""
    more = [c for c in texts.columns if c not in ("id", "text")]

    def work():
        shingler = Shingler(width)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingler(t) for t in part.column("text").to_pylist()]
            digest = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets])
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = pa.ListArray.from_arrays(ends, np.concatenate(sets).view(np.int64))
            return pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(digest[:, 0]), pa.array(digest[:, 1]), flat, *map(part.column, more)],
                ["id", "d1", "d2", "shingles", *more])

        return step

    return per_slice(texts, work, ", ".join(["id long, d1 long, d2 long, shingles array<long>", *(f"{c} long" for c in more)]))


def equal_lanes(a: Column, b: Column, hashes: int = HASHES, bits: int = BITS) -> Column:
    """How many of the low-bit lanes agree (lanes of one or two bits)."""
    off = F.lit(0)
    for i in range(hashes * bits // 64):
        x = a[i].bitwiseXOR(b[i])
        off = off + F.bit_count(x if bits == 1 else x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_ODD_LANES)))
    return F.lit(hashes) - off


def estimate(equal: Column, hashes: int = HASHES, bits: int = BITS) -> Column:
    """Similarity with the chance agreement of the low bits taken out."""
    chance = 2.0 ** -bits
    return (equal / F.lit(float(hashes)) - chance) / (1 - chance)


def floor_of(threshold: float, hashes: int = HASHES, bits: int = BITS, deviations: float = 5.0) -> float:
    """The estimate that a pair at the threshold falls below only beyond so many standard deviations."""
    chance = 2.0 ** -bits
    p = threshold + (1 - threshold) * chance
    return threshold - deviations * math.sqrt(p * (1 - p) / hashes) / (1 - chance)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, class_id, component_id, kept.

    ``class_id`` is the smallest id with the same set, ``component_id`` the
    smallest id reachable by links, ``kept`` marks it. A null or blank text has
    an empty set and is its own component. A row with a null id is linked with
    nothing and kept. Rows that share an id are one node per distinct set. Other
    columns are not read; an empty table gives an empty result.
    """
    texts = id_and_text(docs, id_col, text_col)
    rows = settle(signatures(texts, width))
    one = rows.where("n > 0 AND id IS NOT NULL")
    classes = settle(one.groupBy("d1", "d2").agg(F.min(F.struct("id", "n", "sig", "bands")).alias("r")).select(
        "d1", "d2", F.col("r.id").alias("node"), "r.n", "r.sig", "r.bands"))
    # every band moves once: a window needs no second pass to join what an aggregate has found
    same = Window.partitionBy("key")
    bands = classes.select(F.explode("bands").alias("key"), "node").select(
        "key", "node", F.min("node").over(same).alias("pivot"), F.max("node").over(same).alias("high"))
    members = settle(bands.where("pivot < high").drop("high"))
    facts = settle(classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "n", "sig", "d1", "d2"))
    sets = _opened(texts, facts, width)
    info = facts.select("node", "n", "sig")

    def plausible(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(info.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a")
        pairs = pairs.join(info.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b")
        return pairs.where(_may_link("na", "nb", "sa", "sb", percent)).select("a", "b")

    def confirmed(pairs: DataFrame, many: bool = False) -> DataFrame:
        # written first: a few pairs then travel to the sets, not the sets to them;
        # many, as many as there are members, are never broadcast
        pairs = settle(pairs)
        pairs = (pairs.hint("merge") if many else pairs).join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        pairs = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        both = F.size(F.array_intersect("x", "y"))
        return settle(pairs.select("a", "b", both.alias("i"), (F.size("x") + F.size("y") - both).alias("u")).where(
            F.col("i") * 100 >= F.col("u") * percent).select("a", "b").distinct())

    def ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
        return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a < b").distinct()

    # one pivot for each member: a group of near copies gives as many pairs as it has members
    first = members.groupBy("node").agg(F.min("pivot").alias("pivot"))
    links = confirmed(plausible(ordered(first, "node", "pivot")), many=True)
    parts = components(links)
    links = links.union(confirmed(_across(_open_members(members, parts), sets, percent)))
    parts = components(links)
    parts = settle(parts)
    named = classes.select("d1", "d2", "node").join(parts, "node", "left").select(
        "d1", "d2", F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component_id"))
    own = F.col("id").isNull() | F.col("class_id").isNull()
    return rows.join(named, ["d1", "d2"], "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(own, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("id").isNull() | (F.col("id") == F.col("component_id")))


def _sifted(rows: DataFrame, ids: DataFrame, bits: int = FILTER) -> DataFrame:
    """The rows whose first column may be one of ``ids``, without moving any.

    A bitmap of the ids' hashes goes to the rows, words of 64 bits as rows. No
    wanted row is lost; of the others stays the share of bits that are set.
    """
    bit = F.pmod(F.xxhash64(rows.columns[0]), F.lit(bits))
    one = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
    words = ids.toDF(rows.columns[0]).select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("set"))
    near = rows.withColumn("bit", bit).join(F.broadcast(words), F.shiftright("bit", 6) == F.col("word"))
    return near.where(F.getbit("set", F.col("bit").bitwiseAND(F.lit(63))) == 1).select(*rows.columns)


def _opened(texts: DataFrame, facts: DataFrame, width: int) -> DataFrame:
    """node and shingles of the rows that stand for their class.

    A row is told by its id and the digest of its set. Only where several sets
    share a node, the sets themselves move to the digests.
    """
    wanted = facts.groupBy(F.col("node").alias("id")).agg(F.count("*").alias("m"), F.min("d1").alias("e1"), F.min("d2").alias("e2"))
    # the documents to open grow with the corpus, so they are never broadcast
    rows = _sifted(texts, facts.select("node")).join(wanted.hint("merge"), "id")
    found = settle(shingle_sets(rows, width).where("m > 1 OR (d1 = e1 AND d2 = e2)").select("id", "m", "d1", "d2", "shingles"))
    several = found.where("m > 1").join(facts.select("d1", "d2", "node"), ["d1", "d2"]).where("id = node")
    return found.where("m = 1").select(F.col("id").alias("node"), "shingles").union(settle(several.select("node", "shingles")))


def _may_link(na: str, nb: str, sa: str, sb: str, percent: int) -> Column:
    sizes = F.least(na, nb) * 100 >= F.greatest(na, nb) * percent
    small = F.greatest(na, nb) < SMALL
    return sizes & (small | (estimate(equal_lanes(F.col(sa), F.col(sb))) >= floor_of(percent / 100)))


def _open_members(members: DataFrame, parts: DataFrame) -> DataFrame:
    """key, node, part of the buckets whose members are not yet all connected."""
    own = members.select("key", "node").join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    split = own.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    return settle(own.join(split, "key", "left_semi"))


def _fine_facts(sets: DataFrame) -> DataFrame:
    """node, n, common and fine of each set.

    ``common`` is the number of its shingles that another of these sets has too;
    no pair can share more, also if there are more sets than pairs need. ``fine`` packs one mixed bit for each of FINE minima.
    """
    def work():
        signer = Signer(hashes=FINE, seed=23)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [np.asarray(x.values).view(np.uint64) for x in part.column("shingles")]
            minima = np.stack([signer.minima(x) for x in rows])
            return pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([len(x) for x in rows], pa.int64()), _lists(_packed(signer.lanes(minima), 1))], ["node", "n", "fine"])

        return step

    fine = per_slice(sets, work, "node long, n long, fine array<long>")
    single = sets.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("c"), F.min("node").alias("node"))
    single = single.where("c = 1").groupBy("node").agg(F.count("*").alias("alone"))
    return fine.join(single, "node", "left").select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"), "fine")


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of a bucket between members of different components, each pair once.

    One side leaves out the bucket's largest component, so that its members
    never meet each other. What is left is sifted by exact bounds on the
    similarity and by a finer signature of the few documents that are left, with
    the same margin of five standard deviations. Two sets below SMALL shingles
    pass it; they are confirmed on their shingles like all pairs.
    """
    # sets that pass by chance only raise what others may share; the join with the members leaves them out
    own = _sifted(sets, members.select("node"))
    facts = settle(_fine_facts(own).join(members.groupBy("node").agg(F.collect_list("key").alias("keys")), "node"))
    sizes = members.groupBy("key", "part").count()
    main = sizes.groupBy("key").agg(F.max_by("part", F.struct("count", "part")).alias("main"))
    rows = members.join(facts, "node").select("key", F.struct("node", "part", "n", "common", "fine", "keys").alias("m"))
    small = rows.join(main, "key").where("m.part <> main").select("key", "main", F.col("m").alias("x"))
    every = rows.select("key", F.col("m").alias("y"))
    # two small members meet once; a small one meets each of the main part
    once = (F.col("y.part") == F.col("main")) | (F.col("x.node") < F.col("y.node"))
    shared = F.least("x.common", "y.common")
    bound = shared * 100 >= (F.col("x.n") + F.col("y.n") - shared) * percent
    alike = estimate(equal_lanes(F.col("x.fine"), F.col("y.fine"), FINE, 1), FINE, 1) >= floor_of(percent / 100, FINE, 1)
    near = ((F.col("x.n") < SMALL) & (F.col("y.n") < SMALL)) | alike
    here = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("key")
    pairs = small.join(every, "key").where((F.col("x.part") != F.col("y.part")) & once & bound & here & near)
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))

"""Byte-level BPE and packing against the public tokenizer libraries."""

import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_samples import sample_texts
from tokenizers import Tokenizer

from voxspark.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def coder():
    ranks = bpe.read_ranks(RANKS)
    return bpe.TwoTier(bpe.MinimalHash.build(list(ranks)), ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_the_hash_is_minimal_and_perfect(coder):
    keys = list(coder.ranks)
    assert sorted(coder.table.find(k) for k in keys) == list(range(len(keys)))
    assert coder.table.find(b"no such token, surely") == -1


def test_encoding_equals_the_library(coder, library):
    rng = random.Random(2)
    signs = " \n\t\r  ab'sé1., \x1c\x85日😀"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 16))) for _ in range(3000)] + [t for _, t in sample_texts(60)]
    texts += ["a" * 20000, " " * 3000 + "x", "<|endoftext|>", "it's we'll I'd"]
    for t in texts:
        ids = coder.encode(t)
        assert ids.tolist() == library.encode_ordinary(t)
        assert coder.decode(ids) == t.encode()


def test_any_code_point(coder, library):
    for c in [*range(0x3000), *range(0xFE00, 0x10000, 7), *range(0x1F300, 0x1F700, 5)]:
        if not 0xD800 <= c < 0xE000:
            t = f"a{chr(c)}b 1{chr(c)} {chr(c)}x"
            assert coder.encode(t).tolist() == library.encode_ordinary(t), hex(c)


def test_tables(edge_docs, no_docs, library):
    coded = bpe.decode_ids(bpe.encode_texts(edge_docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    got = sorted(((r["id"], r["ids"], bytes(r["decoded"])) for r in coded.collect()), key=str)
    want = [(r[0], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in edge_docs.select("doc_id", "text").collect()]
    assert got == sorted(want, key=str)
    assert bpe.encode_texts(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def word_ids(texts):
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return [np.array(e.ids, np.int32) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_word_tokens_equal_the_library():
    rng = random.Random(4)
    signs = "aéÉß'sz19., \x1c\x85ªºΣİ́Åx "
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 14))) for _ in range(4000)] + [t for _, t in sample_texts(80)] + ["don't we'll O'Neil's x'", "a" * 3000]
    own = packing.WordTokens(WORDS)
    for t, ids in zip(texts, word_ids(texts)):
        assert own(t).tolist() == ids.tolist(), repr(t)


def test_new_words_cost_no_python_call_each():
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abcdefghij", k=8)) + rng.choice(["", ".", "),"]) for _ in range(20000)})
    own, calls = packing.WordTokens(WORDS), []
    texts = pa.array([" ".join(words[k::40]) for k in range(40)])
    sys.setprofile(lambda _, event, __: calls.append(1) if event in ("call", "c_call") else None)
    flat, size = own.many(texts)
    sys.setprofile(None)
    assert len(calls) < 2000
    assert [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])] == [x.tolist() for x in word_ids(texts.to_pylist())]
    assert packing.WordTokens(WORDS).whole is own.whole  # read once per worker


def test_lots_hold_every_row():
    texts = ["", "ab" * 30, "", "c" * 500, "", "", "d", "é" * 49, "e"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(9)), "text": texts})
    for most in (1, 7, 60, 100, 10_000):
        got = [lot.column("text").to_pylist() for lot in packing.lots([batch.slice(0, 0), batch], most)]
        assert sum(got, []) == texts and all(got)
        assert all(sum(len(t.encode()) for t in lot[1:]) <= most for lot in got)


def check_pack(docs, **more):
    rows = [(r[0], r[1] or "") for r in docs.select("doc_id", "text").collect()]
    want = sorted((str(i), [*ids.tolist(), 1]) for (i, _), ids in zip(rows, word_ids([t for _, t in rows])))
    got = packing.pack(docs, WORDS, **more).toPandas()
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]] and seq["length"].sum() <= more.get("window", 2048)
    for _, p in got.iterrows():
        assert len(p["ids"]) == p["length"] and zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"]
    assert got["length"].sum() == sum(len(x) for _, x in want)
    return got, want


def test_pack_keeps_every_token(spark):
    docs = spark.createDataFrame(sample_texts(150), "doc_id long, text string").repartition(3)
    got, want = check_pack(docs, window=256, shard_tokens=8000, partition_chars=100_000)
    by = {k: v.sort_values("start") for k, v in got.groupby(got["doc_id"].astype(str) if "doc_id" in got else got["id"].astype(str))}
    for i, ids in want:
        p = by[i]
        assert [x for row in p["ids"] for x in row] == ids and (p["doc_tokens"] == len(ids)).all()
        assert p["start"].tolist() == [0, *p["length"].cumsum().tolist()[:-1]]
    sizes = got.groupby("sequence_id")["length"].sum()
    assert (sizes < 256).sum() <= 5 + docs.count() * 3000 // 100_000  # one open window a partition


def test_pack_edge_cases(edge_docs, no_docs):
    got, want = check_pack(edge_docs)
    # rows with equal ids are packed as often as they come
    assert got[got["start"] == 0].shape[0] == len(want)
    assert packing.pack(no_docs, WORDS).count() == 0


def test_a_window_takes_related_texts():
    rng = np.random.default_rng(0)
    topics = [np.arange(k * 50, k * 50 + 50, dtype=np.int32) for k in range(8)]
    pieces = [[i, 60, 0, rng.choice(topics[i % 8], 60)] for i in range(64)]
    df = np.bincount(np.concatenate([np.unique(p[3]) for p in pieces]), minlength=400)
    idf = np.maximum(0, np.log((64 - df + 0.5) / (df + 0.5)))
    rows = [[p[0] % 8 for p in row] for row, _ in packing.fill(pieces, 240, idf, 60.0, True) if row]
    assert len(rows) == 16 and all(len(set(r)) == 1 for r in rows)

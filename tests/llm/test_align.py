"""Alignment of two tokenizations against the libraries and brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_samples import sample_texts
from tokenizers import Tokenizer

from voxspark.llm import align

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def pair():
    files = [open(p, "rb").read() for p in PATHS]
    return align.Pair(align.ByteLevel(files[0], public_tokenizers.PATTERN), align.Pieces(files[1]))


def test_both_coders_of_a_give_the_same_ids(pair):
    plain, words = align.ByteLevel(open(PATHS[0], "rb").read()), [w for t in hard_texts() for w in t.split(" ")]
    assert plain(words) == pair.a(words)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), (lambda t: b.encode(t))


def by_force(texts, pair, libraries):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text."""
    links, rows = [], []
    for t in texts:
        a, b = (lib(t) if t else [] for lib in libraries)
        raw = [[pair.a.bytes[x] for x in a], [pair.b.bytes[x] for x in b]]
        if not t or any(b"".join(r) != (" " + t).encode() for r in raw):
            rows.append(None)
            links.append(Counter())
            continue
        ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
        begins = [[0, *e[:-1]] for e in ends]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for cut in shared:
            stop = [es.index(cut, i) + 1 for es, i in zip(ends, at)]
            groups.append("|".join(",".join(map(str, ids[i:j])) for ids, i, j in zip((a, b), at, stop)))
            at = stop
        found, near = Counter(), 0
        for i, x in enumerate(a):
            while near < len(b) and ends[1][near] <= begins[0][i]:
                near += 1
            j = near
            while j < len(b) and begins[1][j] < ends[0][i]:
                found[x, b[j]] += 1
                j += 1
        links.append(found)
        rows.append([len(a), len(b), len(shared), sum(found.values()), ";".join(groups)])
    held = Counter(p for found in links for p in found)
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else
        (*r[:4], sum(n for p, n in f.items() if held[p] == best[p[0]]), sum(held[p] * n for p, n in f.items()), hashlib.sha256(r[4].encode()).hexdigest())
        for r, f in zip(rows, links)]


def hard_texts():
    rng = random.Random(5)
    signs = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "日本", "😀", "1", "23", ".", " ", " ", "\x1f", "\x85", "<s>", "<|endoftext|>", "▁", "<0x41>", "the", "ﬁ", "́", "\r\n", "_", "-"]
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 14))) for _ in range(1500)]
    return texts + [" x", "x ", " ", "\n", "\x00a", "a" * 3000, " " * 500 + "z", "it's we'll don't I'd", "naïve café " * 900]


def test_words_encode_as_whole_texts(pair, libraries):
    texts = hard_texts() + [t for _, t in sample_texts(60)]
    for t, got in zip(texts, pair(texts)):
        a, b = (lib(t) for lib in libraries)
        same = all(b"".join(c.bytes[x] for x in ids) == (" " + t).encode() for c, ids in ((pair.a, a), (pair.b, b)))
        assert (got is not None) == same, repr(t)
        if same:
            assert (got[0].tolist(), got[1].tolist()) == (a, b), repr(t)


def test_runs_and_irregular_groups():
    rng = np.random.default_rng(1)
    for _ in range(600):
        n = int(rng.integers(1, 60))
        a, b = (np.flatnonzero(np.append(rng.random(n) < p, True)).astype(np.int32) + 1 for p in rng.choice([0.1, 0.5, 0.9, 0.99, 1.0], 2))
        group_a, group_b, link_a, link_b = align.align(a, b)
        shared = np.intersect1d(a, b)
        assert a[group_a].tolist() == b[group_b].tolist() == shared.tolist()
        begin_a, begin_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i]}
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == sorted(want)


@pytest.mark.parametrize("docs,entries", [(2048, 1 << 19), (3, 40)])
def test_table(spark, monkeypatch, pair, libraries, docs, entries):
    monkeypatch.setattr(align, "BLOCK_DOCS", docs)
    monkeypatch.setattr(align, "BLOCK_PAIRS", entries)
    texts = hard_texts()[::10] + [t for _, t in sample_texts(40)] + [None, "", "same text", "same text"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, block string, codes int").repartition(3)
    got = {r["id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in align.align_tokens(df, *PATHS, public_tokenizers.PATTERN).collect()}
    assert [got[i] for i in range(len(texts))] == by_force(texts, pair, libraries)


def test_edge_cases(edge_docs, no_docs, pair, libraries):
    rows = edge_docs.select("doc_id", "text").collect()
    got = sorted((tuple(r[c] for c in ("id", "n_a", "n_links", "count_sum", "groups_sha256")) for r in align.align_tokens(edge_docs, *PATHS).collect()), key=str)
    want = by_force([r["text"] for r in rows], pair, libraries)
    assert got == sorted(((r["doc_id"], w[0], w[3], w[5], w[6]) for r, w in zip(rows, want)), key=str)
    assert align.align_tokens(no_docs, *PATHS).count() == 0

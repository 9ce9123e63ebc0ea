"""Words one edit apart against brute force, counts, forms, roots, hot halves, edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from voxspark.llm import spelling

PATTERN = r"[A-Za-zÀ-ÿ]+"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a != b and a[i + 1 :] == b[i + 1 :]
    return len(b) == len(a) + 1 and a[i:] == b[i + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefgÿ"])
def test_both_searches_find_all_pairs(letters):
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(300)} | {"a" * k for k in range(20, 40)})
    size, got = np.array([len(w) for w in words]), set()
    for turn, free in ((lambda w: w[::-1], size - size // 2), (lambda w: w, size // 2)):
        found = spelling.near_pairs(list(map(turn, words)), list(map(turn, words)), free).tolist()
        got |= {(words[a], words[b]) for a, b in found}
    assert got == {(a, b) for a in words for b in words if near(a, b)}


def by_force(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        close = [x for x in counts if near(w, x)]
        form = min(close, key=lambda x: (-counts[x], x), default=None)
        form = form if form is not None and counts[form] >= ratio * n else None
        out[w] = [n, len(close), form, form and counts[form]]
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        row.append(root)
    return {w: tuple(r) for w, r in out.items()}


def rows(df):
    got = df.collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got}


@pytest.mark.parametrize("shard,together", [(1 << 14, 1 << 13), (64, 8)])
def test_variants_with_and_without_hot_halves(spark, monkeypatch, shard, together):
    rng = random.Random(7)
    # half of the words share one front, a third one end
    words = {f"comput{''.join(rng.choices('aeé', k=rng.randint(0, 5)))}" for _ in range(150)}
    words |= {f"{''.join(rng.choices('rst', k=rng.randint(2, 5)))}tation" for _ in range(100)} | {"".join(rng.choices("xyz", k=6)) for _ in range(100)}
    counts = {w: rng.choice([1, 2, 5, 25, 125, 600]) for w in sorted(words)}
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "TOGETHER", together)
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(spelling.variants(table)) == by_force(counts)


def test_counts_with_typos(spark, edge_docs):
    want = Counter()
    for i, text in edge_docs.select("doc_id", "text").collect():
        for run in re.findall(PATTERN, text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            want[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 5 == 0 else low] += 1
    assert {r["word"]: r["n"] for r in spelling.count_runs(edge_docs, PATTERN, typo_every=5).collect()} == want
    plain = spelling.count_runs(edge_docs, PATTERN)
    assert rows(spelling.variants(plain.where("length(word) > 3"))) == by_force(
        {r["word"]: r["n"] for r in plain.collect() if len(r["word"]) > 3})


def test_no_words(spark, no_docs):
    assert spelling.variants(spelling.count_runs(no_docs, PATTERN)).count() == 0
    few = spark.createDataFrame([("a", 3), ("é", 9), ("", 1), (None, 2), ("ab", 4)], "word string, n long")
    got = {r["word"]: r["n_near"] for r in spelling.variants(few).collect()}
    assert got == {"a": 0, "é": 0, "": 0, None: 0, "ab": 0}

"""Linked vectors and exact top-k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxspark.llm import top_k, vector_links

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, id long, node string, block int, n_links string, dim int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, l, 9, "n", 1, "x", 2) for i, v, l in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist(), i % 3) for i in range(150)]
    center = rng.normal(size=24)
    rows += [(200 + i, (center + 0.12 * rng.normal(size=24)).astype(np.float32).tolist(), 1) for i in range(120)]  # near copies
    rows += [(400 + i, rows[5][1], rows[5][2]) for i in range(30)]  # equal vectors
    step = rng.normal(size=24)
    rows += [(500 + i, (rows[7][1] + 0.05 * i * step).astype(np.float32).tolist(), rows[7][2]) for i in range(40)]  # a chain
    rows += [
        (600, None, 1), (601, [0.0] * 24, 1), (602, [None] + [1.0] * 23, 1), (603, [NAN] * 24, 1), (604, [INF] * 24, 1), (605, rows[0][1], None),
        (606, [], 1), (607, [1.0, 2.0], 1), (608, [2.0, 4.0], 1), (609, [3.0], 1), (610, [-3.0], 1), (611, [5.0], 1), (None, rows[0][1], 0),
        (613, [x * 7.0 for x in rows[0][1]], 0),
    ]
    return rows


def fit(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def expected_links(rows, cosine):
    n = len(rows)
    links = [[] for _ in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if fit(v) else None for _, v, _ in rows]
    for a in range(n):
        for b in range(a):
            (i, v, l), (j, w, m) = rows[a], rows[b]
            if l is not None and l == m and i is not None and j is not None and fit(v) and fit(w) and len(v) == len(w) and unit[a] @ unit[b] >= cosine:
                links[a].append(b), links[b].append(a)
    out = []
    for a in range(n):
        seen, work = {a}, [a]
        while work:
            for b in links[work.pop()]:
                if b not in seen:
                    seen.add(b), work.append(b)
        out.append((rows[a][0], len(links[a]), min(rows[b][0] for b in seen) if rows[a][0] is not None else None))
    return sorted(out, key=str)


def test_links_equal_brute_force(spark, vectors):
    got = vector_links.near_vectors(table(spark, vectors)).collect()
    assert sorted(((r["id"], r["n_links"], r["component_id"]) for r in got), key=str) == expected_links(vectors, 0.93)
    assert all(r["kept"] == (r["id"] is None or r["id"] == r["component_id"]) for r in got)
    assert vector_links.near_vectors(table(spark, vectors).limit(0)).count() == 0


def test_links_across_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(vector_links, "BLOCK", 17)
    got = vector_links.near_vectors(table(spark, vectors)).collect()
    assert sorted(((r["id"], r["n_links"], r["component_id"]) for r in got), key=str) == expected_links(vectors, 0.93)


@pytest.mark.parametrize("dim", [2, 3, 24, 64, 768])
def test_the_count_is_calibrated(dim):
    """Pairs exactly at the threshold reach the count; unrelated ones mostly do not."""
    _, window, least = vector_links.calibrated(dim, 0.93)
    rng, d = np.random.default_rng(dim), vector_links.directions(dim)
    x = rng.normal(size=(400, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.normal(size=(400, dim))
    y -= (x * y).sum(axis=1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    near = 0.93 * x + math.sqrt(1 - 0.93**2) * y
    hits = (np.abs((x - near) @ d) <= window).sum(axis=1)
    assert (hits >= least).all()
    if dim >= 24:
        assert ((np.abs((x - y) @ d) <= window).sum(axis=1) >= least).mean() < 0.1


def test_collision_chance_in_two_dimensions():
    """Directions drawn anew for each pair, as the chance is defined."""
    distance, window, least = vector_links.calibrated(2, 0.93)
    angle = np.random.default_rng(1).uniform(0, math.pi, (20_000, vector_links.LINES))
    hits = (np.abs(distance * np.cos(angle)) <= window).sum(axis=1)
    assert abs(hits.mean() / vector_links.LINES - vector_links._collision_chance(2, distance, window)) < 0.01
    assert (hits >= least).all() and vector_links._collision_chance(2, 0.0, 0.0) == 1


def expected_top(rows, ids, k):
    out = []
    for i, v in rows:
        if i in ids:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), j) for j, w in rows if j != i and len(v) == len(w))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK", 50)
    monkeypatch.setattr(top_k, "QUERIES", 7)
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-1000, 1000, 12).tolist()) for i in range(300)]
    rows += [(300 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(400, [1, 2]), (410, [3, 4]), (420, [5]), (430, [0] * 12)]
    frame = spark.createDataFrame(rows, "id long, v array<long>").repartition(4)
    got = top_k.top_k(frame, frame.where("id % 10 = 0"), 10).collect()
    want = expected_top(rows, {i for i, _ in rows if i % 10 == 0}, 10)
    assert sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got) == want
    assert top_k.top_k(frame.limit(0), frame.limit(0)).count() == 0 and top_k.top_k(frame, frame.limit(0)).count() == 0


def test_top_k_reads_few_exact_vectors():
    rng = np.random.default_rng(2)
    exact = rng.integers(-400, 400, (3000, 32))
    query = rng.integers(-400, 400, 32)
    lowest, highest = top_k.bounds(*top_k.approximate(exact), query[None, :])
    score = exact @ query
    assert (lowest[0] <= score).all() and (score <= highest[0]).all()
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            read.append(np.size(at))
            return np.asarray(self)[at]

    best = top_k.certain_top(exact.view(Counted), np.arange(3000), query, lowest[0], highest[0], 10)
    assert [s for s, _ in best] == sorted(score.tolist(), reverse=True)[:10] and sum(read) < 1500


def test_whole_numbers(spark):
    frame = spark.createDataFrame([([0.5, -0.001], 1), ([NAN], 2), (None, 3), ([None], 4)], "v array<float>, i int")
    assert [r[0] for r in frame.select(top_k.usable(F.col("v"))).collect()] == [True, False, False, False]
    assert frame.select(top_k.whole_numbers(F.col("v"), 1024)).first()[0] == [512, -2]

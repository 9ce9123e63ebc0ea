"""Line dedup and near-duplicate documents against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from voxspark import session
from voxspark.llm import graph, line_dedup, minhash, shingles

BLANKS = "[\x20\x09-\x0d]+"


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def expected_lines(rows):
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen[ascii_lower(line).strip("\x20\t\n\x0b\x0c\r")].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(k := ascii_lower(x).strip("\x20\t\n\x0b\x0c\r")) < 10 or min(seen[k] - {None}) == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def got_lines(df):
    return sorted(((r["doc_id"], r["_kept_text"], r["_n_lines"], r["_n_dropped"]) for r in df.collect()), key=str)


def test_lines_of_edge_cases(edge_docs, no_docs):
    rows = [(r[0], r[1]) for r in edge_docs.select("doc_id", "text").collect()]
    done = line_dedup.dedup_lines(edge_docs)
    assert done.columns[: len(edge_docs.columns)] == edge_docs.columns
    assert got_lines(done) == expected_lines(rows)
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_lines_do_not_depend_on_batches(spark):
    rng = random.Random(3)
    pool = [f"shared line {i} of the pool" for i in range(12)] + ["short", "  Shared Line 3 of the pool\t"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 6)) + [f"a line of document {i}"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches, fanout in ((1, 2), (3, 2), (7, 2), (7, 3)):
        assert got_lines(line_dedup.dedup_lines(docs, batches=batches, fanout=fanout)) == expected_lines(rows)


def test_line_dedup_runs_no_python(edge_docs):
    plan = line_dedup.dedup_lines(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def word_sets(rows, width=5):
    out = []
    for i, t in rows:
        w = [x for x in re.split(BLANKS, ascii_lower(t or "")) if x]
        out.append((i, {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())))
    return out


def expected_components(sets):
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            (i, p), (j, q) = sets[x], sets[y]
            if i is not None and j is not None and p and q and 100 * len(p & q) >= 75 * len(p | q):
                parent[root(x)] = root(y)
    groups = defaultdict(list)
    for x in range(len(sets)):
        groups[root(x)].append(x)
    low = {r: min(sets[x][0] for x in g) if sets[g[0]][0] is not None else None for r, g in groups.items()}
    return sorted(((sets[x][0], len(sets[x][1]), low[root(x)]) for x in range(len(sets))), key=str)


def check_components(docs):
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == expected_components(word_sets(rows))


def test_near_duplicates_of_edge_cases(edge_docs, no_docs):
    check_components(edge_docs.select("doc_id", "text", "kept", "node", "key"))
    assert minhash.near_duplicates(no_docs).count() == 0


def test_near_duplicates_of_groups(spark):
    """Chains of edits, a large group of near copies, exact copies and unrelated texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], rng.choices(words, k=150)
    for i in range(60):  # near copies of one text
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(150)] = rng.choice(words)
        rows.append((len(rows), " ".join(own)))
    chain = rng.choices(words, k=80)
    for i in range(15):  # each links to the next, the ends do not
        chain = list(chain)
        chain[rng.randrange(80)] = f"new{i}"
        rows.append((len(rows), " ".join(chain)))
    rows += [(len(rows) + i, "the same text that comes again and again") for i in range(20)]
    rows += [(200 + i, " ".join(rng.choices(words, k=rng.randint(3, 90)))) for i in range(60)]
    rng.shuffle(rows)
    check_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_links_of_small_sets_across_components(spark):
    """Pairs at exactly 0.75, of different components of one bucket, for 4 to 40 shingles."""
    rng = np.random.default_rng(3)
    sets, members, want = [], [], set()
    for shared, one, other in [(3, 4, 3), (6, 7, 7), (9, 12, 9), (15, 20, 15), (30, 40, 30), (18, 21, 21), (75, 100, 75), (72, 84, 84), (66, 88, 66)]:
        for _ in range(60):
            a, b = len(sets), len(sets) + 1
            x = rng.integers(-(1 << 62), 1 << 62, one + other - shared).tolist()
            sets += [(a, x[:one]), (b, x[:shared] + x[one:])]
            members += [(a, a, a), (a, b, b)]
            want.add((a, b))
    sets = spark.createDataFrame(sets, "node long, shingles array<long>").repartition(4)
    members = spark.createDataFrame(members, "key long, node long, part long")
    got = {(r["a"], r["b"]) for r in minhash._across(members, sets, 75).collect()}
    assert got == want


def test_lane_bits_agree_by_chance_on_small_sets():
    """Unrelated minima agree in half of the lanes for each single pair, not only on average."""
    rng, signer = np.random.default_rng(6), minhash.Signer(hashes=minhash.FINE, seed=23)
    for _ in range(40):
        a, b = (signer.lanes(signer.minima(rng.integers(0, 1 << 63, 2, dtype=np.uint64))[None, :]) & 1 for _ in range(2))
        assert abs((a == b).mean() - 0.5) < 0.08


def test_near_copies_of_repeated_ids(spark):
    """A text of its own stays, though another row of its id is a near copy."""
    story = " ".join(f"word{i}" for i in range(40))
    rows = [
        (3, story, "a"), (5, story + " more", "b"), (5, "a text that is found nowhere else at all", "c"), (6, "", "d"), (6, "", "e"), (7, " ", "f"),
        (8, "two different texts of one id, the first", "g"), (8, "and the second one which nobody else has", "h"), (8, story, "i"),
        (None, story, "j"), (None, story, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    done = corpus_pipeline.near_copies(spark, docs, "")
    got = {r["source"] for r in done.collect()}
    assert done.columns == docs.columns and done.count() == 8
    assert got - {"d", "e"} == {"a", "c", "f", "g", "h", "j", "k"} and len(got & {"d", "e"}) == 1
    assert corpus_pipeline.near_copies(spark, docs.limit(0), "").count() == 0


def test_estimate_takes_chance_out():
    rng = np.random.default_rng(0)
    signer = minhash.Signer()
    for share in (0.2, 0.5, 0.8):
        got = []
        for _ in range(40):
            x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
            common = int(3000 * 2 * share / (1 + share))
            y = np.concatenate([x[:common], rng.integers(0, 1 << 63, 3000 - common, dtype=np.uint64)])
            a, b = (signer.minima(s) & 3 for s in (x, y))
            f = (a == b).mean()
            got.append((f - 0.25) / 0.75)
        assert abs(np.mean(got) - share) < 0.03


def test_lanes_are_counted_in_the_engine(spark):
    rng = np.random.default_rng(1)
    m = rng.integers(0, 1 << 32, (6, minhash.HASHES), dtype=np.uint32)
    m[1] = m[0]
    sig = minhash._packed(m, minhash.BITS).tolist()
    got = spark.createDataFrame([(sig[i], sig[j]) for i in range(6) for j in range(6)], "x array<long>, y array<long>").select(
        minhash.equal_lanes(F.col("x"), F.col("y"))).collect()
    assert [r[0] for r in got] == [int(((m[i] & 3) == (m[j] & 3)).sum()) for i in range(6) for j in range(6)]


def test_shingles_are_words_not_letters():
    s = shingles.Shingler()
    assert len(s("A b\tc d E f")) == 2 and len(s("a b c")) == 1 and not len(s("  \n"))
    assert set(s("A B C D E")) == set(s("a b  c d e")) and set(s("É b c d e")) != set(s("é b c d e"))


def test_components_of_long_paths_and_loops(spark):
    path = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000), (500, 900), (900, 500), (901, 900)]
    random.Random(1).shuffle(path)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {500: 500, 900: 500, 901: 500}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_digest_of_kept_text(spark):
    docs = spark.createDataFrame([(1, "a repeated line\nx"), (2, "A repeated line \ny")], "doc_id long, text string")
    got = line_dedup.dedup_lines(docs).select("doc_id", F.sha2("_kept_text", 256)).collect()
    assert dict(map(tuple, got)) == {1: hashlib.sha256(b"a repeated line\nx").hexdigest(), 2: hashlib.sha256(b"y").hexdigest()}


def test_bands_and_texts_move_once(spark, monkeypatch):
    plans = []

    def settle(df):
        plans.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return session.settle(df)

    monkeypatch.setattr(minhash, "settle", settle)
    texts = [" ".join(f"w{(i * 7 + j) % 400}" for j in range(30)) for i in range(40)]
    docs = spark.createDataFrame([(i, texts[i // 2] + (" end" if i % 2 else "")) for i in range(80)], "doc_id long, text string")
    assert minhash.near_duplicates(docs).where("kept").count() == 40
    plan = next(p for c, p in plans if c == ["key", "node", "pivot"])
    assert "Join" not in plan and plan.count("Generate explode(bands") == 1
    # no join moves the sets of shingles on their digests, unless nodes share an id
    plan = next(p for c, p in plans if "shingles" in c)
    assert plan.index("MapInArrow") < plan.index("Join")
    # the sets of open buckets are sifted where they lie
    assert "LeftSemi" not in next(p for c, p in plans if "fine" in c)


def test_texts_that_no_candidate_needs_stay_in_their_place(spark):
    ids = [-(1 << 63), -64, -1, 0, 1, 63, 64, 65, 32767, 32768, (1 << 63) - 1, *range(1000, 1200)]
    texts = spark.createDataFrame([(i, f"t{i}") for i in [*ids, *range(10_000, 20_000), 64]] + [(None, "none")], "id long, text string")
    wanted = spark.createDataFrame([(i,) for i in [*ids, 64]], "id long")
    got = [r[0] for r in minhash._sifted(texts, wanted).collect()]
    assert set(ids) <= set(got) and got.count(64) == 2 and len(got) < len(ids) + 20
    # a filter that is too small keeps more, and loses nothing
    got = [r[0] for r in minhash._sifted(texts, wanted, 128).collect()]
    assert set(ids) <= set(got) and got.count(64) == 2 and len(got) == len(set(got)) + 1


def test_sets_of_a_shared_id_are_all_opened(spark):
    base = [f"w{i}" for i in range(200)]
    one, other = " ".join(base[:90]), " ".join(base[100:190])
    rows = [(5, one), (5, other), (7, one + " more"), (8, other + " more"), (9, None), (5, ""), (5, one)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {(r["id"], r["n_shingles"]): r["component_id"] for r in got}
    assert len(got) == 7 and by == {(5, 86): 5, (7, 87): 5, (8, 87): 5, (9, 0): 9, (5, 0): 5}

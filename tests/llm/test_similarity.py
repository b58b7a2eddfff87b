"""Near-duplicates, repeated substrings and vectors against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import ann, embed_dedup, minhash, substring
from panelkit.llm.fmindex import FMIndex, repeated_windows
from panelkit.llm.graph import components

RNG = np.random.default_rng(9)
VOCABULARY = [f"w{i}" for i in range(4000)]


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def noisy(words, share):
    return [RNG.choice(VOCABULARY) if RNG.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    passage = RNG.choice(VOCABULARY, 60).tolist()
    rows = []
    for _ in range(120):
        rows.append(RNG.choice(VOCABULARY, RNG.integers(3, 150)).tolist())
    for _ in range(40):  # a widely shared passage
        rows.append(RNG.choice(VOCABULARY, 20).tolist() + passage + RNG.choice(VOCABULARY, RNG.integers(10, 60)).tolist())
    for base in rows[:25]:  # copies around the threshold
        rows += [noisy(base, s) for s in (0, 0.01, 0.02, 0.03, 0.05)]
    hub = RNG.choice(VOCABULARY, 200).tolist()
    rows += [noisy(hub, 0.015) for _ in range(60)]
    texts = [" ".join(w) for w in rows]
    docs = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"),
                                     (905, texts[0].upper()), (906, "x " * 40_000), (907, "x " * 39_000)]
    return docs


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_minhash_components_equal_brute_force(spark, corpus):
    docs = spark.createDataFrame([(d, t, 0, "x") for d, t in corpus], "doc_id long, text string, n int, component string")
    sets = {d: shingles(t) for d, t in corpus}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = closure(sets, links)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, block=16).collect()}
    assert len(got) == len(corpus)
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.n_shingles == len(sets[d]) and r.kept == (want[d] == d) for d, r in got.items())
    keep = minhash.representatives(docs).collect()
    assert sorted(r.doc_id for r in keep) == sorted({c for c in want.values()})


def test_minhash_null_and_repeated_keys(spark):
    body = " ".join(VOCABULARY[:50])
    rows = [(None, body), (None, body), (7, body), (8, " ".join(VOCABULARY[50:90])), (8, " ".join(VOCABULARY[90:140])),
            (None, "alone in the world of words"), (9, body), (9, body)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == Counter(
        [(None, 7, False)] * 2 + [(7, 7, True)] + [(8, 8, True)] * 2 + [(None, None, False)] + [(9, 7, False)] * 2)


@pytest.mark.parametrize("neighbours", [1000, 3])
def test_repeated_windows_equal_brute_force(spark, corpus, neighbours):
    loop = " ".join(VOCABULARY[:9] * 12)  # every gram of it comes again and again
    rows = corpus + [(980 + i, f"{VOCABULARY[100 + i]} {loop} {' '.join(VOCABULARY[200 + i:220 + i])}") for i in range(8)]
    rows += [(905, corpus[3][1]), (905, corpus[3][1])] + [(950 + i, " ".join(VOCABULARY[:34 + i])) for i in range(4)]
    window = 35
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    want = Counter()
    for (d, _), w in zip(rows, words):
        hit = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                hit[i:i + window] = True
        kept = [x for x, h in zip(w, hit) if not h]
        want[d, len(w), int(hit.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, key int")
    got = substring.repeated_spans(docs, shard_words=3000, most_neighbours=neighbours).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed for r in got)


def test_periodic_texts_and_null_keys(spark, monkeypatch):
    own = [f"x{i}" for i in range(50)]
    texts = [["a"] * 900, ["a"] * 340 + own, own[:20] + ["a"] * 33 + own[20:], ["b", "c"] * 400, ["c", "b"] * 36,
             ["d", "e", "f"] * 11 + ["d"], ["g"] * 35, None]
    rows = [(None if i % 3 == 0 else i, " ".join(t) if t else t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    windows = Counter(tuple(t[i:i + 35]) for t in texts if t for i in range(len(t) - 34))
    want = Counter()
    for (d, _), t in zip(rows, texts):
        gone = {j for i in range(len(t or []) - 34) if windows[tuple(t[i:i + 35])] > 1 for j in range(i, i + 35)}
        want[d, len(t or []), len(gone)] += 1
    for most, neighbours in ((256, 1000), (10, 1000), (64, 2)):
        monkeypatch.setattr(substring, "MOST_WINDOWS", most)
        got = substring.repeated_spans(docs, most_neighbours=neighbours).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == want


def test_fm_index_counts_and_matches():
    for _ in range(40):
        texts = [RNG.integers(1, 4, RNG.integers(1, 16)) for _ in range(RNG.integers(1, 8))]
        index = FMIndex(np.concatenate([x for t in texts for x in (t, [0])]), 4)
        seen = Counter(tuple(t[i:i + 5]) for t in texts for i in range(len(t) - 4))
        for t, hit in zip(texts, repeated_windows(index, texts, 5)):
            assert hit.tolist() == [seen[tuple(t[i:i + 5])] > 1 for i in range(len(t) - 4)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(50)] + [(300, 300), (401, 400), (400, 401)]
    want = closure({x for p in links for x in p}, links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in want.items() if n != 300}


@pytest.fixture(scope="module")
def vectors():
    rows = []
    for label in (0, 1):
        centre = RNG.normal(size=(30, 16))
        for i, c in enumerate(centre):
            for _ in range(20 if i == 0 else 1 + i % 3):
                rows.append((c + RNG.normal(scale=0.12, size=16), label))
    rows += [(rows[0][0], 0)] * 5 + [(rows[0][0] * 2.5, 0), (rows[0][0], 1)]
    out = [(i, [float(x) for x in v], lab) for i, (v, lab) in enumerate(rows)]
    n = len(out)
    out += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 1), (n + 3, [None] + [1.0] * 15, 1),
            (n + 4, out[0][1], None), (n + 5, [float("inf")] * 16, 0), (n + 6, [], 0), (n + 7, [1.0, 2.0], 0)]
    return out


def test_vector_links_equal_brute_force(spark, vectors):
    df = spark.createDataFrame([(i, v, lab, 1, 2) for i, v, lab in vectors],
                               "vec_id long, embedding array<double>, label int, node int, n int")
    able = [(i, np.array(v) / np.linalg.norm(v), lab) for i, v, lab in vectors[:-8]]
    links = [(a[0], b[0]) for a, b in itertools.combinations(able, 2) if a[2] == b[2] and a[1] @ b[1] >= 0.93]
    want = closure([v[0] for v in vectors], links)
    count = Counter(x for p in links for x in p)
    for block in (1024, 7):
        got = {r.vec_id: r for r in embed_dedup.near_duplicates(df, window=4, block=block).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_links for i, r in got.items()} == {v[0]: count[v[0]] for v in vectors}
        assert all(r.kept == (want[i] == i) for i, r in got.items())


def test_pairs_are_found_over_empty_partitions(spark):
    rows = [(0, [1.0, 0.1], 0), (1, [1.0, 0.11], 0), (2, [-1.0, 3.0], 0), (3, [1.0, 0.1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df, window=1).collect())
    assert got == [(0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 0, 3)]


@pytest.mark.parametrize("base", [0.9, 0.5])
def test_pairs_are_found_around_a_common_mean(spark, base):
    rng = np.random.default_rng(31)
    axis = np.eye(64)[0]
    x = rng.normal(size=(4000, 64))
    x[:, 0] = 0
    x = math.sqrt(base) * axis + math.sqrt(1 - base) * x / np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(300, 64))  # partners at cosine 0.94 of the first 300
    side -= (side * x[:300]).sum(axis=1, keepdims=True) * x[:300]
    pairs = 0.94 * x[:300] + math.sqrt(1 - 0.94 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    u = np.concatenate([x, pairs])
    s = u @ u.T
    links = [(a, b) for a, b in zip(*np.nonzero(s >= 0.93)) if a < b]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(u)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    assert {i: r.component_id for i, r in got.items()} == closure(range(len(u)), links)
    assert sum(r.n_links for r in got.values()) == 2 * len(links)


def test_passes_follow_from_the_sample():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(512, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    plan = lambda u, rows: embed_dedup.plan_passes(u, u.mean(axis=0), rows, embed_dedup.WINDOWS, 0.93, 1e-4)
    assert plan(x[:50], 50)[:2] == (1, 64) and plan(x, 1024)[:2] == (1, 1024)
    for rows in (5_000, 100_000, 10_000_000):  # a falling share of all pairs
        passes, window, _ = plan(x, rows)
        assert passes > 0 and passes * 1.5 * window < 1.5 * rows / 2 / (1 if rows < 10_000 else 4)
    y = 0.5 ** 0.5 * np.eye(64)[0] + 0.5 ** 0.5 * x
    y[0] = np.eye(64)[0]  # one vector at the mean does not turn the label over to all pairs
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    assert plan(y, 1_000_000)[0] > 0
    copies = np.concatenate([x[:256], x[:1] + rng.normal(scale=0.005, size=(256, 64))])  # nor does a group of copies
    copies /= np.linalg.norm(copies, axis=1, keepdims=True)
    assert plan(copies, 1_000_000)[0] > 0


def _with_partners(x, cosine, rng):
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    return cosine * x + math.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)


def test_a_crowd_that_a_sample_misses_is_planned_for(spark):
    rng = np.random.default_rng(37)
    x = rng.normal(size=(1000, 64))
    crowd = np.eye(64)[0] + 0.42 * rng.normal(size=(4000, 64)) / 8  # near each other, mostly not linked
    x, crowd = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, crowd))
    crowd = np.concatenate([crowd, _with_partners(crowd[:1000], 0.932, rng)])
    # the crowd avoids the rows that a hash of the vector would have chosen
    packs = spark.createDataFrame([(i, bytearray((v + 0.0).astype("<f8").tobytes())) for i, v in enumerate(crowd)],
                                  "i int, raw binary")
    rate = 512 / 5000
    kept = [r.i for r in packs.filter(F.pmod(F.xxhash64(F.lit("sample"), "raw"), F.lit(1 << 30)) > rate * (1 << 30))
            .select("i").collect()]
    u = np.concatenate([x, crowd[sorted(kept)]])
    s = u @ u.T
    links = [(a, b) for a, b in zip(*np.nonzero(s >= 0.93)) if a < b]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(u)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    assert {i: r.component_id for i, r in got.items()} == closure(range(len(u)), links)


@pytest.mark.parametrize("n", [700, 16_000])  # in one partition, in several
def test_every_row_is_measured_in_all_its_passes(spark, n):
    rng = np.random.default_rng(38)
    u = rng.normal(size=(n, 8))
    u[:200] = u[0] + 0.01 * u[:200]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    nodes = spark.createDataFrame(
        [(i, i % 2, v.astype("<f8").tobytes(), np.zeros(8).tobytes(), 3, 16, 0.5) for i, v in enumerate(u)],
        "node long, label_no long, raw binary, centre binary, passes int, window int, spread double")
    got = {r.node: r.log0 for r in embed_dedup._unseen(nodes, 0.93).collect()}
    both = {r.node: (r.log0, r.log1) for r in embed_dedup._unseen(nodes, 0.93, (16, 1024)).collect()}
    want = np.zeros(n)
    for label in (0, 1):
        ids = np.arange(label, n, 2)
        for p in range(3):
            code = embed_dedup._code(u[ids], np.full(len(ids), 0.5), 8, p)
            same = embed_dedup._same(np.linalg.norm(u[ids] - 0.5 * embed_dedup._jitter(8, p), axis=1), 0.93)
            text = sorted((f"{c:060b}", i, s) for c, i, s in zip(code.tolist(), ids.tolist(), same))
            for at, (c, i, s) in enumerate(text):
                ends = [text[e][0] for e in (at - 16, at + 16) if 0 <= e < len(text)]
                bits = max(1 + next((k for k in range(60) if c[k] != e[k]), 60) for e in ends) if ends else 0
                want[i] += math.log1p(-s ** bits) if bits <= 60 else 0
    logs = np.array([got[i] for i in range(n)])
    assert all(both[i][1] < both[i][0] + 1e-9 for i in range(n))
    for found in (logs, np.array([both[i][0] for i in range(n)])):
        assert (found > want - 1e-6).all()  # less sure beside the ends of partitions, never surer
        assert np.isclose(found, want).mean() > (0.99 if n == 16_000 else 1 - 1e-9)
    assert (logs[:200] > math.log(1e-4)).all()


def test_all_joined_rows_of_a_block_stay_joined():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.02, 0.2, 1.0):
        hit = rng.random((20, 35)) < share
        a, b = np.arange(20), np.arange(100, 135)
        pairs = np.concatenate([np.empty((0, 2), np.int64), *embed_dedup._joined(hit, a, b)])
        assert len(pairs) < 56
        want = closure([*a, *b], [(a[i], b[j]) for i, j in zip(*np.nonzero(hit))])
        assert closure([*a, *b], [tuple(map(int, p)) for p in pairs]) == want


def test_pairs_at_the_threshold_are_decided_in_double_precision(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = 0.93 + np.where(np.arange(200) % 2, 1e-9, -1e-9)[:, None]  # below single precision
    rows = np.stack([x, cosine * x + np.sqrt(1 - cosine ** 2) * side], 1).reshape(-1, 32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rows)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    assert [got[2 * i + 1].component_id == 2 * i for i in range(200)] == [i % 2 == 1 for i in range(200)]


def test_pairs_are_found_over_short_partitions(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(7, 16))
    u = np.concatenate([x, x + rng.normal(scale=0.3, size=x.shape)])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = [(a, b) for a, b in zip(*np.nonzero(u @ u.T >= 0.93)) if a < b]
    assert len(links) > 3
    nodes = spark.createDataFrame(
        [(i, 0, v.astype("<f8").tobytes(), np.zeros(16).tobytes(), 1, 16, 0.0) for i, v in enumerate(u)],
        "node long, label_no long, raw binary, centre binary, passes int, window int, spread double")
    got = embed_dedup._link_passes(nodes, 0.93, 16).collect()  # 14 rows over 8 partitions
    assert closure(range(14), [(r.a, r.b) for r in got]) == closure(range(14), links)


def test_nearest_vectors(spark):
    x = RNG.normal(size=(3000, 24))
    x[100:140] = x[100]
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)] + [(9000, None, 0), (9050, [0.0] * 24, 0), (None, [1.0] * 24, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = ann.nearest(df, df.filter("vec_id % 50 = 0"), leaf_rows=100, block=64).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == list(range(0, 3000, 50))
    for q, rs in by.items():
        s = u @ u[q]
        s[q] = -2
        s = np.round(s, 12)
        best = np.lexsort((np.arange(3000), -s))[:5]
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == [1, 2, 3, 4, 5]
        assert [r.score for r in rs] == pytest.approx([s[r.vec_id] for r in rs], abs=1e-9)
        hits += len({r.vec_id for r in rs} & set(best.tolist()))
    assert hits / (5 * len(by)) >= 0.93
    assert [r.vec_id for r in by[100]] == [101, 102, 103, 104, 105]


def test_nearest_is_the_same_in_small_blocks(spark):
    x = RNG.normal(size=(1200, 16))
    x[300:700] = x[300] + RNG.normal(scale=1e-3, size=(400, 16))  # one busy leaf in each tree
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 3 = 0")
    rows = lambda block: {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.nearest(
        df, asked, leaf_rows=100, block=block).collect()}
    assert rows(37) == rows(4096)


def test_forest_leaves_out_most_of_clustered_vectors(spark):
    centres = RNG.normal(size=(60, 32))
    x = centres[RNG.integers(60, size=6000)] + RNG.normal(scale=0.25, size=(6000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    packed = ann.packed(df, "vec_id", "embedding")
    forest = ann._fit(packed, 6000, 32, 5, 8, 100, 65_536, 64 << 20, 0.98)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    place, hits, share = forest.leaves(u), 0, []
    for q in range(0, 6000, 50):
        seen = np.zeros(6000, bool)
        for t, leaf in forest.search(u[q], forest.visits):
            seen |= place[:, t] == leaf
        s = u @ u[q]
        s[q] = -2
        hits += seen[np.argsort(-s)[:5]].sum()
        share.append(seen.mean())
    assert hits >= 0.97 * 600 and np.mean(share) < 0.3
    # a sample bounded by bytes, and one too small to hold any plane
    assert ann._fit(packed, 6000, 32, 5, 8, 100, 65_536, 500 * 256, 0.98).depth <= 6
    assert ann._fit(packed.limit(3), 3, 32, 5, 8, 100, 65_536, 64 << 20, 0.98).depth == 0


def test_a_query_key_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (3, [-1.0, 0.5]), (3, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id) for r in ann.nearest(df, df.filter("vec_id = 0")).collect())
    assert got == [(1, 1), (2, 2), (3, 3)]


def test_few_candidates_are_all_returned(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.filter("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]


def test_every_vector_length_is_compared(spark):
    rng = np.random.default_rng(8)
    rows = []
    for dim, n in ((16, 12), (6, 5)):
        for _ in range(n):
            v = rng.normal(size=dim)
            rows += [(len(rows), v.tolist(), 0), (len(rows) + 1, (v + rng.normal(scale=0.05, size=dim)).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    scores = {(i, j): np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
              for (i, a, _), (j, b, _) in itertools.permutations(rows, 2) if len(a) == len(b)}
    links = [p for p, s in scores.items() if s >= 0.93]
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    assert {i: r.component_id for i, r in got.items()} == closure(range(len(rows)), links)
    assert {i: r.n_links for i, r in got.items()} == {i: sum(a == i for a, _ in links) for i in range(len(rows))}
    near = {(r.query_id, r["rank"]): r.vec_id for r in ann.nearest(df, df).collect()}
    for i, v, _ in rows:
        best = sorted((j for j, w, _ in rows if j != i and len(w) == len(v)), key=lambda j: -scores[i, j])[:5]
        assert [near[i, k] for k in range(1, 6)] == best


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    vecs = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert minhash.near_duplicates(docs).collect() == []
    assert substring.repeated_spans(docs).collect() == []
    assert embed_dedup.near_duplicates(vecs).collect() == []
    assert ann.nearest(vecs, vecs).collect() == []


def test_vectors_with_null_and_repeated_keys(spark):
    a, b, c = [1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [0.0, 0.0, 1.0]
    rows = [(None, a, 0), (None, a, 0), (None, b, 0), (5, b, 0), (5, b, 0), (None, c, 0), (None, c, 1), (6, c, None)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()) == Counter(
        [(None, 4, 5, False)] * 3 + [(5, 4, 5, True)] * 2 + [(None, 0, None, False)] * 2 + [(6, 0, 6, True)])

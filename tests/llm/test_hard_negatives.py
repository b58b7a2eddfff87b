"""Hard negatives against brute force, and the bounds of the anchor tree."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label string, id long, raw string, slab int, dim int"


def brute(rows, is_anchor, positives=5, negatives=5):
    able = [(d, [math.floor(256.0 * x) for x in v], y) for d, v, y in rows
            if d is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    able = [r for r in able if sum(x * x for x in r[1]) < 1 << 62]
    out = []
    for a, u, ya in sorted({(d, tuple(v), y) for d, v, y in able if is_anchor(d)}):
        scored = [(sum(p * q for p, q in zip(u, v)), d, y) for d, v, y in able if d != a and len(v) == len(u)]
        rank = sorted((-s, d, y) for s, d, y in scored)
        for ps, pid, _ in [r for r in rank if r[2] == ya][:positives]:
            below = [(-s, d) for s, d, y in rank if y != ya and 80 * -ps <= 100 * -s <= 100 * -ps][:negatives]
            out += [(a, pid, k + 1, d, -ps, s) for k, (s, d) in enumerate(below)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)


def odd_rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).tolist(), str(i % 5)) for i in range(600)]
    tie = rows[0][1]
    rows += [(700 + i, tie, str(i % 3)) for i in range(30)]  # ties
    rows += [rows[100], rows[100], rows[7], (50, rows[9][1], "0"), (50, rows[10][1], "1")]  # repeated rows and keys
    rows += [(None, tie, "0"), (800, None, "0"), (900, tie, None), (801, [], "1"), (802, [None] + tie[1:], "1"),
             (803, [float("nan")] + tie[1:], "1"), (804, [float("inf")] + tie[1:], "1"), (805, [1e300] * 16, "1"),
             (1000, [0.0] * 16, "2"), (1050, [1.0, 2.0], "0"), (806, [1.0, 1.9], "1"), (807, [0.5, 1.0], "0"),
             (1100, [2.0 ** 20] * 16, "0"), (1101, [2.0 ** 20 - 1] * 16, "1"), (1102, [2.0 ** 20] * 15 + [1.0], "0")]
    return rows


@pytest.mark.parametrize("slab, block, pass_bytes", [(1024, 2048, 64 << 20), (4, 37, 2000)])
def test_equals_brute_force(spark, slab, block, pass_bytes):
    rows = odd_rows()
    vectors = frame(spark, rows).repartition(4)
    got = hn.hard_negatives(vectors, vectors.filter("vec_id % 50 = 0"), slab=slab, block=block, pass_bytes=pass_bytes)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    want = brute(rows, lambda d: d is not None and d % 50 == 0)
    assert len(want) > 100
    # anchors of one key but different rows are told apart inside only
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_spanning_tree_is_minimal_and_ordered():
    m = np.random.default_rng(1).integers(-50, 50, (40, 6))
    order, parent, edge = hn.spanning_tree(m)
    seen = set()
    for i in order:
        assert parent[i] == -1 or parent[i] in seen
        seen.add(int(i))
    pairs = sorted((math.dist(m[i], m[j]), i, j) for i in range(40) for j in range(i))
    root, total = list(range(40)), 0.0
    for d, i, j in pairs:
        while root[i] != i:
            i = root[i]
        while root[j] != j:
            j = root[j]
        if i != j:
            root[i], total = j, total + d
    assert len(seen) == 40 and edge.sum() == pytest.approx(total)


def test_bounds_spare_rescoring_where_anchors_are_close():
    """Groups of near anchors over spread rows: few pairs are scored."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 64))
    anchors = np.floor(256 * (centres[np.arange(200) % 8] + 0.01 * rng.normal(size=(200, 64)))).astype("<i8")
    rows = np.floor(256 * rng.normal(size=(4000, 64))).astype("<i8")
    rows[::8] = np.floor(256 * (centres[np.arange(500) % 8] + 0.05 * rng.normal(size=(500, 64))))
    order, parent, edge = hn.spanning_tree(anchors)
    slab = hn.Slab({"a_ids": range(200), "a_labels": [str(i % 4) for i in range(200)], "a_raw": anchors.tobytes(),
                    "order": order.tolist(), "parent": parent.tolist(), "edge": edge.tolist()}, 5, 5, (4, 5))
    ids = np.arange(1000, 5000)
    for k in range(0, 4000, 500):
        slab.scan(ids[k:k + 500], [str(i % 4) for i in range(500)], rows[k:k + 500])
    assert slab.met == 200 * 4000 and slab.rescored < 0.1 * slab.met
    for i, best in enumerate(g[0][1] for g in slab.goals):
        s = rows @ anchors[i]
        own = np.array([d % 500 % 4 == i % 4 for d in range(4000)])
        first = sorted(zip(-s[own], ids[own]))[:5]
        assert [(-int(x), int(y)) for x, y in first] == list(zip(best.scores.tolist(), best.ids.tolist()))


def test_empty_tables(spark):
    vectors = frame(spark, odd_rows())
    assert hn.hard_negatives(vectors.limit(0), vectors.limit(0)).collect() == []
    assert hn.hard_negatives(vectors, vectors.filter("false")).collect() == []
    assert hn.hard_negatives(vectors.filter("false"), vectors.filter("vec_id = 0")).collect() == []

"""Benchmark phrases and proximity matches against plain scans."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, row long, words string, n_words long, win string"
ITEMS = "item_id long, text string, row long, win string"


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def windows(items):
    out = {}
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            out.setdefault(tuple(w[i:i + 10]), set()).add(key)
    return out


def plain(docs, items):
    """(doc_id, n_words, n_hit, item names) of every document."""
    asked, out = windows(items), []
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(s) for s in asked}:
            for i in range(len(w) - n + 1):
                s = tuple(w[i:i + n])
                if s in asked:
                    hit.update(range(i, i + n))
                    names |= {str(k) for k in asked[s] if k is not None}
        out.append((d, len(w), len(hit), tuple(sorted(names))))
    return out


@pytest.fixture(scope="module")
def tables():
    rng = np.random.default_rng(17)
    vocabulary = [f"w{i}" for i in range(300)] + ["the"] * 200
    body = lambda n: rng.choice(vocabulary, n).tolist()
    items = [(i, body(int(rng.integers(1, 40)))) for i in range(25)]
    items += [(30, items[3][1]), (100, items[4][1][:12]), (9, items[9][1]), (None, body(15)), (40, []), (41, ["the"] * 3),
              (42, ["the"] * 14), (43, ["absent", "words"])]
    docs = [(i, body(int(rng.integers(0, 120)))) for i in range(150)]
    for i in range(60):  # planted, whole or in part, more than once
        src = items[int(rng.integers(0, 26))][1]
        docs.append((200 + i, body(7) + src + body(3) + src[:int(rng.integers(1, 12))] + body(5)))
    docs += [(400, ["the"] * 500), (401, body(30_000) + items[5][1]), (None, items[6][1]), (None, items[6][1]),
             (402, items[7][1]), (402, items[8][1])]
    marks = [" ", "  ", ", ", "\n", "-", "\x00", "'", "\t"]
    text = lambda w: "".join(x.upper() + str(rng.choice(marks)) for x in w)
    more = [(500, None), (501, ""), (502, " .,;"), (503, "É中 ÉÉ x́y")]
    return [(d, text(w)) for d, w in docs] + more, [(k, text(w)) for k, w in items] + [(50, None), (51, "É中 éé?")]


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, 1, "x", 2, "y") for d, t in docs], DOCS),
            spark.createDataFrame([(k, t, 3, "z") for k, t in items], ITEMS))


def test_phrases_equal_a_plain_scan(spark, tables):
    got = dc.decontaminate(*frames(spark, *tables)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == Counter(plain(*tables))
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_hit
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("rare, slab", [(1, 400), (5, 1 << 18)])
def test_any_number_of_lists_and_slabs(spark, tables, rare, slab):
    docs, items = frames(spark, *tables)
    tokens = dc.tokenized(docs, "doc_id", "text")
    wins, _ = dc.windows_of(items, "item_id", "text", 10)
    want = {tuple(r) for r in dc.matches(tokens, wins)[0].collect()}
    assert len(want) > 500
    assert {tuple(r) for r in dc.matches(tokens, wins, rare=rare, slab=slab)[0].collect()} == want


def test_shuffled_joins_beyond_the_broadcast_bounds(spark, tables):
    docs, items = frames(spark, *tables)
    tokens = dc.tokenized(docs, "doc_id", "text")
    wins, pairs = dc.windows_of(items, "item_id", "text", 10)
    plan = dc.rarest_terms(tokens, wins, 3)
    found = dc.intersected(dc.postings(tokens, plan), plan, 3)
    sort = lambda df: sorted(map(tuple, df.collect()))
    near = dc.confirmed(tokens, wins, found)
    assert sort(dc.confirmed(tokens, wins, found, rows_bound=0)) == sort(near)
    assert sort(dc._named(near, pairs, bound=0, salts=3)) == sort(dc._named(near, pairs))


def test_proximity_equals_a_plain_scan(spark, tables):
    docs, items = tables
    slop, rare = 4, 3
    count = Counter(w for _, t in docs for w in words(t))
    want = Counter()
    texts = [words(t) for _, t in docs]
    for s, keys in windows(items).items():
        if any(w not in count for w in s):
            continue
        terms = sorted({w: (count[w], s.index(w)) for w in s}.items(), key=lambda x: x[1])[:rare]
        offs = [(w, o) for w, (_, o) in terms]
        for r, w in enumerate(texts):
            for p, x in enumerate(w):
                if x == offs[0][0]:
                    start = p - offs[0][1]
                    if all(t in w[max(0, start + o - slop):max(0, start + o + slop + 1)] for t, o in offs[1:]):
                        want.update({(r, k) for k in keys if k is not None})
    got = dc.decontaminate(*frames(spark, docs, items), near=slop).collect()
    assert sum(r.n_near for r in got) == len(want) and len(want) > 100
    assert all(r.n_near >= len(r["items"]) for r in got)


def test_empty_tables(spark, tables):
    docs, items = frames(spark, *tables)
    assert dc.decontaminate(docs.limit(0), items).collect() == []
    assert all(r.n_hit == 0 and r["items"] == [] for r in dc.decontaminate(docs.limit(20), items.limit(0)).collect())


def test_registered_query(spark, tables, tmp_path):
    from panelkit.llm.queries import QUERIES

    docs, items = frames(spark, *tables)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op12_positional_index"](spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"),
                          ("items_sha256", "string"), ("contaminated", "boolean")]
    assert Counter(map(tuple, got.collect())) == Counter(
        (d, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for d, n, h, x in plain(*tables))

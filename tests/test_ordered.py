"""Windows over one long series and dictionaries of wide keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Window, functions as F

from panelkit.operators import ordered

SCHEMA = "flag string, at int, x long, y double"


def _rows(n=900):
    rng = random.Random(8)
    rows = [("hot" if i % 3 else f"s{i % 5}", i, rng.randrange(50) if rng.random() < 0.8 else None, float(i % 7))
            for i in range(n)]
    rows += [(None, i, i, 1.0) for i in range(5)] + [("one", 1, None, 2.0)]
    rows += [("blank", i, None, 1.0) for i in range(20)] + [("late", i, None if i < 12 else 1, 1.0) for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows_per_block, preceding, following, back", [(10, 3, 1, 1), (1, 5, 4, 7), (4, 0, 2, 1),
                                                                       (1 << 20, 3, 1, 2)])
def test_long_windows_equal_whole_windows(spark, rows_per_block, preceding, following, back):
    df = spark.createDataFrame(_rows(), SCHEMA)
    got = ordered.long_windows(df, ["at"], series=["flag"], running={"total": "x"}, lags={"before": ("x", back)},
                               rolling={"near": "x"}, preceding=preceding, following=following,
                               rows_per_block=rows_per_block)
    w = Window.partitionBy("flag").orderBy("at")
    want = df.select("*", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
                     F.lag("x", back).over(w).alias("before"),
                     F.sum("x").over(w.rowsBetween(-preceding, following)).alias("near"))
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_no_block_holds_a_series(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    placed = ordered.positions(df, ["at"], series=["flag"], rows_per_block=20)
    sizes = {(r.flag, r._block): r["count"] for r in placed.groupBy("flag", "_block").count().collect()}
    assert max(sizes.values()) <= 80 and sum(f == "hot" for f, _ in sizes) > 8
    for flag in ("hot", "s0", None):
        at = sorted((r._pos, r.at) for r in placed.filter(F.col("flag").eqNullSafe(flag)).collect())
        assert [p for p, _ in at] == list(range(len(at))) and [a for _, a in at] == sorted(a for _, a in at)


def test_a_series_without_a_key_and_empty_input(spark):
    df = spark.createDataFrame(_rows(200), SCHEMA).filter("flag = 'hot'")
    got = ordered.long_windows(df, ["at"], running={"total": "x"}, rows_per_block=5).agg(F.max("total")).first()[0]
    assert got == df.agg(F.sum("x")).first()[0]
    assert ordered.long_windows(df.limit(0), ["at"], series=["flag"], rolling={"r": "x"}).collect() == []


def test_frequency_index_and_encoding(spark):
    rng = random.Random(2)
    keys = ["big"] * 3000 + [f"k{rng.randrange(400)}" for _ in range(3000)] + [None] * 40
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")
    known = ordered.frequency_index(df.filter("id % 2 = 0"), "k", rows_per_block=30)
    count = Counter(k for i, k in enumerate(keys) if i % 2 == 0 and k is not None)
    want = {k: i for i, (k, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0])))}
    assert {r.k: r["index"] for r in known.collect()} == want and want["big"] == 0
    for share in (1, 16, 1024):
        got = ordered.encode(df, known, "k", hot_share=share).collect()
        assert Counter((r.id, r.k, r["index"]) for r in got) == Counter(
            (i, k, want.get(k, len(want))) for i, k in enumerate(keys))
    slots = ordered.wide_one_hot(ordered.encode(df, known, "k"), known, ["id"]).collect()
    assert {(r.id, r.slot, r.value) for r in slots} == {(i, want[k], 1.0) for i, k in enumerate(keys) if k in want}


def test_index_equals_the_string_indexer(spark):
    from panelkit.operators import model as ml

    df = spark.createDataFrame([(k,) for k in "bacabcbbdd"], "State string")
    labels = ml.state_indexer().fit(df).labels
    got = ordered.frequency_index(df, "State").orderBy("index").collect()
    assert [r.State for r in got] == list(labels)


def test_dictionary_of_nothing(spark):
    df = spark.createDataFrame([(1, "a")], "id long, k string")
    none = ordered.frequency_index(df.limit(0), "k")
    assert none.collect() == []
    assert [tuple(r) for r in ordered.encode(df, none, "k").collect()] == [(1, "a", 0)]

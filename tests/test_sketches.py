"""Stored sketches of keys and values against exact counts and ranks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelkit.operators import quality, sketches


@pytest.mark.parametrize("n", [500, 60_000])
def test_match_report_is_inside_its_bounds(spark, n):
    left = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 5).alias("part"))
    right = spark.range(n // 3, 2 * n).select(F.col("id").alias("k"), (F.col("id") % 3).alias("part"))
    nulls = spark.createDataFrame([(None, 0)] * 9, "k long, part long")
    left, right = left.union(nulls).union(left.limit(50)), right.union(nulls)
    got = sketches.sketch_match_report(*[sketches.key_sketches(x, "k", ["part"]) for x in (left, right)]).first()
    want = quality.key_match_report(left, right, "k").first()
    for c in ("n_left", "n_right", "n_matched", "n_missing"):
        assert abs(got[c] - want[c]) <= got[f"{c}_bound"], c
        assert got[f"{c}_bound"] == 0 if n == 500 else 0 < got[f"{c}_bound"] < 0.2 * 2 * n
    assert got.pct_matched == pytest.approx(want.pct_matched, abs=0.0 if n == 500 else 8)


def test_merging_equals_sketching_at_once(spark):
    df = spark.range(30_000).select((F.col("id") % 9000).alias("k"), (F.col("id") % 7).alias("part"))
    parts = sketches.key_sketches(df, "k", ["part"])
    assert parts.count() == 7
    at_once = sketches.key_sketches(df, "k")
    est = lambda s: s.select(F.theta_sketch_estimate("keys")).first()[0]
    assert est(sketches.merged_keys(parts)) == pytest.approx(est(at_once), rel=0.05)


def test_merged_medians_have_a_bounded_rank_error(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919 % 40_009).cast("double")).alias("v"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"), (F.col("id") % 6).alias("part"))
    stored = sketches.value_sketches(df, "v", ["g", "part"])
    for by in (["g"], []):
        q = sketches.merged_quantiles(stored, by)
        rows = sketches.rank_check(df, "v", q, by).collect()
        assert len(rows) == (4 if by else 1) and all(r.inside and r.low <= r.high for r in rows)
        assert sum(r.n for r in rows) == sum(r.n for r in q.collect()) == df.filter("v IS NOT NULL").count()
    wrong = sketches.merged_quantiles(stored).withColumn("quantile", F.lit(1000.0))
    assert not sketches.rank_check(df, "v", wrong).first().inside


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([], "k long, v double, part long")
    assert sketches.merged_quantiles(sketches.value_sketches(df, "v", ["part"]), ["part"]).collect() == []


@pytest.mark.parametrize("skew", ["skewed", "flat", "few"])
def test_heavy_hitters_equal_exact_counts(spark, skew):
    k = {"skewed": F.when(F.col("id") % 3 == 0, F.col("id") % 6).otherwise(F.col("id")),
         "flat": F.col("id") % 9_001, "few": F.col("id") % 3}[skew]
    df = spark.range(40_000).select(F.when(F.col("id") % 50 != 7, k).alias("k"), F.lit(1).alias("_k"))
    for n, buckets in ((5, 1 << 16), (5, 16), (1, 256)):
        got = sketches.heavy_hitters(df, "k", n, counters=64, buckets=buckets, probed=4)
        assert got.columns == ["k", "n_rows"]
        assert list(map(tuple, got.collect())) == list(map(tuple, quality.top_values(df, "k", n).collect()))


def test_heavy_hitters_of_texts_and_of_nothing(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,), (None,), ("b",), ("",), ("x" * 5000,)], "k string")
    assert [r.k for r in sketches.heavy_hitters(df, "k", 4).collect()] == [None, "a", "b", ""]
    assert sketches.heavy_hitters(df.limit(0), "k").collect() == []

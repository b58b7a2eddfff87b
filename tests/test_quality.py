"""Join validation, value counts and the distributed exact median."""

from __future__ import annotations

import random
import statistics

from panelkit.functions import stats
from panelkit.operators import quality


def test_key_sets_and_report(spark):
    # keys_join: 3 facility utilities (+ a NULL), 2 of them in the sales data
    left = spark.createDataFrame([("A", "VA"), ("B", "VA"), ("C", "TX"), (None, "TX"), ("A", "OH")],
                                 "Utility_Name string, State string")
    right = spark.createDataFrame([("A",), ("B",), ("D",)], "Utility_Name string")
    assert sorted(r[0] for r in quality.matched_keys(left, right, "Utility_Name").collect()) == ["A", "B"]
    assert [r[0] for r in quality.missing_keys(left, right, "Utility_Name").collect()] == ["C"]
    rep = quality.key_match_report(left, right, "Utility_Name").collect()[0].asDict()
    assert rep == {"n_left": 3, "n_right": 3, "n_matched": 2, "n_missing": 1, "pct_matched": 66.7}


def test_inner_join_drops_null_keys(spark):
    a = spark.createDataFrame([("A", "VA", 1), (None, "VA", 2)], "u string, s string, x int")
    b = spark.createDataFrame([("A", "VA", 2019), ("A", "VA", 2020), (None, "VA", 2020)],
                              "u string, s string, y int")
    assert quality.inner_join(a, b, ["u", "s"]).count() == 2


def test_top_values_ties_by_key(spark):
    df = spark.createDataFrame([(s,) for s in "CCBBAADEF"], "State string")
    out = [tuple(r) for r in quality.top_values(df, "State", n=4).collect()]
    assert out == [("A", 2), ("B", 2), ("C", 2), ("D", 1)]


def _median(spark, values, buckets=8):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return stats.exact_median(df, "v", buckets=buckets).collect()[0].median


def test_exact_median_matches_statistics(spark):
    rnd = random.Random(7)
    for n in (1, 2, 3, 10, 101, 1000):
        vals = [round(rnd.uniform(0, 100), 3) for _ in range(n)]
        assert _median(spark, vals) == statistics.median(vals)


def test_exact_median_hot_value_and_nulls(spark):
    # one value holds a third of the rows; NULLs are ignored
    vals = [5.0] * 400 + [float(i) for i in range(800)]
    got = _median(spark, vals + [None] * 10)
    assert got == statistics.median(vals)


def test_summary_row(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "p double")
    r = quality.summary(df, "p").collect()[0]
    assert (r["min"], r["max"], r["n"], r["median"]) == (1.0, 4.0, 3, 2.0)
    assert abs(r["mean"] - 7 / 3) < 1e-12


def test_exact_median_empty_and_single(spark):
    assert _median(spark, []) is None
    assert _median(spark, [None, None]) is None
    assert _median(spark, [3.5]) == 3.5


def test_approximate_summary_is_close(spark):
    vals = [float(i) for i in range(10001)]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    approx = quality.summary(df, "p", exact=False).first()
    exact = quality.summary(df, "p").first()
    assert exact["median"] == 5000.0
    assert abs(approx["median"] - 5000.0) <= 2.0
    assert (approx["min"], approx["max"], approx["n"]) == (0.0, 10000.0, 10001)

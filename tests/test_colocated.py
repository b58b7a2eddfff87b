"""Tables bucketed alike meet without a shuffle."""

from __future__ import annotations

import os

import pytest

from panelkit.operators import quality
from panelkit.sinks import writers

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_orders_meet_line_items_without_exchange(spark):
    from panelkit.plans import catalog

    df = catalog.QUERIES["colocated_order_lines"](spark, SF)
    assert "SortMergeJoin" in _plan(df) and "Exchange" not in _plan(df)
    df.collect()
    assert "Exchange" not in _plan(df)  # nor after the plan was made anew at run time


def test_bucketed_join_equals_the_plain_one(spark, scratch):
    left = spark.createDataFrame([(i % 40 if i % 9 else None, i) for i in range(300)], "k long, a long")
    right = spark.createDataFrame([(i if i % 7 else None, -i) for i in range(60)], "k long, b long")
    tables = [writers.write_bucketed(df, f"bucket_test_{n}", ["k"], 5, path=scratch(n))
              for n, df in (("l", left), ("r", right))]
    for how in ("inner", "left", "full"):
        got = quality.colocated_join(*tables, ["k"], how=how)
        assert "Exchange" not in _plan(got)
        key = lambda r: str(tuple(r))
        assert sorted(got.collect(), key=key) == sorted(left.join(right, ["k"], how).collect(), key=key)
    assert tables[0].count() == 300 and 0 < len(tables[0].inputFiles()) <= 5
    empty = writers.write_bucketed(left.limit(0), "bucket_test_empty", ["k"], 5, path=scratch("e"))
    assert empty.count() == 0 and empty.dtypes == left.dtypes
    assert quality.colocated_join(tables[0], empty, ["k"], "left").count() == 300

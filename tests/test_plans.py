"""Plan shape: pushdown and pruning reach the scans, no Python UDF runs,
the flagship's main plan reads only the two written aggregates; and a hot
key (a third of all rows) gives the same panel as a brute-force count."""

from __future__ import annotations

import os
import random
import re
from collections import Counter, defaultdict

import pytest

from panelkit.operators import panel
from panelkit.plans import roles
from panelkit.sources.tables import read_table

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_sales_scan_is_pruned(spark):
    plan = _plan(roles.utility_sales(spark, SF))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln]
    assert scans
    for ln in scans:
        schema = ln.split("ReadSchema: ")[1]
        assert "l_discount" not in schema and "l_tax" not in schema and "l_partkey" not in schema


@needs_tables
def test_no_python_udf_in_plans(spark):
    from __spark_entry__ import queries

    for key in ("panel_flagship", "consolidate_duplicates", "header_mapping",
                "ragged_rows_filter", "scenario_wide", "price_summary", "key_match_report"):
        plan = _plan(queries()[key](spark, SF))
        assert "PythonUDF" not in plan and "EvalPython" not in plan, key


@needs_tables
def test_flagship_reads_written_aggregates_only(spark):
    from __spark_entry__ import queries

    plan = _plan(queries()["panel_flagship"](spark, SF))
    for table in ("lineitem", "orders", "customer", "supplier"):
        assert f"{table}.parquet" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_state_matches_brute_force(spark):
    rnd = random.Random(11)
    states = [f"S{i:02d}" for i in range(12)]
    fac = []
    for i in range(3000):
        s = "S00" if i % 3 == 0 else rnd.choice(states[1:])   # a third in one state
        fac.append((s, rnd.choice([None] + list(range(2000, 2016)))))
    sales = [(s, y, rnd.uniform(0.05, 0.3)) for s in states for y in range(2005, 2013)
             for _ in range(rnd.randint(1, 3))]
    fdf = spark.createDataFrame(fac, "State string, Opening_Year int").repartition(7)
    sdf = spark.createDataFrame(sales, "State string, Year int, Price_Per_kWh double")
    cum, _ = panel.cumulative_panel(fdf, sdf)
    got = {(r.State, r.Year): (r.DC_Opened, r.Cumulative_DC) for r in cum.collect()}

    opened = Counter((s, y) for s, y in fac if y is not None and 2005 <= y)
    pre = Counter(s for s, y in fac if y is not None and y < 2005)
    want, run = {}, defaultdict(int)
    for s in sorted({s for s, _ in fac}):
        run[s] = pre[s]
        for y in range(2005, 2013):
            run[s] += opened[(s, y)]
            want[(s, y)] = (opened[(s, y)], run[s])
    assert got == want


@needs_tables
def test_preaggregated_counts_equal_row_counts(spark):
    from pyspark.sql import functions as F

    a = roles.facility_counts(spark, SF).withColumn("Capacity_MW", F.round("Capacity_MW", 2))
    b = (panel.event_counts(roles.facilities(spark, SF), sums=("Capacity_MW",))
         .withColumn("Capacity_MW", F.round("Capacity_MW", 2)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))


@needs_tables
def test_year_partitioned_layout_prunes_partitions(spark, scratch):
    from pyspark.sql import functions as F

    from panelkit.sinks import writers

    path = scratch("power_by_year")
    writers.write_csv(roles.utility_sales(spark, SF), path, partition_by=["Year"])
    df = spark.read.option("header", True).csv(path).filter(F.col("Year") >= 2000)
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    part = [re.sub(r"#\d+", "", ln) for ln in formatted.splitlines()
            if ln.startswith("PartitionFilters")]
    assert part and "isnotnull(Year" in part[0] and "(Year >= 2000)" in part[0]
    assert {r.Year for r in df.select("Year").distinct().collect()} == {2000, 2001}


@needs_tables
def test_line_items_are_pre_aggregated_before_every_shuffle(spark):
    # each Exchange fed (directly or through a projection) by the line-item
    # scan must sit on a partial aggregate, so hot keys are combined map side
    plan = _plan(roles.utility_sales(spark, SF)).splitlines()
    scan_depths = [i for i, ln in enumerate(plan) if "FileScan parquet" in ln and "lineitem" in ln]
    assert scan_depths
    for i in scan_depths:
        above = [ln for ln in plan[max(0, i - 6):i] if "Exchange" in ln or "HashAggregate" in ln]
        # nearest operator of interest above the scan is a partial aggregate
        assert above and "partial_" in above[-1], above
        # a partial aggregate on nearly unique keys would reduce nothing
        assert "l_orderkey" not in above[-1], above[-1]
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert roles.supplier_year_sales(read_table(spark, SF, "lineitem")).count() < 0.05 * lines


@needs_tables
def test_first_line_filter_reaches_the_scan(spark):
    formatted = spark._jvm.PythonSQLUtils.explainString(
        roles.facility_utilities(spark, SF)._jdf.queryExecution(), "formatted")
    pushed = [re.sub(r"#\d+", "", ln) for ln in formatted.splitlines()
              if ln.startswith("PushedFilters") and "l_linenumber" in ln]
    assert pushed and "EqualTo(l_linenumber,1)" in pushed[0]

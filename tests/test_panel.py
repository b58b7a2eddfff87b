"""Panel operators on hand-written fixtures (quirks Q1, Q4, Q5, Q12)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelkit.operators import features, panel

FAC_COLS = "State string, Opening_Year int"
SALES_COLS = "State string, Year int, Price_Per_kWh double"


def _fac_min(spark):
    # 3 states; years 2010-2016 priced; one NULL year (state CC only), one
    # opening after the last priced year, two pre-period openings in AA
    rows = [("AA", 2005), ("AA", 2008), ("AA", 2011), ("AA", 2011), ("AA", 2014),
            ("BB", 2012), ("BB", 2019), ("CC", None)]
    return spark.createDataFrame(rows, FAC_COLS)


def _sales(spark, states=("AA", "BB", "CC"), years=range(2010, 2017), skip=()):
    rows = [(s, y, 0.1 + 0.01 * (y - 2010) + (0.001 * i))
            for i, s in enumerate(states) for y in years if (s, y) not in skip]
    return spark.createDataFrame(rows, SALES_COLS)


def test_grid_covers_every_state_and_year(spark):
    fac, sales = _fac_min(spark), _sales(spark)
    b = panel.year_bounds(sales)
    assert b.collect()[0].asDict() == {"min_year": 2010, "max_year": 2016}
    grid = panel.panel_grid(fac, b)
    # Q4: CC has only a NULL opening year and still enters the grid
    assert grid.count() == 3 * 7
    assert {r.State for r in grid.collect()} == {"AA", "BB", "CC"}
    assert [r.Year for r in panel.year_spine(b).orderBy("Year").collect()] == list(range(2010, 2017))


def test_counts_and_running_total(spark):
    fac, sales = _fac_min(spark), _sales(spark)
    cum, _ = panel.cumulative_panel(fac, sales, materialize_inputs=False)
    got = {(r.State, r.Year): (r.DC_Opened, r.Cumulative_DC) for r in cum.collect()}
    # pre-period baseline of 2 enters AA's running count from the first year
    assert got[("AA", 2010)] == (0, 2)
    assert got[("AA", 2011)] == (2, 4)
    assert got[("AA", 2016)] == (0, 5)
    # Q5: BB's 2019 opening is after the last priced year and is not counted
    assert got[("BB", 2016)] == (0, 1)
    # Q4: the NULL year is never counted
    assert all(v == (0, 0) for (s, _), v in got.items() if s == "CC")
    # property: running count never decreases within a state
    for s in ("AA", "BB", "CC"):
        seq = [got[(s, y)][1] for y in range(2010, 2017)]
        assert seq == sorted(seq)


def test_materialized_inputs_give_same_panel(spark):
    fac, sales = _fac_min(spark), _sales(spark)
    direct = sorted(map(tuple, panel.build_panel(fac, sales).collect()))
    cum, prices = panel.cumulative_panel(fac, sales, materialize_inputs=False)
    lazy = panel.price_integration(cum, prices)
    lazy = features.recent_activity_filter(features.rolling_sum(features.lag_feature(lazy)))
    assert direct == sorted(map(tuple, lazy.collect()))


def test_lag_skips_a_missing_year(spark):
    # Q12: AA has no 2012 price; 2013's previous price is 2011's
    fac = _fac_min(spark)
    sales = _sales(spark, skip={("AA", 2012)})
    cum, prices = panel.cumulative_panel(fac, sales, materialize_inputs=False)
    lagged = features.lag_feature(panel.price_integration(cum, prices))
    rows = {(r.State, r.Year): r for r in lagged.collect()}
    assert ("AA", 2012) not in rows
    assert rows[("AA", 2013)].PrevPrice == rows[("AA", 2011)].Avg_kWh
    # the first priced year of each state has no previous price and drops
    assert ("AA", 2010) not in rows and ("BB", 2010) not in rows


def test_activity_frame_includes_next_row(spark):
    # Q1: a single opening in year 5 of 10 keeps years 4-8 with (-3, +1)
    # and 5-8 with the trailing-only frame (-3, 0)
    df = spark.createDataFrame([("AA", y, 1 if y == 5 else 0) for y in range(1, 11)],
                               "State string, Year int, DC_Opened long")
    keep = features.recent_activity_filter(features.rolling_sum(df))
    assert [r.Year for r in keep.orderBy("Year").collect()] == [4, 5, 6, 7, 8]
    trailing = features.recent_activity_filter(features.rolling_sum(df, following=0))
    assert [r.Year for r in trailing.orderBy("Year").collect()] == [5, 6, 7, 8]


def test_weighted_price_option(spark):
    df = spark.createDataFrame([("AA", 2010, 10.0, 100.0, 0.1), ("AA", 2010, 30.0, 100.0, 0.3)],
                               "State string, Year int, Rev double, Sales double, Price_Per_kWh double")
    plain = panel.avg_price(df).collect()[0].Avg_kWh
    weighted = panel.avg_price(df, weighted_by="Sales", revenue="Rev").collect()[0].Avg_kWh
    assert abs(plain - 0.2) < 1e-12 and abs(weighted - 0.2) < 1e-12
    df2 = df.withColumn("Sales", F.when(F.col("Rev") == 10.0, 300.0).otherwise(100.0))
    w2 = panel.avg_price(df2, weighted_by="Sales", revenue="Rev").collect()[0].Avg_kWh
    assert abs(w2 - 0.1) < 1e-12


def test_customer_keys_use_whole_tables(spark):
    import os

    from panelkit import schemas as S
    from panelkit.plans import catalog, roles

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    orders = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert roles.customer_counts(spark, sf).agg({"n": "sum"}).first()[0] == orders
    base = {(r.custkey, r.Year): r for r in catalog.QUERIES["customer_features"](spark, sf).collect()}
    wide = catalog.QUERIES["customer_scenarios"](spark, sf).collect()
    assert {(r.custkey, r.Year) for r in wide} == set(base) and len(wide) == len(base)
    for r in wide:
        b = base[r.custkey, r.Year]
        assert (r.DC_Opened, r.PrevPrice, r.Avg_kWh) == (b.DC_Opened, b.PrevPrice, b.Avg_kWh)
        for name, factor in [("baseline", 1.0), *S.SCENARIOS]:
            assert r[f"Pred_{name}"] == pytest.approx(b.PrevPrice + 0.001 * factor * b.DC_Opened, abs=2e-6)
    rows = catalog.QUERIES["customer_forest"](spark, sf).collect()
    assert len(rows) == len(base) > 100
    assert {r.split for r in rows} == {"train", "test"}
    assert all(r.Pred_baseline > 0 and r.Pred_ban0 > 0 for r in rows)

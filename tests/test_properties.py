"""Property-based checks (hypothesis) of the header rules and the exact
median."""

from __future__ import annotations

import statistics

from hypothesis import given, settings, strategies as st

from panelkit import schemas as S
from panelkit.functions import stats
from panelkit.functions.headers import dedupe_names, header_map

BLOCK = ["Thousand Dollars", "Megawatthours", "Count"]


@given(st.integers(min_value=1, max_value=6), st.booleans(),
       st.lists(st.sampled_from(["Note", "Region", "Ownership"]), max_size=3))
def test_rightmost_total_block_wins(blocks, total_word, extra):
    names = ["Data Year", "Utility Number", "Utility Name", "State", *extra]
    for b in range(blocks):
        names += BLOCK
    if total_word:
        names += ["Total Revenue Thousand Dollars"]
    names = dedupe_names(names)
    m = header_map(names)
    rev = [k for k, v in m.items() if v == "Revenue_Thousands"]
    assert len(rev) == 1
    if total_word:
        assert rev[0] == "Total Revenue Thousand Dollars"
    elif blocks >= 5:
        assert rev[0] == "Thousand Dollars.4"   # the rightmost ".4"-marked column
    else:
        cands = [n for n in names if "Thousand Dollars" in n]
        assert rev[0] == cands[-1]               # no marker: the last one
    assert set(m.values()) <= set(S.REQUIRED_COLUMNS)
    assert len(set(dedupe_names(names))) == len(names)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=0, max_size=60),
       st.integers(min_value=2, max_value=16))
def test_exact_median_equals_statistics(spark, values, buckets):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = stats.exact_median(df, "v", buckets=buckets).first().median
    present = [v for v in values if v is not None]
    assert got == (statistics.median(present) if present else None)


def _brute_panel(fac, sales, preceding=3, following=1):
    """Plain-Python flagship: the semantics spelled out step by step."""
    years = [y for _, y, _ in sales]
    if not years:
        return []
    lo, hi = min(years), max(years)
    states = sorted({s for s, _ in fac})
    prices = {}
    for s, y, p in sales:
        prices.setdefault((s, y), []).append(p)
    out = []
    for s in states:
        cum = sum(1 for fs, fy in fac if fs == s and fy is not None and fy < lo)
        rows = []
        for y in range(lo, hi + 1):
            opened = sum(1 for fs, fy in fac if fs == s and fy == y)
            cum += opened
            if (s, y) in prices:                       # inner join on prices
                rows.append([y, opened, cum, sum(prices[(s, y)]) / len(prices[(s, y)])])
        lagged = [r + [rows[i - 1][3]] for i, r in enumerate(rows) if i > 0]
        for i, r in enumerate(lagged):
            window = lagged[max(0, i - preceding): i + following + 1]
            if sum(w[1] for w in window) > 0:
                out.append((s, r[0], r[1], r[2], round(r[3], 9), round(r[4], 9)))
    return sorted(out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["AA", "BB", "CC"]),
                          st.one_of(st.none(), st.integers(2000, 2012))), max_size=40),
       st.lists(st.tuples(st.sampled_from(["AA", "BB", "CC", "DD"]), st.integers(2002, 2010),
                          st.integers(1, 99).map(lambda x: x / 100)), min_size=1, max_size=40))
def test_flagship_matches_brute_force(spark, fac, sales):
    from pyspark.sql import functions as F

    from panelkit.operators import panel

    fdf = spark.createDataFrame(fac, "State string, Opening_Year int")
    sdf = spark.createDataFrame(sales, "State string, Year int, Price_Per_kWh double")
    got = panel.build_panel(fdf, sdf).select(
        "State", "Year", "DC_Opened", "Cumulative_DC",
        F.round("Avg_kWh", 9).alias("Avg_kWh"), F.round("PrevPrice", 9).alias("PrevPrice"))
    assert sorted(map(tuple, got.collect())) == _brute_panel(fac, sales)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["U1", "U2"]), st.sampled_from(["AA", "BB"]),
                          st.sampled_from([2019, 2020]),
                          st.one_of(st.none(), st.sampled_from(["1.0", "2.0", "3.0"])),
                          st.one_of(st.none(), st.integers(0, 50).map(float)),
                          st.one_of(st.none(), st.integers(0, 3).map(float)),
                          st.one_of(st.none(), st.integers(0, 9).map(float))),
                max_size=30))
def test_consolidation_matches_brute_force(spark, rows):
    from panelkit.operators import clean

    data = [(*r[:4], i, *r[4:]) for i, r in enumerate(rows)]          # i = source order
    df = spark.createDataFrame(data, "Utility_Name string, State string, Year int, "
                               "Utility_ID string, ord int, Revenue_Thousands double, "
                               "Sales_MWh double, Customers double")
    got = {(r.Utility_Name, r.State, r.Year):
           (r.Utility_ID, r.Revenue_Thousands, r.Sales_MWh, r.Customers, r.Price_Per_kWh)
           for r in clean.consolidate_duplicates(df, order="ord").collect()}
    want = {}
    for key in {r[:3] for r in data}:
        grp = sorted((r for r in data if r[:3] == key), key=lambda r: r[4])
        ids = [r[3] for r in grp if r[3] is not None]
        rev, sales, cust = (sum(r[j] for r in grp if r[j] is not None) for j in (5, 6, 7))
        want[key] = (ids[0] if ids else None, float(rev), float(sales), float(cust),
                     rev / sales if sales else None)
    assert got == want


_FIELD = st.one_of(
    st.text(alphabet="abcxyz019 .-\\", max_size=6),
    st.text(alphabet='abc, 12\\"', max_size=6).map(lambda t: '"' + t.replace('"', '""') + '"'))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(_FIELD, min_size=1, max_size=6), min_size=1, max_size=20))
def test_positional_values_equal_csv_module(spark, rows):
    import csv

    from panelkit.operators import clean

    lines = [",".join(r) for r in rows]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    for arity in (2, 3, 5):
        got = sorted(tuple(v or "" for v in r) for r in clean.ragged_rows_filter(df, arity=arity).collect())
        want = sorted(tuple(r) for r in csv.reader([x for x in lines if x]) if len(r) == arity)
        assert got == want

"""Sheets of many layouts in one scan (S7, P17), observed step counts (A10)."""

from __future__ import annotations

import csv
import os

import pytest
from pyspark.sql import functions as F

from panelkit.operators import clean
from panelkit.sources import csv as csv_src

IDS = ["Data Year", "Utility Number", "Utility Name", "State"]
VALUES = ["Thousand Dollars", "Megawatthours", "Count"]


def _write(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w", newline="") as f:
        f.write("a title\nunits\n")
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


def _layout(i):
    """Rotated columns, ``i`` notes columns in front: every i another layout."""
    names = IDS + VALUES
    k = i % len(names)
    return [f"Note {j}" for j in range(i // len(names))] + names[k:] + names[:k]


def _sheet(i):
    record = {"Data Year": "2001.0" if i % 2 else "2001", "Utility Number": f"{i}.0", "Utility Name": f" U, {i} ",
              "State": "aa", "Thousand Dollars": str(10 * i), "Megawatthours": "5", "Count": "x" if i % 3 else "7"}
    return [record.get(n, 'a "note", here') for n in _layout(i)]


def _rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_two_hundred_layouts_one_scan(spark, tmp_path):
    for i in range(200):
        _write(str(tmp_path), f"s{i}", _layout(i), [_sheet(i)])
    df = csv_src.read_sheets(spark, str(tmp_path))
    got = {r.Utility_ID: r for r in df.collect()}
    assert len(got) == 200
    for i in range(200):
        r = got[f"{i}.0"]
        assert (r.Utility_Name, r.State, r.Year) == (f"U, {i}", "AA", 2001)
        assert (r.Revenue_Thousands, r.Sales_MWh) == (10.0 * i, 5.0)
        assert r.Customers == (None if i % 3 else 7.0) and r.Price_Per_kWh == 2.0 * i
    # the written lines are read once and parsed once
    raw = csv_src.read_layouts(spark, str(tmp_path), targets=["State", "_y"])
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value#") == 1 and "Union" not in plan
    assert plan.count("from_csv") + plan.count("csvtostructs") == 1


def test_equal_to_one_scan_a_layout(spark, tmp_path):
    for i in (0, 3, 8, 20):
        rows = [_sheet(i), _sheet(i)[:4], [*_sheet(i), "over", "long"], [], _sheet(i)]
        _write(str(tmp_path), f"s{i}", _layout(i), rows)
    _write(str(tmp_path), "short", ["Data Year", "State", "Utility Name"], [["1999", "b", "V"], ["1999", "c"], [""]])
    _write(str(tmp_path), "repeats", IDS + VALUES * 5, [["2000", "1", "W", "d", *map(str, range(15))]])
    keep = ("_file", "_line")
    one = csv_src.read_sheets(spark, str(tmp_path), keep=keep)
    each = csv_src.read_preamble_csv(spark, str(tmp_path), per_layout=lambda df: clean.clean_sheet(df, keep=keep))
    assert set(one.columns) == set(each.columns) and dict(one.dtypes) == dict(each.dtypes)
    assert _rows(one, sorted(one.columns)) == _rows(each, sorted(one.columns))
    w = one.filter("State = 'D'").first()
    assert (w.Revenue_Thousands, w.Sales_MWh, w.Customers) == (12.0, 13.0, 14.0)


def test_layout_errors(spark, tmp_path):
    _write(str(tmp_path / "a"), "s", ["State", "Count"], [["x", "1"]])
    with pytest.raises(ValueError, match="Data Year"):
        csv_src.read_sheets(spark, str(tmp_path / "a"))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "s.csv").write_text("only a title\n")
    with pytest.raises(ValueError, match="no header line"):
        csv_src.read_sheets(spark, str(tmp_path / "b"))


def test_observed_counts_equal_the_aggregate(spark, scratch):
    rows = [(i % 7, None if i % 5 == 0 else float(i), "7.0" if i % 4 == 0 else None if i % 11 == 0 else str(i))
            for i in range(500)]
    df = spark.createDataFrame(rows, "_n long, Sales_MWh double, Utility_ID string").repartition(6)
    how = dict(count_col="_n", keep_sizes=F.col("Sales_MWh") > 40, keep_codes=F.col("Utility_ID") != "7.0")
    out, seen = clean.observed_step_counts(df, **how)
    path = scratch("observed")
    out.write.parquet(path)
    assert spark.read.parquet(path).count() == 500
    got = clean.observed_row(spark, seen)
    assert got.collect() == clean.clean_step_counts(df, **how).collect()
    out, seen = clean.observed_step_counts(df.limit(0), **how)
    out.write.parquet(scratch("observed_none"))
    assert clean.observed_row(spark, seen).collect() == clean.clean_step_counts(df.limit(0), **how).collect()

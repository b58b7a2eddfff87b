"""Cleaning operators and readers on hand-written fixtures (Q7, Q9, Q10,
Q16, Q18, A5, A9)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelkit import schemas as S
from panelkit.functions.headers import dedupe_names, header_map
from panelkit.operators import clean
from panelkit.sinks import writers
from panelkit.sources import csv as csv_src


def test_code_exclusion_numeric_and_null(spark):
    # Q7: '99999.0' and '99999' both excluded, NULL dropped, all else kept
    ids = ["99999.0", "99999", None, "123.0", "abc", "3000000000.0", "12A", "99999.7", "5.0"]
    df = spark.createDataFrame([(i,) for i in ids], "Utility_ID string")
    out = clean.exclude_codes(df, "Utility_ID", S.ADJUSTMENT_CODES)
    assert [r.Utility_ID for r in out.collect()] == ids[3:]


def test_size_filter_is_strict_and_drops_nulls(spark):
    rows = [(400.0, 400.0), (401.0, 401.0), (None, 500.0), (401.0, 400.0)]
    df = spark.createDataFrame(rows, "Customers double, Sales_MWh double")
    out = clean.size_filter(df, {"Customers": 400, "Sales_MWh": 400})
    assert [(r.Customers, r.Sales_MWh) for r in out.collect()] == [(401.0, 401.0)]
    # the minimum filter is inclusive and 0 switches it off
    assert clean.min_size_filter(df, "Customers", 401).count() == 2
    assert clean.min_size_filter(df, "Customers", 0).count() == 4


def test_consolidate_duplicates(spark):
    # A5: first non-NULL id in source order, NULL skipped in sums, price
    # recomputed, all-zero sales -> NULL price (Q9)
    rows = [("U", "AA", 2020, None, 1, 10.0, 100.0, 5.0),
            ("U", "AA", 2020, "7.0", 2, None, 100.0, 5.0),
            ("U", "AA", 2020, "8.0", 3, 30.0, 200.0, None),
            ("Z", "BB", 2020, "9.0", 1, 5.0, 0.0, None)]
    df = spark.createDataFrame(rows, "Utility_Name string, State string, Year int, "
                               "Utility_ID string, ord int, Revenue_Thousands double, "
                               "Sales_MWh double, Customers double")
    out = {r.Utility_Name: r for r in clean.consolidate_duplicates(df, order="ord").collect()}
    u = out["U"]
    assert u.Utility_ID == "7.0"
    assert (u.Revenue_Thousands, u.Sales_MWh, u.Customers) == (40.0, 400.0, 10.0)
    assert abs(u.Price_Per_kWh - 0.1) < 1e-12
    z = out["Z"]
    assert z.Customers == 0.0 and z.Price_Per_kWh is None


def test_detect_year_mode_smallest_on_tie(spark):
    df = spark.createDataFrame([("f", 2019), ("f", 2020), ("f", 2020), ("f", 2019), ("f", None),
                                ("g", 2021)], "file string, `Data Year` int")
    out = {r.file: r.Year for r in clean.detect_year(df, by=["file"]).collect()}
    assert out == {"f": 2019, "g": 2021}


def test_header_rules():
    sheet = ["Data Year", "Utility Number", "Utility Name", "State",
             "Thousand Dollars", "Megawatthours", "Count",
             "Thousand Dollars.1", "Megawatthours.1", "Count.1",
             "Thousand Dollars.4", "Megawatthours.4", "Count.4"]
    m = header_map(sheet)
    assert m["Thousand Dollars.4"] == "Revenue_Thousands"
    assert m["Megawatthours.4"] == "Sales_MWh"
    assert m["Count.4"] == "Customers"
    assert m["Utility Number"] == "Utility_ID" and m["State"] == "State"
    assert "Data Year" not in m
    # a 'Total' column wins over a later plain one; else the last one
    m2 = header_map(["Utility ID", "Revenue Total", "Revenue Other", "Sales A", "Sales B"])
    assert m2["Revenue Total"] == "Revenue_Thousands" and m2["Sales B"] == "Sales_MWh"
    with pytest.raises(ValueError):
        header_map(["Utility ID", "Utility ID Alt"])
    assert dedupe_names(["a", "b", "a", "a"]) == ["a", "b", "a.1", "a.2"]


def test_ragged_rows(spark):
    # Q16: blank line, 9, 10, 11 fields; the header line has 10 fields and
    # survives unless skipped explicitly; quoted commas do not split
    header = ",".join(S.LIST_FIELDS)
    ten = 'F1,"Name, Inc",Op,City,VA,1.0,2.0,2003.0,10,Util'
    lines = [header, "", ",".join(["x"] * 9), ten, ",".join(["y"] * 11)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    kept = clean.ragged_rows_filter(df, arity=10, names=S.LIST_FIELDS)
    assert kept.count() == 2
    kept = clean.ragged_rows_filter(df, arity=10, names=S.LIST_FIELDS, skip_line=header)
    r = kept.collect()[0]
    assert r.name == "Name, Inc" and r.year == "2003.0"
    full = clean.conform_rows(kept)
    assert full.columns == S.FACILITY_COLUMNS
    f = full.collect()[0]
    assert f.Utility_Name == "Util" and f.Opening_Month is None and f.Capacity_MW == "10"


def test_facility_csv_mixed_year_spelling(spark, scratch):
    # Q18: '2003.0' and '2008' both read (double then int), empty -> NULL,
    # missing capacity -> 0.0
    path = scratch("fac")
    head = ",".join(S.FACILITY_COLUMNS)
    rows = [head,
            "1,A,Op,City,VA,U1,,,2003.0,,5.5,,,,",
            "2,B,Op,City,VA,U1,,,2008,,,,,,",
            "3,C,Op,City,TX,U2,,,,,,,,,"]
    spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1).write.text(path)
    out = {r.Facility_ID: r for r in csv_src.read_facilities(spark, path).collect()}
    assert (out["1"].Opening_Year, out["2"].Opening_Year, out["3"].Opening_Year) == (2003, 2008, None)
    assert out["2"].Capacity_MW == 0.0 and out["1"].Capacity_MW == 5.5
    assert "Notes" not in csv_src.read_facilities(spark, path).columns


def test_preamble_sheets_roundtrip(spark, scratch):
    path = scratch("sheets")
    df = spark.createDataFrame(
        [(2019, "7.0", " Util A ", " va", 10.0, 100.0, 3.0, 20.0, 200.0, 5.0),
         (2019, "8.0", "Util B", "tx ", 1.0, 0.0, 1.0, 2.0, 0.0, 2.0),
         (2020, "7.0", "Util A", "VA", 30.0, 100.0, 3.0, 60.0, 300.0, 6.0)],
        "`Data Year` int, `Utility Number` string, `Utility Name` string, State string, "
        "`Thousand Dollars` double, Megawatthours double, Count double, "
        "`Thousand Dollars.1` double, `Megawatthours.1` double, `Count.1` double")
    header = ["Data Year", "Utility Number", "Utility Name", "State",
              "Thousand Dollars", "Megawatthours", "Count",
              "Thousand Dollars", "Megawatthours", "Count"]
    writers.write_sheets(df.withColumn("y", F.col("`Data Year`")), path, sheet="y",
                         columns=df.columns, header=header, preamble=["title", "units"])
    raw = csv_src.read_preamble_csv(spark, path)
    assert "Thousand Dollars.1" in raw.columns and raw.count() == 3
    out = clean.clean_sheet(raw)
    assert out.columns == S.REQUIRED_COLUMNS
    got = sorted((r.Year, r.Utility_Name, r.State, r.Revenue_Thousands, r.Price_Per_kWh)
                 for r in out.collect())
    # the rightmost block (no total marker here) is used; zero sales -> NULL
    assert got == [(2019, "Util A", "VA", 20.0, 0.1), (2019, "Util B", "TX", 2.0, None),
                   (2020, "Util A", "VA", 60.0, 0.2)]


def test_conform_schema_adds_typed_nulls(spark):
    df = spark.createDataFrame([("n", "VA", 2020)], "Utility_Name string, State string, Year int")
    out = clean.conform_schema(df)
    assert out.columns == S.REQUIRED_COLUMNS
    assert dict(out.dtypes)["Customers"] == "double"
    assert out.collect()[0].Utility_ID is None


def test_required_columns_and_missing_input(spark, scratch):
    from pyspark.errors import AnalysisException

    df = spark.createDataFrame([("a",)], "Utility_Name string")
    assert clean.require_columns(df, ["Utility_Name"]) is df
    with pytest.raises(ValueError, match="State"):
        clean.require_columns(df, ["Utility_Name", "State"])
    # A missing input path surfaces as an error, not an empty table
    with pytest.raises(AnalysisException):
        csv_src.read_facilities(spark, scratch("does-not-exist")).count()


def test_preamble_sheets_with_two_layouts(spark, scratch):
    # two sheets with different header layouts are parsed separately
    path = scratch("sheets2")
    a = spark.createDataFrame([(2019, "U1", "VA", 10.0, 100.0)],
                              "`Data Year` int, `Utility Name` string, State string, "
                              "`Thousand Dollars` double, Megawatthours double")
    b = spark.createDataFrame([(2020, "U2", "TX", "5", 50.0, 25.0)],
                              "`Data Year` int, `Utility Name` string, State string, "
                              "`Utility Number` string, `Revenue Total` double, `Sales Total` double")
    writers.write_sheets(a.withColumn("y", F.col("`Data Year`")), path + "/a", sheet="y",
                         columns=a.columns, preamble=["t", "u"], files_per_sheet=1)
    writers.write_sheets(b.withColumn("y", F.col("`Data Year`")), path + "/b", sheet="y",
                         columns=b.columns, preamble=["t", "u"], files_per_sheet=1)
    out = csv_src.read_preamble_csv(spark, [path + "/a", path + "/b"],
                                    per_layout=clean.clean_sheet)
    got = sorted((r.Year, r.Utility_Name, r.Utility_ID, r.Price_Per_kWh) for r in out.collect())
    assert got == [(2019, "U1", None, 0.1), (2020, "U2", "5", 2.0)]


def test_line_numbers_are_exact_across_splits(spark, scratch):
    # files far larger than the split size: every line still gets its own
    # line number within its file
    path = scratch("lines")
    lines = spark.range(0, 20000).selectExpr("concat('line-', lpad(cast(id as string), 6, '0')) AS value")
    lines.coalesce(1).sortWithinPartitions("value").write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = csv_src.numbered_lines(spark, path)
        n_files = got.select("_file").distinct().count()
        n_splits = spark.read.text(path).rdd.getNumPartitions()
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = {}
    for r in rows:
        by_file.setdefault(r._file, []).append((r._line, r.value))
    assert n_splits > 2 * n_files and len(rows) == 20000   # files span many splits
    for items in by_file.values():
        items.sort()
        assert [n for n, _ in items] == list(range(len(items)))
        assert [v for _, v in items] == sorted(v for _, v in items)


def test_null_keys_form_their_own_group(spark):
    # Q9: missing names / states are NULL (not the text 'nan') and such rows
    # are consolidated as a NULL group rather than dropped
    rows = [(None, "AA", 2020, "1.0", 10.0, 100.0, 1.0),
            (None, "AA", 2020, "2.0", 20.0, 100.0, 1.0),
            ("U", None, 2020, "3.0", 5.0, 50.0, 1.0)]
    df = spark.createDataFrame(rows, "Utility_Name string, State string, Year int, "
                               "Utility_ID string, Revenue_Thousands double, Sales_MWh double, "
                               "Customers double")
    out = {(r.Utility_Name, r.State): r for r in clean.consolidate_duplicates(df).collect()}
    assert set(out) == {(None, "AA"), ("U", None)}
    assert out[(None, "AA")].Revenue_Thousands == 30.0 and out[(None, "AA")].Utility_ID == "1.0"


def test_read_positional_from_files(spark, scratch):
    path = scratch("raw_list")
    lines = ["a,b,c", "", "1,2", '4,"5,6",7', "8,9,10,11"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = sorted(tuple(r) for r in csv_src.read_positional(spark, path, arity=3,
                                                           names=["x", "y", "z"]).collect())
    assert got == [("4", "5,6", "7"), ("a", "b", "c")]
    got = csv_src.read_positional(spark, path, arity=3, skip_line="a,b,c").collect()
    assert [tuple(r) for r in got] == [("4", "5,6", "7")]


def test_partitioned_csv_files_per_value(spark, scratch):
    import glob
    import os

    path = scratch("by_year")
    df = spark.range(0, 4000).selectExpr("cast(id % 3 + 2019 as int) AS Year", "id")
    writers.write_csv(df.repartition(16), path, partition_by=["Year"], files_per_partition=2)
    for y in (2019, 2020, 2021):
        files = glob.glob(os.path.join(path.replace("file:", ""), f"Year={y}", "*.csv"))
        assert 1 <= len(files) <= 2
    back = csv_src.read_inferred_csv(spark, path)
    assert back.count() == 4000 and dict(back.dtypes)["Year"] == "int"


def test_lines_do_not_depend_on_split_size(spark, scratch):
    # the split size changes between building the query and running it
    path = scratch("lines")
    spark.range(0, 20000).selectExpr("concat('line-', lpad(cast(id as string), 6, '0')) AS value") \
        .coalesce(1).sortWithinPartitions("value").write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    results = []
    try:
        for build, run in (("16384", "40960"), ("40960", "16384"), (old, "16384"), ("16384", old)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", build)
            got = csv_src.numbered_lines(spark, path)
            spark.conf.set("spark.sql.files.maxPartitionBytes", run)
            results.append(sorted((r._line, r.value) for r in got.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert results[0] == [(i, f"line-{i:06d}") for i in range(20000)]
    assert all(r == results[0] for r in results)


def test_positional_rows_equal_the_csv_module(spark, scratch):
    import csv
    import io

    wide = ",".join(["x"] * 10_000)
    lines = ['a,"x ""y"" z",b', 'a,"c\\",b', "a,b\\,c", "1,2", "1,2,3,4", '"p,q",,"r"', '"","",""', wide,
             ",".join(['"quoted, field"'] * 3000), "last,one,here"]
    path = scratch("dialect")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = sorted(tuple(v or "" for v in r) for r in csv_src.read_positional(spark, path, arity=3).collect())
    assert got == sorted(tuple(r) for r in csv.reader(lines) if len(r) == 3)
    got = csv_src.read_positional(spark, path, arity=10_000).collect()
    assert [tuple(r) for r in got] == [("x",) * 10_000]

    text = 'a,"two\nlines",b\n1,2\n"q""q",r\\,s\n'
    path = scratch("newlines")
    spark.createDataFrame([(text[:-1],)], "value string").coalesce(1).write.text(path)
    got = csv_src.read_positional(spark, path, arity=3, quoted_newlines=True).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in csv.reader(io.StringIO(text)) if len(r) == 3)


def test_swapped_header_fails(spark, scratch):
    path = scratch("swapped")
    df = spark.createDataFrame([("VA", "U1", 2013.0, "1", 1.0, 500.0, 500.0, 0.1)],
                               "State string, Utility_Name string, Year double, Utility_ID string, "
                               "Revenue_Thousands double, Sales_MWh double, Customers double, Price_Per_kWh double")
    writers.write_csv(df, path)
    with pytest.raises(Exception, match="(?i)header"):
        csv_src.read_power_costs(spark, path).collect()
    path = scratch("right")
    writers.write_csv(df.select(*S.POWER_COLUMNS), path)
    assert csv_src.read_power_costs(spark, path).first().Year == 2013


def test_sheet_year_is_the_mode_of_numbers(spark):
    rows = [("f", y, "U", "VA") for y in ("2019", "2019", "2019.0", "2019.0", "2020", "2020", "2020")]
    df = spark.createDataFrame(rows, "_file string, `Data Year` string, `Utility Name` string, State string")
    assert {r.Year for r in clean.clean_sheet(df).collect()} == {2019}


def test_consolidate_order_across_files_and_missing_columns(spark):
    rows = [("U", "AA", 2020, "9.0", 1.0, 1.0, 1.0, "b", 0), ("U", "AA", 2020, None, 1.0, 1.0, 1.0, "a", 1),
            ("U", "AA", 2020, "7.0", 1.0, 1.0, 1.0, "a", 2)]
    df = spark.createDataFrame(rows, "Utility_Name string, State string, Year int, Utility_ID string, "
                               "Revenue_Thousands double, Sales_MWh double, Customers double, _file string, _line int")
    out = clean.consolidate_duplicates(df, order=F.struct("_file", "_line")).collect()
    assert [r.Utility_ID for r in out] == ["7.0"]
    less = df.drop("Customers")
    assert clean.consolidate_duplicates(less).collect() == less.collect()


def test_sheet_rows_keep_numeric_order(spark, scratch):
    path = scratch("order")
    df = spark.createDataFrame([(2020, n) for n in (10, 2, 1, 11, 9)], "y int, n int")
    writers.write_sheets(df, path, sheet="y", columns=["n"], preamble=["t", "u"], order_by=["n"])
    lines = csv_src.numbered_lines(spark, path).orderBy("_line").collect()
    assert [r.value for r in lines][3:] == ["1", "2", "9", "10", "11"]

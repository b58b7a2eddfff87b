"""Test-table roles: how the driver's TPC-H-ish tables play the parts of the
original inputs.

* facility openings  <- every order: state = customer's nation,
  opening year = the year before the order, so some precede the first sales;
  capacity = order total, id = order key.
* utility-year sales <- every line item, grouped per (supplier, ship
  year): utility = supplier, state = supplier's nation, revenue = summed
  extended price in integer cents, sales = summed quantity, customers = five
  for each line item (a supplier-year has about 85 lines, so the original
  threshold of 400 customers cuts inside the range).
* facility counts <- the same openings reduced per (customer, year) before the
  customer join, then per (state, year): what the panel needs.
* facility utilities <- facilities with the supplier of the order's first
  line item as their utility (join validation).
* duplicate-grain sales <- sales per (supplier, year, return flag), so one
  utility-year appears up to three times (consolidation).
* customer openings and prices <- all orders and all line items, per customer
  and year (the whole-table panel).
* raw sheets and raw lists <- the sales or facility rows laid out like the
  original raw inputs (repeated header blocks, 10 positional fields).

Every role reads its whole table and
aggregates line items per (supplier, year) *before* joining the dimension
tables, so the joins see suppliers x years rows, not line items.  Join
strategies are left to AQE, which broadcasts only sides measured small at run
time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit import schemas as S
from panelkit.operators import clean
from panelkit.sources.tables import read_table

CUSTOMERS_PER_LINE = 5


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def _opened(date: str):
    return F.year(date) - 1


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility rows: Facility_ID, Facility_Name, Operator, State,
    Opening_Year (int), Capacity_MW (double)."""
    orders = (read_table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").cast("string").alias("Facility_ID"),
                    F.col("c_name").alias("Facility_Name"),
                    F.col("c_mktsegment").alias("Operator"),
                    F.col("n_name").alias("State"),
                    _opened("o_orderdate").alias("Opening_Year"),
                    F.col("o_totalprice").alias("Capacity_MW")))


def facility_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(State, Opening_Year, n, Capacity_MW) without joining every order.

    Orders are first reduced per (customer, year) - partial
    aggregation, so a customer holding a third of the orders becomes at most
    one row per year before any shuffle - then joined to customer and nation
    and summed per (state, year).  Same result as
    ``event_counts(facilities(...))``; the joins see customers x years rows.
    """
    orders = (read_table(spark, sf_dir, "orders")
              .groupBy("o_custkey", _opened("o_orderdate").alias("Opening_Year"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(_cents("o_totalprice")).alias("cents")))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("State"), "Opening_Year")
            .agg(F.sum("n").alias("n"), (F.sum("cents") / 100).alias("Capacity_MW")))


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint")


def supplier_year_sales(lines: DataFrame, *, keys=("l_suppkey",)) -> DataFrame:
    """Line items -> one row per (keys, ship year): integer sums, reduced in
    every task before the shuffle."""
    return (lines.groupBy(*keys, F.year("l_shipdate").alias("Year"))
            .agg(F.sum(_cents("l_extendedprice")).alias("rev"),
                 F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
                 (F.count(F.lit(1)) * CUSTOMERS_PER_LINE).alias("cust")))


def customer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(custkey, Opening_Year, n): every order, whatever its priority, price
    and year."""
    return (read_table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("Opening_Year"))
            .agg(F.count(F.lit(1)).alias("n")))


def customer_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(custkey, Year, Price_Per_kWh): every line item, in its ship year.

    Line items are reduced per (order, year) before they meet the orders, and
    per (customer, year) after.
    """
    lines = supplier_year_sales(read_table(spark, sf_dir, "lineitem"), keys=("l_orderkey",))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .groupBy("custkey", "Year").agg(F.sum("rev").alias("rev"), F.sum("qty").alias("qty"))
            .select("custkey", "Year", F.try_divide(F.col("rev"), F.col("qty")).alias("Price_Per_kWh")))


def _with_supplier(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (df.join(sup, df.l_suppkey == sup.s_suppkey)
            .join(_nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")))


def utility_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utility-year rows in the sales-file layout (F-UTL), one per
    (supplier, year): Utility_Name, State, Year, Utility_ID ('<key>.0'),
    Revenue_Thousands, Sales_MWh, Customers (bigint), Price_Per_kWh."""
    agg = supplier_year_sales(read_table(spark, sf_dir, "lineitem"))
    return (_with_supplier(spark, sf_dir, agg)
            .select(F.col("s_name").alias("Utility_Name"),
                    F.col("n_name").alias("State"),
                    F.col("Year"),
                    F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")).alias("Utility_ID"),
                    F.col("rev").alias("Revenue_Thousands"),
                    F.col("qty").alias("Sales_MWh"),
                    F.col("cust").alias("Customers"),
                    F.try_divide(F.col("rev"), F.col("qty")).alias("Price_Per_kWh")))


def power_costs(power: DataFrame) -> DataFrame:
    """The price table the panel uses: size filter, adjustment-code
    exclusion, numeric id, revenue and sales dropped."""
    df = clean.size_filter(power, {"Customers": S.MIN_CUSTOMERS, "Sales_MWh": S.MIN_SALES})
    df = clean.exclude_codes(df, "Utility_ID", S.ADJUSTMENT_CODES)
    df = clean.cast_columns(df, ints=["Utility_ID", "Customers"])
    return df.drop("Revenue_Thousands", "Sales_MWh")


def sales_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with duplicates: sales at (supplier, year, return flag) grain.

    The id is NULL on 'A' rows and differs between 'N' ('<key>.0') and 'R'
    ('<key>.9') rows, so "first non-NULL id in flag order" has work to do.
    """
    agg = supplier_year_sales(read_table(spark, sf_dir, "lineitem"), keys=("l_suppkey", "l_returnflag"))
    return (_with_supplier(spark, sf_dir, agg)
            .select(F.col("s_name").alias("Utility_Name"),
                    F.col("n_name").alias("State"),
                    F.col("Year"),
                    F.when(F.col("l_returnflag") != "A",
                           F.concat(F.col("l_suppkey").cast("string"),
                                    F.when(F.col("l_returnflag") == "N", F.lit(".0"))
                                    .otherwise(F.lit(".9"))))
                    .alias("Utility_ID"),
                    F.col("l_returnflag").alias("src_order"),
                    F.col("rev").alias("Revenue_Thousands"),
                    F.col("qty").alias("Sales_MWh"),
                    F.col("cust").alias("Customers")))


def raw_sheet(power: DataFrame, blocks: int = 5, carry: tuple[str, ...] = ()) -> DataFrame:
    """The sales rows laid out like a raw annual sheet: 'Data Year',
    'Utility Number', 'Utility Name', 'State', then (revenue, sales, count)
    blocks with repeated names suffixed .1 .. .4; the last block is the total,
    earlier blocks hold partial (sector-like) shares."""
    cols = [F.col("Year").alias("Data Year"),
            F.col("Utility_ID").alias("Utility Number"),
            F.col("Utility_Name").alias("Utility Name"),
            F.col("State").alias("State")]
    for b in range(blocks):
        sfx = "" if b == 0 else f".{b}"
        last = b == blocks - 1
        for src, name in (("Revenue_Thousands", "Thousand Dollars"),
                          ("Sales_MWh", "Megawatthours"), ("Customers", "Count")):
            val = F.col(src) if last else (F.col(src) * (b + 1)).cast("bigint") / blocks
            cols.append(val.alias(name + sfx))
    return power.select(cols + [F.col(c) for c in carry])


def facility_list_rows(fac: DataFrame) -> DataFrame:
    """Facilities as a raw 10-field positional list (all text, _c0.._c9)."""
    vals = [F.col("Facility_ID"), F.col("Facility_Name"), F.col("Operator"),
            F.lower(F.col("State")), F.col("State"),
            F.lit(None).cast("string"), F.lit(None).cast("string"),
            F.col("Opening_Year").cast("string"), F.col("Capacity_MW").cast("string"),
            F.concat(F.lit("Utility of "), F.col("State"))]
    return fac.select([v.alias(f"_c{i}") for i, v in enumerate(vals)])


def facility_utilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities with the utility that serves them: the supplier of the
    order's first line item (NULL when the order has no line 1).

    The line-item side is reduced to line 1 at the scan; the join is on the
    order key.  Facility rows are the output here, so they
    cannot be pre-aggregated; a customer holding many of them is split by
    AQE's skew-join handling.
    """
    orders = (read_table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))
    first_line = (read_table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") == 1)
                  .select("l_orderkey", "l_suppkey"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(first_line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .select(F.col("o_orderkey").cast("string").alias("Facility_ID"),
                    F.col("c_name").alias("Facility_Name"),
                    F.col("n_name").alias("State"),
                    F.col("s_name").alias("Utility_Name"),
                    _opened("o_orderdate").alias("Opening_Year"),
                    F.col("o_totalprice").alias("Capacity_MW")))

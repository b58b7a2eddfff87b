"""Oracle SQL (DuckDB dialect) for every SQL-expressible catalog key.

Written independently of the Spark code from the role definitions: the
tables ``region nation customer supplier part orders lineitem ...`` are views.
Rules: integer sums are cast back to BIGINT (DuckDB widens to HUGEINT),
``year()`` to INTEGER, every double is rounded to 6 places.
"""

from __future__ import annotations

import math

ORACLE: dict[str, str] = {}

FAC = """
fac AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS Facility_ID, c.c_name AS Facility_Name,
         c.c_mktsegment AS Operator, n.n_name AS State,
         CAST(year(o.o_orderdate) - 1 AS INTEGER) AS Opening_Year, o.o_totalprice AS Capacity_MW
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

SYA = """
sya AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS Year,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS rev,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
         5 * count(*) AS cust
  FROM lineitem
  GROUP BY 1, 2
)"""

POWER = SYA + """,
power AS (
  SELECT s.s_name AS Utility_Name, n.n_name AS State, a.Year,
         CAST(a.l_suppkey AS VARCHAR) || '.0' AS Utility_ID,
         a.rev AS Revenue_Thousands, a.qty AS Sales_MWh, a.cust AS Customers,
         a.rev / nullif(a.qty, 0) AS Price_Per_kWh
  FROM sya a JOIN supplier s ON a.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

PC = POWER + """,
pc AS (
  SELECT Utility_Name, State, Year,
         CAST(try_cast(Utility_ID AS DOUBLE) AS INTEGER) AS Utility_ID,
         CAST(Customers AS INTEGER) AS Customers, Price_Per_kWh
  FROM power
  WHERE Sales_MWh > 400 AND Customers > 400
    AND NOT (CAST(try_cast(Utility_ID AS DOUBLE) AS INTEGER) IN (99999, 88888, 77777))
)"""

PANEL = FAC + "," + PC + """,
bounds AS (SELECT min(Year) AS min_year, max(Year) AS max_year FROM pc),
spine AS (SELECT CAST(unnest(range(min_year, max_year + 1)) AS INTEGER) AS Year FROM bounds),
states AS (SELECT DISTINCT State FROM fac),
grid AS (SELECT s.State, y.Year FROM states s, spine y),
by_year AS (
  SELECT State, Opening_Year AS Year, count(*) AS DC_Opened FROM fac
  WHERE Opening_Year >= (SELECT min_year FROM bounds) GROUP BY 1, 2),
pre AS (
  SELECT State, count(*) AS Pre_DC FROM fac
  WHERE Opening_Year < (SELECT min_year FROM bounds) GROUP BY 1),
filled AS (
  SELECT g.State, g.Year, coalesce(b.DC_Opened, 0) AS DC_Opened,
         coalesce(p.Pre_DC, 0) AS Pre_DC
  FROM grid g LEFT JOIN by_year b ON g.State = b.State AND g.Year = b.Year
       LEFT JOIN pre p ON g.State = p.State),
cum AS (
  SELECT State, Year, DC_Opened,
         CAST(Pre_DC + sum(DC_Opened) OVER (PARTITION BY State ORDER BY Year) AS BIGINT) AS Cumulative_DC
  FROM filled),
prices AS (SELECT State, Year, avg(Price_Per_kWh) AS Avg_kWh FROM pc GROUP BY 1, 2),
full_panel AS (
  SELECT c.*, p.Avg_kWh FROM cum c JOIN prices p ON c.State = p.State AND c.Year = p.Year
  WHERE p.Avg_kWh IS NOT NULL),
lagged AS (
  SELECT * FROM (
    SELECT *, lag(Avg_kWh, 1) OVER (PARTITION BY State ORDER BY Year) AS PrevPrice FROM full_panel)
  WHERE PrevPrice IS NOT NULL),
rolled AS (
  SELECT *, CAST(sum(DC_Opened) OVER (PARTITION BY State ORDER BY Year
                 ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS RecentOpenings
  FROM lagged),
panel AS (
  SELECT State, Year, DC_Opened, Cumulative_DC, Avg_kWh, PrevPrice FROM rolled
  WHERE RecentOpenings > 0)
"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip().lstrip(",") + "\n" + body


def add(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = _with(ctes, body)


# step 1: panel -------------------------------------------------------------
add("panel_flagship", PANEL,
    "SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh, "
    "round(PrevPrice, 6) AS PrevPrice FROM panel")
add("year_bounds", PANEL, "SELECT min_year, max_year FROM bounds")
add("year_spine", PANEL, "SELECT Year FROM spine")
add("distinct_states", PANEL, "SELECT State FROM states")
add("panel_grid", PANEL, "SELECT State, Year FROM grid")
add("openings_by_year", PANEL, "SELECT State, Year, DC_Opened FROM by_year")
add("pre_period_count", PANEL, "SELECT State, Pre_DC FROM pre")
add("left_join_fill", PANEL, "SELECT State, Year, DC_Opened FROM filled")
add("fill_missing", PANEL, "SELECT State, Year, DC_Opened, Pre_DC FROM filled")
add("cumulative_openings", PANEL, "SELECT State, Year, DC_Opened, Cumulative_DC FROM cum")
add("cumulative_capacity", PANEL, """
, mw_year AS (
  SELECT State, Opening_Year AS Year, sum(Capacity_MW) AS MW_Opened FROM fac
  WHERE Opening_Year >= (SELECT min_year FROM bounds) GROUP BY 1, 2),
mw_pre AS (
  SELECT State, sum(Capacity_MW) AS Pre_MW FROM fac
  WHERE Opening_Year < (SELECT min_year FROM bounds) GROUP BY 1)
SELECT g.State, g.Year, round(coalesce(m.MW_Opened, 0.0), 6) AS MW_Opened,
       round(coalesce(p.Pre_MW, 0.0) + sum(coalesce(m.MW_Opened, 0.0))
             OVER (PARTITION BY g.State ORDER BY g.Year), 6) AS Cum_MW
FROM grid g LEFT JOIN mw_year m ON g.State = m.State AND g.Year = m.Year
     LEFT JOIN mw_pre p ON g.State = p.State
""")
add("avg_price", PANEL, "SELECT State, Year, round(Avg_kWh, 6) AS Avg_kWh FROM prices")
add("price_integration", PANEL,
    "SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh FROM full_panel")
add("lag_feature", PANEL,
    "SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh, "
    "round(PrevPrice, 6) AS PrevPrice FROM lagged")
add("rolling_openings", PANEL,
    "SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh, "
    "round(PrevPrice, 6) AS PrevPrice, RecentOpenings FROM rolled")
add("recent_activity_filter", PANEL, """
SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh,
       round(PrevPrice, 6) AS PrevPrice
FROM (SELECT *, sum(DC_Opened) OVER (PARTITION BY State ORDER BY Year
                ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS r FROM lagged)
WHERE r > 0""")


# step 2: cleaning ------------------------------------------------------------
add("size_filter", POWER, """
SELECT Utility_Name, State, Year, Utility_ID, Revenue_Thousands, Sales_MWh, Customers,
       round(Price_Per_kWh, 6) AS Price_Per_kWh
FROM power WHERE Customers > 400 AND Sales_MWh > 400""")
add("code_exclusion", POWER, """
SELECT Utility_Name, State, Year, CAST(try_cast(Utility_ID AS DOUBLE) AS INTEGER) AS Utility_ID
FROM (SELECT Utility_Name, State, Year, nullif(Utility_ID, '3.0') AS Utility_ID FROM power)
WHERE Utility_ID IS NOT NULL
  AND NOT (CAST(try_cast(Utility_ID AS DOUBLE) AS INTEGER) IN (7, 8, 9))""")
add("min_size_filter", POWER, """
SELECT Utility_Name, State, Year, Utility_ID, Revenue_Thousands, Sales_MWh, Customers,
       round(Price_Per_kWh, 6) AS Price_Per_kWh
FROM power WHERE Customers >= 430""")
ORACLE["safe_cast"] = """
SELECT p_partkey,
       CAST(try_cast(p_name AS DOUBLE) AS INTEGER) AS name_int,
       round(try_cast(p_name AS DOUBLE), 6) AS name_double,
       CAST(try_cast(CAST(p_size AS VARCHAR) AS DOUBLE) AS INTEGER) AS size_int,
       CAST(try_cast(CAST(p_size AS VARCHAR) || '.0' AS DOUBLE) AS INTEGER) AS size_dot_int
FROM part"""
ORACLE["unit_price"] = """
SELECT l_orderkey, l_linenumber, rev AS Revenue_Thousands, qty AS Sales_MWh,
       round(rev / nullif(qty, 0), 6) AS Price_Per_kWh
FROM (SELECT l_orderkey, l_linenumber,
             CAST(round(l_extendedprice * 100) AS BIGINT) AS rev,
             CASE WHEN l_linenumber = 1 THEN CAST(0 AS BIGINT)
                  ELSE CAST(l_quantity AS BIGINT) END AS qty
      FROM lineitem)"""
add("normalize_text", POWER, "SELECT Utility_Name, upper(State) AS State, Year FROM power")
add("header_mapping", POWER, """
SELECT Utility_ID, Utility_Name, State, Revenue_Thousands, Sales_MWh, Customers FROM power""")
add("conform_schema", POWER, """
SELECT CAST(NULL AS VARCHAR) AS Utility_ID, Utility_Name, State, Year, Revenue_Thousands,
       Sales_MWh, CAST(NULL AS DOUBLE) AS Customers, round(Price_Per_kWh, 6) AS Price_Per_kWh
FROM power""")
add("conform_rows", FAC, """
SELECT Facility_ID, Facility_Name, Operator, lower(State) AS City, State,
       'Utility of ' || State AS Utility_Name,
       CAST(NULL AS VARCHAR) AS Latitude, CAST(NULL AS VARCHAR) AS Longitude,
       CAST(Opening_Year AS VARCHAR) AS Opening_Year, CAST(NULL AS VARCHAR) AS Opening_Month,
       CAST(Capacity_MW AS VARCHAR) AS Capacity_MW, CAST(NULL AS VARCHAR) AS Verified,
       CAST(NULL AS VARCHAR) AS Data_Source, CAST(NULL AS VARCHAR) AS Source_URL,
       CAST(NULL AS VARCHAR) AS Notes
FROM fac""")
ORACLE["ragged_rows_filter"] = """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size
FROM part WHERE p_size BETWEEN 5 AND 45"""

GRAIN = SYA.replace("l_suppkey, CAST(year", "l_suppkey, l_returnflag, CAST(year") \
    .replace("GROUP BY 1, 2", "GROUP BY 1, 2, 3").replace("sya AS", "gsya AS") + """,
grain AS (
  SELECT s.s_name AS Utility_Name, n.n_name AS State, a.Year,
         CASE WHEN a.l_returnflag = 'A' THEN NULL
              WHEN a.l_returnflag = 'N' THEN CAST(a.l_suppkey AS VARCHAR) || '.0'
              ELSE CAST(a.l_suppkey AS VARCHAR) || '.9' END AS Utility_ID,
         a.l_returnflag AS src_order,
         a.rev AS Revenue_Thousands, a.qty AS Sales_MWh, a.cust AS Customers
  FROM gsya a JOIN supplier s ON a.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
),
cons AS (
  SELECT Utility_Name, State, Year,
         arg_min(Utility_ID, src_order) FILTER (WHERE Utility_ID IS NOT NULL) AS Utility_ID,
         CAST(coalesce(sum(Revenue_Thousands), 0) AS BIGINT) AS Revenue_Thousands,
         CAST(coalesce(sum(Sales_MWh), 0) AS BIGINT) AS Sales_MWh,
         CAST(coalesce(sum(Customers), 0) AS BIGINT) AS Customers,
         count(*) AS n
  FROM grain GROUP BY 1, 2, 3
)"""
add("consolidate_duplicates", GRAIN, """
SELECT Utility_Name, State, Year, Utility_ID, Revenue_Thousands, Sales_MWh, Customers,
       round(Revenue_Thousands / nullif(Sales_MWh, 0), 6) AS Price_Per_kWh
FROM cons""")
add("duplicate_groups", POWER, """
SELECT Utility_Name, State, count(*) AS n_rows FROM power GROUP BY 1, 2 HAVING count(*) > 1""")
ORACLE["detect_year"] = """
SELECT l_suppkey, Year FROM (
  SELECT l_suppkey, y AS Year,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, y) AS rn
  FROM (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y, count(*) AS n
        FROM lineitem GROUP BY 1, 2))
WHERE rn = 1"""
add("clean_step_counts", GRAIN, """
SELECT CAST(sum(n) AS BIGINT) AS n_raw, count(*) AS n_consolidated,
       count(*) FILTER (WHERE Sales_MWh > 400) AS n_size_ok,
       count(*) FILTER (WHERE Sales_MWh > 400 AND
             try_cast(Utility_ID AS DOUBLE) NOT IN (7.0, 8.0, 9.0)) AS n_code_ok
FROM cons""")


# step 3: join validation and quality ---------------------------------------------
FU = POWER + """,
fu AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS Facility_ID, c.c_name AS Facility_Name,
         n.n_name AS State, s.s_name AS Utility_Name,
         CAST(year(o.o_orderdate) - 1 AS INTEGER) AS Opening_Year
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber = 1) l
              ON o.o_orderkey = l.l_orderkey
       LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
latest AS (
  SELECT * FROM power
  WHERE Year = (SELECT max(Year) FROM power) AND Sales_MWh > 400 AND Customers > 400),
lk AS (SELECT DISTINCT Utility_Name FROM fu WHERE Utility_Name IS NOT NULL),
rk AS (SELECT DISTINCT Utility_Name FROM latest WHERE Utility_Name IS NOT NULL),
fj AS (
  SELECT f.Facility_ID, f.Facility_Name, f.Utility_Name, f.State, f.Opening_Year, p.Year,
         p.Price_Per_kWh
  FROM fu f JOIN power p ON f.Utility_Name = p.Utility_Name AND f.State = p.State
)"""
add("facility_utility_join", FU, """
SELECT Facility_ID, Facility_Name, Utility_Name, State, Opening_Year, Year,
       round(Price_Per_kWh, 6) AS Price_Per_kWh FROM fj""")
add("distinct_facilities", FU,
    "SELECT DISTINCT Facility_Name, Utility_Name, State, Opening_Year FROM fu")
add("matched_keys", FU, "SELECT Utility_Name FROM lk INTERSECT SELECT Utility_Name FROM rk")
add("missing_keys", FU, "SELECT Utility_Name FROM lk EXCEPT SELECT Utility_Name FROM rk")
add("key_match_report", FU, """
SELECT (SELECT count(*) FROM lk) AS n_left, (SELECT count(*) FROM rk) AS n_right,
       (SELECT count(*) FROM lk JOIN rk USING (Utility_Name)) AS n_matched,
       (SELECT count(*) FROM lk ANTI JOIN rk USING (Utility_Name)) AS n_missing,
       round(100.0 * (SELECT count(*) FROM lk JOIN rk USING (Utility_Name))
             / nullif((SELECT count(*) FROM lk), 0), 1) AS pct_matched""")
add("join_preview", FU, """
SELECT Facility_ID, Facility_Name, Utility_Name, State, Opening_Year, Year,
       round(Price_Per_kWh, 6) AS Price_Per_kWh
FROM fj ORDER BY Facility_Name, Utility_Name, State, Opening_Year, Year, Facility_ID LIMIT 5""")
add("top_states", FU, """
SELECT State, count(*) AS n_rows FROM power GROUP BY State ORDER BY n_rows DESC, State LIMIT 5""")
add("price_summary", POWER, """
SELECT round(avg(Price_Per_kWh), 6) AS mean, round(min(Price_Per_kWh), 6) AS min,
       round(max(Price_Per_kWh), 6) AS max, count(*) AS n,
       round(median(Price_Per_kWh), 6) AS median
FROM power WHERE Price_Per_kWh IS NOT NULL""")
add("growth_comparison", PANEL, """
SELECT State, round(first_price, 6) AS first_price, round(last_price, 6) AS last_price,
       total_opened,
       round((last_price - first_price) / nullif(first_price, 0), 6) AS growth,
       CASE WHEN total_opened >= 4 THEN 'high' ELSE 'low' END AS "group"
FROM (SELECT State, arg_min(Avg_kWh, Year) AS first_price, arg_max(Avg_kWh, Year) AS last_price,
             CAST(sum(DC_Opened) AS BIGINT) AS total_opened
      FROM full_panel GROUP BY State)""")


# step 4: sources and sinks -----------------------------------------------------
add("csv_scan_schema", FAC, """
SELECT Facility_ID, Facility_Name, Operator, lower(State) AS City, State,
       'Utility of ' || State AS Utility_Name, Opening_Year,
       round(Capacity_MW, 6) AS Capacity_MW
FROM fac""")
add("csv_glob_scan", PC, """
SELECT Utility_Name, State, Year, Utility_ID, Customers, round(Price_Per_kWh, 6) AS Price_Per_kWh
FROM pc""")
add("csv_infer_scan", POWER, """
SELECT Utility_Name, State, Year, CAST(Utility_ID AS DOUBLE) AS Utility_ID,
       CAST(Customers AS INTEGER) AS Customers, round(Price_Per_kWh, 6) AS Price_Per_kWh
FROM power""")
add("preamble_csv_scan", POWER, """
SELECT Utility_ID, Utility_Name, upper(State) AS State, Year,
       CAST(Revenue_Thousands AS DOUBLE) AS Revenue_Thousands,
       CAST(Sales_MWh AS DOUBLE) AS Sales_MWh, CAST(Customers AS DOUBLE) AS Customers,
       round(Price_Per_kWh, 6) AS Price_Per_kWh
FROM power""")
ORACLE["parquet_scan"] = """
SELECT l_orderkey, l_suppkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
       CAST(year(l_shipdate) AS INTEGER) AS Year
FROM lineitem"""
add("parquet_roundtrip", PANEL,
    "SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh, "
    "round(PrevPrice, 6) AS PrevPrice FROM panel")
add("csv_roundtrip", PANEL,
    "SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh, "
    "round(PrevPrice, 6) AS PrevPrice FROM panel")
add("partitioned_write", POWER, """
SELECT Utility_Name, State, Utility_ID, Revenue_Thousands, Sales_MWh, Customers,
       round(Price_Per_kWh, 6) AS Price_Per_kWh, Year
FROM power""")
add("project_alias", PANEL,
    "SELECT State, Year AS yr, DC_Opened AS opened, round(Avg_kWh, 6) AS label, "
    "round(PrevPrice, 6) AS prev FROM panel")


# step 5: ML features --------------------------------------------------------------
IDX = PANEL + """,
idx AS (
  SELECT State, CAST(row_number() OVER (ORDER BY n DESC, State) - 1 AS DOUBLE) AS StateIndex
  FROM (SELECT State, count(*) AS n FROM panel GROUP BY State))
"""
add("string_index", IDX,
    "SELECT p.State, p.Year, i.StateIndex FROM panel p JOIN idx i ON p.State = i.State")
add("one_hot", IDX, """
SELECT p.State, p.Year, CAST(i.StateIndex AS INTEGER) AS slot, CAST(1.0 AS DOUBLE) AS value
FROM panel p JOIN idx i ON p.State = i.State""")
add("assemble_features", IDX, """
SELECT State, Year, 0 AS slot, CAST(DC_Opened AS DOUBLE) AS value FROM panel WHERE DC_Opened <> 0
UNION ALL
SELECT State, Year, 1 AS slot, round(PrevPrice, 6) AS value FROM panel WHERE PrevPrice <> 0
UNION ALL
SELECT p.State, p.Year, CAST(i.StateIndex AS INTEGER) + 2 AS slot, CAST(1.0 AS DOUBLE) AS value
FROM panel p JOIN idx i ON p.State = i.State""")
add("hash_split", PANEL, """
SELECT State, Year, bucket, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split
FROM (SELECT State, Year,
             CAST(('0x' || substr(md5(State || '#' || CAST(Year AS VARCHAR)), 1, 8)) AS BIGINT) % 100
               AS bucket
      FROM panel)""")

# step 6: scenarios (linear score prev + 0.001 * opened) --------------------------
SCEN = PANEL + """,
wide AS (
  SELECT State, Year, DC_Opened, PrevPrice, Avg_kWh,
         PrevPrice + 0.001::DOUBLE * DC_Opened AS Pred_baseline,
         DC_Opened * 0.9::DOUBLE AS DC_minus10, PrevPrice + 0.001::DOUBLE * (DC_Opened * 0.9::DOUBLE) AS Pred_minus10,
         DC_Opened * 1.1::DOUBLE AS DC_plus10, PrevPrice + 0.001::DOUBLE * (DC_Opened * 1.1::DOUBLE) AS Pred_plus10,
         DC_Opened * 1.2::DOUBLE AS DC_plus20, PrevPrice + 0.001::DOUBLE * (DC_Opened * 1.2::DOUBLE) AS Pred_plus20,
         DC_Opened * 0.75::DOUBLE AS DC_slow75, PrevPrice + 0.001::DOUBLE * (DC_Opened * 0.75::DOUBLE) AS Pred_slow75,
         DC_Opened * 1.5::DOUBLE AS DC_fast150, PrevPrice + 0.001::DOUBLE * (DC_Opened * 1.5::DOUBLE) AS Pred_fast150,
         DC_Opened * 0.0::DOUBLE AS DC_ban0, PrevPrice + 0.001::DOUBLE * (DC_Opened * 0.0::DOUBLE) AS Pred_ban0
  FROM panel),
long AS (
  UNPIVOT wide ON Pred_baseline, Pred_minus10, Pred_plus10, Pred_plus20, Pred_slow75,
                 Pred_fast150, Pred_ban0
  INTO NAME Scenario VALUE PredictedPrice),
labels(code, label) AS (VALUES ('Pred_baseline', 'Baseline'), ('Pred_minus10', '-10%'),
  ('Pred_plus10', '+10%'), ('Pred_plus20', '+20%'), ('Pred_slow75', '-25%'),
  ('Pred_fast150', '+50%'), ('Pred_ban0', 'x0'))
"""
add("scenario_scale", PANEL, """
SELECT p.State, p.Year, p.Cumulative_DC, round(p.Avg_kWh, 6) AS Avg_kWh,
       round(p.PrevPrice, 6) AS PrevPrice, s.Scenario, s.Factor,
       round(p.DC_Opened * s.Factor, 6) AS DC_Opened
FROM panel p CROSS JOIN (VALUES ('baseline', 1.0::DOUBLE), ('minus10', 0.9::DOUBLE),
  ('plus10', 1.1::DOUBLE), ('plus20', 1.2::DOUBLE), ('slow75', 0.75::DOUBLE),
  ('fast150', 1.5::DOUBLE), ('ban0', 0.0::DOUBLE)) s(Scenario, Factor)""")
add("scenario_wide", SCEN, """
SELECT State, Year, DC_Opened, round(PrevPrice, 6) AS PrevPrice, round(Avg_kWh, 6) AS Avg_kWh,
       round(Pred_baseline, 6) AS Pred_baseline,
       round(DC_minus10, 6) AS DC_minus10, round(Pred_minus10, 6) AS Pred_minus10,
       round(DC_plus10, 6) AS DC_plus10, round(Pred_plus10, 6) AS Pred_plus10,
       round(DC_plus20, 6) AS DC_plus20, round(Pred_plus20, 6) AS Pred_plus20,
       round(DC_slow75, 6) AS DC_slow75, round(Pred_slow75, 6) AS Pred_slow75,
       round(DC_fast150, 6) AS DC_fast150, round(Pred_fast150, 6) AS Pred_fast150,
       round(DC_ban0, 6) AS DC_ban0, round(Pred_ban0, 6) AS Pred_ban0
FROM wide""")
add("scenario_long", SCEN,
    "SELECT State, Year, Scenario, round(PredictedPrice, 6) AS PredictedPrice FROM long")
add("label_map", SCEN, """
SELECT l.State, l.Year, b.label AS Scenario, round(l.PredictedPrice, 6) AS PredictedPrice
FROM (SELECT State, Year, Scenario, PredictedPrice FROM long
      UNION ALL SELECT State, Year, 'Avg_kWh', Avg_kWh FROM wide) l
LEFT JOIN labels b ON l.Scenario = b.code""")
add("scenario_series", SCEN, """
SELECT l.State, l.Year, b.label AS Scenario, round(l.PredictedPrice, 6) AS PredictedPrice
FROM long l LEFT JOIN labels b ON l.Scenario = b.code
WHERE l.State = (SELECT min(State) FROM panel)""")
add("scenario_delta", SCEN, """
SELECT State, Year, Scenario, round(Delta, 6) AS Delta FROM (
  UNPIVOT (SELECT State, Year, Pred_minus10 - Pred_baseline AS minus10,
                  Pred_plus10 - Pred_baseline AS plus10, Pred_plus20 - Pred_baseline AS plus20,
                  Pred_slow75 - Pred_baseline AS slow75, Pred_fast150 - Pred_baseline AS fast150,
                  Pred_ban0 - Pred_baseline AS ban0 FROM wide)
  ON minus10, plus10, plus20, slow75, fast150, ban0 INTO NAME Scenario VALUE Delta)""")

# step 7: model (baseline "price = previous price") --------------------------------
add("regression_metrics", PANEL, """
SELECT n, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
       round(1.0 - sse / (n * var_l), 6) AS r2,
       round(rmse / mean_label, 6) AS rmse_share_of_mean,
       round(rmse * 10000, 2) AS household_error, round(mean_label, 6) AS mean_label
FROM (SELECT count(*) AS n, sqrt(avg((PrevPrice - Avg_kWh) * (PrevPrice - Avg_kWh))) AS rmse,
             avg(abs(PrevPrice - Avg_kWh)) AS mae,
             sum((PrevPrice - Avg_kWh) * (PrevPrice - Avg_kWh)) AS sse,
             var_pop(Avg_kWh) AS var_l, avg(Avg_kWh) AS mean_label
      FROM panel)""")


# streaming ------------------------------------------------------------------------
add("stream_avg_price", PANEL, "SELECT State, Year, round(Avg_kWh, 6) AS Avg_kWh FROM prices")


# optional: difference-in-differences ----------------------------------------------
add("diff_in_diff", PANEL, """
, flagged AS (
  SELECT *, sum(DC_Opened) OVER (PARTITION BY State) >= 4 AS treated,
         Year > (SELECT (min(Year) + max(Year)) / 2.0 FROM full_panel) AS post
  FROM full_panel),
cells AS (
  SELECT avg(Avg_kWh) FILTER (WHERE treated AND NOT post) AS treated_before,
         avg(Avg_kWh) FILTER (WHERE treated AND post) AS treated_after,
         avg(Avg_kWh) FILTER (WHERE NOT treated AND NOT post) AS control_before,
         avg(Avg_kWh) FILTER (WHERE NOT treated AND post) AS control_after
  FROM flagged)
SELECT round(treated_before, 6) AS treated_before, round(treated_after, 6) AS treated_after,
       round(control_before, 6) AS control_before, round(control_after, 6) AS control_after,
       round((treated_after - treated_before) - (control_after - control_before), 6) AS did
FROM cells""")
add("scenario_pivot", SCEN, """
SELECT State, Year, round(Pred_baseline, 6) AS Pred_baseline,
       round(Pred_minus10, 6) AS Pred_minus10, round(Pred_plus10, 6) AS Pred_plus10,
       round(Pred_plus20, 6) AS Pred_plus20, round(Pred_slow75, 6) AS Pred_slow75,
       round(Pred_fast150, 6) AS Pred_fast150, round(Pred_ban0, 6) AS Pred_ban0
FROM wide""")
add("sheet_consolidation", GRAIN, """
SELECT Utility_Name, State, Year, Utility_ID,
       CAST(Revenue_Thousands AS DOUBLE) AS Revenue_Thousands,
       CAST(Sales_MWh AS DOUBLE) AS Sales_MWh, CAST(Customers AS DOUBLE) AS Customers,
       round(Revenue_Thousands / nullif(Sales_MWh, 0), 6) AS Price_Per_kWh
FROM cons""")
add("avg_price_weighted", PC, """
SELECT State, Year, round(CAST(sum(Revenue_Thousands) AS DOUBLE) / nullif(sum(Sales_MWh), 0), 6)
       AS Avg_kWh
FROM power
WHERE Sales_MWh > 400 AND Customers > 400
  AND NOT (CAST(try_cast(Utility_ID AS DOUBLE) AS INTEGER) IN (99999, 88888, 77777))
GROUP BY State, Year""")


add("ordered_utilities", POWER, "SELECT DISTINCT Utility_Name FROM power ORDER BY 1")
add("sheets_to_panel", PANEL.replace("pc AS (", "pc0 AS (").replace(
    "bounds AS (", """pc AS (
  SELECT Utility_Name, upper(State) AS State, Year, Price_Per_kWh FROM pc0),
bounds AS (""").replace("n.n_name AS State,\n         CAST(year", "upper(n.n_name) AS State,\n         CAST(year"),
    "SELECT State, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh, "
    "round(PrevPrice, 6) AS PrevPrice FROM panel")
ORACLE["positional_file_scan"] = r"""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ', the "best"' AS p_name,
       'c:\' || p_brand || '\' AS p_brand, p_type
FROM part WHERE p_size BETWEEN 5 AND 45""".replace("\\\\", "\\")
ORACLE["customer_panel"] = """
WITH b AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
y AS (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS Year FROM b),
o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS Year, count(*) AS n,
             CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
      FROM orders GROUP BY 1, 2),
g AS (SELECT c.o_custkey, y.Year FROM (SELECT DISTINCT o_custkey FROM orders) c, y)
SELECT g.o_custkey AS custkey, g.Year, coalesce(o.n, 0) AS orders,
       CAST(sum(coalesce(o.n, 0)) OVER (PARTITION BY g.o_custkey ORDER BY g.Year) AS BIGINT) AS orders_to_date,
       coalesce(o.cents, 0) AS cents
FROM g LEFT JOIN o ON g.o_custkey = o.o_custkey AND g.Year = o.Year"""

CUSTOMER = """
fac AS (SELECT o_custkey AS custkey, CAST(year(o_orderdate) AS INTEGER) AS Opening_Year FROM orders),
pc AS (
  SELECT o.o_custkey AS custkey, CAST(year(l.l_shipdate) AS INTEGER) AS Year,
         CAST(sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS BIGINT)
           / nullif(CAST(sum(CAST(l.l_quantity AS BIGINT)) AS BIGINT), 0) AS Avg_kWh
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
bounds AS (SELECT min(Year) AS lo, max(Year) AS hi FROM pc),
grid AS (
  SELECT c.custkey, y.Year FROM (SELECT DISTINCT custkey FROM fac) c,
         (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS Year FROM bounds) y),
filled AS (
  SELECT g.custkey, g.Year, (SELECT lo FROM bounds) AS lo, coalesce(b.n, 0) AS DC_Opened, coalesce(p.n, 0) AS Pre_DC
  FROM grid g
       LEFT JOIN (SELECT custkey, Opening_Year, count(*) AS n FROM fac GROUP BY 1, 2) b
         ON b.custkey = g.custkey AND b.Opening_Year = g.Year
       LEFT JOIN (SELECT custkey, count(*) AS n FROM fac WHERE Opening_Year < (SELECT lo FROM bounds) GROUP BY 1) p
         ON p.custkey = g.custkey),
cum AS (
  SELECT custkey, Year, DC_Opened,
         CAST(Pre_DC + sum(DC_Opened) OVER (PARTITION BY custkey ORDER BY Year) AS BIGINT) AS Cumulative_DC
  FROM filled),
lagged AS (
  SELECT c.*, p.Avg_kWh, lag(p.Avg_kWh) OVER (PARTITION BY c.custkey ORDER BY c.Year) AS PrevPrice
  FROM cum c JOIN pc p ON p.custkey = c.custkey AND p.Year = c.Year WHERE p.Avg_kWh IS NOT NULL),
rolled AS (
  SELECT *, sum(DC_Opened) OVER (PARTITION BY custkey ORDER BY Year ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING) AS recent
  FROM (SELECT * FROM lagged WHERE PrevPrice IS NOT NULL)),
panel AS (SELECT custkey, Year, DC_Opened, Cumulative_DC, Avg_kWh, PrevPrice FROM rolled WHERE recent > 0)
"""
add("customer_features", CUSTOMER, """
SELECT custkey, Year, DC_Opened, Cumulative_DC, round(Avg_kWh, 6) AS Avg_kWh, round(PrevPrice, 6) AS PrevPrice
FROM panel""")

# model keys: what SQL can check beside the predictions -------------------------------
SPLIT = PANEL + """,
split AS (
  SELECT *, CAST(('0x' || substr(md5(State || '#' || CAST(Year AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS bucket
  FROM panel)
"""
add("rf_train_score", SPLIT,
    "SELECT State, Year, round(Avg_kWh, 6) AS label, TRUE AS in_range FROM split WHERE bucket >= 80")
ORACLE["best_params"] = """
SELECT CAST(t AS INTEGER) AS "numTrees", CAST(m AS INTEGER) AS "maxDepth", TRUE AS measured,
       TRUE AS best_is_lowest, TRUE AS one_best
FROM (SELECT unnest([25, 50, 100, 200, 300]) AS t), (SELECT unnest([2, 3, 4, 6, 8, 10]) AS m)"""
ORACLE["feature_importance"] = """
SELECT unnest(['DC_Opened', 'PrevPrice', 'StateVec']) AS feature, TRUE AS is_share,
       CAST(1.0 AS DOUBLE) AS total"""
add("rf_counterfactual", SCEN, """
SELECT State, Year, DC_Opened, round(PrevPrice, 6) AS PrevPrice, round(Avg_kWh, 6) AS Avg_kWh,
       round(DC_minus10, 6) AS DC_minus10, round(DC_plus10, 6) AS DC_plus10,
       round(DC_plus20, 6) AS DC_plus20, round(DC_slow75, 6) AS DC_slow75,
       round(DC_fast150, 6) AS DC_fast150, round(DC_ban0, 6) AS DC_ban0, TRUE AS in_range
FROM wide""")
ORACLE["run_log"] = """
SELECT unnest(['NumTrees', 'MaxDepth', 'RMSE', 'R2', 'IMPORTANCE - DC_Opened', 'IMPORTANCE - PrevPrice',
               'IMPORTANCE - StateVec']) AS name, TRUE AS has_value"""
add("alt_learners", SPLIT, """
SELECT unnest(['forest', 'gbt', 'linear']) AS learner, n, TRUE AS sound
FROM (SELECT count(*) AS n FROM split WHERE bucket >= 80)""")
add("linear_fit", SPLIT, """
SELECT round(regr_slope(Avg_kWh, PrevPrice), 3) AS slope,
       round(regr_intercept(Avg_kWh, PrevPrice) / 100, 1) AS intercept_hundreds
FROM split WHERE bucket < 80""")

add("customer_scenarios", CUSTOMER + """,
wide AS (
  SELECT custkey, Year, DC_Opened, PrevPrice, Avg_kWh, s.*
  FROM panel, LATERAL (SELECT
    PrevPrice + 0.001::DOUBLE * DC_Opened AS Pred_baseline,
    DC_Opened * 0.9::DOUBLE AS DC_minus10, PrevPrice + 0.001::DOUBLE * (DC_Opened * 0.9::DOUBLE) AS Pred_minus10,
    DC_Opened * 1.1::DOUBLE AS DC_plus10, PrevPrice + 0.001::DOUBLE * (DC_Opened * 1.1::DOUBLE) AS Pred_plus10,
    DC_Opened * 1.2::DOUBLE AS DC_plus20, PrevPrice + 0.001::DOUBLE * (DC_Opened * 1.2::DOUBLE) AS Pred_plus20,
    DC_Opened * 0.75::DOUBLE AS DC_slow75, PrevPrice + 0.001::DOUBLE * (DC_Opened * 0.75::DOUBLE) AS Pred_slow75,
    DC_Opened * 1.5::DOUBLE AS DC_fast150, PrevPrice + 0.001::DOUBLE * (DC_Opened * 1.5::DOUBLE) AS Pred_fast150,
    DC_Opened * 0.0::DOUBLE AS DC_ban0, PrevPrice + 0.001::DOUBLE * (DC_Opened * 0.0::DOUBLE) AS Pred_ban0) s)
""", # doubles half way between two rounded values go up in decimal, as in Spark
"SELECT custkey, Year, DC_Opened, "
    "CAST(round(CAST(COLUMNS('(PrevPrice|Avg_kWh|Pred_.*|DC_[a-z].*)') AS DECIMAL(28, 10)), 6) AS DOUBLE) FROM wide")

# windows and dictionaries wider than a task ------------------------------------------
ORACLE["line_item_series"] = """
WITH lines AS (
  SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity, cents,
       CAST(sum(quantity) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS quantity_to_date,
       lag(cents) OVER w AS previous_cents,
       CAST(sum(quantity) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS rolling_quantity
FROM lines
WINDOW w AS (PARTITION BY l_returnflag
             ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity, cents)"""
ORACLE["customer_index"] = """
SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) - 1 AS "index"
FROM orders GROUP BY o_custkey"""
ORACLE["customer_one_hot"] = """
SELECT o_orderkey, slot, 1.0::DOUBLE AS value
FROM orders JOIN (
  SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, o_custkey) - 1 AS slot
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) USING (o_custkey)"""

# stored sketches: exact counts; the estimates must lie inside their bounds -------------
ORACLE["key_sketch_report"] = """
WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R'),
r AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'A')
SELECT (SELECT count(*) FROM l) AS n_left, (SELECT count(*) FROM r) AS n_right,
       (SELECT count(*) FROM l JOIN r USING (k)) AS n_matched,
       (SELECT count(*) FROM l ANTI JOIN r USING (k)) AS n_missing,
       TRUE AS n_left_inside, TRUE AS n_right_inside, TRUE AS n_matched_inside, TRUE AS n_missing_inside"""
ORACLE["price_sketch"] = """
SELECT l_returnflag, count(*) AS n, TRUE AS inside FROM lineitem WHERE l_extendedprice IS NOT NULL
GROUP BY GROUPING SETS ((l_returnflag), ())"""


ORACLE["heavy_orders"] = """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY n_rows DESC, l_orderkey LIMIT 5"""


# sheets of many layouts over every line item ---------------------------------------------
add("layout_consolidation", GRAIN, """
SELECT Utility_Name, State, Year, Utility_ID,
       CAST(Revenue_Thousands AS DOUBLE) AS Revenue_Thousands,
       CAST(Sales_MWh AS DOUBLE) AS Sales_MWh, CAST(Customers AS DOUBLE) AS Customers,
       round(Revenue_Thousands / nullif(Sales_MWh, 0), 6) AS Price_Per_kWh
FROM cons""")
add("observed_step_counts", GRAIN, """
SELECT CAST(sum(n) AS BIGINT) AS n_raw, count(*) AS n_consolidated,
       count(*) FILTER (WHERE Sales_MWh > 400) AS n_size_ok,
       count(*) FILTER (WHERE Sales_MWh > 400 AND
             try_cast(Utility_ID AS DOUBLE) NOT IN (7.0, 8.0, 9.0)) AS n_code_ok
FROM cons""")

# bootstrap replicates and two-way effects on the customer panel ---------------------------
POISSON = " + ".join(
    f"CAST(u >= {round(math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) * (1 << 32))} AS INTEGER)"
    for k in range(12))
ERRORS = "n, sqrt(sse / n) AS rmse, sae / n AS mae, 1 - sse / (syy - sy * sy / n) AS r2, sqrt(sse / n) / (sy / n) AS rmse_share_of_mean"


def _replicates(count: int) -> str:
    return CUSTOMER + f""",
draws AS (
  SELECT CAST(r AS INTEGER) AS replicate, Avg_kWh AS y, PrevPrice - Avg_kWh AS e,
         CAST('0x' || substr(md5(CAST(custkey AS VARCHAR) || '#' || CAST(Year AS VARCHAR) || '#'
              || CAST(r // 4 AS VARCHAR)), CAST(8 * (r % 4) + 1 AS BIGINT), 8) AS BIGINT) AS u
  FROM panel, (SELECT unnest(range({count})) AS r)),
sums AS (
  SELECT replicate, CAST(sum(w) AS BIGINT) AS n, sum(w * e * e) AS sse, sum(w * abs(e)) AS sae,
         sum(w * y) AS sy, sum(w * y * y) AS syy
  FROM (SELECT *, {POISSON} AS w FROM draws) GROUP BY replicate),
reps AS (SELECT replicate, {ERRORS} FROM sums)"""


add("bootstrap_errors", _replicates(40), """
SELECT replicate, n, round(rmse, 3) AS rmse, round(mae, 3) AS mae, round(r2, 6) AS r2,
       round(rmse_share_of_mean, 6) AS rmse_share_of_mean
FROM reps""")
add("error_intervals", _replicates(200) + f""",
point AS (SELECT {ERRORS} FROM (
  SELECT count(*) AS n, sum((PrevPrice - Avg_kWh) ** 2) AS sse, sum(abs(PrevPrice - Avg_kWh)) AS sae,
         sum(Avg_kWh) AS sy, sum(Avg_kWh * Avg_kWh) AS syy FROM panel)),
long AS (UNPIVOT (SELECT rmse, mae, r2, rmse_share_of_mean FROM reps)
         ON rmse, mae, r2, rmse_share_of_mean INTO NAME metric VALUE v),
points AS (UNPIVOT (SELECT rmse, mae, r2, rmse_share_of_mean FROM point)
           ON rmse, mae, r2, rmse_share_of_mean INTO NAME metric VALUE v)""", """
SELECT metric, round(any_value(p.v), 4) AS value, round(quantile_cont(l.v, 0.025), 4) AS low,
       round(quantile_cont(l.v, 0.975), 4) AS high
FROM long l JOIN points p USING (metric) GROUP BY metric""")


def _two_way(rounds: int = 60) -> str:
    steps = ["t0 AS MATERIALIZED (SELECT DISTINCT Year, 0.0::DOUBLE AS gy, 0.0::DOUBLE AS gx FROM two)"]
    for i in range(rounds):
        steps += [f"k{i} AS MATERIALIZED (SELECT custkey, avg(y - gy) AS ay, avg(x - gx) AS ax "
                  f"FROM two JOIN t{i} USING (Year) GROUP BY custkey)",
                  f"t{i + 1} AS MATERIALIZED (SELECT Year, avg(y - ay) AS gy, avg(x - ax) AS gx "
                  f"FROM two JOIN k{i} USING (custkey) GROUP BY Year)"]
    return CUSTOMER + ",\ntwo AS MATERIALIZED (SELECT custkey, Year, Avg_kWh AS y, " \
        "CAST(Cumulative_DC AS DOUBLE) AS x FROM panel),\n" + ",\n".join(steps) + f""",
ends AS (SELECT custkey, avg(y - gy) AS ay, avg(x - gx) AS ax FROM two JOIN t{rounds} USING (Year) GROUP BY custkey),
rest AS (SELECT custkey, y - gy - ay AS y, x - gx - ax AS x FROM two JOIN t{rounds} USING (Year) JOIN ends USING (custkey)),
per_key AS (SELECT custkey, count(*) AS n, sum(x * y) AS xy, sum(x * x) AS xx FROM rest GROUP BY custkey),
fit AS (SELECT sum(xy) / sum(xx) AS e FROM per_key)"""


add("two_way_effect", _two_way(), """
SELECT CAST(sum(n) AS BIGINT) AS n, count(*) AS n_keys, (SELECT count(*) FROM t0) AS n_times,
       round(max(e), 6) AS effect, round(sqrt(sum((xy - e * xx) ** 2)) / sum(xx), 6) AS std_error
FROM per_key, fit""")

# co-located tables
ORACLE["colocated_order_lines"] = """
SELECT o_orderkey AS orderkey, o_custkey, count(*) AS n_lines, min(l_suppkey) AS first_supplier,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2"""

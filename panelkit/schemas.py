"""Schemas and fixed values.

FIXED VALUES: the names, codes, factors, labels and keyword lists below must
equal the ones the original application uses, otherwise results differ.  They
are stated plainly, in their natural order, and nowhere else in the package.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- FIXED VALUES: facility table, 15 columns in file order -----------------
FACILITY_FIELDS = [
    ("Facility_ID", T.StringType()),
    ("Facility_Name", T.StringType()),
    ("Operator", T.StringType()),
    ("City", T.StringType()),
    ("State", T.StringType()),
    ("Utility_Name", T.StringType()),
    ("Latitude", T.DoubleType()),
    ("Longitude", T.DoubleType()),
    ("Opening_Year", T.DoubleType()),
    ("Opening_Month", T.DoubleType()),
    ("Capacity_MW", T.DoubleType()),
    ("Verified", T.StringType()),
    ("Data_Source", T.StringType()),
    ("Source_URL", T.StringType()),
    ("Notes", T.StringType()),
]
FACILITY_SCHEMA = T.StructType([T.StructField(n, t) for n, t in FACILITY_FIELDS])
FACILITY_COLUMNS = [n for n, _ in FACILITY_FIELDS]
# columns dropped right after the facility read
FACILITY_DROPPED = ["Notes", "Source_URL", "Data_Source", "Verified",
                    "Opening_Month", "Latitude", "Longitude"]

# --- FIXED VALUES: raw 10-field positional list, in field order -------------
LIST_FIELDS = ["facility_id", "name", "operator", "city", "state",
               "lat", "lon", "year", "cap", "utility"]
# where each positional field lands in the 15-column facility layout
LIST_TO_FACILITY = {
    "facility_id": "Facility_ID",
    "name": "Facility_Name",
    "operator": "Operator",
    "city": "City",
    "state": "State",
    "utility": "Utility_Name",
    "lat": "Latitude",
    "lon": "Longitude",
    "year": "Opening_Year",
    "cap": "Capacity_MW",
}

# --- FIXED VALUES: utility-year sales table, file (positional) order --------
POWER_FIELDS = [
    ("Utility_Name", T.StringType()),
    ("State", T.StringType()),
    ("Year", T.IntegerType()),
    ("Utility_ID", T.StringType()),
    ("Revenue_Thousands", T.DoubleType()),
    ("Sales_MWh", T.DoubleType()),
    ("Customers", T.DoubleType()),
    ("Price_Per_kWh", T.DoubleType()),
]
POWER_SCHEMA = T.StructType([T.StructField(n, t) for n, t in POWER_FIELDS])
POWER_COLUMNS = [n for n, _ in POWER_FIELDS]
# as files hold it: the year may be written as '2013.0'
POWER_FILE_SCHEMA = T.StructType([T.StructField(n, T.DoubleType() if n == "Year" else t)
                                  for n, t in POWER_FIELDS])

# --- FIXED VALUES: required column order of a cleaned sheet -----------------
REQUIRED_COLUMNS = ["Utility_ID", "Utility_Name", "State", "Year",
                    "Revenue_Thousands", "Sales_MWh", "Customers", "Price_Per_kWh"]
REQUIRED_TYPES = {
    "Utility_ID": T.StringType(),
    "Utility_Name": T.StringType(),
    "State": T.StringType(),
    "Year": T.IntegerType(),
    "Revenue_Thousands": T.DoubleType(),
    "Sales_MWh": T.DoubleType(),
    "Customers": T.DoubleType(),
    "Price_Per_kWh": T.DoubleType(),
}

# --- FIXED VALUES: utility adjustment codes excluded from the sales table ---
ADJUSTMENT_CODES = (99999, 88888, 77777)

# --- FIXED VALUES: size thresholds of the sales filter (strict) -------------
MIN_CUSTOMERS = 400
MIN_SALES = 400

# --- FIXED VALUES: raw sheet header rules, checked in this order ------------
YEAR_HEADER = "Data Year"
ID_HEADER_KEYS = ["Utility Number", "Utility ID"]
NAME_HEADER_KEYS = ["Utility Name"]
STATE_HEADER_KEYS = ["State"]
REVENUE_HEADER_KEYS = ["Thousand Dollars", "Revenue"]
SALES_HEADER_KEYS = ["Megawatthours", "Sales", "MWh"]
CUSTOMER_HEADER_KEYS = ["Count", "Customer"]
TOTAL_HEADER_MARKS = [".4", "Total"]
SHEET_PREAMBLE_LINES = 2

# --- FIXED VALUES: rolling activity frame, rows (-3, +1) --------------------
RECENT_PRECEDING = 3
RECENT_FOLLOWING = 1

# --- FIXED VALUES: counterfactual scenarios (name, factor), in order --------
SCENARIOS = [
    ("minus10", 0.90),
    ("plus10", 1.10),
    ("plus20", 1.20),
    ("slow75", 0.75),
    ("fast150", 1.50),
    ("ban0", 0.0),
]

# --- FIXED VALUES: wide scenario column names --------------------------------
SCENARIO_BASELINE_PRED = "Pred_baseline"
SCENARIO_OPENED_COL = "DC_{name}"
SCENARIO_PRED_COL = "Pred_{name}"

# --- FIXED VALUES: prediction column -> chart label, in order ---------------
SCENARIO_LABELS = [
    ("Pred_baseline", "Baseline"),
    ("Pred_minus10", "-10%"),
    ("Pred_plus10", "+10%"),
    ("Pred_plus20", "+20%"),
    ("Pred_slow75", "-25%"),
    ("Pred_fast150", "+50%"),
    ("Pred_ban0", "x0"),
]

# --- FIXED VALUES: forest settings and tuning grid ---------------------------
FOREST_MIN_INSTANCES_PER_NODE = 5
FOREST_SUBSAMPLING_RATE = 1.0
GRID_NUM_TREES = [25, 50, 100, 200, 300]
GRID_MAX_DEPTH = [2, 3, 4, 6, 8, 10]
CV_FOLDS = 4
TRAIN_FRACTION = 0.8
SPLIT_SEED = 19
FEATURE_INPUTS = ["DC_Opened", "PrevPrice", "StateVec"]

# --- FIXED VALUES: run log line formats, in order ---------------------------
RUN_LOG_LINES = [
    "NumTrees: {num_trees}",
    "MaxDepth: {max_depth}",
    "RMSE: {rmse}",
    "R2:   {r2}",
]
RUN_LOG_IMPORTANCE = "IMPORTANCE - {name}: {value}"

# household figure used in the error report: kWh per year
HOUSEHOLD_KWH = 10000

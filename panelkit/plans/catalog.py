"""Query catalog: key -> ``fn(spark, sf_dir) -> DataFrame``.

Each entry applies one operator (or the flagship chain) to the role tables of
:mod:`panelkit.plans.roles`.  Doubles in the output are rounded to 6 places
so that results compare across engines regardless of summation order.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from panelkit import schemas as S
from panelkit.functions import headers
from panelkit.functions.exprs import not_in_codes, safe_double, safe_int
from panelkit.operators import clean, effects, features, ordered, panel, quality, sketches
from panelkit.operators import model as ml
from panelkit.operators import scenario as sc
from panelkit.plans import roles
from panelkit.session import materialize, materialize_all, scratch_path
from panelkit.sinks import writers
from panelkit.sources import csv as csv_src
from panelkit.sources.tables import read_parquet, read_table
from panelkit.streaming import yearly_prices

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    cols = {f.name: F.round(F.col(f"`{f.name}`"), places)
            for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(cols) if cols else df


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# --------------------------------------------------------------------------
# shared inputs
# --------------------------------------------------------------------------

def _fac(spark, d):
    return roles.facilities(spark, d)


def _pc(spark, d):
    return roles.power_costs(roles.utility_sales(spark, d))


def _bounds(spark, d):
    return panel.year_bounds(_pc(spark, d))


def _counts(spark, d):
    """Facility counts per (state, year), orders reduced before the joins."""
    return roles.facility_counts(spark, d)


def _cum(spark, d):
    return panel.cumulative_panel(None, _pc(spark, d), counts=_counts(spark, d))[0]


def _full(spark, d):
    cum, prices = panel.cumulative_panel(None, _pc(spark, d), counts=_counts(spark, d))
    return panel.price_integration(cum, prices)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.build_panel(None, _pc(spark, sf_dir), counts=_counts(spark, sf_dir))


# --------------------------------------------------------------------------
# step 1: panel
# --------------------------------------------------------------------------

@query("panel_flagship")
def q_panel_flagship(spark, d):
    """Whole chain: openings + prices -> filtered feature panel."""
    return flagship(spark, d)


@query("year_bounds")
def q_year_bounds(spark, d):
    return _bounds(spark, d)


@query("year_spine")
def q_year_spine(spark, d):
    return panel.year_spine(_bounds(spark, d))


def _inputs(spark, d):
    """Facility counts (+ capacity) per (state, year) and prices per (state,
    year), each computed once and written; bounds from the prices."""
    counts, prices = materialize_all(_counts(spark, d), panel.avg_price(_pc(spark, d)),
                                     names=("facility_counts", "prices"))
    return counts, prices, panel.year_bounds(prices)


@query("distinct_states")
def q_distinct_states(spark, d):
    return panel.distinct_keys(_counts(spark, d))


@query("panel_grid")
def q_panel_grid(spark, d):
    counts, _, b = _inputs(spark, d)
    return panel.panel_grid(counts, b)


@query("openings_by_year")
def q_openings_by_year(spark, d):
    counts, _, b = _inputs(spark, d)
    return panel.openings_by_year(counts, b, weight="n")


@query("pre_period_count")
def q_pre_period_count(spark, d):
    counts, _, b = _inputs(spark, d)
    return panel.pre_period_count(counts, b, weight="n")


@query("left_join_fill")
def q_left_join_fill(spark, d):
    counts, _, b = _inputs(spark, d)
    return panel.left_join_fill(panel.panel_grid(counts, b),
                                panel.openings_by_year(counts, b, weight="n"),
                                ["State", "Year"], {"DC_Opened": 0})


@query("fill_missing")
def q_fill_missing(spark, d):
    counts, _, b = _inputs(spark, d)
    df = (panel.panel_grid(counts, b)
          .join(panel.openings_by_year(counts, b, weight="n"), ["State", "Year"], "left")
          .join(panel.pre_period_count(counts, b, weight="n"), ["State"], "left"))
    return panel.fill_missing(df, {"DC_Opened": 0, "Pre_DC": 0})


@query("cumulative_openings")
def q_cumulative_openings(spark, d):
    return _cum(spark, d)


@query("cumulative_capacity")
def q_cumulative_capacity(spark, d):
    """Capacity opened per (state, year) plus pre-period capacity,
    accumulated over the grid."""
    counts, _, b = _inputs(spark, d)
    yearly = panel.openings_by_year(counts, b, weight="Capacity_MW", out="MW_Opened")
    pre = panel.pre_period_count(counts, b, weight="Capacity_MW", out="Pre_MW")
    df = panel.left_join_fill(panel.panel_grid(counts, b), yearly, ["State", "Year"],
                              {"MW_Opened": 0.0})
    df = panel.left_join_fill(df, pre, ["State"], {"Pre_MW": 0.0})
    return (panel.cumulative_sum_column(df, value="MW_Opened", base="Pre_MW", out="Cum_MW")
            .select("State", "Year", "MW_Opened", "Cum_MW"))


@query("avg_price")
def q_avg_price(spark, d):
    return panel.avg_price(_pc(spark, d))


@query("price_integration")
def q_price_integration(spark, d):
    return _full(spark, d)


@query("lag_feature")
def q_lag_feature(spark, d):
    return features.lag_feature(_full(spark, d))


@query("rolling_openings")
def q_rolling_openings(spark, d):
    return features.rolling_sum(features.lag_feature(_full(spark, d)))


@query("recent_activity_filter")
def q_recent_activity_filter(spark, d):
    """F5 with the trailing-only frame (-3, 0), the documented intent."""
    rolled = features.rolling_sum(features.lag_feature(_full(spark, d)), following=0)
    return features.recent_activity_filter(rolled)


# --------------------------------------------------------------------------
# step 2: cleaning
# --------------------------------------------------------------------------

TEST_CODES = (7, 8, 9)  # ids that occur in the test tables
SIZES = {"Customers": S.MIN_CUSTOMERS, "Sales_MWh": S.MIN_SALES}


def _power(spark, d):
    return roles.utility_sales(spark, d)


@query("size_filter")
def q_size_filter(spark, d):
    return clean.size_filter(_power(spark, d), SIZES)


@query("code_exclusion")
def q_code_exclusion(spark, d):
    p = _power(spark, d).withColumn(
        "Utility_ID", F.when(F.col("Utility_ID") != "3.0", F.col("Utility_ID")))
    out = clean.exclude_codes(p, "Utility_ID", TEST_CODES)
    return clean.cast_columns(out, ints=["Utility_ID"]).select(
        "Utility_Name", "State", "Year", "Utility_ID")


@query("min_size_filter")
def q_min_size_filter(spark, d):
    return clean.min_size_filter(_power(spark, d), "Customers", 430)


@query("safe_cast")
def q_safe_cast(spark, d):
    part = read_table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return part.select(
        "p_partkey",
        safe_int("p_name").alias("name_int"),
        safe_double("p_name").alias("name_double"),
        safe_int(F.col("p_size").cast("string")).alias("size_int"),
        safe_int(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias("size_dot_int"))


@query("unit_price")
def q_unit_price(spark, d):
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    li = li.select(
        "l_orderkey", "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("Revenue_Thousands"),
        F.when(F.col("l_linenumber") == 1, F.lit(0).cast("bigint"))
        .otherwise(F.col("l_quantity").cast("bigint")).alias("Sales_MWh"))
    return clean.with_unit_price(li)


@query("normalize_text")
def q_normalize_text(spark, d):
    messy = _power(spark, d).select(
        F.concat(F.lit(" "), F.col("Utility_Name"), F.lit("\t")).alias("Utility_Name"),
        F.concat(F.lit("  "), F.lower("State"), F.lit(" ")).alias("State"), "Year")
    return clean.normalize_text(messy)


@query("header_mapping")
def q_header_mapping(spark, d):
    return headers.apply_header_map(roles.raw_sheet(_power(spark, d)))


@query("conform_schema")
def q_conform_schema(spark, d):
    return clean.conform_schema(_power(spark, d).drop("Customers", "Utility_ID"))


@query("conform_rows")
def q_conform_rows(spark, d):
    return clean.conform_rows(roles.facility_list_rows(_fac(spark, d)))


@query("ragged_rows_filter")
def q_ragged_rows_filter(spark, d):
    part = read_table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # a raw line per part: very small parts lost their name field (4 fields),
    # very large ones carry an extra trailing note (6 fields); both are dropped
    lines = part.select(F.concat_ws(
        ",", F.col("p_partkey").cast("string"),
        F.when(F.col("p_size") >= 5, F.col("p_name")),
        "p_brand", "p_type", F.col("p_size").cast("string"),
        F.when(F.col("p_size") > 45, F.lit("oversize"))).alias("value"))
    return clean.ragged_rows_filter(
        lines, arity=5, names=["p_partkey", "p_name", "p_brand", "p_type", "p_size"])


@query("consolidate_duplicates")
def q_consolidate_duplicates(spark, d):
    return clean.consolidate_duplicates(roles.sales_grain(spark, d), order="src_order")


@query("duplicate_groups")
def q_duplicate_groups(spark, d):
    return clean.duplicate_groups(_power(spark, d))


@query("detect_year")
def q_detect_year(spark, d):
    li = read_table(spark, d, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("Data Year"))
    return clean.detect_year(li, by=["l_suppkey"])


@query("clean_step_counts")
def q_clean_step_counts(spark, d):
    cons = clean.consolidate_duplicates(roles.sales_grain(spark, d), order="src_order",
                                        count_as="_n")
    return clean.clean_step_counts(
        cons, count_col="_n", keep_sizes=F.col("Sales_MWh") > S.MIN_SALES,
        keep_codes=not_in_codes("Utility_ID", TEST_CODES))


# --------------------------------------------------------------------------
# step 3: join validation and quality
# --------------------------------------------------------------------------

_FU_COLS = [c for c in S.FACILITY_COLUMNS
            if c in ("Facility_ID", "Facility_Name", "Utility_Name", "State", "Opening_Year")]


def _fu(spark, d):
    return roles.facility_utilities(spark, d)


def _latest_power(spark, d):
    """The cleaned sales file of the latest year (one yearly file, as the
    original validation reads), without utilities below the size thresholds."""
    p = _power(spark, d)
    return clean.size_filter(p.filter(F.col("Year") == p.agg(F.max("Year")).scalar()),
                             {"Customers": S.MIN_CUSTOMERS, "Sales_MWh": S.MIN_SALES})


def _fu_join(spark, d):
    p = _power(spark, d).select("Utility_Name", "State", "Year", "Price_Per_kWh")
    return quality.inner_join(_fu(spark, d).select(*_FU_COLS), p, ["Utility_Name", "State"])


@query("facility_utility_join")
def q_facility_utility_join(spark, d):
    return _fu_join(spark, d)


@query("distinct_facilities")
def q_distinct_facilities(spark, d):
    return quality.distinct_rows(_fu(spark, d),
                                 ["Facility_Name", "Utility_Name", "State", "Opening_Year"])


@query("matched_keys")
def q_matched_keys(spark, d):
    return quality.matched_keys(_fu(spark, d), _latest_power(spark, d), "Utility_Name")


@query("missing_keys")
def q_missing_keys(spark, d):
    return quality.missing_keys(_fu(spark, d), _latest_power(spark, d), "Utility_Name")


@query("key_match_report")
def q_key_match_report(spark, d):
    return quality.key_match_report(_fu(spark, d), _latest_power(spark, d), "Utility_Name")


@query("join_preview")
def q_join_preview(spark, d):
    return quality.preview(_fu_join(spark, d),
                           ["Facility_Name", "Utility_Name", "State", "Opening_Year", "Year",
                            "Facility_ID"])


@query("top_states")
def q_top_states(spark, d):
    return quality.top_values(_power(spark, d), "State")


@query("ordered_utilities")
def q_ordered_utilities(spark, d):
    """Distinct utility names in order."""
    return quality.ordered_keys(_power(spark, d), "Utility_Name")


@query("price_summary")
def q_price_summary(spark, d):
    return quality.summary(_power(spark, d), "Price_Per_kWh")


@query("growth_comparison")
def q_growth_comparison(spark, d):
    """Per state first / last price over the panel years, growth, total
    openings and a high / low openings flag (>= 4)."""
    full = _full(spark, d)
    per = full.groupBy("State").agg(
        F.min_by("Avg_kWh", "Year").alias("first_price"),
        F.max_by("Avg_kWh", "Year").alias("last_price"),
        F.sum("DC_Opened").alias("total_opened"))
    return per.select(
        "State", "first_price", "last_price", "total_opened",
        F.try_divide(F.col("last_price") - F.col("first_price"), F.col("first_price")).alias("growth"),
        F.when(F.col("total_opened") >= 4, "high").otherwise("low").alias("group"))


# --------------------------------------------------------------------------
# step 4: sources and sinks (round trips through the shared scratch folder)
# --------------------------------------------------------------------------


PANEL_SCHEMA = T.StructType([
    T.StructField("State", T.StringType()), T.StructField("Year", T.IntegerType()),
    T.StructField("DC_Opened", T.LongType()), T.StructField("Cumulative_DC", T.LongType()),
    T.StructField("Avg_kWh", T.DoubleType()), T.StructField("PrevPrice", T.DoubleType())])


def _facility_table(spark, d):
    """Facilities in the 15-column file layout, typed (year as a double)."""
    rows = clean.conform_rows(roles.facility_list_rows(_fac(spark, d)))
    return rows.select([F.col(n).cast(t).alias(n) for n, t in S.FACILITY_FIELDS])


@query("csv_scan_schema")
def q_csv_scan_schema(spark, d):
    path = scratch_path(spark, "facilities_csv")
    writers.write_csv(_facility_table(spark, d), path)
    return csv_src.read_facilities(spark, path)


@query("csv_glob_scan")
def q_csv_glob_scan(spark, d):
    base = scratch_path(spark, "power_years")
    p = _power(spark, d).select(*S.POWER_COLUMNS)
    writers.write_csv(p.withColumn("_file_year", F.col("Year")), base,
                      partition_by=["_file_year"], files_per_partition=4)
    return csv_src.read_power_costs(spark, f"{base}/_file_year=*/*.csv")


@query("csv_infer_scan")
def q_csv_infer_scan(spark, d):
    path = scratch_path(spark, "power_infer")
    cols = ["Utility_Name", "State", "Year", "Utility_ID", "Customers", "Price_Per_kWh"]
    writers.write_csv(_power(spark, d).select(*cols), path)
    return csv_src.read_inferred_csv(spark, path)


@query("preamble_csv_scan")
def q_preamble_csv_scan(spark, d):
    path = scratch_path(spark, "sheets")
    sheet = roles.raw_sheet(_power(spark, d))
    header = [re.sub(r"\.\d+$", "", c) for c in sheet.columns]
    writers.write_sheets(sheet.withColumn("_sheet_year", F.col("`Data Year`")), path,
                         sheet="_sheet_year", columns=sheet.columns, header=header,
                         preamble=["Utility sales by sector (test export)",
                                   "Values in thousand dollars, megawatthours and counts"])
    return csv_src.read_preamble_csv(spark, path, per_layout=clean.clean_sheet)


@query("parquet_scan")
def q_parquet_scan(spark, d):
    li = read_table(spark, d, "lineitem")
    return (li.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                    F.year("l_shipdate").alias("Year")))


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "panel_parquet")
    writers.write_parquet(flagship(spark, d), path)
    return read_parquet(spark, path)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "panel_csv")
    writers.write_csv(flagship(spark, d), path, single_file=True)
    return csv_src.read_typed_csv(spark, path, PANEL_SCHEMA)


@query("partitioned_write")
def q_partitioned_write(spark, d):
    path = scratch_path(spark, "power_by_year")
    writers.write_csv(_power(spark, d), path, partition_by=["Year"], files_per_partition=4)
    schema = T.StructType([
        T.StructField("Utility_Name", T.StringType()), T.StructField("State", T.StringType()),
        T.StructField("Utility_ID", T.StringType()),
        T.StructField("Revenue_Thousands", T.LongType()), T.StructField("Sales_MWh", T.LongType()),
        T.StructField("Customers", T.LongType()), T.StructField("Price_Per_kWh", T.DoubleType()),
        T.StructField("Year", T.IntegerType())])
    return spark.read.option("header", True).schema(schema).csv(path)


@query("project_alias")
def q_project_alias(spark, d):
    return (flagship(spark, d)
            .select("State", "Year", "DC_Opened", F.col("Avg_kWh").alias("label"),
                    F.col("PrevPrice").alias("prev"))
            .withColumnsRenamed({"DC_Opened": "opened", "Year": "yr"}))


# --------------------------------------------------------------------------
# step 5: ML features
# --------------------------------------------------------------------------


def _encoded(spark, d):
    p = flagship(spark, d)
    return ml.feature_stages().fit(p).transform(p)


@query("string_index")
def q_string_index(spark, d):
    p = flagship(spark, d)
    return ml.state_indexer().fit(p).transform(p).select("State", "Year", "StateIndex")


@query("one_hot")
def q_one_hot(spark, d):
    return ml.sparse_slots(_encoded(spark, d), "StateVec", ["State", "Year"])


@query("assemble_features")
def q_assemble_features(spark, d):
    return ml.sparse_slots(_encoded(spark, d), "features", ["State", "Year"])


@query("hash_split")
def q_hash_split(spark, d):
    return ml.hash_split(flagship(spark, d), ["State", "Year"]).select(
        "State", "Year", "bucket", "split")


# --------------------------------------------------------------------------
# step 6: scenarios (SQL-checked with a fixed linear score)
# --------------------------------------------------------------------------
def _wide_linear(spark, d):
    return sc.scenario_wide(flagship(spark, d), sc.linear_scorer())


@query("scenario_scale")
def q_scenario_scale(spark, d):
    return sc.scale_scenarios(flagship(spark, d))


@query("scenario_wide")
def q_scenario_wide(spark, d):
    return _wide_linear(spark, d)


@query("scenario_long")
def q_scenario_long(spark, d):
    return sc.scenario_long(_wide_linear(spark, d))


@query("label_map")
def q_label_map(spark, d):
    long = sc.scenario_long(_wide_linear(spark, d),
                            values=sc.prediction_columns() + ["Avg_kWh"])
    return sc.label_scenarios(long)


@query("scenario_series")
def q_scenario_series(spark, d):
    p = flagship(spark, d)
    long = sc.label_scenarios(sc.scenario_long(sc.scenario_wide(p, sc.linear_scorer())))
    return sc.scenario_series(long, value=p.agg(F.min("State")).scalar())


@query("scenario_delta")
def q_scenario_delta(spark, d):
    return sc.scenario_delta(_wide_linear(spark, d))


# --------------------------------------------------------------------------
# step 7: model
# --------------------------------------------------------------------------
@query("regression_metrics")
def q_regression_metrics(spark, d):
    """Metrics of the "price = previous price" baseline on the panel."""
    m = ml.regression_metrics(flagship(spark, d), label="Avg_kWh", prediction="PrevPrice")
    # a money figure: cents (6 places of a 1e8 value exceed double precision)
    return m.withColumn("household_error", F.round("household_error", 2))


def training_table(spark, d) -> DataFrame:
    """Encoded panel with label and split, written once to the shared folder
    (it is re-read by every fold and grid point)."""
    t = ml.hash_split(_encoded(spark, d).withColumn("label", F.col("Avg_kWh")), ["State", "Year"])
    return materialize(t, "training_table", keep=True)  # outlives one query: see tuned()


_TUNED: dict[tuple[str, str], tuple] = {}


def tuned(spark, d):
    """(training table, best forest, metric table) of the full tuning job
    (5 x 6 grid, 4 folds), run once per application and input folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _TUNED:
        t = training_table(spark, d)
        _TUNED[key] = (t, *ml.tune(t.filter(F.col("split") == "train"), ml.forest(seed=42)))
    return _TUNED[key]


def _label_range(t):
    """Bounds of the training labels: a forest predicts means of them."""
    r = t.filter(F.col("split") == "train").agg(F.min("label"), F.max("label")).first()
    return F.lit(r[0] - 1e-6), F.lit(r[1] + 1e-6)


# Each model job returns its whole result with the columns that SQL can check
# beside it; the keys with SQL are its checkable columns.


@query("rf_train_score_results")
def q_rf_train_score_results(spark, d):
    """Held-out rows scored by the tuned forest: label, prediction, and
    whether the prediction is a mean of training labels."""
    t, m, _ = tuned(spark, d)
    return m.transform(t.filter(F.col("split") == "test")).select(
        "State", "Year", "label", "prediction",
        F.col("prediction").between(*_label_range(t)).alias("in_range"))


@query("rf_train_score")
def q_rf_train_score(spark, d):
    """Checkable columns of ``rf_train_score_results``."""
    return q_rf_train_score_results(spark, d).drop("prediction")


@query("best_params_results")
def q_best_params_results(spark, d):
    """The full grid (5 x 6) and 4 folds: each point with its mean metric and
    the best flag, whether the metric was measured, and whether the flag marks
    the lowest metric and only it."""
    table = tuned(spark, d)[2]
    low = table.agg(F.min("avg_metric")).scalar()
    return table.select(
        "numTrees", "maxDepth", "avg_metric", "is_best", (F.col("avg_metric") >= 0).alias("measured"),
        (~F.col("is_best") | (F.col("avg_metric") == low)).alias("best_is_lowest"),
        (table.agg(F.count_if("is_best")).scalar() == 1).alias("one_best"))


@query("best_params")
def q_best_params(spark, d):
    """Checkable columns of ``best_params_results``."""
    return q_best_params_results(spark, d).drop("avg_metric", "is_best")


@query("feature_importance_results")
def q_feature_importance_results(spark, d):
    """Importance of each input, between 0 and 1; together they make 1."""
    t, m, _ = tuned(spark, d)
    rows = spark.createDataFrame(ml.grouped_importances(m, t), "feature string, importance double")
    total = rows.agg(F.round(F.sum("importance"), 6)).scalar()
    return rows.select("feature", "importance", F.col("importance").between(0.0, 1.0).alias("is_share"),
                       total.alias("total"))


@query("feature_importance")
def q_feature_importance(spark, d):
    """Checkable columns of ``feature_importance_results``."""
    return q_feature_importance_results(spark, d).drop("importance")


@query("rf_counterfactual_results")
def q_rf_counterfactual_results(spark, d):
    """Save the feature stages and the tuned forest (K6), load both back
    (S10, S11), score the written panel (K1 -> S3) under every scenario and
    write the scenario table as one CSV file with a header (K2)."""
    panel_path = scratch_path(spark, "panel_features")
    writers.write_parquet(flagship(spark, d), panel_path)
    p = read_parquet(spark, panel_path)
    stages = ml.feature_stages().fit(p)
    t, forest, _ = tuned(spark, d)
    stages_path, model_path = scratch_path(spark, "feature_stages"), scratch_path(spark, "forest")
    stages.write().overwrite().save(stages_path)
    forest.write().overwrite().save(model_path)
    loaded_stages = ml.load_feature_stages(stages_path)
    loaded_forest = ml.load_forest(model_path)
    wide = sc.scenario_wide(loaded_stages.transform(p), sc.model_scorer(loaded_forest))
    # the scenario table is states x years rows: one CSV file with a header (K2)
    out_path = scratch_path(spark, "counterfactuals")
    writers.write_csv(wide, out_path, single_file=True)
    back = csv_src.read_typed_csv(spark, out_path, wide.schema)
    inside = F.lit(True)
    for c in sc.prediction_columns():
        inside = inside & F.col(c).between(*_label_range(t))
    return back.withColumn("in_range", inside)


@query("rf_counterfactual")
def q_rf_counterfactual(spark, d):
    """Checkable columns of ``rf_counterfactual_results``."""
    return q_rf_counterfactual_results(spark, d).drop(*sc.prediction_columns())


@query("run_log_results")
def q_run_log_results(spark, d):
    """Tuned parameters (lowest cross-validated RMSE), held-out RMSE and R2,
    and importances grouped per input, as text lines written to the shared
    folder and read back: each line, its name, and whether a number follows
    it."""
    t, best, table = tuned(spark, d)
    chosen = table.filter("is_best").first()
    met = ml.regression_metrics(best.transform(t.filter(F.col("split") == "test"))).first()
    imp = dict(ml.grouped_importances(best, t))
    values = {"num_trees": chosen.numTrees, "max_depth": chosen.maxDepth,
              "rmse": met["rmse"], "r2": met["r2"]}
    lines = [fmt.format(**values) for fmt in S.RUN_LOG_LINES]
    lines += [S.RUN_LOG_IMPORTANCE.format(name=k, value=imp.get(k, 0.0)) for k in S.FEATURE_INPUTS]
    path = scratch_path(spark, "run_logs")
    writers.write_text_lines(spark.createDataFrame([(x,) for x in lines], "value string"), path)
    parts = F.split("value", ": +")
    return spark.read.text(path).select(
        "value", parts[0].alias("name"), parts[1].try_cast("double").isNotNull().alias("has_value"))


@query("run_log")
def q_run_log(spark, d):
    """Checkable columns of ``run_log_results``."""
    return q_run_log_results(spark, d).drop("value")


# --------------------------------------------------------------------------
# streaming: yearly sales files as a file stream -> running average price
# --------------------------------------------------------------------------


@query("stream_avg_price")
def q_stream_avg_price(spark, d):
    """Sales files consumed as a file stream with running state per (state,
    year); the result equals the batch ``avg_price``."""
    src, out, ckpt = (scratch_path(spark, "stream_src"), scratch_path(spark, "stream_out"),
                      scratch_path(spark, "stream_ckpt"))
    p = _power(spark, d).select(*S.POWER_COLUMNS)
    writers.write_csv(p, src)
    stream = yearly_prices.price_stream(spark, src)
    yearly_prices.run_until_caught_up(stream, out, ckpt)
    return spark.read.parquet(out)


# --------------------------------------------------------------------------
# optional: alternative learners (X6) and difference-in-differences
# --------------------------------------------------------------------------


@query("diff_in_diff")
def q_diff_in_diff(spark, d):
    return effects.diff_in_diff(_full(spark, d))


@query("alt_learners_results")
def q_alt_learners_results(spark, d):
    """The forest, gradient-boosted trees and linear regression on the same
    deterministic split: held-out rows, their metrics, and whether these are
    sound (0 <= mae <= rmse, r2 <= 1)."""
    t, forest, _ = tuned(spark, d)
    train, test = t.filter(F.col("split") == "train"), t.filter(F.col("split") == "test")
    out = None
    for name, model in (("forest", forest), ("gbt", ml.other_learner("gbt").fit(train)),
                        ("linear", ml.other_learner("linear").fit(train))):
        m = ml.regression_metrics(model.transform(test)).select(
            F.lit(name).alias("learner"), "n", "rmse", "mae", "r2",
            ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") + 1e-9) & (F.col("r2") <= 1)).alias("sound"))
        out = m if out is None else out.unionByName(m)
    return out


@query("alt_learners")
def q_alt_learners(spark, d):
    """Checkable columns of ``alt_learners_results``."""
    return q_alt_learners_results(spark, d).drop("rmse", "mae", "r2")


@query("linear_fit")
def q_linear_fit(spark, d):
    """The linear learner on one input: slope and intercept of price on the
    previous price, over the training rows."""
    t = training_table(spark, d).filter(F.col("split") == "train").drop("features")
    one = ml.assembler(["PrevPrice"]).transform(t)
    m = ml.other_learner("linear").fit(one)
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))], "slope double, intercept double") \
        .select(F.round("slope", 3).alias("slope"), F.round(F.col("intercept") / 100, 1).alias("intercept_hundreds"))


@query("scenario_pivot")
def q_scenario_pivot(spark, d):
    """Long scenario table back to one prediction column per scenario."""
    return sc.pivot_scenarios(sc.scenario_long(_wide_linear(spark, d)))


@query("sheet_consolidation")
def q_sheet_consolidation(spark, d):
    """Raw yearly sheets holding duplicate utility rows (one row per return
    flag), written in (utility, flag) line order; read back, cleaned per
    layout, and consolidated with "first non-NULL id" taken in file order."""
    path = scratch_path(spark, "dup_sheets")
    grain = roles.sales_grain(spark, d)
    sheet = roles.raw_sheet(grain, carry=("src_order",))
    cols = [c for c in sheet.columns if c != "src_order"]
    header = [re.sub(r"\.\d+$", "", c) for c in cols]
    writers.write_sheets(sheet.withColumn("_sheet_year", F.col("`Data Year`")), path,
                         sheet="_sheet_year", columns=cols, header=header,
                         together=["Utility Name"], order_by=["Utility Name", "src_order"],
                         preamble=["Utility sales by sector (test export)", "duplicates kept"])
    rows = csv_src.read_preamble_csv(
        spark, path, per_layout=lambda df: clean.clean_sheet(df, keep=("_line",)))
    return clean.consolidate_duplicates(rows, order="_line")


@query("sheets_to_panel")
def q_sheets_to_panel(spark, d):
    """End to end: raw sheets -> cleaned and consolidated rows -> yearly CSV
    files -> glob read with the size and code filters -> feature panel."""
    sheets, years = scratch_path(spark, "raw_sheets"), scratch_path(spark, "clean_years")
    sheet = roles.raw_sheet(roles.sales_grain(spark, d), carry=("src_order",))
    cols = [c for c in sheet.columns if c != "src_order"]
    writers.write_sheets(sheet.withColumn("_sheet_year", F.col("`Data Year`")), sheets,
                         sheet="_sheet_year", columns=cols,
                         header=[re.sub(r"\.\d+$", "", c) for c in cols],
                         together=["Utility Name"], order_by=["Utility Name", "src_order"],
                         preamble=["Utility sales by sector (test export)", "raw sheets"])
    rows = csv_src.read_preamble_csv(
        spark, sheets, per_layout=lambda df: clean.clean_sheet(df, keep=("_file", "_line")))
    rows = clean.min_size_filter(rows, "Customers", 1)
    cons = clean.consolidate_duplicates(rows, order=F.struct("_file", "_line"))
    writers.write_csv(cons.select(*S.POWER_COLUMNS).withColumn("_y", F.col("Year")), years,
                      partition_by=["_y"], files_per_partition=4)
    power = csv_src.read_power_costs(spark, f"{years}/_y=*/*.csv")
    # the panel's state names are those of the sheets, in upper case there
    counts = _counts(spark, d).withColumn("State", F.upper("State"))
    return panel.build_panel(None, power, counts=counts)


@query("positional_file_scan")
def q_positional_file_scan(spark, d):
    """S8 + F7 from files: quoted fields with commas, doubled quotes and
    literal backslashes; rows of another field count are dropped."""
    path = scratch_path(spark, "raw_list")
    part = read_table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    writers.write_text_lines(part.select(F.concat_ws(
        ",", F.col("p_partkey").cast("string"),
        F.when(F.col("p_size") >= 5, quote(F.concat(F.col("p_name"), F.lit(', the ""best""')))),
        quote(F.concat(F.lit("c:\\"), F.col("p_brand"), F.lit("\\"))), "p_type",
        F.when(F.col("p_size") > 45, F.lit("oversize"))).alias("value")), path, single_file=False)
    return csv_src.read_positional(spark, path, arity=4, names=["p_partkey", "p_name", "p_brand", "p_type"])


@query("customer_panel")
def q_customer_panel(spark, d):
    """The panel operators on keys that grow with the data: every customer
    with an order x every order year, all orders counted, running totals."""
    orders = (read_table(spark, d, "orders")
              .groupBy(F.col("o_custkey").alias("State"), F.year("o_orderdate").alias("Opening_Year"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
                   .alias("cents")))
    counts = materialize(orders, "customer_years")
    bounds = panel.year_bounds(counts.select(F.col("Opening_Year").alias("Year")))
    grid = panel.panel_grid(counts, bounds)
    full = panel.left_join_fill(grid, panel.openings_by_year(counts, bounds, weight="n"),
                                ["State", "Year"], {"DC_Opened": 0})
    full = panel.left_join_fill(
        full, panel.openings_by_year(counts, bounds, weight="cents", out="cents"), ["State", "Year"], {"cents": 0})
    return (panel.cumulative_sum_column(full.withColumn("_zero", F.lit(0).cast("long")), value="DC_Opened",
                                        base="_zero", out="Cumulative_DC")
            .select(F.col("State").alias("custkey"), "Year", F.col("DC_Opened").alias("orders"),
                    F.col("Cumulative_DC").alias("orders_to_date"), "cents"))


def customer_features(spark, d) -> DataFrame:
    """The feature panel over whole tables: every order (any priority and
    price) is an opening of its customer, every line item a sale to the
    customer in its ship year, priced revenue / quantity."""
    counts, prices = roles.customer_counts(spark, d), roles.customer_prices(spark, d)
    return panel.build_panel(None, prices, key="custkey", counts=counts)


@query("customer_features")
def q_customer_features(spark, d):
    """Customer panel with running total, price, lag and recent activity."""
    return customer_features(spark, d)


@query("customer_scenarios")
def q_customer_scenarios(spark, d):
    """Every scenario of the customer panel with the fixed linear score."""
    return sc.scenario_wide(customer_features(spark, d), sc.linear_scorer(), keys=("custkey", "Year"))


def customer_training(spark, d) -> DataFrame:
    """Encoded customer panel with label and split.  The state is the
    customer's nation: one-hot customers would grow with the data."""
    cust = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    p = (customer_features(spark, d).join(cust, F.col("custkey") == F.col("c_custkey"))
         .join(read_table(spark, d, "nation").select("n_nationkey", "n_name"),
               F.col("c_nationkey") == F.col("n_nationkey"))
         .select("custkey", "Year", F.col("n_name").alias("State"), "DC_Opened", "Cumulative_DC",
                 "Avg_kWh", "PrevPrice"))
    p = materialize(p, "customer_features")
    enc = ml.feature_stages().fit(p).transform(p).withColumn("label", F.col("Avg_kWh"))
    return materialize(ml.hash_split(enc, ["custkey", "Year"]), "customer_training")


@query("customer_forest")
def q_customer_forest(spark, d):
    """A forest (20 trees of depth 5) trained on the customer panel's training
    rows; all rows with their split, prediction and every scenario."""
    t = customer_training(spark, d)
    m = ml.forest(seed=42).fit(t.filter(F.col("split") == "train"))
    return sc.scenario_wide(t, sc.model_scorer(m), keys=("custkey", "Year"),
                            carry=("State", "PrevPrice", "Avg_kWh", "split"))


@query("avg_price_weighted")
def q_avg_price_weighted(spark, d):
    """Q11 option: sales-weighted price per (state, year), sum(revenue) /
    sum(sales), over the same filtered sales rows as the panel."""
    p = clean.exclude_codes(clean.size_filter(_power(spark, d), SIZES),
                            "Utility_ID", S.ADJUSTMENT_CODES)
    return panel.avg_price(p, weighted_by="Sales_MWh", revenue="Revenue_Thousands")


# --------------------------------------------------------------------------
# windows and dictionaries wider than a task
# --------------------------------------------------------------------------


@query("line_item_series")
def q_line_item_series(spark, d):
    """All line items as one series per return flag, by ship date: running
    quantity, previous price and rolling quantity (3 before, 1 after)."""
    lines = read_table(spark, d, "lineitem").select(
        "l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    return ordered.long_windows(
        lines, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity", "cents"],
        series=["l_returnflag"],
        running={"quantity_to_date": "quantity"}, lags={"previous_cents": ("cents", 1)},
        rolling={"rolling_quantity": "quantity"}).drop("l_shipdate")


@query("customer_index")
def q_customer_index(spark, d):
    """Frequency index of every customer with an order: no label list on the
    driver, whatever the number of customers."""
    return ordered.frequency_index(read_table(spark, d, "orders").select("o_custkey"), "o_custkey")


@query("customer_one_hot")
def q_customer_one_hot(spark, d):
    """Orders with the index of their customer as sparse one-hot slots; the
    dictionary is that of the customers of finished orders, so some are unseen."""
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    known = ordered.frequency_index(orders.filter("o_orderstatus = 'F'"), "o_custkey")
    return ordered.wide_one_hot(ordered.encode(orders, known, "o_custkey"), known, ["o_orderkey"])


# --------------------------------------------------------------------------
# stored sketches
# --------------------------------------------------------------------------


@query("key_sketch_report_results")
def q_key_sketch_report_results(spark, d):
    """Orders with a returned line against orders with an accepted line, from
    key sketches written per ship year: estimates and bounds beside the exact
    counts, and whether each estimate is inside its bound."""
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", F.year("l_shipdate").alias("year"))
    sides = [lines.filter(F.col("l_returnflag") == f) for f in ("R", "A")]
    report = sketches.sketch_match_report(*[sketches.key_sketches(s, "l_orderkey", ["year"]) for s in sides])
    names = ["n_left", "n_right", "n_matched", "n_missing"]
    exact = quality.key_match_report(*sides, "l_orderkey").select(F.struct(*names)).scalar()
    return report.withColumn("_x", exact).select(
        *[F.col("_x")[n].alias(n) for n in names],
        *[(F.abs(F.col(n) - F.col("_x")[n]) <= F.col(f"{n}_bound")).alias(f"{n}_inside") for n in names],
        *[F.col(n).alias(f"{n}_estimate") for n in names], *[f"{n}_bound" for n in names])


@query("key_sketch_report")
def q_key_sketch_report(spark, d):
    """Checkable columns of ``key_sketch_report_results``."""
    out = q_key_sketch_report_results(spark, d)
    return out.drop(*[c for c in out.columns if c.endswith(("_estimate", "_bound"))])


@query("price_sketch_results")
def q_price_sketch_results(spark, d):
    """Median line price per return flag and in total, merged from quantile
    sketches written per (flag, ship year), with its exact rank."""
    lines = read_table(spark, d, "lineitem").select(
        "l_returnflag", F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("price"))
    stored = sketches.value_sketches(lines, "price", ["l_returnflag", "year"])
    per_flag = sketches.rank_check(lines, "price", sketches.merged_quantiles(stored, ["l_returnflag"]), ["l_returnflag"])
    total = sketches.rank_check(lines, "price", sketches.merged_quantiles(stored))
    return per_flag.unionByName(total, allowMissingColumns=True)


@query("price_sketch")
def q_price_sketch(spark, d):
    """Checkable columns of ``price_sketch_results``."""
    return q_price_sketch_results(spark, d).select("l_returnflag", "n", "inside")


@query("heavy_orders")
def q_heavy_orders(spark, d):
    """A7 on a key as wide as the orders: the five orders with most lines."""
    return sketches.heavy_hitters(read_table(spark, d, "lineitem"), "l_orderkey")


# --------------------------------------------------------------------------
# sheets of many layouts in one scan, counts seen while writing
# --------------------------------------------------------------------------


def layout_sheets(spark, d) -> str:
    """Folder of raw yearly sheets over every line item, in four layouts:
    as published, state first, blocks turned round after a notes column, and
    totals by name."""
    path = scratch_path(spark, "layout_sheets")
    sheet = roles.raw_sheet(materialize(roles.sales_grain(spark, d), "sheet_grain"),
                            carry=("src_order",))
    cols = [c for c in sheet.columns if c != "src_order"]
    sheet = sheet.withColumns({"_sheet_year": F.col("`Data Year`"), "Notes": F.lit('kept, "as is"')})
    ids, values = cols[:4], cols[4:]
    blocks = [values[i:i + 3] for i in range(0, len(values), 3)]
    bare = lambda c: re.sub(r"\.\d+$", "", c)
    named = {c: f"{n} Total" for c, n in zip(blocks[-1], ("Revenue", "Sales", "Customers"))}
    layouts = [(cols, [bare(c) for c in cols]),
               (order := [ids[3], *ids[:3], *values], [bare(c) for c in order]),
               (order := [*ids, "Notes", *[c for b in blocks for c in reversed(b)]], [bare(c) for c in order]),
               (order := [*blocks[-1], *ids], [named.get(c, c) for c in order])]
    for i, (columns, header) in enumerate(layouts):
        writers.write_sheets(sheet.filter(F.pmod("_sheet_year", F.lit(len(layouts))) == i), f"{path}/layout{i}",
                             sheet="_sheet_year", columns=columns, header=header,
                             together=["Utility Name"], order_by=["Utility Name", "src_order"],
                             preamble=["Utility sales by sector (test export)", f"layout {i}"])
    return path


@query("layout_consolidation")
def q_layout_consolidation(spark, d):
    """Sheets of four layouts read in one scan, cleaned and consolidated."""
    rows = csv_src.read_sheets(spark, layout_sheets(spark, d), keep=("_file", "_line"))
    return clean.consolidate_duplicates(rows, order=F.struct("_file", "_line"))


@query("observed_step_counts")
def q_observed_step_counts(spark, d):
    """Counts of the cleaning steps, seen while the cleaned sheets are written
    as yearly files."""
    rows = csv_src.read_sheets(spark, layout_sheets(spark, d), keep=("_file", "_line"))
    cons = clean.consolidate_duplicates(rows, order=F.struct("_file", "_line"), count_as="_n")
    rows, seen = clean.observed_step_counts(
        cons, count_col="_n", keep_sizes=F.col("Sales_MWh") > S.MIN_SALES,
        keep_codes=not_in_codes("Utility_ID", TEST_CODES))
    writers.write_csv(rows.select(*S.POWER_COLUMNS).withColumn("_y", F.col("Year")),
                      scratch_path(spark, "observed_years"), partition_by=["_y"])
    return clean.observed_row(spark, seen)


# --------------------------------------------------------------------------
# error intervals and two-way effects over whole tables
# --------------------------------------------------------------------------


@query("bootstrap_errors")
def q_bootstrap_errors(spark, d):
    """Errors of the "price = previous price" baseline on the customer panel
    in each of 40 bootstrap replicates."""
    m = ml.bootstrap_metrics(customer_features(spark, d), ["custkey", "Year"], label="Avg_kWh",
                             prediction="PrevPrice")
    # cents in the hundred thousands: six places exceed what a sum in another order keeps
    return m.withColumns({"rmse": F.round("rmse", 3), "mae": F.round("mae", 3)})


@query("error_intervals")
def q_error_intervals(spark, d):
    """The same errors on all rows, with 95 % intervals from 200 replicates."""
    panel_rows = materialize(customer_features(spark, d), "customer_features")
    m = ml.error_intervals(panel_rows, ["custkey", "Year"], label="Avg_kWh", prediction="PrevPrice")
    return m.withColumns({c: F.round(c, 4) for c in ("value", "low", "high")})


@query("two_way_effect")
def q_two_way_effect(spark, d):
    """Price on running order count, with effects of customer and year."""
    return effects.two_way_effect(customer_features(spark, d), key="custkey", exposure="Cumulative_DC")


# --------------------------------------------------------------------------
# co-located tables
# --------------------------------------------------------------------------


def bucketed_orders(spark, d):
    """Orders and line items bucketed alike by order key (few lines an order),
    into as many buckets as a shuffle has partitions."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    lines = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    run = uuid.uuid4().hex
    return [writers.write_bucketed(df, f"panelkit_{name}_{run}", ["orderkey"], buckets,
                                   path=scratch_path(spark, f"bucketed_{name}"))
            for name, df in (("orders", orders), ("lines", lines))]


@query("colocated_order_lines")
def q_colocated_order_lines(spark, d):
    """Lines, suppliers and revenue of every order with a line, from bucketed
    tables: join and aggregate without a shuffle."""
    orders, lines = bucketed_orders(spark, d)
    return (quality.colocated_join(orders, lines, ["orderkey"]).groupBy("orderkey", "o_custkey")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.min("l_suppkey").alias("first_supplier"),
                 F.sum("cents").alias("cents")))

"""Counterfactual scenarios.

The original scores the same table seven times and folds the results with
six left joins on (State, Year).  Here every scenario is a column of the same
row: scale the opening count, score it, keep going - one scan, one stage, no
join and no pivot shuffle.  The long form is an ``unpivot`` of that row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from panelkit import schemas as S
from panelkit.functions.exprs import map_values

# (df, opened column, output column) -> df with the output column added
Scorer = Callable[[DataFrame, str, str], DataFrame]


def linear_scorer(prev: str = "PrevPrice", slope: float = 0.001) -> Scorer:
    """A fixed linear score, ``prev + slope * opened``, used where a result
    must be checked against SQL."""
    def score(df: DataFrame, opened: str, out: str) -> DataFrame:
        return df.withColumn(out, F.col(prev) + F.lit(slope) * F.col(opened))
    return score


def model_scorer(model: Model, inputs: Sequence[str] = S.FEATURE_INPUTS) -> Scorer:
    """Score with a fitted prediction model on (opened, other inputs...).

    ``inputs[0]`` is replaced by the scenario's opened column; the model's
    JVM predict runs as one more projection on the same rows.
    """
    def score(df: DataFrame, opened: str, out: str) -> DataFrame:
        feats = f"_features_{out}"
        cols = [opened, *inputs[1:]]
        df = VectorAssembler(inputCols=cols, outputCol=feats).transform(df)
        m = model.copy().setFeaturesCol(feats).setPredictionCol(out)
        return m.transform(df).drop(feats)
    return score


def scale_scenarios(df: DataFrame, *, opened: str = "DC_Opened",
                    scenarios: Sequence[tuple[str, float]] = S.SCENARIOS,
                    baseline: bool = True) -> DataFrame:
    """One row per (input row, scenario) with the scaled opening count.

    The scenario list is a literal array exploded next to each row (7 rows
    per input row), not a join.
    """
    items = ([("baseline", 1.0)] if baseline else []) + list(scenarios)
    arr = F.array(*[F.struct(F.lit(n).alias("Scenario"), F.lit(float(f)).alias("Factor"))
                    for n, f in items])
    return (df.select("*", F.explode(arr).alias("_s"))
            .select(*[c for c in df.columns if c != opened], "_s.Scenario", "_s.Factor",
                    (F.col(opened) * F.col("_s.Factor")).alias(opened)))


def scenario_wide(df: DataFrame, score: Scorer, *, opened: str = "DC_Opened",
                  keys: Sequence[str] = ("State", "Year"),
                  carry: Sequence[str] = ("PrevPrice", "Avg_kWh"),
                  scenarios: Sequence[tuple[str, float]] = S.SCENARIOS) -> DataFrame:
    """M11 + M12 + J6: baseline prediction plus (DC_x, Pred_x) per scenario,
    columns in the order State, Year, DC_Opened, PrevPrice, Avg_kWh,
    Pred_baseline, DC_minus10, Pred_minus10, ..."""
    base = S.SCENARIO_BASELINE_PRED
    out = score(df, opened, base)
    cols = [*keys, opened, *carry, base]
    for name, factor in scenarios:
        dc, pred = S.SCENARIO_OPENED_COL.format(name=name), S.SCENARIO_PRED_COL.format(name=name)
        out = out.withColumn(dc, F.col(opened) * F.lit(float(factor)))
        out = score(out, dc, pred)
        cols += [dc, pred]
    return out.select(*cols)


def prediction_columns(scenarios: Sequence[tuple[str, float]] = S.SCENARIOS) -> list[str]:
    return [S.SCENARIO_BASELINE_PRED] + [S.SCENARIO_PRED_COL.format(name=n) for n, _ in scenarios]


def scenario_long(wide: DataFrame, *, keys: Sequence[str] = ("State", "Year"),
                  values: Sequence[str] | None = None, name: str = "Scenario",
                  value: str = "PredictedPrice") -> DataFrame:
    """Wide prediction columns -> (keys, Scenario, PredictedPrice)."""
    values = list(values or prediction_columns())
    return wide.unpivot(list(keys), values, name, value)


def pivot_scenarios(long: DataFrame, *, keys: Sequence[str] = ("State", "Year"),
                    name: str = "Scenario", value: str = "PredictedPrice",
                    codes: Sequence[str] | None = None) -> DataFrame:
    """Long -> wide, one column per scenario code.  The value list is fixed,
    so Spark plans no extra job to find the distinct codes and the column
    order is stable; one aggregation grouped by the keys."""
    codes = list(codes or prediction_columns())
    return long.groupBy(*keys).pivot(name, codes).agg(F.first(value))


def label_scenarios(long: DataFrame, *, column: str = "Scenario",
                    labels: Sequence[tuple[str, str]] = S.SCENARIO_LABELS) -> DataFrame:
    """Scenario code -> chart label; unknown codes become NULL."""
    return long.withColumn(column, map_values(column, labels))


def scenario_delta(wide: DataFrame, *, keys: Sequence[str] = ("State", "Year"),
                   scenarios: Sequence[tuple[str, float]] = S.SCENARIOS) -> DataFrame:
    """Change of each scenario's prediction against the baseline, long."""
    base = F.col(S.SCENARIO_BASELINE_PRED)
    d = wide.select(*keys, *[(F.col(S.SCENARIO_PRED_COL.format(name=n)) - base).alias(n)
                             for n, _ in scenarios])
    return d.unpivot(list(keys), [n for n, _ in scenarios], "Scenario", "Delta")


def scenario_series(long: DataFrame, *, key: str = "State", value=None,
                    order: Sequence[str] = ("Scenario", "Year")) -> DataFrame:
    """F8 + D6: the series of one key value, ordered (scenario, then year)."""
    sel = long.filter(F.col(key) == (value if isinstance(value, F.Column) else F.lit(value)))
    return sel.orderBy(*order)

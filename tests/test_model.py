"""Feature stages, metrics, scenarios and the forest (fixed seeds)."""

from __future__ import annotations

import functools
import math
import os
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from panelkit import schemas as S
from panelkit.operators import forest_grid
from panelkit.operators import model as ml
from panelkit.operators import scenario as sc


def _panel(spark):
    rows = []
    for i, s in enumerate(["NV", "AZ", "IA", "TX", "VA", "OH"]):
        for y in range(2014, 2025):
            opened = (i + y) % 3
            prev = 0.10 + 0.002 * (y - 2014) + 0.01 * i
            rows.append((s, y, opened, prev, prev + 0.001 * opened + 0.0005 * ((y * 7 + i) % 5)))
    return spark.createDataFrame(rows, "State string, Year int, DC_Opened long, PrevPrice double, "
                                 "Avg_kWh double")


def test_index_ties_alphabetical(spark):
    df = spark.createDataFrame([(s,) for s in ["TX", "TX", "AZ", "CA", "CA", "NV"]], "State string")
    m = ml.state_indexer().fit(df)
    assert list(m.labels) == ["CA", "TX", "AZ", "NV"]


def test_one_hot_width_and_assembly(spark):
    p = _panel(spark)
    enc = ml.feature_stages().fit(p).transform(p)
    first = enc.select(vector_to_array("features").alias("f"), "DC_Opened", "PrevPrice").first()
    # 6 states + unseen bucket - dropped last = 6 slots; +2 numeric inputs
    assert len(first.f) == 8
    assert first.f[0] == first.DC_Opened and first.f[1] == first.PrevPrice


def test_metrics_known_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0), (4.0, 3.0)],
                               "label double, prediction double")
    r = ml.regression_metrics(df).collect()[0]
    errs = [1.0, 0.0, 2.0, -1.0]
    rmse = math.sqrt(sum(e * e for e in errs) / 4)
    assert abs(r.rmse - rmse) < 1e-12
    assert abs(r.mae - 1.0) < 1e-12
    sst = sum((y - 2.5) ** 2 for y in (1, 2, 3, 4))
    assert abs(r.r2 - (1 - 6.0 / sst)) < 1e-12
    assert abs(r.household_error - rmse * S.HOUSEHOLD_KWH) < 1e-6


def test_hash_split_is_deterministic(spark):
    p = _panel(spark)
    a = {(r.State, r.Year): r.split for r in ml.hash_split(p, ["State", "Year"]).collect()}
    b = {(r.State, r.Year): r.split
         for r in ml.hash_split(p.repartition(5), ["State", "Year"]).collect()}
    assert a == b and set(a.values()) == {"train", "test"}


def test_scenarios_linear(spark):
    p = _panel(spark)
    wide = sc.scenario_wide(p, sc.linear_scorer())
    assert wide.columns == (["State", "Year", "DC_Opened", "PrevPrice", "Avg_kWh", "Pred_baseline"]
                            + [c for n, _ in S.SCENARIOS for c in (f"DC_{n}", f"Pred_{n}")])
    r = wide.filter(F.col("DC_Opened") == 2).first()
    assert abs(r.DC_plus20 - 2.4) < 1e-12 and r.DC_ban0 == 0.0
    assert r.Pred_ban0 == r.PrevPrice
    long = sc.scenario_long(wide)
    assert long.count() == p.count() * 7
    # a factor of 1.0 reproduces the baseline
    scaled = sc.scale_scenarios(p)
    base = scaled.filter(F.col("Scenario") == "baseline")
    assert sorted(r.DC_Opened for r in base.collect()) == sorted(float(r.DC_Opened) for r in p.collect())
    labelled = sc.label_scenarios(sc.scenario_long(wide, values=sc.prediction_columns() + ["Avg_kWh"]))
    labels = {r.Scenario for r in labelled.select("Scenario").distinct().collect()}
    assert labels == {lab for _, lab in S.SCENARIO_LABELS} | {None}
    delta = sc.scenario_delta(wide).filter(F.col("Scenario") == "ban0")
    assert all(abs(r.Delta + 0.001 * d) < 1e-12 for r, d in
               zip(delta.orderBy("State", "Year").collect(),
                   [x.DC_Opened for x in p.orderBy("State", "Year").collect()]))


def test_forest_scoring_and_importances(spark):
    p = ml.feature_stages().fit(_panel(spark)).transform(_panel(spark)) \
        .withColumn("label", F.col("Avg_kWh"))
    m = ml.forest(num_trees=10, max_depth=3, seed=1).fit(p)
    scored = m.transform(p)
    lo, hi = p.agg(F.min("label"), F.max("label")).first()
    preds = [r.prediction for r in scored.collect()]
    assert all(x is not None and lo <= x <= hi for x in preds)
    imp = dict(ml.grouped_importances(m, p))
    assert set(imp) == set(S.FEATURE_INPUTS)
    assert abs(sum(imp.values()) - 1.0) < 1e-9
    wide = sc.scenario_wide(p, sc.model_scorer(m))
    base = {(r.State, r.Year): r.Pred_baseline for r in wide.collect()}
    direct = {(r.State, r.Year): r.prediction for r in scored.collect()}
    assert base == direct


def test_tuning_picks_lowest_rmse(spark):
    p = ml.feature_stages().fit(_panel(spark)).transform(_panel(spark)) \
        .withColumn("label", F.col("Avg_kWh"))
    _, table = ml.tune(p, ml.forest(seed=3), num_trees=[5, 10], max_depth=[1, 3], folds=2)
    rows = table.collect()
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].avg_metric == min(r.avg_metric for r in rows)


def test_pivot_inverts_unpivot(spark):
    p = _panel(spark)
    wide = sc.scenario_wide(p, sc.linear_scorer())
    back = sc.pivot_scenarios(sc.scenario_long(wide))
    cols = ["State", "Year"] + sc.prediction_columns()
    assert sorted(map(tuple, back.select(cols).collect())) == \
        sorted(map(tuple, wide.select(cols).collect()))


def test_saved_models_load_and_score_the_same(spark, scratch):
    p = _panel(spark)
    stages = ml.feature_stages().fit(p)
    enc = stages.transform(p).withColumn("label", F.col("Avg_kWh"))
    m = ml.forest(num_trees=5, max_depth=3, seed=2).fit(enc)
    sp, mp = scratch("stages"), scratch("forest")
    stages.write().overwrite().save(sp)
    m.write().overwrite().save(mp)
    again = ml.load_forest(mp).transform(ml.load_feature_stages(sp).transform(p))
    a = {(r.State, r.Year): r.prediction for r in m.transform(enc).collect()}
    b = {(r.State, r.Year): r.prediction for r in again.collect()}
    assert a == b


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables not present")
def test_model_queries_return_their_results(spark, monkeypatch):
    from panelkit.plans import catalog

    monkeypatch.setattr(catalog, "_TUNED", {})
    monkeypatch.setattr(ml, "tune", functools.partial(ml.tune, num_trees=[5, 8], max_depth=[2, 3], folds=2))
    got = {k: catalog.QUERIES[f"{k}_results"](spark, "/root/testdata/sf0.01").collect()
           for k in ("rf_train_score", "best_params", "feature_importance", "rf_counterfactual",
                     "run_log", "alt_learners")}
    t, m, _ = catalog.tuned(spark, "/root/testdata/sf0.01")
    want = {(r.State, r.Year): r.prediction for r in m.transform(t.filter("split = 'test'")).collect()}
    assert want and {(r.State, r.Year): r.prediction for r in got["rf_train_score"]} == \
        {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}
    best = [r for r in got["best_params"] if r.is_best]
    assert len(best) == 1 and best[0].avg_metric == min(r.avg_metric for r in got["best_params"])
    assert sum(r.importance for r in got["feature_importance"]) == pytest.approx(1, abs=1e-5)
    assert all(r[c] > 0 for r in got["rf_counterfactual"] for c in sc.prediction_columns())
    lines = [r.value for r in got["run_log"]]
    assert f"NumTrees: {best[0].numTrees}" in lines and f"MaxDepth: {best[0].maxDepth}" in lines
    assert len(lines) == 7
    for r in got["alt_learners"]:
        assert 0 < r.mae <= r.rmse and r.r2 <= 1
    forest = next(r for r in got["alt_learners"] if r.learner == "forest")
    assert forest.n == len(want)


def _training(spark, n=400):
    rng = random.Random(5)
    rows = [(f"s{i % 6}", 2000 + i, float(i % 9), rng.random(), 3.0 * (i % 6) + rng.random() + 0.2 * (i % 9))
            for i in range(n)]
    p = spark.createDataFrame(rows, "State string, Year int, DC_Opened double, PrevPrice double, label double")
    return ml.feature_stages().fit(p).transform(p)


def test_prefixes_of_a_forest(spark):
    """The whole prefix is the model itself; shorter and shallower ones are
    the means of its first trees, cut, followed by hand."""
    t = _training(spark).withColumn("fold", F.lit(0))
    m = ml.forest(num_trees=12, max_depth=6, seed=1).fit(t)
    nodes = forest_grid.node_table(m)
    got = forest_grid.prefix_predictions(t, nodes, ["State", "Year"], [1, 5, 12], [0, 1, 3, 6]).collect()
    assert len(got) == 400 * 12
    whole = {(r.State, r.Year): r.prediction for r in m.transform(t).collect()}
    tree = {(r.tree, r.id): r for r in nodes.collect()}
    assert any(r.categorical for r in tree.values()) and any(r.feature >= 0 and not r.categorical for r in tree.values())
    x = {(r.State, r.Year): r.features.toArray() for r in t.collect()}

    def follow(k, v, depth):
        node = tree[k, 0]
        while depth and node.feature >= 0:
            z = v[node.feature]
            left = z in node["values"] if node.categorical else z <= node["values"][0]
            node, depth = tree[k, node.left if left else node.right], depth - 1
        return node.prediction

    for r in got:
        key = (r.State, r.Year)
        if (r.numTrees, r.maxDepth) == (12, 6):
            assert r.prediction == pytest.approx(whole[key], rel=1e-12)
        want = sum(follow(k, x[key], r.maxDepth) for k in range(r.numTrees)) / r.numTrees
        assert r.prediction == pytest.approx(want, rel=1e-12)


def test_cut_forest_equals_a_shallow_fit(spark):
    """Same trees, same draws: a forest fitted at the smaller depth agrees on the first levels."""
    t = _training(spark).withColumn("fold", F.lit(0))
    deep, flat = (ml.forest(num_trees=8, max_depth=d, seed=3).fit(t) for d in (5, 1))
    cut = forest_grid.prefix_predictions(t, forest_grid.node_table(deep), ["State", "Year"], [8], [1])
    want = {(r.State, r.Year): r.prediction for r in flat.transform(t).collect()}
    assert {(r.State, r.Year): pytest.approx(r.prediction) for r in cut.collect()} == want


def test_nested_grid_fits_once_a_fold(spark, monkeypatch):
    t = _training(spark)
    fits = []
    fit = RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, *a: fits.append(self) or fit(self, *a))
    m, table = ml.tune(t, ml.forest(seed=3), num_trees=[3, 6, 9], max_depth=[1, 2, 4], folds=4)
    rows = table.collect()
    assert len(fits) == 5 and len(rows) == 9
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].avg_metric == min(r.avg_metric for r in rows)
    assert (m.getNumTrees, m.getOrDefault("maxDepth")) == (best[0].numTrees, best[0].maxDepth)
    # the largest point is its own fit: equal to fitting it separately
    _, apart = ml.tune(t, ml.forest(seed=3), num_trees=[9], max_depth=[4], folds=4, nested=False)
    assert apart.first().avg_metric == pytest.approx(
        next(r.avg_metric for r in rows if (r.numTrees, r.maxDepth) == (9, 4)), rel=1e-9)
    # the others differ by their draws only
    _, others = ml.tune(t, ml.forest(seed=3), num_trees=[3, 6, 9], max_depth=[1, 2, 4], folds=4, nested=False)
    near = {(r.numTrees, r.maxDepth): r.avg_metric for r in others.collect()}
    for r in rows:
        assert r.avg_metric == pytest.approx(near[r.numTrees, r.maxDepth], rel=0.35)


@pytest.mark.parametrize("metric", ["rmse", "mse", "mae", "r2"])
def test_nested_metrics_equal_the_evaluator(spark, metric):
    t = _training(spark, 80).withColumn("_fold", (F.col("Year") % 2).cast("int"))
    est = ml.forest(num_trees=4, max_depth=3, seed=1)
    got = forest_grid.nested_grid(t, est, num_trees=[4], max_depth=[3], keys=["State", "Year"], metric=metric).first()
    ev = RegressionEvaluator(metricName=metric)
    want = [ev.evaluate(est.fit(t.filter(f"_fold <> {k}")).transform(t.filter(f"_fold = {k}"))) for k in (0, 1)]
    assert got.avg_metric == pytest.approx(sum(want) / 2, rel=1e-9)

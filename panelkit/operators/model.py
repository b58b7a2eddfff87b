"""Spark ML operators.

The feature table is a panel of ``states x years`` rows whatever the size of
the raw data, so the learners train on a small table; it is checkpointed
once (to the shared checkpoint folder) before tuning so the 4-fold grid does
not re-run the upstream line-item aggregation for every fit, and so a lost
executor cannot force a recomputation of it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (GBTRegressor, LinearRegression, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window, functions as F

from panelkit import schemas as S
from panelkit.functions.exprs import hash_bucket
from panelkit.operators.forest_grid import nested_grid
from panelkit.session import materialize


def state_indexer(key: str = "State", out: str = "StateIndex") -> StringIndexer:
    """M1: most frequent first, ties alphabetical; unseen values kept in an
    extra last index.  Fitting brings the distinct labels (bounded by the
    number of states) to the driver."""
    return StringIndexer(inputCol=key, outputCol=out, handleInvalid="keep",
                         stringOrderType="frequencyDesc")


def state_encoder(index: str = "StateIndex", out: str = "StateVec") -> OneHotEncoder:
    """M2: one-hot with the last slot dropped (the unseen bucket)."""
    return OneHotEncoder(inputCol=index, outputCol=out, dropLast=True)


def assembler(inputs: Sequence[str] = S.FEATURE_INPUTS, out: str = "features") -> VectorAssembler:
    """M3: (DC_Opened, PrevPrice, StateVec) -> one vector."""
    return VectorAssembler(inputCols=list(inputs), outputCol=out)


def feature_stages(key: str = "State") -> Pipeline:
    return Pipeline(stages=[state_indexer(key), state_encoder(), assembler()])


def sparse_slots(df: DataFrame, vector: str, keep: Sequence[str], *, slot: str = "slot",
                 value: str = "value") -> DataFrame:
    """Vector column -> one row per non-zero slot (for inspection / SQL checks)."""
    return (df.select(*keep, F.posexplode(vector_to_array(vector)).alias(slot, value))
            .filter(F.col(value) != 0))


def hash_split(df: DataFrame, keys: Sequence[str], *, train_pct: int = round(S.TRAIN_FRACTION * 100),
               out: str = "split") -> DataFrame:
    """M4: deterministic train / test label from md5 of the row key; it does
    not depend on partitioning or row order, unlike ``randomSplit``."""
    b = hash_bucket(*keys, buckets=100)
    return df.withColumn("bucket", b).withColumn(
        out, F.when(F.col("bucket") < train_pct, "train").otherwise("test"))


def random_split(df: DataFrame, *, train: float = S.TRAIN_FRACTION,
                 seed: int = S.SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """M4 option: ``randomSplit`` with the original seed; the parts depend on
    the partitioning of ``df``, so write it first if they must agree."""
    a, b = df.randomSplit([train, 1 - train], seed)
    return a, b


def forest(*, num_trees: int = 20, max_depth: int = 5, seed: int = 42,
           features: str = "features", label: str = "label") -> RandomForestRegressor:
    """M5: random forest with the original leaf and sampling settings; the
    seed is always explicit (PySpark's default differs per process)."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees,
                                 maxDepth=max_depth, seed=seed,
                                 minInstancesPerNode=S.FOREST_MIN_INSTANCES_PER_NODE,
                                 subsamplingRate=S.FOREST_SUBSAMPLING_RATE)


def other_learner(kind: str, *, features: str = "features", label: str = "label", seed: int = 42):
    """The alternative learners behind the same fit call."""
    if kind == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, maxDepth=3, maxIter=20, seed=seed)
    if kind == "linear":
        return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0)
    raise ValueError(kind)


def tune(train: DataFrame, estimator, *, num_trees: Sequence[int] = S.GRID_NUM_TREES,
         max_depth: Sequence[int] = S.GRID_MAX_DEPTH, folds: int = S.CV_FOLDS,
         parallelism: int | None = None, seed: int = 42, metric: str = "rmse",
         keys: Sequence[str] = ("State", "Year"), nested: bool = True):
    """M6 + M7: grid x k-fold cross validation; returns (model, table of
    params and mean metric with the best row flagged).

    ``nested`` fits one forest per fold and reads every grid point off its
    prefixes (:mod:`panelkit.operators.forest_grid`, which states how this
    differs); otherwise every point is fitted by itself in every fold.  Either
    way the best point is fitted once more on all rows.

    The best row is chosen by the evaluator's direction (lowest RMSE), not by
    the largest metric.  Folds are dealt in hash order of ``keys``, so they
    are equal in size, never empty and the same on every run; a table of
    fewer rows than folds gets one row a fold.  The table is a panel (states
    x years rows), small enough for one window.
    """
    folds = max(2, min(folds, train.count()))
    order = Window.orderBy(F.xxhash64(F.lit(seed), *keys), *keys)
    train = train.withColumn("_fold", ((F.row_number().over(order) - 1) % folds).cast("int"))
    ev = RegressionEvaluator(labelCol=estimator.getLabelCol(),
                             predictionCol=estimator.getPredictionCol(), metricName=metric)
    if nested:
        train = materialize(train, "folds")
        points = nested_grid(train, estimator, num_trees=num_trees, max_depth=max_depth, keys=keys, metric=metric)
        rows = {(r.numTrees, r.maxDepth): r.avg_metric for r in points.collect()}  # the grid
        pick = max if ev.isLargerBetter() else min
        best = pick(((n, d) for n in num_trees for d in max_depth), key=rows.get)
        model = estimator.copy({estimator.numTrees: best[0], estimator.maxDepth: best[1]}).fit(train)
        return model, train.sparkSession.createDataFrame(
            [(n, d, float(m), (n, d) == best) for (n, d), m in sorted(rows.items())],
            "numTrees int, maxDepth int, avg_metric double, is_best boolean")
    if parallelism is None:  # one fit per core at a time
        parallelism = train.sparkSession.sparkContext.defaultParallelism
    grid = (ParamGridBuilder().addGrid(estimator.numTrees, list(num_trees))
            .addGrid(estimator.maxDepth, list(max_depth)).build())
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev,
                        numFolds=folds, foldCol="_fold", parallelism=parallelism, seed=seed)
    cvm = cv.fit(train)
    pick = min if not ev.isLargerBetter() else max
    best = pick(range(len(grid)), key=lambda i: cvm.avgMetrics[i])
    rows = [(int(pm[estimator.numTrees]), int(pm[estimator.maxDepth]), float(m), i == best)
            for i, (pm, m) in enumerate(zip(grid, cvm.avgMetrics))]
    table = train.sparkSession.createDataFrame(
        rows, "numTrees int, maxDepth int, avg_metric double, is_best boolean")
    return cvm.bestModel, table


def grouped_importances(model: RandomForestRegressionModel, scored: DataFrame,
                        features: str = "features") -> list[tuple[str, float]]:
    """M9: importances summed per assembler input (all one-hot slots of the
    state count towards the state), using the vector's attribute metadata."""
    imp = model.featureImportances.toArray()
    meta = scored.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    totals: dict[str, float] = {}
    for i, v in enumerate(imp):
        n = names.get(i, f"f{i}")
        base = next((x for x in S.FEATURE_INPUTS if n == x or n.startswith(x + "_")), n)
        totals[base] = totals.get(base, 0.0) + float(v)
    return sorted(totals.items())


def regression_metrics(df: DataFrame, *, label: str = "label", prediction: str = "prediction",
                       household_kwh: int = S.HOUSEHOLD_KWH) -> DataFrame:
    """M8 + X2 + X3 in one aggregate: rmse, mae, r2 (1 - SSE / SST), RMSE as
    a share of the mean label, and the yearly error for a household."""
    err = F.col(prediction) - F.col(label)
    agg = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(label).alias("_var"),
        F.avg(label).alias("mean_label"))
    return agg.select(
        "n", "rmse", "mae",
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_var"))).alias("r2"),
        F.try_divide(F.col("rmse"), F.col("mean_label")).alias("rmse_share_of_mean"),
        (F.col("rmse") * household_kwh).alias("household_error"),
        "mean_label")


def _poisson_steps(limit: int = 12) -> list[int]:
    """Where a uniform 32-bit draw passes from one Poisson(1) count to the next."""
    return [round(math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) * (1 << 32)) for k in range(limit)]


def bootstrap_metrics(df: DataFrame, keys: Sequence[str], *, label: str = "label", prediction: str = "prediction",
                      replicates: int = 40) -> DataFrame:
    """M8 + X3 once per bootstrap replicate: ``replicate, n, rmse, mae, r2,
    rmse_share_of_mean``.

    A row counts Poisson(1) times in a replicate.  The count is drawn from md5 of
    its ``keys`` and the replicate, so reruns agree, whatever the partitions, and
    the rows never move: each task reduces its rows to one line a replicate.
    Rows with a NULL label or prediction are left out; rows of equal keys (null
    keys are text ``-``) share their draws.
    """
    key = F.concat_ws("#", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in keys])
    err = F.col(prediction) - F.col(label)
    rows = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()).select(
        key.alias("_k"), F.col(label).cast("double").alias("_y"), err.cast("double").alias("_e"))
    # four draws of 32 bits from each digest
    rows = rows.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // 4))))
    rows = rows.withColumn("_m", F.md5(F.concat_ws("#", "_k", F.col("_b").cast("string"))))
    rows = rows.withColumn("_j", F.explode(F.array(*[F.lit(j) for j in range(4)])))
    rows = rows.withColumn("_u", F.conv(F.substring("_m", F.col("_j") * 8 + 1, F.lit(8)), 16, 10).cast("bigint"))
    w = F.lit(0)
    for step in _poisson_steps():
        w = w + (F.col("_u") >= step).cast("int")
    rows = rows.select((F.col("_b") * 4 + F.col("_j")).alias("replicate"), w.alias("w"), "_y", "_e")
    sums = rows.filter(F.col("replicate") < replicates).groupBy("replicate").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col("_e") * F.col("_e")).alias("sse"),
        F.sum(F.col("w") * F.abs("_e")).alias("sae"), F.sum(F.col("w") * F.col("_y")).alias("sy"),
        F.sum(F.col("w") * F.col("_y") * F.col("_y")).alias("syy"))
    mean = lambda c: F.try_divide(F.col(c), F.col("n"))
    return sums.select(
        "replicate", "n", F.sqrt(mean("sse")).alias("rmse"), mean("sae").alias("mae"),
        (1 - F.try_divide(F.col("sse"), F.col("syy") - F.col("sy") * mean("sy"))).alias("r2"),
        F.try_divide(F.sqrt(mean("sse")), mean("sy")).alias("rmse_share_of_mean"))


INTERVAL_METRICS = ("rmse", "mae", "r2", "rmse_share_of_mean")


def error_intervals(df: DataFrame, keys: Sequence[str], *, label: str = "label", prediction: str = "prediction",
                    replicates: int = 200, level: float = 0.95) -> DataFrame:
    """``metric, value, low, high``: each error figure with the percentile
    interval of its bootstrap replicates."""
    reps = bootstrap_metrics(df, keys, label=label, prediction=prediction, replicates=replicates)
    point = regression_metrics(df, label=label, prediction=prediction)
    long = lambda d: d.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in INTERVAL_METRICS])).alias("m")).select("m.*")
    cut = (1 - level) / 2
    spans = long(reps).groupBy("metric").agg(F.percentile("value", F.lit(cut)).alias("low"),
                                             F.percentile("value", F.lit(1 - cut)).alias("high"))
    return long(point).join(spans, "metric")


def load_feature_stages(path: str) -> PipelineModel:
    """Saved feature stages (indexer, encoder, assembler)."""
    return PipelineModel.load(path)


def load_forest(path: str) -> RandomForestRegressionModel:
    """Saved forest."""
    return RandomForestRegressionModel.load(path)

"""Nested-grid tuning of a forest (M6, M7, A13): one fit per fold.

A forest of ``n`` trees is the first ``n`` trees of a larger one, and a tree
of depth ``d`` is a deeper one cut at level ``d`` (an inner node holds the
mean label of its rows, which is what a leaf there would predict).  So one
forest with the most trees and the largest depth per fold holds every point
of the grid as a prefix: its node table is walked level by level, as joins,
and the predictions of all grid points come out of one aggregate per row.

Against separate fits the points of a fold share their bootstrap samples and
feature subsets (a separate fit draws its own for each number of trees), so
metrics differ in the noise of one draw; points are compared on equal draws.
A one-tree forest under the "auto" feature strategy is no prefix: Spark gives
it all features at every node.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.session import materialize, scratch_path

#: Node tables up to this many rows (some 60 bytes each) go to every task.
BROADCAST_NODES = 1 << 20

_NODE = ("prediction", "left", "right", "feature", "values", "categorical")

_METRICS = {
    "rmse": lambda e, y: F.sqrt(F.avg(e * e)),
    "mse": lambda e, y: F.avg(e * e),
    "mae": lambda e, y: F.avg(F.abs(e)),
    "r2": lambda e, y: F.lit(1.0) - F.try_divide(F.avg(e * e), F.var_pop(y)),
}


def node_table(model, fold: int = 0) -> DataFrame:
    """``fold, tree, id, prediction, left, right, feature, values, categorical``
    of every node of a fitted forest (leaves: ``feature`` -1; ids per tree, the
    root is 0), read back from the saved model."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "forest_nodes")
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.lit(fold).alias("fold"), F.col("treeID").alias("tree"), n["id"].alias("id"),
        n["prediction"].alias("prediction"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), n["split"]["leftCategoriesOrThreshold"].alias("values"),
        (n["split"]["numCategories"] >= 0).alias("categorical"))


def walk(rows: DataFrame, nodes: DataFrame, depths: Sequence[int], features: str = "features") -> DataFrame:
    """Every row with every tree of its fold: ``tree`` and, for each of
    ``depths``, the prediction ``at<d>`` of the tree cut there.

    ``rows`` has ``fold`` and a vector column.  Each level is one join on
    (fold, tree, node); a row that reached a leaf stays at it.
    """
    if nodes.count() <= BROADCAST_NODES:  # beyond, the join is left to the optimizer
        nodes = F.broadcast(nodes)
    state = (rows.withColumn("_x", vector_to_array(features))
             .join(nodes.filter("id = 0"), "fold"))
    table = nodes.select(*[F.col(c).alias(f"_{c}") for c in ("fold", "tree", "id", *_NODE)])
    wanted = set(depths)
    if 0 in wanted:
        state = state.withColumn("at0", F.col("prediction"))
    for level in range(1, max(depths, default=0) + 1):
        x = F.get("_x", F.col("feature"))
        goes_left = F.when(F.col("categorical"), F.array_contains("values", x)).otherwise(x <= F.get("values", F.lit(0)))
        state = state.withColumn("_next", F.when(F.col("feature") < 0, F.col("id"))
                                 .when(goes_left, F.col("left")).otherwise(F.col("right")))
        kept = [c for c in state.columns if c not in ("id", "_next", *_NODE)]
        state = (state.join(table, (F.col("fold") == F.col("_fold")) & (F.col("tree") == F.col("_tree"))
                            & (F.col("_next") == F.col("_id")))
                 .select(*kept, F.col("_id").alias("id"), *[F.col(f"_{c}").alias(c) for c in _NODE]))
        if level in wanted:
            state = state.withColumn(f"at{level}", F.col("prediction"))
    return state.drop("_x", "id", *_NODE)


def prefix_predictions(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], num_trees: Sequence[int],
                       max_depth: Sequence[int], features: str = "features", label: str = "label") -> DataFrame:
    """``fold, keys, label, numTrees, maxDepth, prediction``: every grid point
    of every row, from one walk."""
    walked = walk(rows.select("fold", *keys, label, features), nodes, max_depth, features)
    points = [(n, d) for n in num_trees for d in max_depth]
    sums = [F.sum(F.when(F.col("tree") < n, F.col(f"at{d}"))).alias(f"_{n}_{d}") for n, d in points]
    wide = walked.groupBy("fold", *keys, label).agg(*sums)
    long = F.array(*[F.struct(F.lit(n).alias("numTrees"), F.lit(d).alias("maxDepth"),
                              (F.col(f"_{n}_{d}") / n).alias("prediction")) for n, d in points])
    return wide.select("fold", *keys, label, F.explode(long).alias("p")).select("fold", *keys, label, "p.*")


def nested_grid(train: DataFrame, estimator, *, num_trees: Sequence[int], max_depth: Sequence[int],
                keys: Sequence[str], fold: str = "_fold", metric: str = "rmse") -> DataFrame:
    """Mean metric over the folds of every grid point: ``numTrees, maxDepth,
    avg_metric``.  ``train`` has a fold number (0, 1, ...); fits run side by side."""
    largest = {estimator.numTrees: max(num_trees), estimator.maxDepth: max(max_depth)}
    folds = sorted(r[0] for r in train.select(fold).distinct().collect())  # a handful

    def fit(k):
        return estimator.copy(largest).fit(train.filter(F.col(fold) != k))

    with ThreadPoolExecutor(max_workers=len(folds)) as pool:
        models = list(pool.map(fit, folds))
    nodes = None
    for k, m in zip(folds, models):
        nodes = node_table(m, k) if nodes is None else nodes.unionByName(node_table(m, k))
    label = estimator.getLabelCol()
    predicted = prefix_predictions(train.withColumn("fold", F.col(fold)), materialize(nodes, "nodes"), keys,
                                   num_trees, max_depth, estimator.getFeaturesCol(), label)
    measure = _METRICS[metric](F.col("prediction") - F.col(label), F.col(label))
    return (predicted.groupBy("fold", "numTrees", "maxDepth").agg(measure.alias("metric"))
            .groupBy("numTrees", "maxDepth").agg(F.avg("metric").alias("avg_metric")))

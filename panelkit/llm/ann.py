"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted in one task on a sample bounded by rows and bytes: each node splits its points at the
median of their projections on the line between two local centres.  Every row
is then placed in one leaf of each tree.  A query walks all trees through one
priority queue, ordered by how far it lies on the wrong side of the planes on
the way, and visits a fixed number of leaves; the rows of those leaves are
ranked by exact cosine.  The number of leaves is the smallest that reaches
``recall`` on held queries within the sample, by brute force.

The rows of a leaf and the queries that visit it are counted first; a leaf
with many of either is dealt into blocks by its own counts, and each pair of
blocks is one small matrix product, which returns keys and exact scores only.
A leaf that nobody visits is not shuffled.  Equal vectors are indexed once with their smallest keys, which is
all that a top-k list can use of them.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelkit.llm.common import bounded_sample, text_batches
from panelkit.llm.vectors import packed, unit, unpack, usable
from panelkit.session import materialize


@dataclass
class Forest:
    """``depth`` levels of planes per tree, in heap order; leaf ``i`` of a
    tree is node ``2 ** depth - 1 + i``."""

    normals: np.ndarray  # (trees, 2**depth - 1, dim)
    offsets: np.ndarray
    depth: int
    visits: int = 0

    def leaves(self, units: np.ndarray) -> np.ndarray:
        """(rows, trees) leaf numbers."""
        out = np.empty((len(units), len(self.normals)), np.int64)
        for t in range(len(self.normals)):
            node = np.zeros(len(units), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", units, self.normals[t][node]) > self.offsets[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2 ** self.depth - 1)
        return out

    def search(self, q: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """The first ``visits`` (tree, leaf) in order of the worst margin."""
        first = 2 ** self.depth - 1
        margin = [(n @ q - o).tolist() for n, o in zip(self.normals, self.offsets)]
        queue = [(-np.inf, t, 0) for t in range(len(margin))]
        found = []
        while queue and len(found) < visits:
            m, t, node = heapq.heappop(queue)
            while node < first:
                v = margin[t][node]
                near, far = (2 * node + 2, 2 * node + 1) if v > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(m, abs(v)), t, far))
                node = near  # the near side costs nothing more
            found.append((t, node - first))
        return found


def grow(units: np.ndarray, depth: int, trees: int, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    nodes = 2 ** depth - 1
    normals = np.zeros((trees, nodes, units.shape[1]))
    offsets = np.zeros((trees, nodes))
    for t in range(trees):
        parts = {0: np.arange(len(units))}
        for node in range(nodes):
            m = parts.pop(node)
            s = units[rng.choice(m, min(len(m), 64), replace=False)] if len(m) > 1 else units[:0]
            n = rng.normal(size=units.shape[1])
            if len(s) > 1:
                a, b = s[0], s[-1]
                for _ in range(4):
                    near = s @ a > s @ b
                    if near.all() or not near.any():
                        break
                    a, b = s[near].mean(axis=0), s[~near].mean(axis=0)
                if np.linalg.norm(a - b) > 1e-12:
                    n = a - b
            n /= np.linalg.norm(n)
            p = units[m] @ n
            normals[t, node], offsets[t, node] = n, np.median(p) if len(p) else 0.0
            side = p > offsets[t, node]
            parts[2 * node + 1], parts[2 * node + 2] = m[~side], m[side]
    return Forest(normals, offsets, depth)


def calibrate(forest: Forest, units: np.ndarray, k: int, recall: float, held: int = 128) -> int:
    """Leaves to visit so that ``recall`` of the true ``k`` nearest of held
    sample points lie in them (brute force within the sample)."""
    total = len(forest.normals) << forest.depth
    if forest.depth == 0 or len(units) < 3:
        return total
    place = forest.leaves(units)
    ranks = []
    for i in np.linspace(0, len(units) - 1, min(held, len(units))).astype(int):
        s = units @ units[i]
        s[i] = -2
        order = {leaf: r for r, leaf in enumerate(forest.search(units[i], total))}
        for j in np.argpartition(-s, min(k, len(s) - 1) - 1)[:k]:
            ranks.append(min(order[(t, x)] for t, x in enumerate(place[j].tolist())))
    return int(np.quantile(ranks, recall)) + 1


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
            trees: int = 8, leaf_rows: int = 512, max_sample: int = 65_536, sample_bytes: int = 64 << 20,
            recall: float = 0.98, block: int = 4096) -> DataFrame:
    """The ``k`` nearest of ``vectors`` by cosine for each row of ``queries``.

    Returns ``query_id, rank, vec_id, score``; a vector is no neighbour of
    the query of the same key; ties go to the smaller key; fewer than ``k``
    candidates: all of them.  Vectors that are null, empty, zero or hold null
    or non-finite components take no part, nor do rows with a null key.
    Neighbours have the length of the query; each length has its own forest.  Repeated (key, vector)
    rows count once; a query key with several vectors is several queries whose
    best ``k`` are merged.  An empty table gives an empty result.
    """
    result = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    classes = materialize(
        packed(vectors.filter(F.col(key).isNotNull()), key, vector, keep=k + 1)
        .groupBy("raw").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
                            .alias("ids")), "classes")
    widths = sorted(r[0] for r in classes.select(F.octet_length("raw")).distinct().collect())
    if not widths:
        return spark.createDataFrame([], result)

    def pack_query(batches):
        for _, ids, vs in text_batches(batches, "id", "v"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.array([(np.array(v, "<f8") + 0.0).tobytes() for v in vs], pa.binary())], names=["id", "raw"])

    asked = materialize(
        queries.filter(usable(vector) & F.col(key).isNotNull())
        .select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .mapInArrow(pack_query, "id long, raw binary").distinct(), "queries")
    scored = None
    for width in widths:  # few: a length is a kind of embedding
        same = F.octet_length("raw") == width
        part = _scored(classes.filter(same), asked.filter(same), width, k, trees, leaf_rows, max_sample, sample_bytes,
                       recall, block)
        scored = part if scored is None else scored.union(part)
    # at most visits * k rows a query
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _fit(classes: DataFrame, n: int, dim: int, k: int, trees: int, leaf_rows: int, max_sample: int,
         sample_bytes: int, recall: float) -> Forest:
    """The forest of ``n`` packed vectors, grown and calibrated in one task on a
    sample bounded by rows and bytes.  Its planes, one row a tree, are no more
    bytes than the sample's."""
    most = max(8, min(max_sample, sample_bytes // (8 * dim)))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        sample = unit(unpack(sorted(map(bytes, pdf["raw"])), dim))
        depth = max(0, min(int(np.ceil(np.log2(n / leaf_rows))) if n > leaf_rows else 0,
                           int(np.log2(max(1, len(sample) / 8)))))
        f = grow(sample, depth, trees if depth else 1)
        f.visits = calibrate(f, sample, k, recall)
        return pd.DataFrame({"tree": range(len(f.normals)), "depth": depth, "visits": f.visits,
                             "normals": [m.tobytes() for m in f.normals],
                             "offsets": [o.tobytes() for o in f.offsets]})

    grown = (bounded_sample(classes, "raw", most).select("raw").withColumn("_one", F.lit(0)).groupBy("_one")
             .applyInPandas(fit, "tree int, depth int, visits int, normals binary, offsets binary")
             .orderBy("tree").collect())
    if not grown:  # the hash sample of a few vectors may be empty
        return Forest(np.zeros((1, 0, dim)), np.zeros((1, 0)), 0, 1)
    return Forest(np.stack([np.frombuffer(r.normals, "<f8").reshape(-1, dim) for r in grown]),
                  np.stack([np.frombuffer(r.offsets, "<f8") for r in grown]), grown[0].depth, grown[0].visits)


def _leaf_loads(placed: DataFrame, asked: DataFrame, block: int) -> DataFrame:
    """``_cell, _ibs, _qbs``: the visited leaves, and into how many blocks their
    rows and their visitors are dealt.  At most one row a leaf of the forest."""
    rows = placed.select(F.explode("cells").alias("_cell")).groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows"))
    visitors = asked.select(F.explode("cells").alias("_cell")).groupBy("_cell").agg(F.count(F.lit(1)).alias("_asking"))
    blocks = lambda c: F.ceil(F.col(c) / block).cast("long")
    return materialize(rows.join(visitors, "_cell").select("_cell", blocks("_rows").alias("_ibs"),
                                                           blocks("_asking").alias("_qbs")), "leaf_loads")


def _scored(classes: DataFrame, asked: DataFrame, width: int, k: int, trees: int, leaf_rows: int,
            max_sample: int, sample_bytes: int, recall: float, block: int) -> DataFrame:
    """``query_id, vec_id, score`` of the rows near each query, among packed
    vectors of ``width`` bytes."""
    dim = width // 8
    forest = _fit(classes, classes.count(), dim, k, trees, leaf_rows, max_sample, sample_bytes, recall)

    def place(batches):
        f = forest  # no larger than the sample; travels with the code
        for _, raw, ids in text_batches(batches, "raw", "ids"):
            if not raw:
                continue
            cells = f.leaves(unit(unpack(raw, dim))) + (np.arange(len(f.normals)) << f.depth)
            yield pa.RecordBatch.from_arrays(
                [pa.array(raw, pa.binary()), pa.array(ids, pa.list_(pa.int64())),
                 pa.array(list(cells), pa.list_(pa.int64()))], names=["raw", "ids", "cells"])

    def visit(batches):
        f = forest
        for _, raw, ids in text_batches(batches, "raw", "id"):
            cells = [[(t << f.depth) + x for t, x in f.search(unit(unpack([r], dim))[0], f.visits)] for r in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array(raw, pa.binary()), pa.array(ids, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                names=["raw", "id", "cells"])

    placed = materialize(classes.mapInArrow(place, "raw binary, ids array<long>, cells array<long>"), "placed")
    asking = materialize(asked.mapInArrow(visit, "raw binary, id long, cells array<long>"), "asking")
    # one row a leaf: at most trees * 2**depth, which the sample bounds
    loads = F.broadcast(_leaf_loads(placed, asking, block))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    cells = (placed.withColumn("_cell", F.explode("cells")).join(loads, "_cell")  # leaves without visitors fall away
             .select("_cell", "raw", "ids", F.pmod(F.xxhash64("raw"), F.col("_ibs")).alias("_ib"), upto("_qbs").alias("_qb")))
    visits = (asking.withColumn("_cell", F.explode("cells")).join(loads, "_cell")
              .select("_cell", "raw", "id", F.pmod(F.xxhash64("id"), F.col("_qbs")).alias("_qb"), upto("_ibs").alias("_ib")))
    keys = ["_cell", "_ib", "_qb"]

    def rank(cell: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(cell) and len(asks):
            base, ids = unpack(cell["raw"], dim), cell["ids"].tolist()
            of, units = unpack(asks["raw"], dim), unit(base)
            most = min(k + 1, len(base))
            for lo in range(0, len(of), 512):
                part = of[lo:lo + 512]
                at = []
                for i, (q, s) in enumerate(zip(asks["id"].iloc[lo:lo + 512], unit(part) @ units.T)):
                    # every class that ties with the (k+1)-th best stays in
                    edge = np.partition(s, len(s) - most)[len(s) - most]
                    found = [(-s[j], d, j) for j in np.flatnonzero(s >= edge) for d in ids[j] if d != q]
                    at += [(i, q, d, j) for _, d, j in heapq.nsmallest(k, found)]
                if at:
                    i, q, d, j = zip(*at)
                    out.append(pd.DataFrame({"query_id": q, "vec_id": d,
                                             "score": _cosines(part[list(i)], base[list(j)])}))
        return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "vec_id", "score"])

    return cells.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInPandas(
        rank, "query_id long, vec_id long, score double")


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` and that of ``y``, summed in component
    order: the same for a pair wherever it is met."""
    dot, xx, yy = (np.cumsum(m, axis=1)[:, -1] for m in (x * y, x * x, y * y))
    both = xx * yy
    length = np.where(np.isfinite(both) & (both > 0), np.sqrt(both), np.sqrt(xx) * np.sqrt(yy))
    return np.clip(dot / length, -1.0, 1.0)

"""Hard negatives by anchor spanning-tree bounds.

Scores are inner products of integer vectors (``floor(scale * x)``).  Anchors
are dealt into slabs of about ``slab`` near ones (signs of random projections,
then hash), and each slab gets a minimum spanning tree under Euclidean
distance.  Rows travel as blocks; a task meets a block with a slab and walks
the tree from its root, which is scored against the whole block.  For a child
``c`` of ``p`` and a row ``x``

    | <c, x> - <p, x> |  <=  |c - p| * |x|,

so the parent's scores (or bounds) plus or minus edge length times row norm
bound the child's, and only rows whose bounds overlap what the child still
looks for are scored anew, exactly:

* positives: rows of the anchor's label, from its ``positives``-th best on;
* negatives: rows of other labels within ``[low * s, s]`` of the score ``s``
  of a positive, from the ``negatives``-th best of that window on.

The best so far are kept over all blocks of a task and merged by rank after.
Slabs go to every task in passes of at most about ``pass_bytes`` together;
rows are never shuffled, and no step sees all anchors or all rows in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelkit.llm.common import map_batches, text_batches
from panelkit.session import materialize

#: Rows whose integer vector has this squared length or more take no part:
#: their scores need not fit a long.
TOO_LONG = float(1 << 62)
EXACT = float(1 << 53)  # doubles hold all integers below

_BLOCK = "dim int, ids array<long>, labels array<string>, raw binary"


def _eligible(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(
        F.col(key).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
        v.cast("array<double>").alias("v"))


def _integers(batch, scale: float):
    """(dim, positions, integer matrix) of the rows of a batch, by length."""
    vs = batch.column(batch.schema.get_field_index("v"))
    flat = np.asarray(vs.flatten(), dtype="<f8")
    ends = np.asarray(vs.offsets) - vs.offsets[0].as_py()
    sizes = np.diff(ends)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        with np.errstate(over="ignore"):
            m = np.floor(scale * flat[ends[at][:, None] + np.arange(dim)])
            fits = (m * m).sum(axis=1) < TOO_LONG
        if fits.any():
            yield int(dim), at[fits], m[fits].astype("<i8")


def _blocks(rows: DataFrame, scale: float, size: int) -> DataFrame:
    """Rows packed into blocks of at most ``size`` of one length."""

    def run(batches):
        for batch, ids, labels in text_batches(batches, "id", "label"):
            for dim, at, m in _integers(batch, scale):
                for k in range(0, len(at), size):
                    part = at[k:k + size]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([[ids[i] for i in part]], pa.list_(pa.int64())),
                         pa.array([[labels[i] for i in part]], pa.list_(pa.string())),
                         pa.array([m[k:k + size].tobytes()], pa.binary())],
                        names=["dim", "ids", "labels", "raw"])

    return map_batches(rows, run, _BLOCK)


def spanning_tree(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows from the root (parents first), parent and distance of
    each (root: -1, 0) in the minimum spanning tree; the root is the row
    nearest the mean."""
    m = m.astype("<f8")
    n = len(m)
    root = int(((m - m.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order, parent, edge = [root], np.full(n, -1), np.zeros(n)
    near, best = np.full(n, root), ((m - m[root]) ** 2).sum(axis=1)
    best[root] = np.inf
    inside = np.zeros(n, bool)
    inside[root] = True
    for _ in range(n - 1):
        i = int(np.where(inside, np.inf, best).argmin())
        order.append(i)
        inside[i] = True
        parent[i], edge[i] = near[i], math.sqrt(best[i])
        d = ((m - m[i]) ** 2).sum(axis=1)
        closer = d < best
        near[closer], best[closer] = i, d[closer]
    return np.array(order), parent, edge


def _slabs(anchors: DataFrame, scale: float, slab: int) -> DataFrame:
    """One row per slab: anchors packed, their tree, and no wanted scores yet."""
    bits = max(0, math.ceil(math.log2(max(1, anchors.count()) / slab)))

    def code(batches):
        for batch, ids, labels in text_batches(batches, "id", "label"):
            for dim, at, m in _integers(batch, scale):
                planes = np.random.default_rng([29, dim]).normal(size=(dim, min(bits, 60)))
                cells = (m @ planes > 0) @ (np.int64(1) << np.arange(planes.shape[1], dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), dim), pa.int32()), pa.array(cells.astype("<i8")),
                     pa.array([ids[i] for i in at], pa.int64()), pa.array([labels[i] for i in at], pa.string()),
                     pa.array([r.tobytes() for r in m], pa.binary())], names=["dim", "cell", "id", "label", "raw"])

    rows = materialize(map_batches(anchors, code, "dim int, cell long, id long, label string, raw binary")
                       .dropDuplicates(["id", "label", "raw"]), "anchors")
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / slab).alias("parts"))
    dealt = rows.join(parts, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id", "raw"), F.col("parts")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "label", "raw"])
        m = np.frombuffer(b"".join(pdf["raw"]), "<i8").reshape(len(pdf), -1)
        order, parent, edge = spanning_tree(m)
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "a_ids": [pdf["id"].tolist()],
                             "a_labels": [pdf["label"].tolist()], "a_raw": [m.tobytes()],
                             "order": [order.tolist()], "parent": [parent.tolist()], "edge": [edge.tolist()]})

    schema = ("dim int, a_ids array<long>, a_labels array<string>, a_raw binary, order array<int>, "
              "parent array<int>, edge array<double>")
    trees = dealt.groupBy("dim", "cell", "part").applyInPandas(build, schema)
    return materialize(trees.withColumn("slab", F.monotonically_increasing_id()), "slabs")


class Best:
    """The ``k`` best (score, id) so far: higher scores first, then smaller ids."""

    def __init__(self, k: int, least: int | None = None):
        self.k, self.least = k, least
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> float:
        """Scores below cannot enter any more."""
        if len(self.scores) == self.k:
            return int(self.scores[-1])
        return -math.inf if self.least is None else self.least

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.floor
        if keep.any():
            s, i = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
            first = np.lexsort((i, -s))[:self.k]
            self.scores, self.ids = s[first], i[first]


class Slab:
    """Anchors of one slab with their tree and what each still looks for."""

    def __init__(self, row: dict, positives: int, negatives: int, low: tuple[int, int]):
        self.ids, self.labels = np.array(row["a_ids"], np.int64), row["a_labels"]
        self.m = np.frombuffer(row["a_raw"], "<i8").reshape(len(self.ids), -1)
        self.floats = self.m.astype("<f8")
        self.norm = math.sqrt((self.floats ** 2).sum(axis=1).max())
        self.order, self.parent, self.edge = row["order"], row["parent"], row["edge"]
        self.last = {}  # anchor -> place in the order of its last child
        for at, i in enumerate(self.order):
            self.last[self.parent[i]] = at
        self.seeking = row.get("wanted") is not None
        self.codes = {x: c for c, x in enumerate(dict.fromkeys(self.labels))}
        self.code = [self.codes[x] for x in self.labels]
        self.rescored = self.met = 0
        if self.seeking:  # windows below the score of each positive
            self.goals = [[(s, Best(negatives, -(-low[0] * s // low[1]))) for s in scores] for scores in row["wanted"]]
        else:
            self.goals = [[(None, Best(positives))] for _ in self.ids]

    def scan(self, ids: np.ndarray, labels: list, c: np.ndarray) -> None:
        """Meet one block of rows (integer matrix ``c``)."""
        floats = c.astype("<f8")
        norms = np.sqrt((floats ** 2).sum(axis=1)) * (1 + 1e-9)
        exact = norms.max() * self.norm < EXACT / 4
        rows, anchors = (floats, self.floats) if exact else (c, self.m)
        code = np.array([self.codes.get(x, -1) for x in labels])
        held = {}
        for at, i in enumerate(self.order):
            up = self.parent[i]
            if up < 0:
                picked = np.arange(len(ids))
                lo, hi = np.empty(len(ids)), np.empty(len(ids))
            else:
                slack = self.edge[i] * (1 + 1e-9) * norms + 1
                lo, hi = held[up][0] - slack, held[up][1] + slack
                picked = np.flatnonzero(self._overlaps(i, lo, hi, ids, code))
            if len(picked):
                part = rows if len(picked) == len(ids) else rows[picked]
                scores = part @ anchors[i]
                near = np.abs(scores) * 1e-12
                lo[picked], hi[picked] = scores - near, scores + near
                self._take(i, scores.astype(np.int64), ids[picked], code[picked])
            self.rescored += len(picked)
            if i in self.last:
                held[i] = (lo, hi)
            if up >= 0 and self.last[up] == at:
                del held[up]
        self.met += len(ids) * len(self.ids)

    def _overlaps(self, i, lo, hi, ids, code):
        if not self.seeking:
            return (code == self.code[i]) & (hi >= self.goals[i][0][1].floor) & (ids != self.ids[i])
        hit = np.zeros(len(ids), bool)
        for top, best in self.goals[i]:
            if best.floor <= top:
                hit |= (hi >= best.floor) & (lo <= top)
        return hit & (code != self.code[i])

    def _take(self, i, scores, ids, code):
        if not self.seeking:
            own = (code == self.code[i]) & (ids != self.ids[i])
            self.goals[i][0][1].offer(scores[own], ids[own])
            return
        other = code != self.code[i]
        for top, best in self.goals[i]:
            inside = other & (scores <= top)
            best.offer(scores[inside], ids[inside])

    def found(self):
        """(anchor, goal, score, id) of the best met."""
        for i, goals in enumerate(self.goals):
            for j, (_, best) in enumerate(goals):
                for s, d in zip(best.scores.tolist(), best.ids.tolist()):
                    yield i, j, s, d


_FOUND = "slab long, a int, goal int, score long, id long"


def _met(blocks: DataFrame, slabs: DataFrame, passes: int, make) -> DataFrame:
    """Best of every anchor and goal over each task's blocks."""

    def run(batches):
        slabs: dict[int, Slab] = {}
        for batch in batches:
            for row in batch.to_pylist():
                s = slabs.get(row["slab"])
                if s is None:
                    s = slabs[row["slab"]] = make(row)
                ids = np.array(row["ids"], np.int64)
                s.scan(ids, row["labels"], np.frombuffer(row["raw"], "<i8").reshape(len(ids), -1))
        out = [(n, *x) for n, s in slabs.items() for x in s.found()]
        cols = list(zip(*out)) or [()] * 5
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=["slab", "a", "goal", "score", "id"])

    whole = None
    for p in range(passes):
        now = slabs if passes == 1 else slabs.filter(F.pmod(F.xxhash64("slab"), F.lit(passes)) == p)
        part = map_batches(blocks.join(F.broadcast(now), "dim"), run, _FOUND)
        whole = part if whole is None else whole.union(part)
    return whole


def _ranked(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The ``k`` best of each key; a task gave at most ``k`` of them each."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                   label: str = "label", scale: float = 256.0, positives: int = 5, negatives: int = 5,
                   low: tuple[int, int] = (4, 5), slab: int = 1024, block: int = 2048,
                   pass_bytes: int = 64 << 20) -> DataFrame:
    """Negatives just below each positive of each anchor.

    ``anchors`` are rows of ``vectors`` (same columns).  Returns ``anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score``: for
    every anchor its ``positives`` best other rows of the same label, and for
    each of these the ``negatives`` best rows of other labels with
    ``low * positive_score <= negative_score <= positive_score``.  Higher
    scores come first, ties by smaller key.

    Rows with a null key or label, and vectors that are null, empty, hold null
    or non-finite components or are so long that scores leave 64 bits, take no
    part; vectors of different length never meet.  *Other* rows are those of
    another key.  Repeated rows count each as candidates (so a key may come
    twice in a result); a repeated anchor counts once.  Other columns are
    ignored; empty tables give an empty result.
    """
    blocks = _blocks(_eligible(vectors, key, vector, label), scale, block)
    slabs = _slabs(_eligible(anchors, key, vector, label), scale, slab)
    size = slabs.agg(F.sum(F.octet_length("a_raw") + F.size("a_ids") * 64)).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))

    def make(row):
        return Slab(row, positives, negatives, low)

    best = materialize(_ranked(_met(blocks, slabs, passes, make), positives, "slab", "a")
                       .select("slab", "a", (F.col("rank") - 1).alias("goal"), "score", "id"), "positives")
    # the scores of each anchor's positives, in the slab's order of anchors
    per = best.groupBy("slab", "a").agg(F.sort_array(F.collect_list(F.struct("goal", "score"))).alias("w")) \
        .groupBy("slab").agg(F.map_from_entries(F.collect_list(F.struct("a", F.col("w.score").alias("w")))).alias("w"))
    none = F.array().cast("array<long>")
    aims = slabs.join(per, "slab").withColumn("wanted", F.transform(
        F.sequence(F.lit(0), F.size("a_ids") - 1), lambda i: F.coalesce(F.try_element_at("w", i), none))).drop("w")
    worst = _ranked(_met(blocks, aims, passes, make), negatives, "slab", "a", "goal")
    who = slabs.select("slab", F.posexplode("a_ids").alias("a", "anchor_id"))
    named = best.join(who, ["slab", "a"]).select(
        "slab", "a", "goal", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (worst.join(named, ["slab", "a", "goal"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))

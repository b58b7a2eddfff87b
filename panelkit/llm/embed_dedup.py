"""Near-duplicate vectors by sorted projection passes.

A pass hashes each vector to bits (signs of random projections around a point
near the label's mean, another in each pass), orders the vectors of a label
lexicographically by the concatenated bits, and compares each with a bounded
window of neighbours in that order, as blocked matrix products.  Only unit
vectors in single precision travel; pairs that single precision cannot decide
are compared again on the vectors as they came.  Of the pairs of one block, as
many are kept as join its linked rows.  The links of all passes together are
closed to components.

Window and number of passes are measured for each label on all its rows, from
the codes alone: how many bits a row shares with those just outside its window,
so that whoever shares more is inside, and how likely a partner at the
threshold does.  Of the windows, the one that moves and compares least for the
wanted recall is taken; a label no larger than the largest window needs one
pass.  Every row is then measured in all the passes its label got: a pair of
which one row is sure enough to see its partners needs nothing more.  The rows
left, each too crowded to be sure (in a label whose vectors are all hardly
farther apart than the threshold, every one), are compared with each other
exactly, in blocks.

A bounded window cannot see every member of a large group.  So the links
*within* a component are then counted exactly, in blocks: components are found
by the passes, link counts do not depend on the window.

Equal vectors of a label are one row with a count throughout.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelkit.llm.common import bounded_batches, text_batches
from panelkit.llm.graph import components
from panelkit.llm.vectors import packed, unit, unpack, usable
from panelkit.session import materialize

BITS = 60
WINDOWS = (64, 256, 1024)
MOVED = 500  # what it costs to hash, sort and send a row once, in compared pairs
CROWDED = 8
NEVER = 1 << 30


def plan_passes(units: np.ndarray | None, centre: np.ndarray, rows: int, windows: tuple[int, ...],
                threshold: float, miss: float, trials: int = 8,
                needs: list[tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[int, int, float]:
    """Passes, window and spread of the passes' centres that cost a label of
    ``rows`` vectors least; no passes: the label is too crowded for them.

    ``needs`` has, for each window, passes and how many rows need that many
    until a pair at the threshold stays unseen with probability ``miss``.
    Without it they are worked out for places held in memory (``units``),
    taken to stand for all rows.  Rows that need more passes than the label
    gets are compared exactly, a pair at ``CROWDED`` times its cost.
    """
    if rows <= max(windows):
        return 1, min(w for w in windows if w >= rows), 0.0
    scale = 0.5 * math.sqrt(max(0.0, 1 - centre @ centre))  # half the unit vectors' deviation
    if needs is None:
        needs = [(_needed(log, miss), np.full(len(log), rows / len(log)))
                 for log in _places(units - centre, units @ units.T >= threshold, rows, windows, scale,
                                    threshold, trials)]
    best = CROWDED * _exact_cost(rows), (0, 0, 0.0)
    for (passes, count), w in zip(needs, windows):
        order = np.argsort(passes)
        passes, left = passes[order], np.maximum(rows - np.cumsum(count[order]), 0)
        cost = passes * (rows * (MOVED + 1.5 * w)) + CROWDED * _exact_cost(left)
        cost = np.where(passes < NEVER, cost, np.inf)
        at = int(cost.argmin())
        best = min(best, (float(cost[at]), (int(passes[at]), w, scale)), key=lambda x: x[0])
    return best[1]


def _exact_cost(rows, block: int = 1024):
    """What it costs to send ``rows`` in pairs of blocks and compare them all."""
    return rows * (rows / 2 + MOVED * np.ceil(rows / block))


def _needed(log: np.ndarray, miss: float) -> np.ndarray:
    """Passes after which a pair stays unseen with probability ``miss``, if
    each misses it with probability ``exp(log)``; rounded up to six binary digits."""
    passes = np.ceil(math.log(miss) / np.minimum(log, -1e-9))
    step = 2.0 ** np.maximum(np.floor(np.log2(passes)) - 5, 0)
    return np.minimum(np.ceil(passes / step) * step, NEVER).astype(np.int64)


def _places(m0: np.ndarray, linked: np.ndarray, rows: int, windows: tuple[int, ...], scale: float,
            threshold: float, trials: int) -> np.ndarray:
    """Log of the chance that a pass misses a place's partner, for each window,
    if the places (``m0``, around the mean) stand for ``rows``."""
    unseen = np.zeros((len(windows), len(m0)))
    for p in range(trials):
        m = m0 - scale * _jitter(m0.shape[1], p)
        r = np.maximum(np.sqrt((m * m).sum(axis=1)), 1e-300)
        same = _same(r, threshold)
        m /= r[:, None]
        agree = 1 - np.arccos(np.clip(m @ m.T, -1, 1)) / math.pi
        agree[linked] = 0.0  # rows of one component do not crowd each other out
        share = np.ones_like(agree)
        waits = np.ones(unseen.shape, bool)
        for bits in range(1, BITS + 1):
            share *= agree
            beside = share.sum(axis=1) / max(1, len(m) - 1) * (rows - 1)
            for k, w in enumerate(windows):
                free = waits[k] & (beside <= w / 2)
                unseen[k, free] += np.log1p(-same[free] ** bits) / trials
                waits[k] &= ~free
            if not waits.any():
                break
    return unseen


def _same(r: np.ndarray, threshold: float) -> np.ndarray:
    """Chance that a partner at the threshold is on the same side of a random
    plane through a centre at distance ``r``."""
    apart = math.sqrt(2 - 2 * threshold)
    return 1 - 2 * np.arcsin(apart / (2 * np.maximum(r, apart / math.sqrt(2)))) / math.pi


def _planned(nodes: DataFrame, windows: tuple[int, ...], threshold: float, miss: float,
             trials: int = 8) -> DataFrame:
    """``nodes`` with ``rows, centre, passes, window, spread`` of their label, from
    all rows of it: their mean, and their crowding in ``trials`` passes."""
    centres = "label_no long, rows long, centre binary"

    def add(batches):
        for _, label, raw in text_batches(batches, "label_no", "raw"):
            label = np.array(label, np.int64)
            for no in np.unique(label):
                u = _units([raw[i] for i in np.flatnonzero(label == no)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no], pa.int64()), pa.array([len(u)], pa.int64()),
                     pa.array([u.sum(axis=0).tobytes()], pa.binary())], names=["label_no", "rows", "centre"])

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = int(pdf["rows"].sum())  # sums in one order, so that reruns agree
        total = unpack(sorted(pdf["centre"]), len(pdf["centre"].iat[0]) // 8).sum(axis=0)
        return pd.DataFrame({"label_no": pdf["label_no"].iloc[:1], "rows": [rows],
                             "centre": [(total / rows).tobytes()]})

    labels = materialize(nodes.select("label_no", "raw").mapInArrow(add, centres)
                         .groupBy("label_no").applyInPandas(mean, centres), "centres")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        centre = np.frombuffer(pdf["centre"].iat[0], "<f8")
        needs = [(g["need"].to_numpy(np.int64), g["count"].to_numpy(float))
                 for g in (pdf[pdf["k"] == k] for k in range(len(windows)))]
        passes, window, spread = plan_passes(None, centre, int(pdf["rows"].iat[0]), windows, threshold, miss,
                                             needs=needs)
        return pdf[["label_no", "rows", "centre"]].iloc[:1].assign(passes=passes, window=window, spread=spread)

    def of_label(df: DataFrame, plans: DataFrame) -> DataFrame:
        return df.join(plans.withColumnRenamed("label_no", "_l"), F.col("label_no") == F.col("_l")).drop("_l")

    large = labels.filter(F.col("rows") > max(windows))
    fits = F.array_min(F.filter(F.array(*map(F.lit, windows)), lambda w: w >= F.col("rows")))
    plans = labels.filter(F.col("rows") <= max(windows)).select(
        "label_no", "rows", "centre", F.lit(1).alias("passes"), fits.cast("int").alias("window"),
        F.lit(0.0).alias("spread"))
    if not large.isEmpty():
        def spread(centre: pd.Series) -> pd.Series:
            return centre.map(lambda c: 0.5 * math.sqrt(max(0.0, 1 - (np.frombuffer(c, "<f8") ** 2).sum())))

        tried = large.select("label_no", "centre", F.lit(trials).alias("passes"), F.lit(0).alias("window"),
                             F.pandas_udf(spread, "double")("centre").alias("spread"))

        def need(batches):
            for batch in batches:
                if not len(batch):
                    continue
                label = batch.column(0).to_numpy()
                for k in range(len(windows)):
                    needed = _needed(batch.column(k + 1).to_numpy() / trials, miss)
                    (no, needed), count = np.unique(np.stack([label, needed]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(no), pa.array(np.full(len(no), k), pa.int32()), pa.array(needed),
                         pa.array(count, pa.int64())], names=["label_no", "k", "need", "count"])

        needs = (_unseen(of_label(nodes, tried), threshold, windows)
                 .select("label_no", *(f"log{k}" for k in range(len(windows))))
                 .mapInArrow(need, "label_no long, k int, need long, count long")
                 .groupBy("label_no", "k", "need").agg(F.sum("count").alias("count")))
        plans = plans.union(of_label(needs, large).groupBy("label_no").applyInPandas(
            plan, f"{centres}, passes int, window int, spread double"))
    return of_label(nodes, materialize(plans, "plans"))


def _unseen(nodes: DataFrame, threshold: float, windows: tuple[int, ...] = (),
            reach: int = max(WINDOWS)) -> DataFrame:
    """``node, label_no, log0, log1, ..``: log of the chance that all ``passes``
    of a row miss its partner at the threshold, for each of ``windows``, or
    for the row's own ``window`` (``reach`` at most).

    In the order of a pass, rows that share more bits with a row than those a
    window before and behind it lie between the two.  Next to the ends of a
    partition its first and last row stand for those outside, which share no
    more: there the chance comes out too large, never too small.
    """
    bounded_batches(nodes.sparkSession)
    reach = max(windows, default=reach)
    names = [*SORTED, "window", "same"]

    def project(batches):
        for dim, label, node, passes, window, spread, _, around in _unpacked(batches):
            far = (around * around).sum(axis=1)
            for p in range(passes.max()):
                at = np.flatnonzero(passes > p)
                shift = _jitter(dim, p)
                r2 = far[at] - 2 * spread[at] * (around[at] @ shift) + spread[at] ** 2 * (shift @ shift)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), p), pa.int32()), pa.array(label[at]),
                     pa.array(_code(around[at], spread[at], dim, p)), pa.array(node[at]), pa.array(window[at]),
                     pa.array(_same(np.sqrt(np.maximum(r2, 0)), threshold))], names=names)

    def measure(batches):
        held, done = None, 0

        def logs(hi):
            at = np.arange(done, hi)
            pas, label, code = (held[c] for c in ("pass", "label_no", "code"))

            def shared(to):
                x = code[at] ^ code[to]
                high, low = np.frexp((x >> 30).astype(float))[1], np.frexp((x & (1 << 30) - 1).astype(float))[1]
                return np.where((pas[at] == pas[to]) & (label[at] == label[to]),
                                BITS - np.where(high > 0, high + 30, low), -1)

            for w in windows or (held["window"][at],):
                bits = 1 + np.maximum(shared(np.maximum(at - w, 0)), shared(np.minimum(at + w, len(code) - 1)))
                chance = np.where(bits > BITS, 0.0, held["same"][at] ** bits)
                yield pa.array(np.log1p(-np.minimum(chance, 1 - 1e-12)))

        def measured(hi):
            return pa.RecordBatch.from_arrays(
                [pa.array(held["node"][done:hi]), pa.array(held["label_no"][done:hi]), *logs(hi)],
                names=["node", "label_no", *cols])

        for batch in batches:
            new = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names}
            held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in names}
            if len(held["node"]) - reach > done:
                yield measured(len(held["node"]) - reach)
                done = len(held["node"]) - reach
            cut = max(0, done - reach)
            held, done = {c: v[cut:] for c, v in held.items()}, done - cut
        if held is not None and len(held["node"]) > done:
            yield measured(len(held["node"]))

    cols = [f"log{k}" for k in range(len(windows) or 1)]
    rows = nodes.select("node", "label_no", "raw", "centre", "passes", "window", "spread")
    ends = nodes.sparkSession.range(2).select(  # nothing lies before the first and after the last row
        F.when(F.col("id") == 0, -1).otherwise(NEVER).cast("int").alias("pass"), F.lit(0).cast("long").alias("label_no"),
        F.lit(0).cast("long").alias("code"), F.lit(-1).cast("long").alias("node"), F.lit(0).alias("window"),
        F.lit(0.0).alias("same"))
    coded = rows.mapInArrow(project, "pass int, label_no long, code long, node long, window int, same double")
    few = (rows.agg(F.sum("passes")).first()[0] or 0) // (16 * reach)  # partitions with few rows beside their ends
    logs = _ranged(coded.union(ends), few).mapInArrow(
        measure, "node long, label_no long, " + ", ".join(f"{c} double" for c in cols))
    return logs.filter("node >= 0").groupBy("node", "label_no").agg(*(F.sum(c).alias(c) for c in cols))


def _crowded(planned: DataFrame, threshold: float, miss: float, reach: int) -> DataFrame:
    """Rows that do not see their partners surely enough in their passes."""
    passed = planned.filter((F.col("passes") > 0) & (F.col("rows") > F.col("window")))
    if passed.isEmpty():  # each label lies in one window or takes no pass
        return planned.filter("passes = 0")
    left = _unseen(passed, threshold, reach=reach).filter(F.col("log0") > math.log(miss)).select(F.col("node").alias("_n"))
    return planned.filter("passes = 0").union(planned.join(left, F.col("node") == F.col("_n")).drop("_n"))


def _units(raw) -> np.ndarray:
    """Unit vectors of packed rows; shorter ones end in zeros."""
    sizes = np.array([len(r) // 8 for r in raw])
    out = np.zeros((len(raw), sizes.max()))
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        out[at, :dim] = unit(unpack([raw[i] for i in at], dim))
    return out


def _planes(dim: int, p: int) -> np.ndarray:
    return np.random.default_rng([23, p, dim]).normal(size=(dim, BITS))


def _jitter(dim: int, p: int) -> np.ndarray:
    return np.random.default_rng([29, p, dim]).normal(size=dim) / math.sqrt(dim)


def _joined(hit: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Pairs that join all rows (ids ``a``) and columns (``b``) linked by
    ``hit``: fewer than there are rows and columns."""
    fresh = np.ones(len(b), bool)  # columns not yet reached
    waits = hit.any(axis=1)
    while waits.any():
        first = int(waits.argmax())
        front = np.array([first])
        waits[first] = False
        while len(front):
            new = np.flatnonzero(hit[front].any(axis=0) & fresh)
            fresh[new] = False
            yield np.stack([np.full(len(new), a[first]), b[new]], 1)
            front = np.flatnonzero(hit[:, new].any(axis=1) & waits)
            waits[front] = False
            yield np.stack([np.full(len(front), a[first]), a[front]], 1)


def _code(around: np.ndarray, spread: np.ndarray, dim: int, p: int) -> np.ndarray:
    """Bits of pass ``p`` as one number; ``around``: vectors less their label's centre."""
    planes = _planes(dim, p)
    bits = around @ planes > np.outer(spread, _jitter(dim, p) @ planes)
    return bits.astype(np.int64) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _unpacked(batches):
    """Of each batch and length of vectors: the length, ``label_no, node, passes,
    window, spread``, unit vectors, and these less their label's centre."""
    for _, node, label, raw, centre, passes, window, spread in text_batches(
            batches, "node", "label_no", "raw", "centre", "passes", "window", "spread"):
        node, label, passes = np.array(node, np.int64), np.array(label, np.int64), np.array(passes)
        window, spread = np.array(window, np.int32), np.array(spread)
        sizes = np.array([len(r) // 8 for r in raw])
        for dim in np.unique(sizes):
            of = np.flatnonzero(sizes == dim)
            u = unit(unpack([raw[i] for i in of], dim))
            yield (dim, label[of], node[of], passes[of], window[of], spread[of], u,
                   u - unpack([centre[i] for i in of], dim))


SORTED = ["pass", "label_no", "code", "node"]
CARRIED = [*SORTED, "window", "unit"]


def _ranged(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Rows in the order of their passes, in ``most`` partitions at most."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, parts if most is None else min(parts, most))
    return rows.repartitionByRange(parts, *SORTED).sortWithinPartitions(*SORTED)


def _near_pairs(cols: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows no farther apart than their label's window in the given
    order: those that join all linked rows, and those too close to the
    threshold for single precision."""
    pas, label, node = (np.array(cols[c], np.int64) for c in ("pass", "label_no", "node"))
    sure, open_ = [np.empty((0, 2), np.int64)], [np.empty((0, 2), np.int64)]
    ends = np.flatnonzero((pas[1:] != pas[:-1]) | (label[1:] != label[:-1])) + 1
    for lo, hi in zip([0, *ends], [*ends, len(node)]):
        if hi - lo < 2:
            continue
        u = np.frombuffer(b"".join(cols["unit"][lo:hi]), "<f4").reshape(hi - lo, -1)
        ids, w = node[lo:hi], cols["window"][lo]
        error = (u.shape[1] + 8) * 2.0 ** -23
        for s in range(0, len(u) - 1, w):
            dot = u[s:s + w] @ u[s:s + 2 * w].T
            np.fill_diagonal(dot, -2)
            if dot.max() < threshold - error:
                continue
            a, b = ids[s:s + w], ids[s:s + 2 * w]
            sure += _joined(dot >= threshold + error, a, b)
            i, j = np.nonzero(np.abs(dot - threshold) < error)
            open_.append(np.stack([a[i], b[j]], 1)[i < j])
    return np.concatenate(sure), np.concatenate(open_)


def _link_passes(nodes: DataFrame, threshold: float, reach: int = max(WINDOWS)) -> DataFrame:
    """Links ``a, b`` of the sorted passes that join all linked rows they see:
    ``passes`` of them for each row, around its ``centre``, with its
    ``window`` (``reach`` at most)."""
    bounded_batches(nodes.sparkSession)

    def project(batches):
        for dim, label, node, passes, window, spread, u, around in _unpacked(batches):
            packs = pa.array([x.tobytes() for x in u.astype("<f4")], pa.binary())
            for p in range(passes.max()):
                at = np.flatnonzero(passes > p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), p), pa.int32()), pa.array(label[at]),
                     pa.array(_code(around[at], spread[at], dim, p)), pa.array(node[at]), pa.array(window[at]),
                     packs.take(pa.array(at))], names=CARRIED)

    # a label's rows are of one length (label_no holds it)
    carried = "pass int, label_no long, code long, node long, window int, unit binary"
    ranged = _ranged(nodes.mapInArrow(project, carried))
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    links = "a long, b long, sure boolean"

    def slide(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names = ["a", "b", "sure", "edge", "last", "size", *CARRIED]
        tail = head = None
        size = 0

        def pair_rows(pairs, sure):
            n = len(pairs)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array([sure] * n, pa.bool_()),
                 *(pa.nulls(n, t) for t in [pa.int32()] * 3 + types)], names=names)

        def edge_rows(cols, edge, at):
            at = [i for i, far in at if far < cols["window"][i]]
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()),
                 pa.array([edge] * n, pa.int32()), pa.array([len(cols["node"]) - i for i in at], pa.int32()),
                 pa.array([min(size, reach)] * n, pa.int32()),
                 *(pa.array([cols[c][i] for i in at], t) for c, t in zip(CARRIED, types))], names=names)

        for batch, *lists in text_batches(batches, *CARRIED):
            if not len(batch):
                continue
            size += len(batch)
            cols = dict(zip(CARRIED, lists))
            if head is None:
                head = {k: v[:reach] for k, v in cols.items()}
            elif len(head["node"]) < reach:
                head = {k: (head[k] + cols[k])[:reach] for k in CARRIED}
            if tail is not None:
                cols = {k: tail[k] + cols[k] for k in CARRIED}
            for pairs, sure in zip(_near_pairs(cols, threshold), (True, False)):
                if len(pairs):
                    yield pair_rows(pairs, sure)
            tail = {k: v[-reach:] for k, v in cols.items()}
        if head is not None:  # rows next to the neighbouring partitions
            n = len(tail["node"])
            yield edge_rows(head, 2 * part, [(i, i) for i in range(len(head["node"]))])
            yield edge_rows(tail, 2 * part + 1, [(i, n - 1 - i) for i in range(n)])

    out = materialize(ranged.mapInArrow(slide, f"{links}, edge int, last int, size int, {carried}"), "passes")

    def join_edge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["pass", "node"]).sort_values(SORTED)
        sure, open_ = _near_pairs({k: pdf[k].tolist() for k in CARRIED}, threshold)
        both = np.concatenate([sure, open_])
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1], "sure": np.arange(len(both)) < len(sure)})

    # the end of a partition meets the start of the next that has rows, and is
    # carried on through partitions shorter than the window; at most 2 * reach
    # rows for each boundary, one row a partition in `sizes`
    edges = out.filter(F.col("edge").isNotNull()).withColumn("part", F.floor(F.col("edge") / 2))
    along = Window.orderBy("part")
    sizes = (edges.filter("edge % 2 = 1").groupBy("part").agg(F.max("size").alias("n"))
             .select("part", F.sum("n").over(along).alias("upto"), F.lag("part").over(along).alias("before")))
    ahead = sizes.select(
        F.col("part").alias("_p"), F.col("upto").alias("_upto"), F.col("before").alias("_before"),
        F.collect_list(F.struct("part", "upto")).over(Window.orderBy("upto").rangeBetween(0, reach)).alias("_ahead"))
    reached = F.filter("_ahead", lambda x: x["upto"] - F.col("_upto") + F.col("last") <= F.col("window"))
    across = (edges.join(ahead, F.col("part") == F.col("_p"))
              .withColumn("edge", F.explode(F.when(F.col("edge") % 2 == 1, reached["part"])
                                            .otherwise(F.array("_before"))))
              .filter(F.col("edge").isNotNull()).select("edge", *CARRIED)
              .groupBy("edge").applyInPandas(join_edge, links))
    found = materialize(out.filter(F.col("a").isNotNull()).select("a", "b", "sure").union(across), "pairs")
    return found.filter("sure").select("a", "b").union(_decided(found.filter("not sure"), nodes, threshold))


def _decided(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` whose vectors as they came are at the threshold or above."""

    def decide(batches):
        for _, a, b, left, right in text_batches(batches, "a", "b", "left", "right"):
            if a:
                hit = np.einsum("ij,ij->i", _units(left), _units(right)) >= threshold
                yield pa.RecordBatch.from_arrays([pa.array(np.array(a)[hit]), pa.array(np.array(b)[hit])],
                                                 names=["a", "b"])

    left = nodes.select(F.col("node").alias("a"), F.col("raw").alias("left"))
    right = nodes.select(F.col("node").alias("b"), F.col("raw").alias("right"))
    return pairs.select("a", "b").distinct().join(left, "a").join(right, "b").mapInArrow(decide, "a long, b long")


def _dealt(rows: DataFrame, group: str, block: int, *cols: str) -> DataFrame:
    """Rows of each group in pairs of blocks ``i, j``; ``own`` is a row's block."""
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_m")).withColumnRenamed(group, "_c")
    return (rows.join(sizes, F.col(group) == F.col("_c"))
            .withColumn("_nb", F.ceil(F.col("_m") / block).cast("long"))
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("_nb")))
            .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)))
            .select(group, "node", "raw", *cols, "own",
                    F.least("own", "_o").alias("i"), F.greatest("own", "_o").alias("j"))
            .repartition(group, "i", "j"))  # else a group's block pairs follow the join into one task


def _all_links(nodes: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links ``a, b`` that join all linked rows of each label, by exact
    comparison in pairs of blocks; a block pair gives fewer links than rows."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["own"] == pdf["i"].iat[0]], pdf[pdf["own"] == pdf["j"].iat[0]]
        out = []
        if len(left) and len(right):
            hit = _units(left["raw"].tolist()) @ _units(right["raw"].tolist()).T >= threshold
            out += _joined(hit, left["node"].to_numpy(), right["node"].to_numpy())
        return pd.DataFrame(np.concatenate(out) if out else np.empty((0, 2), np.int64), columns=["a", "b"])

    return (_dealt(nodes, "label_no", block).groupBy("label_no", "i", "j")
            .applyInPandas(join, "a long, b long").filter("a <> b"))


def _count_links(rows: DataFrame, threshold: float, block: int) -> DataFrame:
    """``node, others``: rows linked to each node, by exact comparison of the
    members of each component in pairs of blocks."""
    dealt = _dealt(rows, "component", block, "n")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iat[0], pdf["j"].iat[0]
        left, right = pdf[pdf["own"] == i], pdf[pdf["own"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "others": []}).astype("int64")
        hit = _units(left["raw"].tolist()) @ _units(right["raw"].tolist()).T >= threshold
        if i == j:
            np.fill_diagonal(hit, False)
            return pd.DataFrame({"node": left["node"], "others": hit @ right["n"].to_numpy()})
        return pd.DataFrame({"node": [*left["node"], *right["node"]],
                             "others": [*(hit @ right["n"].to_numpy()), *(left["n"].to_numpy() @ hit)]})

    return (dealt.groupBy("component", "i", "j").applyInPandas(compare, "node long, others long")
            .groupBy("node").agg(F.sum("others").alias("others")))


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.93, window: int | None = None, miss: float = 1e-4,
                    block: int = 1024) -> DataFrame:
    """Links and components of vectors of the same label.

    ``window`` fixes the rows compared beside each; if it is not given, each
    label has the one of ``WINDOWS`` that costs it least.
    Returns one row per input row: ``vec_id, n_links, component_id, kept``.
    Rows with a null label, and vectors that are null, empty, zero or hold
    null or non-finite components, link with nothing; vectors of different
    length never link.  ``component_id`` is the smallest key reachable; a null key
    has a null component unless a linked row has one, and is not kept.  An
    empty table gives an empty result.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"),
                          F.col(label).cast("string").alias("label"))
    able = usable("v") & F.col("label").isNotNull()
    classes = materialize(
        packed(rows.filter(F.col("label").isNotNull()), "vec_id", "v", "label")
        .groupBy("label", "raw").agg(F.sum("n").alias("n"), F.min(F.get("ids", F.lit(0))).alias("first"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    if classes.isEmpty():
        counted = None
    else:
        nodes = classes.withColumn("label_no", F.xxhash64("label", F.octet_length("raw")))
        windows = (window,) if window else WINDOWS
        planned = _planned(nodes, windows, threshold, miss)
        links = _link_passes(planned.filter("passes > 0"), threshold, max(windows)) \
            .union(_all_links(_crowded(planned, threshold, miss, max(windows)), threshold, block))
        comp = materialize(components(links), "components")
        members = nodes.join(comp.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")) \
            .select("component", "node", "n", "raw", "first")
        lowest = members.groupBy("component").agg(F.min("first").alias("lowest")).withColumnRenamed("component", "_c")
        counted = (members.select("component", "node")
                   .join(_count_links(members, threshold, block).withColumnRenamed("node", "_n"),
                         F.col("node") == F.col("_n"))
                   .join(lowest, F.col("component") == F.col("_c"))
                   .select(F.col("node").alias("_node"), "others", "lowest"))
    found = classes.select("label", "raw", "node", "n", "first")
    if counted is not None:
        found = found.join(counted, F.col("node") == F.col("_node"), "left")
    else:
        found = found.withColumn("others", F.lit(0)).withColumn("lowest", F.lit(None).cast("long"))
    found = found.select(F.col("label").alias("_label"), F.col("raw").alias("_raw"),
                         (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
                         F.coalesce("lowest", "first").alias("comp"))

    def pack(batches):
        for batch, vs in text_batches(batches, "v"):
            raw = [(np.array(v, "<f8") + 0.0).tobytes() if ok else None
                   for v, ok in zip(vs, batch.column(batch.schema.get_field_index("ok")).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("vec_id")),
                 batch.column(batch.schema.get_field_index("label")), pa.array(raw, pa.binary())],
                names=["vec_id", "label", "raw"])

    keyed = rows.select("vec_id", "label", F.col("v").cast("array<double>").alias("v"), able.alias("ok")) \
        .mapInArrow(pack, "vec_id long, label string, raw binary")
    component = F.coalesce("comp", "vec_id")
    return (keyed.join(found, (F.col("label") == F.col("_label")) & (F.col("raw") == F.col("_raw")), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")))

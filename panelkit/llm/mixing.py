"""Mixing sources to target weights by entropy balancing.

Targets: source weights share all tokens; no source is asked for more than
``cap`` times what it has, the rest being shared again by weight.

Rates: among all document rates that give each source its target tokens, take
those closest to 1 in relative entropy.  The convex dual has one multiplier
per source and its solution is an exponential tilt by document size,
``rate = min(cap, exp(lambda * size / mean size))``.  The multipliers come
from Newton steps (safeguarded by a bracket); gradient and Hessian are
distributed aggregates.  As documents of one source and size share a rate,
the steps run on (source, size) cells, not on documents.

Copies: cumulative rounding along the sizes turns the rates of the cells into
whole copies, so that a source misses its target by at most about half of its
longest document; inside a cell the copies go to documents in hash order.

Everything is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from panelkit.llm.common import WORD_PATTERN, gapless_slots
from panelkit.session import materialize


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``sid, source, source_size, target`` per source.

    ``sizes`` has one row per source (``source, source_size, n_docs,
    min_size``).  Sources by code point, null last, take the weights in turn.
    The level ``mu`` with sum(min(cap * size, mu * weight)) = total is found
    on the sources sorted by the level at which each reaches its cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    ranked = (sizes.withColumn("sid", F.row_number().over(order) - 1)
              .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                             (F.col("sid") % len(weights) + 1).cast("int")))
              .withColumn("_most", F.col("source_size") * F.lit(float(cap))))
    by_level = Window.orderBy(F.col("_most") / F.col("_w"), "sid")
    upto = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    leveled = (ranked
               .withColumn("_total", F.sum("source_size").over(everything))
               .withColumn("_mu", (F.col("_total") - F.coalesce(F.sum("_most").over(upto), F.lit(0.0)))
                           / F.sum("_w").over(rest)))
    # a level is possible if its source is below the cap; capping more sources
    # than needed only lowers it, so the largest possible level is the one
    level = F.max(F.when(F.col("_mu") * F.col("_w") <= F.col("_most"), F.col("_mu"))).over(everything)
    return leveled.select("sid", "source", "source_size", "n_docs", "min_size",
                          F.least(F.col("_most"), F.coalesce(level, F.lit(0.0)) * F.col("_w")).alias("target"))


def entropy_multipliers(cells: DataFrame, targets: DataFrame, cap: float,
                        tolerance: float = 1e-6, max_steps: int = 80) -> DataFrame:
    """``sid, mean, lam`` per source: the dual's solution.

    ``cells``: ``sid, size, n`` (size > 0).  Each step aggregates the cells
    once and writes the few multipliers, which also cuts the lineage.
    """
    log_cap = math.log(cap)
    zmin = F.col("min_size") / F.col("mean")
    state = materialize(
        targets.filter((F.col("source_size") > 0) & (F.col("target") > 0))
        .withColumn("mean", F.col("source_size") / F.col("n_docs"))
        .select("sid", "mean", "target", F.lit(0.0).alias("lam"),
                F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) / zmin).alias("lo"),
                (F.lit(log_cap) / zmin).alias("hi"),
                F.lit(False).alias("done")), "multipliers")
    for _ in range(max_steps):
        open_ = state.filter(~F.col("done"))
        if open_.isEmpty():
            break
        z = F.col("size") / F.col("mean")
        free = F.col("lam") * z < log_cap
        tokens = F.col("n") * F.col("size") * F.exp(F.least(F.col("lam") * z, F.lit(log_cap)))
        sums = (cells.join(open_, "sid").groupBy("sid")
                .agg(F.sum(tokens).alias("have"),
                     F.sum(F.when(free, tokens * z).otherwise(0.0)).alias("slope"))
                .withColumnRenamed("sid", "_sid"))
        gap = F.col("have") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("lo2")) & (newton < F.col("hi2"))
        met = F.coalesce(F.abs(gap) <= tolerance * F.col("target"), F.lit(False))
        state = materialize(
            state.join(sums, state["sid"] == sums["_sid"], "left")
            .withColumn("lo2", lo).withColumn("hi2", hi)
            .withColumn("now", F.col("done") | met | (F.col("hi2") - F.col("lo2") <= 1e-14 * F.abs(F.col("hi2"))))
            .select("sid", "mean", "target",
                    F.when(F.col("now"), F.col("lam"))
                    .when(inside, newton).otherwise((F.col("lo2") + F.col("hi2")) / 2).alias("lam"),
                    F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), F.col("now").alias("done")),
            "multipliers")
    return state.select("sid", "mean", "lam")


def cell_copies(cells: DataFrame, multipliers: DataFrame, targets: DataFrame, cap: float,
                phases: int = 32) -> DataFrame:
    """``sid, size, n, copies`` per cell: rounded so that the running number
    of copies along falling sizes follows the running sum of rates.  Of
    ``phases`` starting points of the rounding the one nearest the target is
    taken."""
    rate = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(math.log(cap))))
    along = Window.partitionBy("sid").orderBy(F.col("size").desc())
    run = (cells.join(multipliers, "sid")
           .withColumn("_wish", F.col("n") * rate)
           .withColumn("_upto", F.sum("_wish").over(along.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("_before", F.coalesce(
               F.sum("_wish").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))))
    run = materialize(run.select("sid", "size", "n", "_before", "_upto"), "cells_run")

    def copies(phase):
        c = F.floor(F.col("_upto") + phase + 1e-9) - F.floor(F.col("_before") + phase + 1e-9)
        return F.least(F.greatest(c, F.lit(0)), F.floor(F.col("n") * F.lit(float(cap))))

    taken = [F.sum(copies(F.lit((p + 0.5) / phases)) * F.col("size")).alias(f"t{p}") for p in range(phases)]
    best = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"t{p}") - F.col("target")).alias("miss"),
                 F.lit((p + 0.5) / phases).alias("phase")) for p in range(phases)]))["phase"]
    phase = (run.groupBy("sid").agg(*taken).join(targets.select("sid", "target"), "sid")
             .select("sid", best.alias("_phase")))
    given = (run.join(phase, "sid")
             .select("sid", "size", "n", copies(F.col("_phase")).cast("long").alias("copies")))
    for _ in range(2):
        given = _nearer(materialize(given, "copies"), targets, cap)
    return given


def _nearer(given: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """One more or one fewer copy of the document of each source whose size
    brings the source nearest its target, if that is nearer than before."""
    gap = F.col("target") - F.col("have")
    step = F.signum(gap)
    possible = F.when(gap > 0, F.col("copies") < F.floor(F.col("n") * F.lit(float(cap)))).otherwise(F.col("copies") > 0)
    left = F.abs(F.abs(gap) - F.col("size"))
    have = (given.groupBy("sid").agg(F.sum(F.col("copies") * F.col("size")).alias("have"))
            .join(targets.select("sid", "target"), "sid"))
    change = (given.join(have, "sid").filter(possible & (left < F.abs(gap)))
              .groupBy("sid").agg(F.min(F.struct(left.alias("left"), "size", step.cast("long").alias("step"))).alias("c"))
              .select(F.col("sid").alias("_sid"), "c"))
    hit = F.col("size") == F.col("c")["size"]
    return (given.join(change, F.col("sid") == F.col("_sid"), "left")
            .select("sid", "size", "n",
                    (F.col("copies") + F.when(hit, F.col("c")["step"]).otherwise(F.lit(0))).cast("long").alias("copies")))


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                  weights: Sequence[float] = (5.0, 2.0, 1.0), cap: float = 3.0) -> DataFrame:
    """Copies of every document in the mix.

    Returns one row per input row: ``doc_id, source, text_hash, size,
    source_size, target, copies, taken`` (``taken = copies * size``; ``copies`` never
    exceeds ``cap``).  Size is the word count (null or empty text: 0 words,
    one copy, nothing taken).  A null source is a source of its own, last in
    order; null and repeated keys are allowed, equal rows may differ in
    copies by one; other columns are ignored; an empty table gives an empty
    result.  Reruns agree.
    """
    rows = materialize(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size")),
        "sized")
    cells0 = materialize(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    per_source = cells0.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n_docs"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("min_size"))
    targets = materialize(source_targets(per_source, weights, cap), "targets")
    ids = targets.select("sid", F.col("source").alias("_source"))
    cells = materialize(
        cells0.filter(F.col("size") > 0).join(ids, F.col("source").eqNullSafe(F.col("_source")))
        .select("sid", "size", "n"), "cells_by_source")
    lam = entropy_multipliers(cells, targets, cap)
    given = materialize(cell_copies(cells, lam, targets, cap), "copies")
    slots = gapless_slots(rows, ["source", "size"], slot="_slot")
    known = targets.select("sid", F.col("source").alias("_source"), "source_size", "target")
    whole = F.floor(F.col("copies") / F.col("n"))
    extra = (F.col("_slot") < F.col("copies") - whole * F.col("n")).cast("long")
    count = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.coalesce(whole + extra, F.lit(0)))
    return (slots.join(known, F.col("source").eqNullSafe(F.col("_source")))
            .join(given.withColumnRenamed("size", "_size").withColumnRenamed("sid", "_sid"),
                  (F.col("sid") == F.col("_sid")) & (F.col("size") == F.col("_size")), "left")
            .select("doc_id", "source", "text_hash", "size", "source_size", "target",
                    count.cast("long").alias("copies"),
                    (count * F.col("size")).cast("long").alias("taken")))

"""Stored, mergeable sketches of keys and values.

A sketch is a few kilobytes per group, whatever the group holds.  It is
written once per part of the data (a year, a state) and merged upwards, so a
report over more parts, or after new ones, rereads sketches and no rows.

* keys: theta sketches, with intersection and difference, for the match
  report of two key sets;
* values: quantile (KLL) sketches, for medians per group and in total;
* frequent keys: bounded counters in each task, merged, and an exact recount.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.session import materialize

KEY_LOG2 = 12  # a key sketch keeps about 4096 hashes; fewer keys are counted exactly
VALUE_K = 400
COUNTERS = 4096  # keys a task counts for the most frequent ones
BUCKETS = 1 << 16  # hash buckets that bound the counts of all other keys
PROBED = 64  # largest buckets whose keys are counted to learn what the n-th key needs
DEVIATIONS = 4  # width of a stated bound in standard errors


def key_sketches(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """``by, keys``: one written sketch of the non-null keys of each part."""
    return materialize(df.filter(F.col(key).isNotNull()).groupBy(*by).agg(
        F.theta_sketch_agg(key, KEY_LOG2).alias("keys")), "key_sketches")


def merged_keys(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of larger parts from those of smaller ones."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("keys", KEY_LOG2).alias("keys"))


def _bound(estimate: Column, largest: Column) -> Column:
    """Largest error to expect of a set operation on sets of up to ``largest`` keys."""
    share = F.greatest(largest / (1 << KEY_LOG2), F.lit(1.0))  # keys a kept hash stands for
    return F.when(share <= 1, F.lit(0.0)).otherwise(DEVIATIONS * F.sqrt((estimate + DEVIATIONS * share) * share))


def sketch_match_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """The key match report (A11 + P18) of two tables of key sketches: an
    estimate and a bound of its error for ``n_left, n_right, n_matched,
    n_missing``, and the matched share in percent.  One row."""
    sides = merged_keys(left).select(F.col("keys").alias("_l"), merged_keys(right).select("keys").scalar().alias("_r"))
    est = lambda c: F.theta_sketch_estimate(c).cast("double")
    out = sides.select(est(F.col("_l")).alias("n_left"), est(F.col("_r")).alias("n_right"),
                       est(F.theta_intersection("_l", "_r")).alias("n_matched"),
                       est(F.theta_difference("_l", "_r")).alias("n_missing"))
    names = out.columns
    largest = F.greatest("n_left", "n_right")
    return out.select(*names, *[_bound(F.col(n), largest).alias(f"{n}_bound") for n in names],
                      F.round(F.try_divide(F.col("n_matched") * 100, F.col("n_left")), 1).alias("pct_matched"))


def value_sketches(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``by, values``: one written quantile sketch of the non-null values of each part."""
    return materialize(df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), VALUE_K).alias("values")), "value_sketches")


def rank_error() -> float:
    """Largest error of a quantile's rank, as a share of the values, to expect
    of one sketch (twice the published 99 % figure of its size)."""
    return 2 * 2.296 / math.pow(VALUE_K, 0.9723)


def merged_quantiles(sketches: DataFrame, by: Sequence[str] = (), quantile: float = 0.5) -> DataFrame:
    """``by, n, quantile`` of larger parts, from the sketches of smaller ones."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("values", VALUE_K).alias("values"))
    return merged.filter(F.kll_sketch_get_n_double("values") > 0).select(
        *by, F.kll_sketch_get_n_double("values").alias("n"),
        F.kll_sketch_get_quantile_double("values", F.lit(quantile)).alias("quantile"))


def rank_check(df: DataFrame, value: str, quantiles: DataFrame, by: Sequence[str] = (),
               quantile: float = 0.5) -> DataFrame:
    """``by, n, quantile, low, high, inside``: the share of values below, and
    not above, the estimate, counted exactly, and whether the wanted quantile
    lies between them within the stated rank error.  ``quantiles`` has one row a
    part; parts are joined by equal keys."""
    q = quantiles.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("quantile").alias("_q"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    rows = df.filter(F.col(value).isNotNull())
    met = rows.join(q, on) if by else rows.withColumn("_q", q.select("_q").scalar())
    out = met.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max("_q").alias("quantile"),
                               (F.count_if(F.col(value) < F.col("_q")) / F.count(F.lit(1))).alias("low"),
                               (F.count_if(F.col(value) <= F.col("_q")) / F.count(F.lit(1))).alias("high"))
    e = rank_error()
    return out.withColumn("inside", (F.col("low") <= quantile + e) & (F.col("high") >= quantile - e))


def heavy_hitters(df: DataFrame, key: str, n: int = 5, out: str = "n_rows", counters: int = COUNTERS,
                  buckets: int = BUCKETS, probed: int = PROBED) -> DataFrame:
    """A7 on a key of any width: ``key, out`` of the ``n`` most frequent keys,
    exactly, ties by key (null is a key and comes first).

    Frequent-item counters give the hot keys, at most ``counters``.  These are
    counted exactly, and all others by hash bucket, in one pass that shuffles
    one row a counter and bucket from each task.  No key outside the hot ones
    has more rows than its bucket, so once the ``n``-th count among the hot keys
    and those of the ``probed`` largest buckets is known, only keys of buckets
    that reach it are counted one by one.  Where some keys stand out, few
    buckets do; where all keys have about as many rows, most do, and the work
    is that of a plain count.  An empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("_k")).withColumn(
        "_b", F.pmod(F.xxhash64("_k"), F.lit(buckets)).cast("int"))
    met = rows.agg(F.expr(f"approx_top_k(_k, {counters}, {counters})").alias("_t"))
    hot = materialize(met.select(F.explode("_t").alias("_t")).select(
        F.col("_t.item").alias("_h"), F.lit(True).alias("_hot")), "hot_keys")
    # at most `counters` and `buckets` rows are broadcast
    marked = rows.join(F.broadcast(hot), F.col("_k").eqNullSafe(F.col("_h")), "left")
    counted = materialize(
        marked.groupBy(F.when(F.col("_hot"), F.col("_k")).alias("_k"),
                       F.when(F.col("_hot").isNull(), F.col("_b")).alias("_b"))
        .agg(F.count(F.lit(1)).alias(out)), "hot_and_buckets")
    hits, sums = counted.filter("_b IS NULL").select("_k", out), counted.filter("_b IS NOT NULL")

    def recount(chosen: DataFrame) -> DataFrame:
        of = chosen.select(F.col("_b").alias("_c"))
        return (marked.filter(F.col("_hot").isNull()).join(F.broadcast(of), F.col("_b") == F.col("_c"))
                .groupBy("_k").agg(F.count(F.lit(1)).alias(out)))

    best = [F.col(out).desc(), F.col("_k").asc()]
    known = hits.union(recount(sums.orderBy(F.col(out).desc(), "_b").limit(probed)))
    needed = materialize(known.orderBy(*best).limit(n).agg(
        F.when(F.count(F.lit(1)) == n, F.min(out)).otherwise(0).alias("_least")), "needed")
    reach = sums.filter(F.col(out) >= needed.select("_least").scalar())
    return (hits.union(recount(reach)).orderBy(*best).limit(n)
            .select(F.col("_k").alias(key), out))

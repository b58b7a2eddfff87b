"""Exact order statistics without a single-task sort.

``percentile`` / ``median`` in Spark keep every distinct value of a group in
one aggregation buffer; for a global median that is one task holding all
distinct values.  Here:

1. values are compressed to (value, multiplicity) by a partial + final
   aggregation, so a value holding a third of all rows is one row;
2. a bounded quantile sketch over the distinct values gives ``buckets - 1``
   split points (the only thing brought to the driver: a fixed-size array);
3. each distinct value gets its bucket by binary search (``Bucketizer``),
   bucket totals (at most ``buckets`` rows) give each bucket's offset, and a
   window *per bucket* gives running counts, so no task sorts more than about
   ``distinct / buckets`` values;
4. the rows holding ranks ``k`` are picked by one more aggregate.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from panelkit.session import materialize


def ranked_values(df: DataFrame, value: str, *, buckets: int = 1024,
                  accuracy: int = 100000) -> DataFrame:
    """(v, c, cum): distinct non-NULL values, multiplicity and the number of
    rows with a value <= v."""
    return _ranked(value_counts(df, value), buckets, accuracy)


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """(v, c): distinct non-NULL values and their multiplicity, computed when
    called and written, so that the input is read once."""
    v = df.select(F.col(value).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    return materialize(v.groupBy("v").agg(F.count(F.lit(1)).alias("c")), "value_counts")


def _ranked(vc: DataFrame, buckets: int = 1024, accuracy: int = 100000) -> DataFrame:
    probs = [i / buckets for i in range(1, buckets)]
    row = vc.agg(F.percentile_approx("v", probs, accuracy).alias("e")).first()
    # Bucketizer needs at least one inner split, even for an empty input
    edges = sorted(set(row["e"] or [])) or [0.0]
    splits = [float("-inf")] + edges + [float("inf")]
    bk = Bucketizer(splits=splits, inputCol="v", outputCol="b").transform(vc)
    totals = bk.groupBy("b").agg(F.sum("c").alias("bc"))
    offsets = totals.withColumn(
        "before", F.coalesce(F.sum("bc").over(
            Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # at most `buckets` rows: a proven bound for the broadcast
    ranked = bk.join(F.broadcast(offsets.select("b", "before")), on="b")
    within = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return ranked.select("v", "c", (F.col("before") + F.sum("c").over(within)).alias("cum"))


def exact_quantile_rows(df: DataFrame, value: str, ranks: dict[str, F.Column], **kw) -> DataFrame:
    """One row: for each name, the value at the given 1-based rank column."""
    r = ranked_values(df, value, **kw)
    return r.agg(*[
        F.max(F.when((F.col("cum") >= k) & (F.col("cum") - F.col("c") < k), F.col("v"))).alias(name)
        for name, k in ranks.items()])


def exact_median(df: DataFrame, value: str, *, out: str = "median", **kw) -> DataFrame:
    """One row with the interpolated median (mean of the two middle values
    for an even count), as pandas / SQL ``median`` give."""
    return exact_summary(df, value, **kw).select(F.col("median").alias(out))


def exact_summary(df: DataFrame, value: str, **kw) -> DataFrame:
    """One row: mean, min, max, n and the exact median over non-NULL values,
    all from one written (value, multiplicity) table."""
    vc = value_counts(df, value)
    ranked = _ranked(vc, **kw)
    n = vc.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).scalar()

    def at(k):
        return F.max(F.when((F.col("cum") >= k) & (F.col("cum") - F.col("c") < k), F.col("v")))

    return ranked.agg(
        F.try_divide(F.sum(F.col("v") * F.col("c")), F.sum("c")).alias("mean"), F.min("v").alias("min"),
        F.max("v").alias("max"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        ((at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2).alias("median"))

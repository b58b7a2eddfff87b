"""Join-validation and data-quality operators (D1-D4, J5, J7-J8, A7, A8,
A11, P18).

Key sets are compared with distributed set operations (semi / anti joins,
INTERSECT / EXCEPT) instead of driver-side Python sets; the report is one
aggregate over a full outer join of the two distinct key sets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkit.functions import stats
from panelkit.operators.clean import require_columns


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unique combinations of ``columns``."""
    return df.select(*columns).distinct()


def key_set(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys (F9 + D1)."""
    require_columns(df, [key], "key set")
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def matched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on both sides."""
    return key_set(left, key).join(key_set(right, key), on=key, how="left_semi")


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of ``left`` absent from ``right``."""
    return key_set(left, key).join(key_set(right, key), on=key, how="left_anti")


def key_match_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A11 + P18: one row with distinct counts per side, matched, missing and
    the matched share of the left side in percent (one decimal)."""
    lk = key_set(left, key).withColumn("_l", F.lit(True))
    rk = key_set(right, key).withColumn("_r", F.lit(True))
    j = lk.join(rk, on=key, how="full_outer")
    return (j.agg(F.count_if(F.col("_l").isNotNull()).alias("n_left"),
                  F.count_if(F.col("_r").isNotNull()).alias("n_right"),
                  F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_matched"),
                  F.count_if(F.col("_l").isNotNull() & F.col("_r").isNull()).alias("n_missing"))
            .withColumn("pct_matched",
                        F.round(F.try_divide(F.col("n_matched") * 100.0, F.col("n_left")), 1)))


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner equi join on a composite key (NULL keys never match)."""
    require_columns(left, on, "left side")
    require_columns(right, on, "right side")
    return left.join(right, on=list(on), how="inner")


def colocated_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """J5 over tables bucketed alike on ``on`` (:func:`writers.write_bucketed`):
    bucket meets bucket, merged in key order, no shuffle of either side."""
    require_columns(left, on, "left side")
    require_columns(right, on, "right side")
    return left.join(right.hint("merge"), on=list(on), how=how)


def ordered_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys in order."""
    return key_set(df, key).orderBy(key)


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows under a full ordering (top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def top_values(df: DataFrame, key: str, n: int = 5, out: str = "n_rows") -> DataFrame:
    """Value counts, most frequent first, ties by key; top ``n``."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.col(out).desc(), F.col(key).asc()).limit(n))


def summary(df: DataFrame, value: str, *, exact: bool = True,
            accuracy: int = 10000) -> DataFrame:
    """Mean, median, min and max over non-NULL values, one row.

    ``exact`` reads the input once, when called: the (value, multiplicity)
    table is written and everything follows from it.  Otherwise one lazy pass
    with a bounded quantile sketch (relative rank error about
    1 / ``accuracy``).
    """
    if exact:
        return stats.exact_summary(df, value)
    base = df.filter(F.col(value).isNotNull())
    return base.agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
                    F.count(F.lit(1)).alias("n"), F.percentile_approx(value, 0.5, accuracy).alias("median"))

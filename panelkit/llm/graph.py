"""Connected components of a link table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelkit.session import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (smallest node id reachable) for every node of
    ``links`` (``a, b``: long ids, any direction, repeats and loops allowed).

    Alternating large-star and small-star steps: each node points its larger
    neighbours, then its smaller ones, at the smallest node it knows.  A step
    is one aggregation (partial sums in each task, so a node holding most
    links is no hot spot) and one join; its links never outnumber the input's.
    Each step's table is written to the shared scratch folder, so a lost
    executor repeats one step at most.
    """
    e = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "links")
    state = _fingerprint(e)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        e = materialize(_small_star(_large_star(e)), "links")
        now = _fingerprint(e)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    # settled links are stars: (member, centre)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select("b", "b").distinct())


def _fingerprint(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a"))
    lowest = both.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m"))
    return (both.filter(F.col("b") > F.col("a")).join(lowest, F.col("a") == F.col("_n"))
            .select(F.col("b").alias("a"), F.least("_m", "_n").alias("b"))
            # a node whose smallest neighbour is smaller keeps that link
            .union(lowest.filter(F.col("_m") < F.col("_n")).select("_n", "_m"))
            .distinct())


def _small_star(e: DataFrame) -> DataFrame:
    lowest = e.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m"))
    return (e.join(lowest, F.col("a") == F.col("_n"))
            .select(F.col("b").alias("a"), F.col("_m").alias("b")).filter("a != b")
            .union(lowest.select("_n", "_m")).distinct())

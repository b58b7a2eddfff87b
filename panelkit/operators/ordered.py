"""Order over data wider than a task: running totals, lags and rolling sums of
one long series (W1, W2, W3), and the frequency index of a wide key (M1, M2).

Rows are range-partitioned by (series, order) and written sorted, so that a
*block* is the part of a series in one partition.  What a window needs from
outside its block is little and known per block:

* positions and running totals: the sums of the earlier blocks (one row per
  block, so one window over the blocks of a series);
* lags and rolling frames: the rows next to the block's edges (*halo*), at
  most ``preceding + following`` a block, however short its neighbours are.

So no task holds a series, only a block of it and its halo.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.session import materialize

_LOCAL = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | row


def _null_safe(left: Sequence[Column], right: Sequence[Column]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & a.eqNullSafe(b)
    return on


def positions(df: DataFrame, order: Sequence[Column | str], *, series: Sequence[str] = (),
              totals: Mapping[str, str] | None = None, rows_per_block: int = 1 << 20) -> DataFrame:
    """``df`` written in order, with ``_block``, ``_pos`` (0, 1, 2, ... in the
    series) and, for each ``name: column`` of ``totals``, ``name`` as the sum of
    the series' earlier blocks (null if they hold no value).

    ``order`` must tell the rows of a series apart; rows that it does not tell
    apart are numbered in some order and stay in one block.
    """
    totals = dict(totals or {})
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(least, -(-df.count() // rows_per_block))
    by = [*series, *order]
    rows = materialize(df.repartitionByRange(blocks, *by).sortWithinPartitions(*by)
                       .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_block", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(_LOCAL))
    sums = rows.groupBy(*series, "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"),
        *[F.sum(c).alias(f"_t_{n}") for n, c in totals.items()])
    earlier = Window.partitionBy(*series).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(series)], F.col("_block").alias("_b"),
                       (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"),
                       *[F.sum(f"_t_{n}").over(earlier).alias(n) for n in totals])
    on = _null_safe([F.col(c) for c in (*series, "_block")], [F.col(f"_s{i}") for i in range(len(series))] + [F.col("_b")])
    return (rows.join(sums, on).withColumn("_pos", F.col("_at") + F.col("_shift"))
            .drop("_at", "_b", "_shift", *[f"_s{i}" for i in range(len(series))]))


def long_windows(df: DataFrame, order: Sequence[str], *, series: Sequence[str] = (),
                 running: Mapping[str, str] | None = None, lags: Mapping[str, tuple[str, int]] | None = None,
                 rolling: Mapping[str, str] | None = None, preceding: int = 3, following: int = 1,
                 rows_per_block: int = 1 << 20) -> DataFrame:
    """``df`` with, per series in ``order`` (which must tell rows apart):

    * ``running``: ``name: column``, the sum of all rows up to this one;
    * ``lags``: ``name: (column, n)``, the value ``n`` rows before;
    * ``rolling``: ``name: column``, the sum of the rows from ``preceding``
      before to ``following`` after.

    Equal to the SQL windows over the whole series; nulls are skipped by sums
    and kept by lags; a null series is a series.  Empty in, empty out.
    """
    running, lags, rolling = dict(running or {}), dict(lags or {}), dict(rolling or {})
    back = max([n for _, n in lags.values()] + ([preceding] if rolling else [0]))
    ahead = following if rolling else 0
    near = max(back, ahead)
    placed = positions(df, order, series=series, totals={f"_before_{n}": c for n, c in running.items()},
                       rows_per_block=rows_per_block)
    placed = materialize(placed, "placed")
    whole = placed.withColumn("_halo", F.lit(False))
    if near:
        block = Window.partitionBy(*series, "_block")
        edges = (placed.withColumn("_lo", F.min("_pos").over(block)).withColumn("_hi", F.max("_pos").over(block))
                 .filter((F.col("_pos") < F.col("_lo") + near) | (F.col("_pos") > F.col("_hi") - near))
                 .drop("_lo", "_hi"))
        edges = materialize(edges, "edges")
        # an edge row goes to the blocks of the rows that look at it
        lookers = edges.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(series)],
                               F.col("_pos").alias("_p"), F.col("_block").alias("_to"))
        reach = edges.withColumn("_by", F.explode(F.sequence(F.col("_pos") - ahead, F.col("_pos") + back)))
        on = _null_safe([F.col(c) for c in series], [F.col(f"_s{i}") for i in range(len(series))])
        sent = (reach.join(lookers, on & (F.col("_by") == F.col("_p")) & (F.col("_to") != F.col("_block")))
                .dropDuplicates([*series, "_pos", "_to"])
                .withColumn("_block", F.col("_to")).withColumn("_halo", F.lit(True)))
        whole = whole.unionByName(sent.select(*whole.columns))
    w = Window.partitionBy(*series, "_block").orderBy("_pos")
    out = whole
    for n, c in running.items():
        here = F.sum(F.when(~F.col("_halo"), F.col(c))).over(w.rowsBetween(Window.unboundedPreceding, 0))
        # null as long as no value was met, as in SQL
        out = out.withColumn(n, F.coalesce(F.col(f"_before_{n}") + here, here, F.col(f"_before_{n}")))
    for n, (c, k) in lags.items():
        out = out.withColumn(n, F.lag(c, k).over(w))
    for n, c in rolling.items():
        out = out.withColumn(n, F.sum(c).over(w.rowsBetween(-preceding, following)))
    return out.filter(~F.col("_halo")).select(*df.columns, *running, *lags, *rolling)


def frequency_index(df: DataFrame, key: str, *, out: str = "index", rows_per_block: int = 1 << 20) -> DataFrame:
    """Dictionary of a key of any width: ``key, n, index`` with index 0 for the
    most frequent value, ties in ascending order (M1's order); nulls have none.

    Values are counted with partial aggregation, ranked by ranges of (count,
    value) and numbered by the sizes of the earlier ranges; no label list
    reaches the driver.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "value_counts")
    ranked = positions(counts, [F.col("n").desc(), F.col(key).asc()], rows_per_block=rows_per_block)
    return ranked.select(key, "n", F.col("_pos").alias(out))


def encode(df: DataFrame, dictionary: DataFrame, key: str, *, index: str = "index",
           hot_share: int = 1024) -> DataFrame:
    """``df`` with the index of its key; unseen and null values get the extra
    last index, as the string indexer's ``keep`` does.

    A value that holds a large share of the rows is no hot key: values of more
    than 1 in ``hot_share`` rows of the dictionary's data (so fewer than
    ``hot_share`` values) go to every task, the rest meet by a shuffle.
    """
    cols = df.columns
    total, size = dictionary.agg(F.sum("n"), F.count(F.lit(1))).first()
    names = dictionary.select(F.col(key).alias("_k"), F.col(index).alias("_i"), (F.col("n") * hot_share > F.lit(total or 0)).alias("_hot"))
    hot = F.broadcast(names.filter("_hot").select(F.col("_k").alias("_hk"), F.col("_i").alias("_hi")))
    tried = df.join(hot, F.col(key) == F.col("_hk"), "left")
    met = tried.filter(F.col("_hi").isNotNull()).select(*cols, F.col("_hi").alias(index))
    rest = (tried.filter(F.col("_hi").isNull()).select(*cols)
            .join(names.filter("NOT _hot"), F.col(key) == F.col("_k"), "left")
            .select(*cols, F.coalesce("_i", F.lit(size)).alias(index)))
    return met.unionByName(rest)


def wide_one_hot(encoded: DataFrame, dictionary: DataFrame, keep: Sequence[str], *, index: str = "index",
                 slot: str = "slot", value: str = "value") -> DataFrame:
    """M2 over a wide key: one (row, slot, 1.0) per row; the last slot, of
    unseen values, is dropped.  The vector's width is the dictionary's size."""
    size = dictionary.count()
    return encoded.filter(F.col(index) < size).select(*keep, F.col(index).alias(slot), F.lit(1.0).alias(value))

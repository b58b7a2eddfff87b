"""Sinks (K1-K5).

``single_file`` writers move the finished rows to one task (the work before
stays spread out) and are meant for small, bounded results (a panel of states x years, a run log); everything else
writes one file per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = (),
                  mode: str = "overwrite") -> None:
    """K1: parquet, optionally partitioned (partition pruning on read)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, *,
                   path: str | None = None) -> DataFrame:
    """K1, co-located: a parquet table of the session catalog, hash-dealt by
    ``keys`` into ``buckets`` sorted files, and that table read back.

    Tables written with the same ``buckets`` and keys of the same type join
    (:func:`quality.colocated_join`) and aggregate on them without a shuffle; the one
    shuffle is paid here.  A bucket is read by one task, so choose
    ``buckets`` by the table's size and keys whose rows are few (an order's lines); a
    key that may hold a large share of the rows is to be reduced first or left
    to a shuffled join, whose skew Spark splits at run time.  ``path``: an
    external table there, else in the warehouse.
    """
    w = (df.repartition(buckets, *[F.col(f"`{k}`") for k in keys]).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, *keys).sortBy(*keys))
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def write_csv(df: DataFrame, path: str, *, header: bool = True, single_file: bool = False,
              partition_by: Sequence[str] = (), files_per_partition: int | None = None,
              mode: str = "overwrite") -> None:
    """K2/K4/K5: CSV with header; ``single_file`` for small results only;
    ``partition_by`` writes one directory per value (``Year=2013/``).

    By default every task writes a file for each value it holds (many small
    files on a wide cluster).  ``files_per_partition=k`` first spreads each
    value over k tasks by a hash of the row, giving at most k files per value
    while a large value is still written in parallel.
    """
    if single_file:
        df = df.repartition(1)
    elif partition_by and files_per_partition:
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                        F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], spread)
    w = df.write.mode(mode).option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_text_lines(df: DataFrame, path: str, *, single_file: bool = True,
                     mode: str = "overwrite") -> None:
    """K3: one string column -> text lines."""
    if single_file:
        df = df.repartition(1)
    df.write.mode(mode).text(path)


def write_sheets(df: DataFrame, path: str, *, sheet: str, preamble: Sequence[str],
                 columns: Sequence[str] | None = None, header: Sequence[str] | None = None,
                 files_per_sheet: int | None = None, rows_per_file: int = 1_000_000,
                 order_by: Sequence[str] = (), together: Sequence[str] | None = None) -> None:
    """Write raw sheets: every file starts with the ``preamble`` lines and a
    header line (``header`` names, repeats allowed), then CSV rows.

    A sheet value is spread over ``files_per_sheet`` files (rows assigned by
    a hash of the ``together`` columns, all written ones by default; unless
    given, as many files as the largest sheet needs at ``rows_per_file``),
    each its own directory
    ``_sheet=<value>/_part=<k>/``, so one large sheet is written by several
    tasks instead of one.  Each (sheet, part) group is co-located and written
    in line order, so every file begins with its preamble; data rows follow
    in ``order_by`` order (columns of ``df``, not necessarily written).
    """
    columns = list(columns or [c for c in df.columns if c != sheet])
    header = list(header or columns)
    head_text = ",".join(f'"{h}"' if "," in h else h for h in header)
    fixed = [*preamble, head_text]
    cols = [F.col(f"`{c}`") for c in columns]
    if files_per_sheet is None:
        largest = df.groupBy(sheet).count().agg(F.max("count")).first()[0] or 1
        files_per_sheet = -(-largest // rows_per_file)
    spread = [F.col(f"`{c}`") for c in together] if together else cols
    part = F.pmod(F.xxhash64(*spread), F.lit(files_per_sheet))
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(order_by)]
    data = df.select(F.col(sheet).alias("_sheet"), part.alias("_part"),
                     F.lit(len(fixed)).alias("_ord"), *keys,
                     F.to_csv(F.struct(*cols)).alias("value"))
    tops = (data.select("_sheet", "_part").distinct()
            .select("_sheet", "_part",
                    F.posexplode(F.array(*[F.lit(t) for t in fixed])).alias("_ord", "value")))
    lines = data.unionByName(tops, allowMissingColumns=True)
    sort_keys = [f"_k{i}" for i in range(len(order_by))]
    (lines.repartition("_sheet", "_part")
     .sortWithinPartitions("_sheet", "_part", "_ord", *sort_keys)
     .select("_sheet", "_part", "value")
     .write.mode("overwrite").partitionBy("_sheet", "_part").text(path))

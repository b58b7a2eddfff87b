"""Structured Streaming form of the price table.

In the original setting one cleaned sales file arrives per year.  Here the
folder of yearly CSV files is a file stream: each micro-batch applies the
same size filter and code exclusion, and a stateful aggregation keeps
(sum of prices, count) per (state, year).  The state is bounded by
states x years, so ``complete`` output mode is cheap; every batch rewrites
the small result table through ``foreachBatch``.  Offsets and state live in a
checkpoint folder under the shared ``spark.checkpoint.dir``, so a restarted
query resumes without reprocessing or losing files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit import schemas as S
from panelkit.operators import clean


def price_stream(spark: SparkSession, source_dir: str, *,
                 thresholds: Mapping[str, float] | None = None,
                 codes: Sequence[int] = S.ADJUSTMENT_CODES,
                 files_per_batch: int | None = None) -> DataFrame:
    """Streaming DataFrame of running (price_sum, n) per (State, Year)."""
    reader = spark.readStream.schema(S.POWER_FILE_SCHEMA).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = clean.cast_columns(reader.csv(source_dir), ints=["Year"])
    th = {"Customers": S.MIN_CUSTOMERS, "Sales_MWh": S.MIN_SALES} if thresholds is None else thresholds
    rows = clean.exclude_codes(clean.size_filter(rows, th), "Utility_ID", codes)
    return rows.groupBy("State", "Year").agg(
        F.sum("Price_Per_kWh").alias("price_sum"),
        F.count("Price_Per_kWh").alias("n"))


def with_average(df: DataFrame) -> DataFrame:
    """(State, Year, Avg_kWh) from the running sums (NULL when no price)."""
    return df.select("State", "Year", F.try_divide(F.col("price_sum"), F.col("n")).alias("Avg_kWh"))


def run_until_caught_up(stream: DataFrame, out_path: str, checkpoint: str):
    """Process every file present now (possibly in several micro-batches),
    then stop; the latest complete result is written to ``out_path``."""
    def write(batch: DataFrame, _epoch: int) -> None:
        with_average(batch).write.mode("overwrite").parquet(out_path)

    q = (stream.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q

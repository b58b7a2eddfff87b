"""Helpers shared by the corpus operators.

Conventions: a *word* is a maximal run of bytes other than space and
``\\x09-\\x0D``; word and shingle hashes are 64 bit.  Every helper works on
the columns it is given by name and ignores all others.
"""

from __future__ import annotations

import ctypes
import functools
import sys
import types
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelkit.session import materialize

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def read_documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The named columns of ``documents``."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*cols)


def words_of(text: str | None) -> list[bytes]:
    """Words of one text; ``bytes.split`` cuts at exactly the six ASCII
    white-space bytes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hash_words(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hash per word, equal in every process."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix)."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX1
    h = h ^ (h >> np.uint64(27))
    h = h * _MIX2
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; empty when there are fewer."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    acc = words[:m].copy()
    for k in range(1, n):
        acc *= _MULT
        acc ^= acc >> np.uint64(29)
        acc += words[k:k + m]
    return mix64(acc)


def bounded_batches(spark: SparkSession, max_bytes: int = 2 << 20) -> None:
    """Bound the Arrow batches of this session by bytes, so that the memory of
    a Python task does not depend on how long texts are.  A batch is held
    several times (buffers of the JVM and of Python, Python objects)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(max_bytes))


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes.  A task begins without the
    caches of other operators and gives back what it no longer needs."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(tidy(run), schema)


def tidy(run):
    """``run`` over a task's batches in a worker that holds the caches of
    ``run``'s own module only, and returns free memory when it ends: a worker
    lives on beside the executor's heap while other stages run."""

    @functools.wraps(run)
    def tidied(batches):
        worker_store(run.__module__)
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def release_memory() -> None:
    """Give free memory that Arrow and the C library keep back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def text_batches(batches, *cols):
    """(batch, python lists of the named columns) per Arrow batch."""
    for batch in batches:
        yield batch, *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in cols)


def worker_store(owner: str) -> dict:
    """A dict for caches of ``owner`` (a module) that only save time.  It lives
    in this Python process (a Spark worker is reused by later tasks) until
    another owner asks: caches of several operators never add up."""
    module = sys.modules.setdefault("_corpus_worker", types.ModuleType("_corpus_worker"))
    stores = module.__dict__.setdefault("stores", {})
    if owner not in stores:
        stores.clear()
        stores[owner] = {}
    return stores[owner]


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """The text with A-Z in lower case, everything else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key's text modulo ``n`` (null key: null)."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(n))


def bounded_sample(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """At most about ``max_rows`` rows, chosen by a hash of ``key`` (the same
    rows on every run).  Counts the rows first; for fitting models only."""
    n = df.count()
    if n <= max_rows:
        return df
    keep = int(max_rows / n * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < keep)


def gapless_slots(rows: DataFrame, group: Sequence[str], slot: str = "slot",
                  rows_per_bucket: int = 4096, chunk: int = 1 << 16) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without gaps.

    ``rows`` should be narrow (all its columns order the rows; none may be an
    array or map).  Equal rows are first reduced to one with a count, so
    copies never meet in one task.  Each group is dealt into hash buckets of
    bounded size; a bucket's first number is the row count of the group's
    earlier buckets, and rows are numbered inside their bucket.  The order is
    (bucket, columns): pseudo-random but the same on every run.  ``rows`` is
    computed once; an empty input gives an empty result.
    """
    cols = rows.columns
    packed = materialize(rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")), "packed")
    buckets = max(1, -(-packed.count() // rows_per_bucket))
    b = packed.withColumn("_b", F.pmod(F.xxhash64(*cols), F.lit(buckets)))
    keys = [*group, "_b"]
    earlier = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = (b.groupBy(*keys).agg(F.sum("_n").alias("_t"))
            .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                    F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(*keys).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    numbered = b.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    on = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = c if on is None else on & c
    placed = numbered.join(sums, on).withColumn("_first", F.col("_first") + F.col("_off"))
    # a repeated row takes consecutive numbers, unrolled in bounded chunks
    chunks = placed.withColumn("_c", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk))))
    lo = F.col("_first") + F.col("_c") * chunk
    hi = F.col("_first") + F.least(F.col("_n"), (F.col("_c") + 1) * chunk) - 1
    return chunks.select(*cols, F.explode(F.sequence(lo, hi)).alias(slot))

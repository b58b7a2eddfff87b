"""Session and scratch-location helpers.

Scratch output (round trips, run logs, stream checkpoints) always goes under
the shared folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (unit tests on a laptop) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "panelkit",
                  shuffle_partitions: int = 8, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        d = None
    return d.rstrip("/") if d else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only if unset."""
    d = _configured_checkpoint_dir(spark)
    if d:
        try:
            if spark.sparkContext.getCheckpointDir() is None:
                spark.sparkContext.setCheckpointDir(d)
        except Exception:
            pass
        return d
    # local runs only (tests): nothing configured, so make one and register
    # it with the context; later calls find it through getCheckpointDir()
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="panelkit-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return _configured_checkpoint_dir(spark) or d


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str, *, keep: bool = False) -> str:
    """A fresh, never reused path under the shared checkpoint folder; removed
    with the innermost :func:`scratch_scope`, unless ``keep``."""
    path = f"{ensure_checkpoint_dir(spark)}/panelkit-scratch/{name}-{uuid.uuid4().hex}"
    if _scopes and not keep:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch output made inside once the block ends (after the
    results have been consumed; queries are lazy and read it until then)."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, name: str = "materialized", *, keep: bool = False) -> DataFrame:
    """Compute a reused intermediate once and continue from a copy written as
    parquet under the shared checkpoint folder.

    Every later branch reads the written copy instead of re-running the scans,
    and a lost executor cannot force the upstream work to run again.  The panel
    operators write aggregates bounded by the key space (states x years); the
    corpus operators and those over long series also write rows.  (A reliable ``checkpoint()`` of an
    unpersisted DataFrame would compute the plan twice: once for the eager
    action and once more to write the checkpoint.)
    """
    path = scratch_path(df.sparkSession, name, keep=keep)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_all(*dfs: DataFrame, names: tuple[str, ...] = ()) -> list[DataFrame]:
    """:func:`materialize` several independent intermediates as concurrent
    Spark jobs (one driver thread each), so their scans and shuffles share
    the executors instead of running back to back."""
    from concurrent.futures import ThreadPoolExecutor

    names = tuple(names) + tuple(f"materialized{i}" for i in range(len(names), len(dfs)))
    if len(dfs) <= 1:
        return [materialize(df, n) for df, n in zip(dfs, names)]
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(materialize, dfs, names))


def cluster_settings(largest_shuffle_bytes: int, total_cores: int, *,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the biggest shuffle.

    In the panel jobs the line items are reduced in every task before they
    are shuffled; the corpus operators shuffle up to about four times their
    input.  Start with enough shuffle partitions that
    each holds ``target_partition_bytes`` (and at least a few waves of the
    cluster's cores); AQE then coalesces small ones, splits skewed ones and
    switches joins to broadcast only when a side is measured small.
    """
    parts = max(2 * total_cores, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }

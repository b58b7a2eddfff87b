"""Vector columns: validity, packing and collapsing of equal vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, only finite components, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unpack(raw, dim: int) -> np.ndarray:
    """Rows of packed little-endian doubles as one matrix."""
    return np.frombuffer(b"".join(raw), "<f8").reshape(-1, dim)


def unit(m: np.ndarray) -> np.ndarray:
    # scaled first, so that squares of very large or small components hold
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def packed(df: DataFrame, key: str, vector: str, label: str | None = None, keep: int = 1) -> DataFrame:
    """Usable vectors with equal ones pre-combined: ``raw, label, ids, n``.

    ``ids`` has the ``keep`` smallest keys met in one Arrow batch (null keys
    left out), ``n`` the rows; a vector that fills a third of the table is
    reduced inside every batch before anything is shuffled.
    """
    rows = df.filter(usable(vector)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"),
        (F.col(label).cast("string") if label else F.lit(None).cast("string")).alias("label"))

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            seen: dict[tuple, list] = {}
            at = {n: batch.schema.get_field_index(n) for n in ("id", "v", "label")}
            vs = batch.column(at["v"])
            flat = np.asarray(vs.flatten(), dtype="<f8") + 0.0  # -0.0 and 0.0 are one value
            ends = np.asarray(vs.offsets) - vs.offsets[0].as_py()
            for i, (d, lab) in enumerate(zip(batch.column(at["id"]).to_pylist(),
                                             batch.column(at["label"]).to_pylist())):
                x = seen.setdefault((flat[ends[i]:ends[i + 1]].tobytes(), lab), [0, []])
                x[0] += 1
                if d is not None:
                    x[1].append(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.binary()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array([sorted(set(x[1]))[:keep] for x in seen.values()], pa.list_(pa.int64())),
                 pa.array([x[0] for x in seen.values()], pa.int64())], names=["raw", "label", "ids", "n"])

    return rows.mapInArrow(run, "raw binary, label string, ids array<long>, n long")

"""Sharding by weighted rendezvous hashing.

Every shard draws a score ``-ln(u) / weight`` for a record, ``u`` being a
uniform number hashed from (record key, shard); the record goes to the shard
with the smallest score.  A shard's scores do not depend on the other shards,
so a new shard only takes records over (into itself), and removing one only
deals out its own.  The choice is one JVM expression per row: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelkit.llm.common import gapless_slots


def rendezvous_shard(key: Sequence[str], weights: Sequence[float], salt: str = "") -> Column:
    """Shard number (int) of a record by its key columns.

    ``weights[j]`` is the relative share of shard ``j`` (positive).  A null
    key column counts as a value of its own (all-null keys share one shard);
    equal keys always share a shard; score ties go to the smaller shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    scores = []
    for j, w in enumerate(weights):
        parts = [x for k in key for x in (F.col(k), F.col(k).isNull())]
        h = F.xxhash64(F.lit(salt), F.lit(j), *parts)
        u = (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        scores.append(F.struct((-F.log(u) / F.lit(float(w))).alias("score"), F.lit(j).alias("shard")))
    return F.array_min(F.array(*scores))["shard"] if len(scores) > 1 else F.lit(0)


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    weights: Sequence[float] = (1.0,) * 16,
                    grown: Sequence[float] | None = None) -> DataFrame:
    """Place every document and number the rows of each shard.

    Returns one row per input row: ``doc_id, size, text_crc32, shard, slot``
    and, when ``grown`` gives the weights of a larger layout, ``grown_shard``.
    Size is the text's UTF-8 bytes plus 1 (null text: 1, crc of the empty
    text); slots run from 0 in each shard, in the same order on every run.
    Null keys, empty texts, repeated rows and other columns are allowed; an
    empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    cols = [F.col(key).alias("doc_id"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body).alias("text_crc32"),
            rendezvous_shard([key], weights).cast("int").alias("shard")]
    if grown is not None:
        cols.append(rendezvous_shard([key], grown).cast("int").alias("grown_shard"))
    return gapless_slots(docs.select(*cols), ["shard"])

"""Substring dedup: words covered by word windows that occur elsewhere.

Each shard holds a compressed FM-index; documents stream through backward
search, whose matching statistics give the repeated intervals.  So that a
document need not visit every shard, text is cut at *minimizers*: the smallest
hash among the 8-word grams of a window.  Equal windows have equal minimizers,
so the shard of a window's minimizer is the only one that can hold a copy.

1. One pass collects the minimizers of each text.  Only those that occur in
   two texts, or twice in one, can belong to a repeated window.
2. Texts with such minimizers are cut into segments (runs of windows of one
   minimizer).  Equal segments are one entry with a mark that it occurs again.
   A minimizer inside a widely shared passage has as many different
   neighbourhoods as texts hold the passage.  Where there are more than
   ``most_neighbours``, its segments are cut on into windows, dealt by window
   hash, so that no shard has to hold them all (at most ``window - 7`` rows a
   segment).
3. Each shard indexes its distinct segments and searches those that occur
   once; the others are repeated as a whole.
4. Intervals come back to their texts.  Equal texts are one throughout; all
   windows of a text with copies are repeated.

Texts and segments are told apart by 128-bit digests.  Words are 64-bit hashes:
two windows that differ count as equal only where every word in which they
differ collides.  A segment has at most ``MOST_WINDOWS`` windows; a longer run
(periodic text) is several, and each window lies in one of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkit.llm.common import gram_hashes, hash_words, map_batches, text_batches, words_of
from panelkit.llm.fmindex import FMIndex, repeated_windows
from panelkit.session import materialize

GRAM = 8
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
MOST_WINDOWS = 256  # of a segment; only periodic text has longer runs of one minimizer
_SEGMENT = "key long, k binary, start long, windows int, cid binary, words binary"


def minimizers(words: np.ndarray, window: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(smallest gram hash of each window, all gram hashes)."""
    g = gram_hashes(words, gram)
    w = window - gram + 1
    if len(g) < w:
        return np.empty(0, np.uint64), g
    low, k = g, 1
    while 2 * k <= w:
        low = np.minimum(low[:-k], low[k:])
        k *= 2
    n = len(g) - w + 1
    return (np.minimum(low[:n], low[w - k:w - k + n]) if k < w else low), g


def sha_of(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _digest(b: bytes) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(b)


def _key_of(digest: bytes) -> int:
    """64 bits of a digest, to deal by."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _profiles(rows: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            n, sha, mins, own = [], [], [], []
            for t in texts:
                words = words_of(t)
                low, grams = minimizers(hash_words(words), window)
                values = np.unique(low)
                known, count = np.unique(grams, return_counts=True)
                again = values[np.isin(values, known[count > 1])] if len(values) else values
                n.append(len(words))
                sha.append(sha_of(words))
                mins.append(values.view(np.int64))
                own.append(again.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha),
                 pa.array(mins, pa.list_(pa.int64())), pa.array(own, pa.list_(pa.int64()))],
                names=["doc_id", "k", "n_words", "sha", "mins", "own"])

    return map_batches(
        rows, run, "doc_id long, k binary, n_words long, sha string, mins array<long>, own array<long>")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """Segments of the wanted minimizers of each text."""

    def run(batches):
        for _, ks, bodies, wanted in text_batches(batches, "k", "text", "wanted"):
            rows = []
            for k, t, want in zip(ks, bodies, wanted):
                words = hash_words(words_of(t))
                low, _ = minimizers(words, window)
                edges = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1], [True]]))
                keep = np.isin(low[edges[:-1]].view(np.int64), np.array(want, np.int64))
                for first, end in zip(edges[:-1][keep].tolist(), edges[1:][keep].tolist()):
                    for s in range(first, end, MOST_WINDOWS):
                        e = min(end, s + MOST_WINDOWS)
                        body = words[s:e + window - 1].tobytes()
                        rows.append((int(low[s:s + 1].view(np.int64)[0]), k, s, e - s, _digest(body), body))
            yield _segments(rows)

    return texts.select("k", "text", "wanted").mapInArrow(run, _SEGMENT)


def _segments(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 6
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=["key", "k", "start", "windows", "cid", "words"])


def _split(segments: DataFrame, window: int) -> DataFrame:
    """Each window of the segments as a segment keyed by its own hash."""

    def run(batches):
        for _, ks, starts, counts, bodies in text_batches(batches, "k", "start", "windows", "words"):
            rows = []
            for k, s, n, body in zip(ks, starts, counts, bodies):
                for i in range(n):
                    part = body[8 * i:8 * (i + window)]
                    h = _digest(part)
                    rows.append((_key_of(h), k, s + i, 1, h, part))
            yield _segments(rows)

    return segments.mapInArrow(run, _SEGMENT)


def _search(window: int):
    """Repeated windows of the segments of one shard, as runs."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bodies = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
        alphabet, codes = np.unique(np.concatenate(bodies), return_inverse=True)
        cuts = np.cumsum([len(b) for b in bodies])[:-1]
        texts = [c + 1 for c in np.split(codes, cuts)]
        gap = np.zeros(1, np.int64)
        index = FMIndex(np.concatenate([x for t in texts for x in (t, gap)]), len(alphabet) + 1)
        once = np.flatnonzero(~pdf["again"].to_numpy())
        hits = repeated_windows(index, [texts[i] for i in once], window)
        out = []
        for i, hit in zip(once, hits):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            out += [(pdf["key"].iat[i], pdf["cid"].iat[i], a, b - 1) for a, b in zip(edge[::2], edge[1::2])]
        return pd.DataFrame(out, columns=["key", "cid", "first", "last"]).astype(
            {"key": "int64", "first": "int64", "last": "int64"})

    return run


def _merge(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35,
                   shard_words: int = 400_000, most_neighbours: int = 1000) -> DataFrame:
    """Words of each document that lie in a window occurring elsewhere.

    Returns one row per input row: ``doc_id, n_words, n_removed, kept_sha256,
    spans`` (word intervals ``start, stop`` to remove, merged, stop
    exclusive).  Windows are judged on the input.  A null or empty text has no
    words; texts of fewer than ``window`` words are never touched; equal texts
    (and repeated rows) count as occurrences of each other.  Null keys are
    allowed; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("k"),
                       F.col(text).alias("text"))
    profiles = materialize(_profiles(rows, window), "profiles")
    texts = materialize(
        profiles.groupBy("k").agg(F.min(F.struct("doc_id", "n_words", "mins", "own")).alias("r"),
                                  F.count(F.lit(1)).alias("copies"))
        .select("k", "copies", "r.*"), "texts")
    every = texts.select("k", "doc_id", F.explode("mins").alias("m"))
    suspect = (every.groupBy("m").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("m")
               .union(texts.select(F.explode("own").alias("m"))).distinct().withColumnRenamed("m", "_m"))
    wanted = (every.join(suspect, F.col("m") == F.col("_m"))
              .groupBy("k", "doc_id").agg(F.collect_list("m").alias("wanted"))
              .select(F.col("k").alias("_k"), F.col("doc_id").alias("_d"), "wanted"))
    bodies = materialize(rows.join(wanted, (F.col("k") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")))
                         .select("k", "text", "wanted"), "bodies")
    found = materialize(_cut(bodies, window), "segments")
    busy = (found.select("key", "cid").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("c"))
            .filter(F.col("c") > most_neighbours).select(F.col("key").alias("_key")))
    busy = materialize(busy, "busy")
    segments = found.join(busy, F.col("key") == F.col("_key"), "left_anti").unionByName(
        _split(found.join(busy, F.col("key") == F.col("_key"), "left_semi"), window))
    segments = materialize(segments, "pieces") if not busy.isEmpty() else found
    at = F.xxhash64("k", "start")
    distinct = materialize(
        segments.groupBy("key", "cid").agg(F.first("words").alias("words"), F.first("windows").alias("windows"),
                                           (F.min(at) != F.max(at)).alias("again")), "distinct_segments")
    total = distinct.agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
    shards = max(1, -(-int(total) // shard_words))
    searched = (distinct.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
                .groupBy("shard").applyInPandas(_search(window), "key long, cid binary, first long, last long"))
    whole = distinct.filter("again").select("key", "cid", F.lit(0).cast("long"), (F.col("windows") - 1).cast("long"))
    runs = materialize(searched.union(whole), "runs").select(
        F.col("key").alias("_key"), F.col("cid").alias("_cid"), "first", "last")
    spans = (segments.select("key", "cid", "k", "start")
             .join(runs, (F.col("key") == F.col("_key")) & (F.col("cid") == F.col("_cid")))
             .groupBy("k").agg(F.collect_set(F.struct(
                 (F.col("start") + F.col("first")).alias("start"),
                 (F.col("start") + F.col("last") + window).alias("stop"))).alias("spans"))
             .withColumnRenamed("k", "_k"))

    def remove(batches):
        for _, ks, texts_, found_ in text_batches(batches, "k", "text", "spans"):
            sha, gone, spans_ = [], [], []
            for t, f in zip(texts_, found_):
                words, merged = words_of(t), _merge((x["start"], x["stop"]) for x in f)
                kept, last = [], 0
                for s, e in merged:
                    kept += words[last:s]
                    last = e
                kept += words[last:]
                sha.append(sha_of(kept))
                gone.append(len(words) - len(kept))
                spans_.append([{"start": s, "stop": e} for s, e in merged])
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.binary()), pa.array(sha, pa.string()),
                                              pa.array(gone, pa.int64()), pa.array(spans_, span)],
                                             names=["k", "kept", "gone", "cut"])

    changed = (bodies.select("k", "text").dropDuplicates(["k"]).join(spans, F.col("k") == F.col("_k"))
               .select("k", "text", "spans")
               .mapInArrow(remove, "k binary, kept string, gone long, cut array<struct<start:long,stop:long>>"))
    copied = texts.filter((F.col("copies") > 1) & (F.col("n_words") >= window)).select(
        "k", F.lit(_EMPTY_SHA).alias("kept"), F.col("n_words").alias("gone"),
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("stop"))).alias("cut"))
    result = copied.union(changed.join(copied.select("k"), "k", "left_anti").select(*copied.columns)) \
        .withColumnRenamed("k", "_k")
    none = F.array().cast("array<struct<start:long,stop:long>>")
    return (profiles.select("doc_id", "k", "n_words", "sha").join(result, F.col("k") == F.col("_k"), "left")
            .select("doc_id", "n_words", F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("kept", "sha").alias("kept_sha256"), F.coalesce("cut", none).alias("spans")))

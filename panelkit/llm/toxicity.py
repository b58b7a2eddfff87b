"""Toxicity by FTRL-proximal logistic regression.

Features are hashed word unigrams, bigrams and one-word skip-grams of the
whole text (lower case, ASCII punctuation as white space), and the stems
(first five bytes) of longer words, so that inflected forms of a word add up;
each counts as present or not.  FTRL-proximal learns with a rate per coordinate and an L1
term that keeps most weights at exactly zero, so the model is a short list of
(index, weight) that every task gets with its code.

Fitting runs on a bounded sample (``max_train_rows``) of the labelled rows, in
one task that returns the nonzero weights; no text or feature reaches the
driver.
Scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.llm.common import bounded_batches, bounded_sample, hash_words, map_batches, mix64, text_batches, tidy

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANK = bytes.maketrans(_MARKS, b" " * len(_MARKS))
_SECOND = np.uint64(0x9E3779B97F4A7C15)
_SKIP = np.uint64(0xD6E8FEB86659FD93)
_STEM = 5


def feature_ids(text: str | None, bits: int) -> np.ndarray:
    """Hashed n-grams, skip-grams and stems of one text, repeats included."""
    plain = (text or "").lower().encode("utf-8", "replace").translate(_BLANK).split()
    words = hash_words(plain)
    stems = mix64(hash_words([w[:_STEM] for w in plain if len(w) > _STEM]) ^ _SKIP)
    pairs = mix64(words[:-1] * _SECOND + words[1:])
    skips = mix64(words[:-2] * _SKIP + (words[2:] ^ _SECOND))
    return (np.concatenate([mix64(words), pairs, skips, stems]) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class ToxicityModel:
    """Nonzero weights, bias and hash width; ``constant`` replaces the score
    where there was nothing to learn from."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int
    constant: float | None = None

    def scorer(self):
        if self.constant is not None:
            return lambda text: self.constant
        dense = np.zeros(1 << self.bits, np.float32)
        dense[self.index] = self.weight

        def score(text):
            ids = feature_ids(text, self.bits)
            ids = np.unique(ids[dense[ids] != 0])
            return float(1 / (1 + np.exp(-np.clip(self.bias + dense[ids].sum(dtype=np.float64), -30, 30))))

        return score


def ftrl(examples: list[tuple[np.ndarray, int]], bits: int, alpha: float = 2.0, beta: float = 1.0,
         l1: float = 6.0, l2: float = 0.0, epochs: int = 5) -> tuple[np.ndarray, float]:
    """(weights, bias) after ``epochs`` passes in the given order."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0
    for _ in range(epochs):
        for ids, y in examples:
            zi, ni = z[ids], n[ids]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + root) / alpha + l2))
            b = -zb / ((beta + np.sqrt(nb)) / alpha)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -30, 30))) - y
            z[ids] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
            n[ids] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * b
            nb += g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w, -zb / ((beta + np.sqrt(nb)) / alpha)


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, key: str = "doc_id",
                 text: str = "text", label: str = "toxic", bits: int = 20, max_train_rows: int = 12_000,
                 **rates) -> ToxicityModel:
    """Fit on labelled documents.

    ``labels`` gives ``label`` (0/1, null: not labelled) by ``key``; a key
    labelled more than once counts as its largest label.  ``usable`` (on the
    key) says which keys may be learned from.  At most about
    ``max_train_rows`` keys are used, chosen by hash.  Null keys never match.
    With no label, or one class only, every score is that class's rate (0.5
    without any label: nothing is known).
    """
    marked = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_y")) \
        .filter(F.col("_y").isNotNull() & F.col("_key").isNotNull())
    if usable is not None:
        marked = marked.withColumnRenamed("_key", key).filter(usable).withColumnRenamed(key, "_key")
    marked = bounded_sample(marked.groupBy("_key").agg(F.max("_y").alias("_y")), "_key", max_train_rows)

    def features(batches):
        for _, keys, ys, texts in text_batches(batches, "_key", "_y", "_text"):
            ids = [np.unique(feature_ids(t, bits)).astype("<u4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array([str(k) for k in keys]), pa.array(ys, pa.int32()),
                                              pa.array(ids, pa.binary())], names=["k", "y", "ids"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        ys = pdf["y"].unique().tolist()
        if len(ys) == 1:
            return pd.DataFrame({"i": [-2], "w": [float(ys[0])]})
        # an order that depends on the rows alone and mixes the classes
        mixed = mix64(hash_words([k.encode() for k in pdf["k"]]))
        order = sorted(range(len(pdf)), key=lambda r: (mixed[r], pdf["ids"].iat[r]))
        examples = [(np.frombuffer(pdf["ids"].iat[r], "<u4"), int(pdf["y"].iat[r])) for r in order]
        w, b = ftrl(examples, bits, **rates)
        keep = np.flatnonzero(w)
        return pd.DataFrame({"i": [-1, *keep], "w": [b, *w[keep]]})

    # the sample is bounded by max_train_rows, so it may be broadcast, and
    # its features fit one task
    rows = (docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
            .join(F.broadcast(marked), F.col("_id") == F.col("_key"))
            .select("_key", "_y", "_text"))
    model = (map_batches(rows, features, "k string, y int, ids binary")
            .withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(learn, "i long, w double").collect())
    found = {r["i"]: r["w"] for r in model}
    if -1 not in found:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), 0.0, bits, found.get(-2, 0.5))
    bias = found.pop(-1)
    index = np.array(sorted(found), np.int64)
    return ToxicityModel(index, np.array([found[i] for i in index.tolist()], np.float32), bias, bits)


def toxicity_score(model: ToxicityModel, text: str = "text") -> Column:
    """Probability of label 1 for a text column (null scores as empty)."""

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        yield from tidy(lambda texts: (pd.Series([score(t) for t in part], dtype="float64") for part in texts))(parts)

    return run(F.col(text))

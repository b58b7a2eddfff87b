"""Language identification by averaged hashed subword embeddings.

Every 2-, 3- and 4-byte gram of the lower-cased text (runs of white space as
one space, a space at both ends) is hashed to an embedding; the mean goes
through a linear softmax.  Embeddings and weights are trained together by
stochastic gradient descent in numpy, in one task, on a bounded sample.  Because the model
is linear behind the mean, prediction folds both into one table of scores by
gram.  A held-back part of the sample sets the temperature of the softmax and
the score below which a prediction is marked as rejected.
"""

from __future__ import annotations

import pickle
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.llm.common import bounded_batches, hash_words, mix64
from panelkit.session import materialize

UNKNOWN = "und"
_M = np.uint32(0x9E3779B1)


def gram_ids(text: str, bits: int) -> np.ndarray:
    """Hashed byte grams of one text."""
    b = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "replace").split()) + b" ", np.uint8)
    b = b.astype(np.uint32)
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    four = (three[:-1] << np.uint32(8)) | b[3:]
    shift = np.uint32(32 - bits)
    return np.concatenate([((two + np.uint32(0x51ED)) * _M) >> shift,
                           ((three ^ np.uint32(0x3C6EF372)) * _M) >> shift,
                           ((four ^ (four >> np.uint32(15))) * _M) >> shift]).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """``table[gram, language]`` holds folded scores."""

    languages: list[str]
    bits: int
    table: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        ids = gram_ids(text, self.bits)
        return self.table[ids].sum(axis=0, dtype=np.float64) / max(1, len(ids)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); no letter: ``und``, 0, rejected."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.languages[k], float(p[k]), bool(p[k] < self.threshold)


def train(texts: list[str], langs: list[str], bits: int = 16, dim: int = 16, epochs: int = 4,
          rate: float = 2.0, calibration_share: float = 0.2, precision: float = 0.99) -> LanguageModel:
    """Fit on texts in the given order; the last part calibrates."""
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], bits)
    y = np.array([names.index(x) for x in langs])
    if len(names) == 1:
        return LanguageModel(names, bits, np.zeros((1 << bits, 1), np.float32), np.zeros(1))
    n_fit = max(1, int(len(texts) * (1 - calibration_share)))
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32)
    out, bias = np.zeros((dim, len(names))), np.zeros(len(names))

    examples = []
    for t, c in zip(texts[:n_fit], y[:n_fit]):
        lines = [x for x in t.split("\n") if has_letter(x)]
        parts = [t] + ([lines[rng.integers(len(lines))]] if len(lines) > 1 else [])
        for part in parts:  # the whole text, and one of its lines for short inputs
            ids, n = np.unique(gram_ids(part, bits), return_counts=True)
            examples.append((ids, (n / n.sum()).astype(np.float32), c))
    steps, total = 0, epochs * len(examples)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            ids, share, c = examples[i]
            hidden = share @ emb[ids]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[c] -= 1
            lr = rate * (1 - steps / total)
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= 0.05 * lr * p
            emb[ids] -= (lr * 10) * np.outer(share, back).astype(np.float32)
            steps += 1
    model = LanguageModel(names, bits, (emb @ out).astype(np.float32), bias)
    held = [(model.logits(t), c) for t, c in zip(texts[n_fit:], y[n_fit:]) if has_letter(t)]
    if held:
        z, c = np.array([x for x, _ in held]), np.array([k for _, k in held])

        def probabilities(t):
            e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
            return e / e.sum(axis=1, keepdims=True)

        grid = np.geomspace(0.05, 20, 40)
        model.temperature = float(min(grid, key=lambda t: -np.log(
            probabilities(t)[np.arange(len(c)), c] + 1e-12).mean()))
        p = probabilities(model.temperature)
        top = p.max(axis=1)
        order = np.argsort(-top)
        right = np.cumsum((p.argmax(axis=1) == c)[order]) / np.arange(1, len(c) + 1)
        good = np.flatnonzero(right >= precision)
        model.threshold = float(top[order][good[-1]]) if len(good) else 1.0
    return model


def _per_language(rows: DataFrame, max_rows: int, least: int) -> DataFrame:
    """About ``max_rows`` of ``rows`` at most, with about ``least`` of each
    language ``l`` or all of a rarer one, by the hash ``h``."""
    counts = materialize(rows.groupBy("l").agg(F.count(F.lit(1)).alias("_n")), "languages")
    kinds, n = counts.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not n or n <= max_rows:
        return rows
    floor = min(least, max_rows // kinds)
    wanted = floor + (max_rows - floor * kinds) / n * F.col("_n")
    share = counts.select(F.col("l").alias("_l"), (F.least(wanted / F.col("_n"), F.lit(1.0)) * (1 << 30)).alias("_keep"))
    return (rows.join(share, F.col("l") == F.col("_l"))
            .filter(F.pmod(F.xxhash64(F.lit("sample"), "h"), F.lit(1 << 30)) < F.col("_keep"))
            .select(*rows.columns))


def fit_language_model(docs: DataFrame, usable: Column | None = None, key: str = "doc_id",
                       text: str = "text", lang: str = "lang", max_train_rows: int = 5000,
                       least: int = 200, **options) -> LanguageModel:
    """Fit on at most about ``max_train_rows`` documents with a language and a
    letter in the text, chosen per language by a hash of key and text: about
    ``least`` of each language (all of a rarer one; an equal share of the rows
    where the languages are too many for that), the rest in proportion.
    ``usable`` (on the key) says which may be learned from.  Without any, the
    model knows no language and answers ``und``."""
    rows = docs if usable is None else docs.filter(usable)
    rows = rows.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")) \
        .filter(F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}")) \
        .withColumn("h", F.xxhash64("k", "t"))
    bounded_batches(docs.sparkSession)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        # an order that depends on the rows alone and mixes the languages
        pdf = pdf.assign(m=mix64(hash_words([f"{h}".encode() for h in pdf["h"]])), k=pdf["k"].fillna(""))
        pdf = pdf.sort_values(["m", "k", "l"], kind="stable")
        return pd.DataFrame({"model": [pickle.dumps(asdict(train(pdf["t"].tolist(), pdf["l"].tolist(), **options)))]})

    # the sample is bounded by max_train_rows and is fitted in one task
    model = (_per_language(rows, max_train_rows, least).withColumn("_one", F.lit(0))
             .groupBy("_one").applyInPandas(learn, "model binary").first())
    return LanguageModel(**pickle.loads(model[0])) if model else train([], [], **options)


def identify(model: LanguageModel, text: str = "text") -> Column:
    """Struct ``lang_pred, score, rejected`` for a text column."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(parts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in parts], columns=["lang_pred", "score", "rejected"])

    return run(F.col(text))

"""Harmonic packing of token sequences.

A piece of ``n`` tokens belongs to class ``k = capacity // n``: ``k`` of them
always fit in one sequence, whatever their exact lengths, so each class fills
its sequences with a fixed count of ``k`` pieces and no sequence has to know
about any other.  Plain harmonic packing wastes up to ``1 / (k + 1)`` of a
sequence of class ``k``.  As documents may be cut, a piece that would waste
more than ``slack`` gives off a part of exactly ``capacity // (k + 1)`` tokens
(a perfect fit one class down) until the remainder fits its class tightly.

Only the last sequence of a class can be short of pieces.  There are at most
``2 * sqrt(capacity)`` classes, so these leftovers are bounded whatever the
input (fewer than ``capacity`` tokens a class); they are packed together by
first fit on falling length in one small task.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelkit.llm.common import gapless_slots, map_batches, text_batches, worker_store
from panelkit.session import materialize

PIECE_SCHEMA = ("doc_id long, text_crc32 long, start long, length long, ids_crc32 long, "
                "doc_tokens long, k int")


def cut(tokens: int, capacity: int, slack: float) -> Iterator[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document."""
    start = 0
    while tokens - start >= capacity:
        yield start, capacity, 1
        start += capacity
    while start < tokens:
        rest = tokens - start
        k = capacity // rest
        if k * rest >= (1 - slack) * capacity:
            yield start, rest, k
            return
        part = capacity // (k + 1)
        yield start, part, capacity // part
        start += part


class _Places(dict):
    """Word -> number; an unseen word gets the next number and is listed."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word):
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


def _grown(x: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` values and a quarter more."""
    if size <= len(x):
        return x
    out = np.empty(size + size // 4, x.dtype)
    out[:len(x)] = x
    return out


class WordTokenizer:
    """Token ids of texts through a cache of words.

    Valid for tokenizers that never join text across ASCII white space, drop
    it, and fold ASCII case (``word_bpe_49k.json`` does all three): the ids of
    a text are then the ids of its words in order.  The first ``max_words``
    words met (at most 8 ids each on average) are kept by the Python worker
    for its later tasks (frequent words come early); other words are encoded
    where they occur.
    """

    def __init__(self, path: str, max_words: int = 600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_words = max_words
        self.places = _Places()
        self.starts = np.empty(0, np.uint32)
        self.lengths = np.empty(0, np.uint32)
        self.flat = np.empty(0, np.uint32)
        self.words = self.used = 0

    @classmethod
    def of_worker(cls, path: str) -> "WordTokenizer":
        store = worker_store(__name__)
        if (cls.__name__, path) not in store:
            store[(cls.__name__, path)] = cls(path)
        return store[(cls.__name__, path)]

    def _ids_of(self, words: list[str]) -> list[list[int]]:
        """Ids of each word.  Words of letters alone are one unit to the
        tokenizer, so many can go through it as one text."""
        plain = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        found: dict[str, list[int]] = {}
        if plain:
            e = self.tokenizer.encode(" ".join(plain), add_special_tokens=False)
            units = np.array(e.word_ids, np.int64)
            if len(units) and units[-1] == len(plain) - 1:
                cuts = np.searchsorted(units, np.arange(len(plain) + 1)).tolist()
                ids = e.ids
                found = {w: ids[i:j] for w, i, j in zip(plain, cuts, cuts[1:])}
            else:  # a letter that the tokenizer splits at
                other = words
        if other:
            found.update((w, e.ids) for w, e in zip(
                other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)))
        return [found[w] for w in words]

    @staticmethod
    def _apart(core: str) -> bool:
        """Whether marks after these letters are tokenized by themselves: not
        where the last letter is normalized into several characters, as a
        combining one at the end joins the marks."""
        return core.isalpha() and len(unicodedata.normalize("NFC", core[-1]).lower()) == 1

    def _learn(self) -> None:
        """Append the ids of the words listed as unseen.  A word of letters
        followed by marks is its letters' ids and then its marks' ids, where
        the tokenizer parts them."""
        parts, new = [], {}
        for w in self.places.fresh:
            t = w.decode("utf-8", "replace")
            core = t.rstrip(".,;:!?")
            if len(core) < len(t) and self._apart(core):
                parts.append((core, t[len(core):]))
                new[core] = new[t[len(core):]] = None
            else:
                parts.append((t,))
                new[t] = None
        known = {}
        for t in new:
            n = self.places.get(t.encode("utf-8", "replace"), self.words)
            if n < self.words:
                known[t] = self.flat[self.starts[n]:self.starts[n] + self.lengths[n]].tolist()
        fresh = [t for t in new if t not in known]
        known.update(zip(fresh, self._ids_of(fresh)))
        ids = [known[p[0]] if len(p) == 1 else known[p[0]] + known[p[1]] for p in parts]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        n, m = self.words + len(ids), self.used + int(sizes.sum())
        self.starts, self.lengths = _grown(self.starts, n), _grown(self.lengths, n)
        self.flat = _grown(self.flat, m)
        ends = self.used + np.cumsum(sizes)
        self.starts[self.words:n], self.lengths[self.words:n] = ends - sizes, sizes
        self.flat[self.used:m] = np.fromiter(chain.from_iterable(ids), np.uint32, m - self.used)
        self.words, self.used = n, m

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        # special tokens are matched by case, everything else is folded
        parts = [(r if b"<|" in r else r.lower()).split() for r in raw]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        places, words, used = self.places, self.words, self.used
        at = np.fromiter(map(places.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        if places.fresh:
            self._learn()
        lengths = self.lengths[at].astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.starts[at] - (ends - lengths), lengths)]
        if self.words > self.max_words or self.used > 8 * self.max_words:  # full: keep what was there before
            for w in places.fresh:
                del places[w]
            self.words, self.used = words, used
        places.fresh = []
        cuts = np.concatenate([[0], ends])[np.cumsum(counts)]
        return np.split(ids, cuts[:-1])


def _runs(texts: list[str | None], chars: int = 1 << 19) -> Iterator[slice]:
    """Slices of a batch with about ``chars`` characters each (one text at
    least), which bounds the memory of a step."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def token_pieces(docs: DataFrame, key: str, text: str, tokenizer_path: str, end_id: int,
                 capacity: int, slack: float) -> DataFrame:
    """Tokenize whole texts and cut them; one row per piece (no token ids)."""

    def run(batches):
        tokenizer = WordTokenizer.of_worker(tokenizer_path)
        for batch, keys, texts in text_batches(batches, "doc_id", "text"):
            out = []
            for part in _runs(texts):
                for d, t, ids in zip(keys[part], texts[part], tokenizer.encode(texts[part])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    crc = zlib.crc32((t or "").encode("utf-8", "replace"))
                    out += [(d, crc, s, n, zlib.crc32(ids[s:s + n].tobytes()), len(ids), k)
                            for s, n, k in cut(len(ids), capacity, slack)]
            cols = list(zip(*out)) or [()] * 7
            types = [pa.int64()] * 6 + [pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "text_crc32", "start", "length", "ids_crc32", "doc_tokens", "k"])

    return map_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")),
                       run, PIECE_SCHEMA)


def _first_fit(capacity: int):
    """Pack the bounded leftovers: (bin, offset) per piece, falling length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "slot"], ascending=[False, True, True, True])
        room: list[int] = []
        open_from = 0
        bins, offsets = [], []
        for n in pdf["length"]:
            while open_from < len(room) and room[open_from] == 0:
                open_from += 1
            for b in range(open_from, len(room)):
                if room[b] >= n:
                    break
            else:
                b = len(room)
                room.append(capacity)
            bins.append(b)
            offsets.append(capacity - room[b])
            room[b] -= n
        return pdf.drop(columns="_one").assign(bin=bins, offset=offsets)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                   end_id: int = 2, capacity: int = 4096, slack: float = 0.02) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset`` (``offset`` runs gapless from 0 in each
    sequence, sequence ids from 0).  A null or empty text is the end id alone.
    Keys may be null or repeated (equal rows are packed one by one); other
    columns are ignored; an empty table gives an empty result.
    ``read_sequences`` joins the token ids back on.
    """
    pieces = token_pieces(docs, key, text, tokenizer_path, end_id, capacity, slack)
    slots = materialize(gapless_slots(pieces, ["k"]), "packed_pieces")
    # full sequences per class: at most 2 * sqrt(capacity) rows
    full = slots.groupBy("k").agg(F.floor(F.count(F.lit(1)) / F.col("k")).alias("_full"))
    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    base = full.select(F.col("k").alias("_k"), "_full",
                       F.coalesce(F.sum("_full").over(before), F.lit(0)).alias("_base"))
    placed = (slots.join(F.broadcast(base), F.col("k") == F.col("_k"))
              .withColumn("bin", F.floor(F.col("slot") / F.col("k"))))
    ahead = Window.partitionBy("k", "bin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = (placed.filter(F.col("bin") < F.col("_full"))
             .withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
             .select(*out, (F.col("_base") + F.col("bin")).cast("long").alias("sequence_id"),
                     F.col("offset").cast("long").alias("offset")))
    loose = (placed.filter(F.col("bin") >= F.col("_full")).select(*out, "slot", F.lit(0).alias("_one"))
             .groupBy("_one").applyInPandas(
                 _first_fit(capacity),
                 "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                 "slot long, bin long, offset long"))
    end = base.agg(F.sum("_full")).first()[0] or 0  # the loose sequences follow the full ones
    loose = loose.select(*out, (F.col("bin") + F.lit(end)).cast("long").alias("sequence_id"), "offset")
    return whole.unionByName(loose)


def read_sequences(docs: DataFrame, pieces: DataFrame, tokenizer_path: str, key: str = "doc_id",
                   text: str = "text", end_id: int = 2) -> DataFrame:
    """The token ids of packed sequences: ``sequence_id, ids array<int>``.

    Joins each piece to its document and tokenizes again, so that packing
    itself moves no tokens.  Document keys must be unique and not null here.
    """
    spans = pieces.select("doc_id", F.struct("start", "length", "sequence_id", "offset").alias("p")) \
        .groupBy("doc_id").agg(F.collect_list("p").alias("pieces"))
    joined = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).join(spans, "doc_id")

    def run(batches):
        tokenizer = WordTokenizer.of_worker(tokenizer_path)
        for _, texts, places in text_batches(batches, "text", "pieces"):
            rows = []
            for t, ps in zip(texts, places):
                ids = np.append(tokenizer.encode([t])[0], np.uint32(end_id))
                rows += [(p["sequence_id"], p["offset"], ids[p["start"]:p["start"] + p["length"]].tolist())
                         for p in ps]
            s, o, i = list(zip(*rows)) or ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(o, pa.int64()),
                                              pa.array(i, pa.list_(pa.int32()))], names=["sequence_id", "offset", "ids"])

    parts = map_batches(joined, run, "sequence_id long, offset long, ids array<int>")
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))

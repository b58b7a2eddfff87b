"""Personal data: fixed patterns, then bootstrapped contextual extraction.

One pass over the texts finds the *base* entities (mail addresses, IP
addresses, card and phone numbers) and every other identifier-like token
(a digit or ``@`` in it), each with its lexical context.

Base entities are the seeds.  A pattern is a context: the two words before, or
the word on each side, whole, digits folded.  An instance is what stands in a
pattern's slot: a token, or between the words of a two-sided pattern also a run
of two; of any length and made of any characters, without the punctuation at
its ends.  Patterns and instances (distinct strings) form a graph; rounds
alternate between

* patterns: those that ``support`` trusted instances vouch for are looked up
  in all texts, so that everything in their slots counts; their confidence for
  a kind is the confidence of their instances as that kind, summed, over
  (distinct instances + ``prior``);
* instances: noisy-or over their accepted patterns (seeds stay at 1); those
  that are not identifier-like are looked up in all texts for their other
  contexts.

What stands in an accepted pattern, and overlaps no base entity, becomes a span
of its kind.  Counting distinct instances keeps copies of a document from
voting repeatedly.  A lookup sends a bitmap of fixed size to every task and
joins what passes it exactly, so its cost does not depend on how many patterns
or instances there are.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelkit.llm.common import map_batches, text_batches, worker_store
from panelkit.session import materialize

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
# possessive forms that start at digit runs: same matches, linear on long runs
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKENS = re.compile(r"\S+")
_LIKELY = re.compile(r"[0-9@]")
_EDGES = "\"'.,;:!?()[]{}<>|*#$%&=-"
_FOLD = re.compile(r"[0-9]+")


def _emails(text):
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        left = at
        while left > done and text[left - 1] in _LOCAL:
            left -= 1
        m = _DOMAIN.match(text, at + 1) if left < at else None
        if m:
            yield left, m.end()
            done = m.end()
        at += 1


def _ips(text):
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _cards(text):
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text):
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    out = []
    if text:
        if "@" in text:
            out += [(0, s, e) for s, e in _emails(text)]
        if _DIGIT.search(text):
            out += [(1, s, e) for s, e in _ips(text)]
            out += [(2, s, e) for s, e in _cards(text)]
        if "+" in text:
            out += [(3, s, e) for s, e in _phones(text)]
    return out


def join_spans(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _folded(w: str) -> str:
    return _FOLD.sub("0", w.strip(_EDGES).lower())


def _word(w: str, known: dict | None = None) -> str:
    """Folded word; ``known`` keeps up to 131072 short ones for the worker."""
    if known is None or len(w) > 64:
        return _folded(w)
    x = known.get(w)
    if x is None:
        if len(known) >= 1 << 17:
            known.clear()
        x = known[w] = _folded(w)
    return x


class _Tokens:
    """White-space tokens of a text, for the words around a span."""

    def __init__(self, text: str):
        self.text = text
        self.spans = [m.span() for m in _TOKENS.finditer(text)]
        self.starts = [s for s, _ in self.spans]
        self.known = worker_store(__name__).setdefault("folded words", {})

    def word(self, i: int) -> str:
        if 0 <= i < len(self.spans):
            s, e = self.spans[i]
            return _word(self.text[s:e], self.known)
        return ""

    def context(self, start: int, end: int) -> tuple[str, str]:
        """The two patterns of a span; empty where words are missing.  What is
        glued to a span, up to the next punctuation, counts as a word."""
        i = bisect.bisect_right(self.starts, start) - 1
        j = bisect.bisect_left(self.starts, end) - 1
        one, two = self._glued(start - 1, self.spans[i][0] - 1, -1), self.word(i - 1)
        if not one:
            one, two = two, self.word(i - 2)
        right = self._glued(end, self.spans[j][1], 1) or self.word(j + 1)
        return _patterns(two, one, right)

    def _glued(self, at: int, stop: int, step: int) -> str:
        text = self.text
        while at != stop and text[at] in _EDGES:
            at += step
        last = at
        while last != stop and text[last] not in _EDGES:
            last += step
        return _word(text[at:last] if step > 0 else text[last + 1:at + 1])


def _patterns(two: str, one: str, right: str) -> tuple[str, str]:
    return f"{two} {one} _" if one and two else "", f"{one} _ {right}" if one and right else ""


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    t = text[start:end]
    return start + len(t) - len(t.lstrip(_EDGES)), end - (len(t) - len(t.rstrip(_EDGES)))


class _Taken:
    """Base spans merged, to be asked about spans of rising start."""

    def __init__(self, base):
        self.runs, self.at = [], 0
        for s, e in sorted((s, e) for _, s, e in base):
            if self.runs and s < self.runs[-1][1]:
                self.runs[-1][1] = max(e, self.runs[-1][1])
            else:
                self.runs.append([s, e])

    def overlaps(self, start: int, end: int) -> bool:
        while self.at < len(self.runs) and self.runs[self.at][1] <= start:
            self.at += 1
        return any(s < end for s, _ in self.runs[self.at:self.at + 1])


def occurrences(text: str | None, base: list[tuple[int, int, int]]) -> list[dict]:
    """Base entities and other identifier-like tokens with their contexts."""
    if not text or not (base or "@" in text or _DIGIT.search(text)):
        return []
    tokens, taken = _Tokens(text), _Taken(base)
    spots = [(k, s, e) for k, s, e in base]
    for start, end in tokens.spans:
        if not _LIKELY.search(text, start, end):
            continue
        s, e = _trimmed(text, start, end)
        if s < e and not taken.overlaps(s, e):
            spots.append((-1, s, e))
    out = []
    for k, s, e in spots:
        p, q = tokens.context(s, e)
        out.append({"kind": k, "start": s, "stop": e, "item": text[s:e].lower(), "p": p, "q": q})
    return out


BITS = 1 << 20


def _bit(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "replace")) % BITS


def _bitmap(strings: DataFrame, column: str):
    """Bits of the crc32 of all values: one fixed-size array."""
    bit = F.crc32(F.col(column).cast("binary")) % BITS
    rows = strings.select(bit.alias("b")).groupBy(F.floor(F.col("b") / 32768).alias("k")).agg(
        F.bitmap_construct_agg((F.col("b") % 32768).cast("long")).alias("bits")).collect()  # at most BITS / 32768 rows
    out = np.zeros(BITS // 32768, "V4096")
    for r in rows:
        out[r.k] = bytes(r.bits).ljust(4096, b"\0")
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def slots(text: str | None, ones, patterns, items) -> list[dict]:
    """Tokens, and runs of two, that may stand in one of ``patterns`` or be one
    of ``items`` (bitmaps; ``ones`` has the patterns' words before the slot)."""
    if not text:
        return []
    tokens, out, taken = _Tokens(text), [], None
    one = two = ""
    for i in range(len(tokens.spans)):
        two, one = one, tokens.word(i - 1)
        framed = bool(one) and ones[_bit(one)]
        if not framed and items is None:
            continue
        for n in (1, 2):
            if i + n > len(tokens.spans):
                break
            s, e = _trimmed(text, tokens.spans[i][0], tokens.spans[i + n - 1][1])
            if s >= e:
                continue
            p, q = _patterns(two if n == 1 else "", one, tokens.word(i + n))
            item = text[s:e].lower()
            if (framed and (p and patterns[_bit(p)] or q and patterns[_bit(q)])) or \
                    (items is not None and items[_bit(item)]):
                taken = taken or _Taken(base_spans(text))
                if not taken.overlaps(s, e):
                    out.append({"kind": -1, "start": s, "stop": e, "item": item, "p": p, "q": q})
    return out


def lookup(docs: DataFrame, patterns: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, stop, item, pattern`` of everything in the
    slot of one of ``patterns`` (``pattern``), and of all contexts of ``items``
    (``item``); once for equal documents."""
    ones = _bitmap(patterns.select(F.regexp_extract("pattern", r"(\S+) _", 1).alias("one")), "one")
    wanted = _bitmap(patterns, "pattern")
    known = None if items.isEmpty() else _bitmap(items, "item")

    def run(batches):
        occ_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                                       ("item", pa.string()), ("p", pa.string()), ("q", pa.string())]))
        for batch, texts in text_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([slots(t, ones, wanted, known) for t in texts], occ_type)],
                names=["doc_id", "text_hash", "occ"])

    found = map_batches(docs, run, f"doc_id long, text_hash long, occ {_OCC}").select(
        "doc_id", "text_hash", F.explode("occ").alias("o"))
    each = found.select("doc_id", "text_hash", "o.start", "o.stop", "o.item",
                        F.explode(F.array("o.p", "o.q")).alias("pattern")).filter("pattern <> ''").distinct()
    each = materialize(each, "maybe")
    sure = each.join(patterns.select(F.col("pattern").alias("_p")), F.col("pattern") == F.col("_p"), "left_semi")
    if known is not None:
        sure = sure.union(each.join(items.select(F.col("item").alias("_i")), F.col("item") == F.col("_i"), "left_semi"))
    return materialize(sure.distinct(), "slots")


_OCC = "array<struct<kind:int,start:int,stop:int,item:string,p:string,q:string>>"


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Base results and occurrences of every text, in one pass."""

    def run(batches):
        occ_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                                       ("item", pa.string()), ("p", pa.string()), ("q", pa.string())]))
        for batch, texts in text_batches(batches, "text"):
            spans = [base_spans(t) for t in texts]
            counts = [[sum(k == i for k, _, _ in s) for s in spans] for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([join_spans(s) for s in spans], pa.string()),
                 pa.array([occurrences(t, s) for t, s in zip(texts, spans)], occ_type)],
                names=["doc_id", "text_hash", *(f"n_{k}" for k in KINDS), "base", "occ"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).alias("text"))
    return map_batches(rows, run, f"doc_id long, text_hash long, {counts}, base string, occ {_OCC}")


def learn_patterns(found: DataFrame, docs: DataFrame, rounds: int = 3, support: int = 5, prior: float = 1.0,
                   accept: float = 0.8) -> tuple[DataFrame, DataFrame | None]:
    """``pattern, kind, confidence`` of the accepted patterns, and what
    :func:`lookup` found (None: no lookup was needed)."""
    occ = found.select(F.explode("occ").alias("o")).select("o.*")
    first = materialize(
        occ.select("kind", "item", F.explode(F.array("p", "q")).alias("pattern")).filter("pattern <> ''")
        .groupBy("pattern", "item").agg(F.max("kind").alias("kind")), "edges")
    seeds = first.filter("kind >= 0").groupBy("item").agg(F.max("kind").alias("_kind")) \
        .select(F.col("item").alias("_item"), "_kind", F.lit(1.0).alias("_conf"))
    likely = first.select("item").distinct()
    trusted, edges, seen, met = seeds, first, None, None
    patterns = first.select("pattern", F.lit(0).alias("kind"), F.lit(1.0).alias("confidence")).filter("false")

    def strength():
        return (edges.select("pattern", "item").join(trusted, F.col("item") == F.col("_item"))
                .groupBy("pattern", F.col("_kind").alias("kind")).agg(F.sum("_conf").alias("trust"))
                .filter(F.col("trust") >= support))

    def confident(vouched):
        sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("items")).withColumnRenamed("pattern", "_p")
        return (vouched.join(sizes, F.col("pattern") == F.col("_p"))
                .withColumn("confidence", F.col("trust") / (F.col("items") + prior))
                .filter(F.col("confidence") >= accept).select("pattern", "kind", "confidence"))

    for _ in range(rounds):
        # more instances only lower a confidence: patterns below it now stay below
        asked = materialize(confident(strength()).select("pattern").distinct(), "asked")
        new_items = trusted.select(F.col("_item").alias("item")).join(likely, "item", "left_anti")
        if seen is not None:
            fresh = asked.join(seen.withColumnRenamed("pattern", "_p"), F.col("pattern") == F.col("_p"), "left_anti")
        else:
            fresh = asked
        if not fresh.isEmpty() or not new_items.isEmpty():
            more = lookup(docs, fresh, new_items)
            met = more if met is None else met.union(more)
            edges = materialize(
                first.union(met.select("pattern", "item", F.lit(-1).alias("kind")))
                .groupBy("pattern", "item").agg(F.max("kind").alias("kind")), "edges")
            likely = materialize(likely.union(new_items).distinct(), "looked_up")
            seen = asked if seen is None else materialize(seen.union(fresh), "seen")
        # accepted only with all that stands in their slots
        full = strength() if seen is None else strength().join(
            seen.withColumnRenamed("pattern", "_p"), F.col("pattern") == F.col("_p"), "left_semi")
        patterns = materialize(confident(full), "patterns")
        if patterns.isEmpty():
            break
        doubt = F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999)))))
        known = seeds.select(F.col("_item").alias("_s"))
        new = (edges.filter("kind < 0").select(F.col("pattern").alias("_p"), "item")
               .join(patterns, F.col("_p") == F.col("pattern"))
               .join(known, F.col("item") == F.col("_s"), "left_anti")
               .groupBy("item", "kind").agg((1 - doubt).alias("conf"))
               .groupBy("item").agg(F.max(F.struct("conf", "kind")).alias("b"))
               .select(F.col("item").alias("_item"), F.col("b.kind").alias("_kind"), F.col("b.conf").alias("_conf")))
        trusted = materialize(seeds.union(new), "instances")
    return patterns, met


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text", **learning) -> DataFrame:
    """Personal data of every document.

    Returns one row per input row: ``doc_id, text_hash, n_email, n_ip, n_card,
    n_phone, base`` (base spans as ``kind:start:end`` joined by commas),
    ``added`` (array of structs ``kind, start, stop`` from contexts) and
    ``spans`` (base and added, joined likewise, in order).  Spans from contexts
    may be of any length and overlap each other (a token and a run of two), but
    no base span.  A null or empty text has none; keys may be null or repeated;
    very long texts and tokens are read whole; other columns are ignored; an
    empty table gives an empty result.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).alias("text"))
    found = materialize(scan(rows, "doc_id", "text"), "found")
    patterns, met = learn_patterns(found, rows, **learning)
    best = patterns.groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("b")) \
        .select(F.col("pattern").alias("_p"), F.col("b.kind").alias("_kind"), F.col("b.confidence").alias("_conf"))
    loose = (found.select("doc_id", "text_hash", F.explode("occ").alias("o")).filter("o.kind < 0")
             .select("doc_id", "text_hash", "o.start", "o.stop", F.explode(F.array("o.p", "o.q")).alias("pattern")))
    if met is not None:
        loose = loose.union(met.select("doc_id", "text_hash", "start", "stop", "pattern"))
    added = (loose.join(best, F.col("pattern") == F.col("_p"))
             .groupBy("doc_id", "text_hash", "start", "stop").agg(F.max(F.struct("_conf", "_kind")).alias("b"))
             .groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.sort_array(F.collect_list(
                 F.struct(F.col("b._kind").alias("kind"), "start", "stop"))).alias("added")))
    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    return (found.join(added, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
            .withColumn("added", F.coalesce("added", none))
            .withColumn("spans", F.when(F.size("added") == 0, F.col("base")).otherwise(_all_spans()))
            .select("doc_id", "text_hash", *(f"n_{k}" for k in KINDS), "base", "added", "spans"))


def _all_spans() -> Column:
    """Base and added spans in order, joined."""
    base = F.transform(F.filter("occ", lambda o: o["kind"] >= 0),
                       lambda o: F.struct(o["kind"].alias("kind"), o["start"].alias("start"), o["stop"].alias("stop")))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(
        F.array_sort(F.concat(base, F.col("added"))),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
                              s["stop"].cast("string"))), ",")


def masked(text: Column, added: Column) -> Column:
    """The text with every base and added span replaced by its kind."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, more: pd.Series) -> pd.Series:
        out = []
        for t, m in zip(texts, more):
            spans = base_spans(t)
            if m is not None:
                spans += [(x["kind"], x["start"], x["stop"]) for x in m]
            if spans:
                parts, at = [], 0
                for s, e, k in sorted((s, e, k) for k, s, e in spans):
                    if e > at:  # overlapping kinds: the rest of the later span goes too
                        parts += [t[at:s]] if s >= at else []
                        parts += [f"[{KINDS[k].upper()}]"] if s >= at else []
                        at = e
                t = "".join(parts) + t[at:]
            out.append(t)
        return pd.Series(out, dtype="object")

    return run(text, added)

"""MinHash near-duplicates by an inverted join on signature coordinates.

A document's set is its distinct 5-word shingles.  Each distinct set gets a
signature of ``coordinates`` min-hashes and is posted under its (coordinate,
value) pairs.  Two sets of similarity s share each coordinate with chance s;
pairs that share fewer than ``matches`` of them are passed over.  With 48
coordinates and 21 matches a pair at 0.75 is missed with a chance of about
1e-6.

* Prefix: values that occur once cannot collide.  A set with fewer than
  ``matches`` other values has no partner; of the rest, a pair with enough
  collisions must share one of the rarest ``live - matches + 1`` values, so
  only these are posted.  Values of widely shared passages are the most
  frequent ones and mostly fall out.
* Skip: inside a posting, sets are ordered by size and only sizes within the
  threshold's ratio are merged.
* Groups: emitting all pairs of a large group of near copies would be
  quadratic.  First every set is tried against its best posting leader only
  (the leader is the set whose values are the most frequent, as the original
  of many copies is); confirmed links make components.  Then postings are
  merged for pairs of *different* components alone, in blocks of bounded
  size.  Candidates are confirmed inside the block, where a link makes
  further pairs of the two components superfluous: no link that could join
  two components is left out, and a block emits fewer links than it has
  components.

Every link is confirmed by exact set similarity (64-bit shingle hashes).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelkit.llm.common import gram_hashes, hash_words, map_batches, text_batches
from panelkit.llm.graph import components
from panelkit.session import materialize

SHINGLE = 5


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes (A-Z lower-cased); the whole sequence
    where there are fewer words than ``size``."""
    words = hash_words((text or "").encode("utf-8", "surrogatepass").lower().split())
    return np.unique(gram_hashes(words, min(size, len(words)))) if len(words) else words


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Minimum of each of ``coordinates`` hash functions; the low bits hold
    the coordinate, so that values of different coordinates never meet."""
    rng = np.random.default_rng(17)
    a = rng.integers(0, 1 << 63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, coordinates, np.uint64)
    low = np.full(coordinates, np.iinfo(np.uint64).max)
    for s in range(0, len(shingles), 8192):
        part = shingles[s:s + 8192]
        for k in range(coordinates):
            m = ((part ^ b[k]) * a[k]).min()
            if m < low[k]:
                low[k] = m
    mark = np.uint64(63)
    return ((low & ~mark) | np.arange(coordinates, dtype=np.uint64)).view(np.int64)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted distinct arrays."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _profiles(docs: DataFrame, key: str, text: str, coordinates: int) -> DataFrame:
    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            sets = [shingle_set(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([signature(s, coordinates) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n", "digest", "sig"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).alias("text"))
    return map_batches(rows, run, "doc_id long, text_hash long, n long, digest binary, sig array<long>")


def _postings(reps: DataFrame, matches: int) -> DataFrame:
    """``token, node, weight, mask``: the posted prefix of every set that can
    have a partner.  ``weight`` sums the frequencies of its values; bit k of
    ``mask`` says that the value of coordinate k is posted."""
    tokens = reps.select("node", F.explode("sig").alias("token"))
    frequent = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1") \
        .withColumnRenamed("token", "_t")
    live = (tokens.join(frequent, F.col("token") == F.col("_t"))
            .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("live"))
            .filter(F.size("live") >= matches))
    prefix = F.transform(F.slice("live", F.lit(1), F.size("live") - matches + 1), lambda x: x["token"])
    return (live.withColumn("prefix", prefix)
            .select("node", F.expr("aggregate(live, 0L, (s, x) -> s + x.df)").alias("weight"),
                    F.expr("aggregate(prefix, 0L, (s, x) -> s | shiftleft(1L, cast(x & 63 as int)))").alias("mask"),
                    F.explode("prefix").alias("token"))
            .select("token", "node", "weight", "mask"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets are similar enough."""

    def run(batches):
        for _, a, b, x, y in text_batches(batches, "a", "b", "x", "y"):
            hit = [similar(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, h in zip(a, hit) if h], pa.int64()),
                                              pa.array([v for v, h in zip(b, hit) if h], pa.int64())],
                                             names=["a", "b"])

    left = sets.select(F.col("node").alias("_a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("_b"), F.col("shingles").alias("y"))
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    return map_batches(both.select("a", "b", "x", "y"), run, "a long, b long")


def _size_ok(n: str, m: str, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _leader_pairs(posts: DataFrame, reps: DataFrame, matches: int, percent: int) -> DataFrame:
    """Each set with the posting leader it shares most coordinates with."""
    leader = posts.groupBy("token").agg(F.max(F.struct("weight", "node"))["node"].alias("a")) \
        .withColumnRenamed("token", "_t")
    stars = (posts.join(leader, F.col("token") == F.col("_t")).filter(F.col("a") != F.col("node"))
             .select("a", F.col("node").alias("b")).distinct())
    x = reps.select(F.col("node").alias("_a"), F.col("sig").alias("x"), F.col("n").alias("n"))
    y = reps.select(F.col("node").alias("_b"), F.col("sig").alias("y"), F.col("n").alias("m"))
    shared = F.size(F.array_intersect("x", "y"))
    return (stars.join(x, F.col("a") == F.col("_a")).join(y, F.col("b") == F.col("_b"))
            .filter(_size_ok("n", "m", percent))
            .withColumn("shared", shared).filter(F.col("shared") >= matches)
            .groupBy("b").agg(F.max_by("a", "shared").alias("a")))


_CELL = "token long, i int, j int, own int, node long, label long, n long, mask long, sig array<long>"


def _cells(posts: DataFrame, reps: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Postings that hold several components, dealt into pairs of blocks.

    A posting's largest component ("in") meets the rest only, not itself.
    """
    label = F.coalesce("component", "node")
    tagged = (posts.join(labels.withColumnRenamed("node", "_l"), F.col("node") == F.col("_l"), "left")
              .select("token", "node", "mask", label.alias("label")))
    by_label = tagged.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c"))
    stat = (by_label.groupBy("token").agg(F.sum("c").alias("all"), F.max(F.struct("c", "label")).alias("top"),
                                          F.count(F.lit(1)).alias("labels"))
            .filter("labels > 1")
            .select(F.col("token").alias("_t"), F.col("all"), F.col("top.c").alias("inside"),
                    F.col("top.label").alias("main")))
    small = F.col("all") <= block
    n_in = F.when(small, 1).otherwise(F.ceil(F.col("inside") / block)).cast("int")
    n_out = F.when(small, 0).otherwise(F.ceil((F.col("all") - F.col("inside")) / block)).cast("int")
    dealt = (tagged.join(stat, F.col("token") == F.col("_t"))
             .withColumn("_ni", n_in).withColumn("_no", n_out)
             .withColumn("_in", small | (F.col("label") == F.col("main")))
             .withColumn("own", F.when(F.col("_in"), F.pmod(F.xxhash64("node"), F.col("_ni")))
                         .otherwise(F.col("_ni") + F.pmod(F.xxhash64("node"), F.greatest(F.col("_no"), F.lit(1))))
                         .cast("int")))
    out_from, out_to = F.col("_ni"), F.col("_ni") + F.col("_no") - 1
    partners = (F.when(F.col("_no") == 0, F.array(F.lit(0)))
                .when(F.col("_in"), F.sequence(out_from, out_to))
                .otherwise(F.sequence(F.lit(0), out_to)))
    return (dealt.withColumn("_p", F.explode(partners))
            .select("token", "node", "mask", "label", "own", F.least("own", "_p").alias("i"),
                    F.greatest("own", "_p").alias("j"))
            .join(reps.select(F.col("node").alias("_n"), "n", "sig"), F.col("node") == F.col("_n"))
            .select("token", "i", "j", "own", "node", "label", "n", "mask", "sig"))


class _Lists:
    """Inverted lists of the rows of a cell; ``counts(r)`` merges the lists of
    row ``r`` into its number of shared values with every row."""

    def __init__(self, rows: list[np.ndarray]):
        sizes = np.array([len(x) for x in rows])
        codes = np.unique(np.concatenate(rows), return_inverse=True)[1]
        owner = np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(codes, kind="stable")
        self.members = owner[order]
        ends = np.cumsum(np.bincount(codes))
        starts = np.concatenate([[0], ends[:-1]])
        self.row = np.concatenate([[0], np.cumsum(sizes)])
        self.start, self.size = starts[codes], (ends - starts)[codes]

    def counts(self, r: int) -> np.ndarray:
        part = slice(self.row[r], self.row[r + 1])
        start, size = self.start[part], self.size[part]
        shared = size > 1  # a list of one holds the row itself
        start, size = start[shared], size[shared]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(start - (ends - size), size)
        return np.bincount(self.members[at], minlength=len(self.row) - 1)


def _by_cell(pdf: pd.DataFrame):
    """The cells of a bucket, as dicts of arrays (``at``: row numbers)."""
    cols = {c: pdf[c].to_numpy() for c in ("token", "i", "j", "own", "node", "label", "n", "mask")}
    sig = np.stack(pdf["sig"].to_list())
    order = np.lexsort((cols["node"], cols["j"], cols["i"], cols["token"]))
    key = np.stack([cols[c][order] for c in ("token", "i", "j")])
    edges = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0), [True]]))
    for s, e in zip(edges[:-1], edges[1:]):
        at = order[s:e]
        yield {"at": at, "sig": sig[at], **{c: v[at] for c, v in cols.items()}}


def _candidates(cell: dict, matches: int, percent: int):
    """(row, candidate rows after it) of a cell.

    A pair counts in the one cell whose coordinate is the first that both
    have posted and share, so that no pair is looked at twice.
    """
    n, label, own, mask, sig = (cell[c] for c in ("n", "label", "own", "mask", "sig"))
    across = cell["i"][0] != cell["j"][0]
    here = np.int64(1) << (cell["token"][0] & 63)
    bit = np.int64(1) << np.arange(sig.shape[1], dtype=np.int64)
    lists = _Lists(list(sig)) if len(n) > 48 else None
    for r in range(len(n) - 1):
        at = np.flatnonzero(label[r + 1:] != label[r]) + r + 1
        if not len(at):
            continue
        at = at[lists.counts(r)[at] >= matches] if lists else at[(sig[at] == sig[r]).sum(axis=1) >= matches]
        at = at[100 * np.minimum(n[at], n[r]) >= percent * np.maximum(n[at], n[r])]
        if across:
            at = at[own[at] != own[r]]
        if len(at):
            both = ((sig[at] == sig[r]) * bit).sum(axis=1) & mask[at] & mask[r]
            at = at[(both & -both) == here]
        if len(at):
            yield r, at


def _cross_links(posts: DataFrame, reps: DataFrame, labels: DataFrame, sets: DataFrame, matches: int,
                 percent: int, block: int) -> DataFrame:
    """Links ``a, b`` between different components."""

    def involved(pdf: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(pdf), bool)
        for cell in _by_cell(pdf):
            for r, at in _candidates(cell, matches, percent):
                hit[cell["at"][r]] = True
                hit[cell["at"][at]] = True
        return pdf[hit]

    def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
        bodies, out = pdf["shingles"].tolist(), []
        for cell in _by_cell(pdf):
            shingles = [np.frombuffer(bodies[k], np.uint64) for k in cell["at"]]
            out += _links_of(cell, shingles, matches, percent)
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    # many cells a call; a bucket holds few rows more than its largest cell
    buckets = max(1, -(-posts.count() // 4096))
    bucket = F.pmod(F.xxhash64("token", "i", "j"), F.lit(buckets)).alias("bucket")
    few = materialize(_cells(posts, reps, labels, block).groupBy(bucket).applyInPandas(involved, _CELL), "cells")
    return (few.join(sets.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n")).drop("_n")
            .groupBy(bucket).applyInPandas(confirm, "a long, b long"))


def _links_of(cell: dict, shingles: list[np.ndarray], matches: int, percent: int) -> list[tuple[int, int]]:
    """Confirmed links of a cell, fewer than it has components."""
    label, node = cell["label"].tolist(), cell["node"].tolist()
    root = {x: x for x in label}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    lists, out = None, []
    for r, at in _candidates(cell, matches, percent):
        at = [k for k in at.tolist() if find(label[k]) != find(label[r])]
        sure = len(at) > 8  # one merge of all lists instead of pair by pair
        if sure:
            lists = lists or _Lists(shingles)
            size = np.array([len(shingles[k]) for k in at]) + len(shingles[r])
            common = lists.counts(r)[at]
            at = [k for k, ok in zip(at, 100 * common >= percent * (size - common)) if ok]
        for k in at:
            x, y = find(label[r]), find(label[k])
            if x != y and (sure or similar(shingles[r], shingles[k], percent)):
                root[max(x, y)] = min(x, y)
                out.append((node[r], node[k]))
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75,
                    coordinates: int = 48, matches: int = 21, block: int = 1024) -> DataFrame:
    """Components of documents linked at ``percent`` similarity.

    Returns one row per input row: ``doc_id, n_shingles, component_id, kept``.
    A null or empty text has no shingles and links with nothing; a text of
    fewer than five words is one shingle.  ``component_id`` is the smallest
    key reachable (a null key counts only where its component has no other:
    the component id is then null and the row is not kept); rows of equal key
    are told apart by their sets.  Other columns are ignored; an empty table
    gives an empty result.
    """
    component = F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return _classified(docs, key, text, percent, coordinates, matches, block).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75,
                    coordinates: int = 48, matches: int = 21, block: int = 1024) -> DataFrame:
    """``doc_id, text_hash, rows, shingled``: the one document to keep of each
    component (smallest key; a null key only where there is no other), and
    every document without shingles (all its rows; not ``shingled``).
    ``rows`` counts the input rows of that key and text."""
    rows = materialize(
        _classified(docs, key, text, percent, coordinates, matches, block)
        .groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")), "classified")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "rows")
    best = rows.filter("component is not null").groupBy("component").agg(F.min(order).alias("r"))
    return best.select("r.doc_id", "r.text_hash", "r.rows", F.lit(True).alias("shingled")).union(
        rows.filter("component is null").select("doc_id", "text_hash", "rows", F.lit(False)))


def _classified(docs: DataFrame, key: str, text: str, percent: int, coordinates: int, matches: int,
                block: int) -> DataFrame:
    """``doc_id, text_hash, n, component, lowest`` per row; component is a
    node id, null without shingles."""
    if not 0 < coordinates <= 64:
        raise ValueError("coordinates must be 1 to 64")
    profiles = materialize(_profiles(docs, key, text, coordinates), "profiles")
    # copies of one set are one node
    reps = materialize(
        profiles.filter("n > 0").groupBy("digest").agg(
            F.min(F.struct("doc_id", "text_hash", "n", "sig")).alias("r"), F.min("doc_id").alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "first", F.col("r.doc_id").alias("doc_id"),
                F.col("r.text_hash").alias("text_hash"), F.col("r.n").alias("n"), F.col("r.sig").alias("sig")),
        "sets")
    posts = materialize(_postings(reps, matches), "postings")

    def load(batches):
        for _, node, dig, texts in text_batches(batches, "node", "digest", "text"):
            rows = [(i, s.tobytes()) for i, d, s in zip(node, dig, map(shingle_set, texts)) if digest(s) == d]
            i, s = list(zip(*rows)) or ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(s, pa.binary())],
                                             names=["node", "shingles"])

    wanted = (reps.join(posts.select(F.col("node").alias("_p")).distinct(), F.col("node") == F.col("_p"))
              .select("node", "digest", F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")))
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        F.col(text).alias("text"))
    found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")))
    sets = materialize(
        map_batches(found.select("node", "digest", "text"), load, "node long, shingles binary")
        .dropDuplicates(["node"]), "shingles")

    near = reps.join(posts.select(F.col("node").alias("_p")).distinct(), F.col("node") == F.col("_p"), "left_semi")
    stars = materialize(_leader_pairs(posts, near, matches, percent), "leader_pairs")
    links = materialize(_confirmed(stars, sets, percent), "links")
    labels = materialize(components(links), "components")
    more = materialize(_cross_links(posts, near, labels, sets, matches, percent, block), "cross_links")
    # the components so far stand for their members
    of = labels.select(F.col("node").alias("_n"), "component")
    joined = (more.join(of, F.col("a") == F.col("_n"), "left").select(F.coalesce("component", "a").alias("a"), "b")
              .join(of, F.col("b") == F.col("_n"), "left").select("a", F.coalesce("component", "b").alias("b")))
    second = materialize(components(joined), "merged")
    known = labels.select(F.col("node").alias("_m"))
    so_far = labels.select("node", F.col("component").alias("_c1")).union(
        second.join(known, F.col("node") == F.col("_m"), "left_anti").select("node", F.col("node")))
    final = (so_far.join(second.withColumnRenamed("node", "_n"), F.col("_c1") == F.col("_n"), "left")
             .select(F.col("node").alias("_n"), F.coalesce("component", "_c1").alias("component")))

    named = materialize(reps.select("node", "digest", "first").join(final, F.col("node") == F.col("_n"), "left")
                        .select("digest", "first", F.coalesce("component", "node").alias("component")), "named")
    lowest = named.groupBy(F.col("component").alias("_c")).agg(F.min("first").alias("lowest"))
    of_set = (named.join(lowest, F.col("component") == F.col("_c"))
              .select(F.col("digest").alias("_digest"), "component", "lowest"))
    return (profiles.select("doc_id", "text_hash", "n", "digest")
            .join(of_set, F.col("digest") == F.col("_digest"), "left")
            .select("doc_id", "text_hash", "n", "component", "lowest"))

"""PII, sharding, mixing and packing against brute force on small fixtures,
with nulls, empty and long texts, repeated rows, clashing columns and empty
tables."""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from panelkit.llm import common, mixing, packing, pii, sharding
from panelkit.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, source string, size long, shard string, slot string, k string, _b string"
WORDS = "the quick brown fox jumps over a lazy dog while nobody looks at it".split()


def documents(spark, rows):
    return spark.createDataFrame([(d, t, s, -1, "x", "y", "z", "w") for d, t, s in rows], SCHEMA)


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(WORDS, int(n))), f"s{i % 4}" if i % 7 else None)
            for i, n in enumerate(rng.integers(1, 90, 60))]
    rows += [(100, None, "s1"), (101, "", "s1"), (102, " \t\n", None), (None, "no key", "s0"), (None, "no key", "s0"),
             (103, "same row", "s2"), (103, "same row", "s2"), (104, "long " * 30_000, "s3"),
             (105, "Ünïcode wörd é1 " * 5, "s0")]
    return rows


# --- personal data -------------------------------------------------------

BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for k, p in enumerate(BASE):
        for m in re.finditer(p, text or ""):
            s = m.group()
            digits = re.sub("[^0-9]", "", s)
            if k == 1 and any(int(x) > 255 for x in s.split(".")):
                continue
            if k == 2:
                total = 0
                for i, c in enumerate(reversed(digits)):
                    v = int(c) * (2 if i % 2 else 1)
                    total += v - 9 if v > 9 else v
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if k == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.+- ()é0_5%", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "+1 (017) 555-7713", "10.0.0.256", "1.2.3.4.5.6.7.8", "a@b.c@d.e",
                                 "x@y", "é@q.org", "4929348385146306", "0001.2.3.4", " ", "-", ".", "9"]), max_size=8))
def test_base_spans_on_joined_entities(parts):
    assert pii.base_spans("".join(parts)) == plain_spans("".join(parts))


def test_instances_of_any_length_and_form(spark):
    """In learned contexts: 200 characters, letters only, two words; a long
    word beside the slot; frames that mostly hold other things are dropped."""
    long_id, cue = "x" * 120 + "7" + "y" * 79, "identifier" * 9
    rows = [(i, f"please write to user{i}@mail.org for help", "s") for i in range(30)]
    rows += [(100 + i, f"the {cue} +1 (017) 555-77{i:02d} ends", "s") for i in range(12)]
    rows += [(200 + i, f"they went with u{i}@mail.org again", "s") for i in range(6)]
    rows += [(300 + i, f"they went with {w} again", "s") for i, w in enumerate(WORDS)]
    rows += [(400, f"Please write to {long_id}, for help", "s"), (401, "please write to ("+"secretname) for help", "s"),
             (402, "so write to jane.doe at-host for help", "s"), (403, f"the {cue} nonumber ends", "s"),
             (None, "please write to secretname for help", "s"), (404, "ask secretname today", "s")]
    got = {r.doc_id: r for r in pii.extract(documents(spark, rows)).collect()}
    spans = {d: [(pii.KINDS[x.kind], t[x.start:x.stop]) for x in got[d].added] for d, t, _ in rows}
    assert spans[400] == [("email", long_id)] and spans[401] == [("email", "secretname")]
    assert ("email", "jane.doe at-host") in spans[402] and spans[403] == [("phone", "nonumber")]
    assert spans[None] == [("email", "secretname")] and spans[404] == []
    assert all(spans[300 + i] == [] for i in range(len(WORDS))) and spans[5] == []


def test_instances_vouch_for_new_contexts(spark):
    """Names met in a learned frame make another frame known, which then finds
    names that no seed stands beside."""
    names = [f"name{c}" for c in "abcdefghijkl"]
    rows = [(i, f"please write to user{i}@mail.org for help", "s") for i in range(80)]
    rows += [(100 + i, f"please write to {n} for help", "s") for i, n in enumerate(names)]
    rows += [(200 + i, f"account of {n} closed", "s") for i, n in enumerate(names)] + [(300, "account of newone closed", "s")]
    got = {r.doc_id: r.spans for r in pii.extract(documents(spark, rows)).collect()}
    assert got[300] == "email:11:17" and got[205] == "email:11:16"


def test_base_spans_keep_contexts_away():
    text = "a b x1@y.org-7 c 1.2.3.4.5 d"
    base = pii.base_spans(text)
    merged = pii._Taken(base + [(0, 4, 6), (1, 4, 30)])
    assert merged.runs[0][1] == 30 and merged.overlaps(29, 40) and not merged.overlaps(30, 31)
    for o in pii.occurrences(text, base):
        assert o["kind"] >= 0 or not any(s < o["stop"] and o["start"] < e for _, s, e in base)


def test_long_runs_take_linear_time():
    for c in ("a", "1", "1 ", "1.", "+1", "@a", "a@"):
        pii.occurrences(c * 100_000, pii.base_spans(c * 100_000))
    everything = np.ones(pii.BITS, bool)
    pii.slots("word " * 50_000, everything, everything, None)
    pii.slots("w" * 200_000, everything, everything, everything)


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"please write to user{i}@mail.org for help", "s") for i in range(12)]
    rows += [(50, "please write to agent77(at)host for help", "s"), (51, "there were agent78 others", "s"),
             (52, None, "s"), (53, "", None), (50, "please write to agent77(at)host for help", "s")]
    got = {}
    for r in pii.extract(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[50]) == 2
    assert got[50][0].base == "" and got[50][0].spans == "email:16:31"
    assert got[51][0].spans == "" and got[52][0].spans == "" and got[53][0].n_email == 0
    assert got[3][0].n_email == 1 and got[3][0].base == got[3][0].spans == "email:16:30"
    masked = spark.createDataFrame([("call +1 (017) 555-7713 or a1@b.org", [(0, 0, 4)])],
                                   "t string, a array<struct<kind:int,start:int,stop:int>>")
    assert masked.select(pii.masked(masked.t, masked.a)).first()[0] == "[EMAIL] [PHONE] or [EMAIL]"


# --- sharding ------------------------------------------------------------

def test_shards_by_key_only_and_slots_without_gaps(spark):
    rows = odd_rows()
    out = sharding.shard_documents(documents(spark, rows), weights=(1.0,) * 4, grown=(1.0,) * 5).collect()
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    shards = {}
    for r in out:
        assert shards.setdefault(r.doc_id, r.shard) == r.shard
        assert r.grown_shard in (r.shard, 4)
    for s in range(4):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    again = sharding.shard_documents(documents(spark, rows[::-1]).repartition(5), weights=(1.0,) * 4).collect()
    assert sorted((r.doc_id or -1, r.text_crc32, r.slot) for r in again) == \
        sorted((r.doc_id or -1, r.text_crc32, r.slot) for r in out)


def test_shard_weights_are_shares(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "cast(null as string) as text")
    n = Counter(r.shard for r in sharding.shard_documents(df, weights=(1.0, 2.0, 5.0)).collect())
    assert [n[i] / 20_000 for i in range(3)] == pytest.approx([0.125, 0.25, 0.625], abs=0.015)
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(["doc_id"], [1.0, 0.0])


# --- mixing --------------------------------------------------------------

def plain_targets(sizes, weights, cap):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    share = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    total, target, open_ = float(sum(sizes.values())), {}, set(names)
    while open_:
        rest = total - sum(target.values())
        level = rest / sum(share[s] for s in open_)
        over = {s for s in open_ if level * share[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * share[s] for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return target


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(WORDS, int(n))), ["a", "b", "c", "d", None][int(s)])
            for i, (n, s) in enumerate(zip(rng.integers(1, 60, 600), rng.choice(5, 600, p=[.04, .2, .3, .4, .06])))]
    rows += odd_rows()[60:63]
    out = mixing.mix_documents(documents(spark, rows)).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    want = plain_targets(sizes, (5, 2, 1), 3)
    assert len(out) == len(rows)
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.01 * t, 5)
    again = mixing.mix_documents(documents(spark, rows[::-1]).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in out)


def test_rates_tilt_exponentially_with_size(spark):
    cells = spark.createDataFrame([(0, s, 10) for s in (1, 2, 4, 8)], "sid int, size long, n long")
    targets = spark.createDataFrame([(0, 150, 40, 1, 60.0)], "sid int, source_size long, n_docs long, min_size long, target double")
    r = mixing.entropy_multipliers(cells, targets, 3.0).first()
    z = np.array([1, 2, 4, 8]) / r["mean"]
    assert (np.array([1, 2, 4, 8]) * 10 * np.exp(r["lam"] * z)).sum() == pytest.approx(60, rel=1e-5)


# --- packing -------------------------------------------------------------

def test_pieces_cover_documents_and_sequences(spark):
    from tokenizers import Tokenizer

    rows = odd_rows()
    docs = documents(spark, rows)
    out = packing.pack_documents(docs, tokenizer_path(), capacity=256).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    ids = {(d, t): np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for d, t, _ in rows}
    expected = Counter()
    for d, t, _ in rows:
        for s, n, _k in packing.cut(len(ids[d, t]), 256, 0.02):
            expected[d, s, n, zlib.crc32(ids[d, t][s:s + n].tobytes()), len(ids[d, t])] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == expected
    bins = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert bins.get(r.sequence_id, 0) == r.offset
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 256
    assert sorted(bins) == list(range(len(bins)))
    assert 1 - sum(bins.values()) / (256 * len(bins)) < 0.03


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 3000), st.integers(16, 512))
def test_cut_is_gapless_and_tight(tokens, capacity):
    at = 0
    for s, n, k in packing.cut(tokens, capacity, 0.02):
        assert s == at and k * n <= capacity and k == capacity // n
        at += n
    assert at == tokens


def test_sequences_round_trip(spark):
    rows = [(i, t, s) for i, (d, t, s) in enumerate(odd_rows()[:40])]
    docs = documents(spark, rows)
    pieces = packing.pack_documents(docs, tokenizer_path(), capacity=128).cache()
    seqs = {r.sequence_id: r.ids for r in packing.read_sequences(docs, pieces, tokenizer_path()).collect()}
    for r in pieces.collect():
        part = np.array(seqs[r.sequence_id][r.offset:r.offset + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32


def test_word_cache_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(tokenizer_path()), packing.WordTokenizer(tokenizer_path(), max_words=20)
    texts = ["It's 12,5 don't! <|endoftext|>x", "é ́a ﬁ Straße ŒUVRE İ Σας", "a b\x1cc d e", "中文 字 1a2 ...,! ?", "", None,
             "word, word. word.. word", "x" * 300] * 2
    assert [i.tolist() for i in own.encode(texts)] == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    for t in texts:
        assert own.encode([t])[0].tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_every_letter_alone_in_words_and_before_marks():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(tokenizer_path()), packing.WordTokenizer(tokenizer_path())
    texts = [f"{c} a{c}b x{c} {c}. x{c}, {c}; {c}: x{c}! {c}?" for c in map(chr, range(0x32000)) if c.isalpha()]
    for at in range(0, len(texts), 8192):
        part = texts[at:at + 8192]
        for t, ids, e in zip(part, own.encode(part), tok.encode_batch_fast(part, add_special_tokens=False)):
            assert ids.tolist() == e.ids, t


@pytest.mark.parametrize("run", [
    pii.extract, sharding.shard_documents, mixing.mix_documents,
    lambda d: packing.pack_documents(d, tokenizer_path())])
def test_empty_tables(spark, run):
    assert run(documents(spark, [])).collect() == []


def test_word_cache_is_bounded_in_words_and_ids():
    own = packing.WordTokenizer(tokenizer_path())
    own.encode([" ".join(f"w{i}q" for i in range(70_000))])
    tables = own.starts.nbytes + own.lengths.nbytes + own.flat.nbytes
    assert own.words == 70_000 and tables < 1.3 * 4 * (2 * own.words + own.used)
    few = packing.WordTokenizer(tokenizer_path(), max_words=50)
    few.encode(["ab"])
    few.encode(["qz7" * 500])  # one word of more ids than the cache may hold
    assert (few.words, list(few.places)) == (1, [b"ab"]) and few.used <= 8 * 50


def test_a_worker_keeps_the_caches_of_one_operator():
    common.worker_store("one")["words"] = 1
    assert common.worker_store("one") == {"words": 1}
    assert common.worker_store("two") == {} and common.worker_store("one") == {}


def test_tasks_run_on_small_batches_and_tidy_up(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([len(batch)])], names=["bytes", "rows"])

    docs = spark.range(64, numPartitions=1).selectExpr("repeat('x', 200000) AS text")
    sizes = common.map_batches(docs, run, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in sizes) == 64 and max(r["bytes"] for r in sizes) < 3 << 20

    calls = []
    freed = common.tidy(lambda batches: iter(batches))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(common, "release_memory", lambda: calls.append(1))
        assert list(freed([1, 2])) == [1, 2] and calls == [1]


def test_a_task_drops_the_caches_of_other_operators(spark):
    def fill(batches):
        common.worker_store("other")["words"] = 1
        yield from batches

    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(["other" in sys.modules["_corpus_worker"].stores])], names=["kept"])

    rows = spark.range(1, numPartitions=1)
    rows.mapInArrow(fill, "id long").collect()
    assert [r["kept"] for r in common.map_batches(rows, seen, "kept boolean").collect()] == [False]

"""The Merkle manifest against a tree built one node at a time."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from panelkit.llm import merkle

CELLS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, block long, node string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])])


def plain(rows):
    """(doc_id, lang, leaf, subroot, root, proof) of every row."""
    proofs = defaultdict(list)

    def top(nodes):
        while len(nodes) > 1:
            runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
            for run in runs:
                for j, (_, below) in enumerate(run):
                    for r in below:
                        proofs[r] += [d for i, (d, _) in enumerate(run) if i != j]
            nodes = [(H(*[d for d, _ in run]), [r for _, below in run for r in below]) for run in runs]
        return nodes[0]

    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[r[2]].append(i)
    subroots = {}
    for lang, ids in groups.items():
        ids.sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf_of(rows[i])))
        subroots[lang] = top([(leaf_of(rows[i]), [i]) for i in ids])
    order = sorted(subroots, key=lambda x: (x is not None, (x or "").encode()))
    root = top([subroots[x] for x in order])[0]
    return [(r[0], r[2], leaf_of(r), subroots[r[2]][0], root, "".join(proofs[i])) for i, r in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def odd_rows():
    rows = [(i * 3, f"Text {i}", ("en", "de", "é", "", None)[0 if i % 3 else i % 5], f"s{i % 4}" if i % 6 else None, i)
            for i in range(700)]
    rows += [(None, "no key", "en", "s", None), (None, "no key", "en", "s", None), (30, None, "en", None, 0),
             (30, "", "en", None, 0), (30, "", "en", None, 0), (9000, "Long Ünï " * 40_000, "de", "s", 1),
             (9001, "alone", "xx", "s", 1)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_equals_the_plain_tree(spark, levels):
    rows = odd_rows()
    got = merkle.manifest(frame(spark, rows).repartition(5), CELLS, levels=levels, salt_blocks=3).collect()
    assert Counter((r.doc_id, r.lang, r.leaf, r.subroot, r.root, r.proof) for r in got) == Counter(plain(rows))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 72, 513, 577])
def test_every_width_of_the_last_run(spark, n):
    """Also the short subtrees whose root several partners need."""
    rows = [(i, "t", "en", "s", i) for i in range(n)]
    got = merkle.manifest(frame(spark, rows), CELLS, levels=1).collect()
    assert sorted((r.doc_id, r.root, r.proof) for r in got) == sorted((d, t, p) for d, _, _, _, t, p in plain(rows))


def test_many_groups_make_a_deep_second_tree(spark):
    rows = [(i, "t", f"lang{i % 150}", "s", i) for i in range(300)]
    got = merkle.manifest(frame(spark, rows), CELLS, levels=1).collect()
    assert Counter((r.doc_id, r.lang, r.leaf, r.subroot, r.root, r.proof) for r in got) == Counter(plain(rows))


def test_proofs_fold_to_the_root_and_tampering_shows(spark):
    out = merkle.manifest(frame(spark, odd_rows()), CELLS, levels=1,
                          carry={"other": F.sha2(F.concat(F.lit("other"), F.col("n_chars")), 256)})
    fold = lambda leaf: merkle.fold_proof(F.col(leaf), F.col("proof"), F.col("places"), F.col("counts"))
    for r in out.select("*", fold("leaf").alias("good"), fold("other").alias("bad")).collect():
        assert r.good == r.root
        assert r.bad != r.root if r.other else r.bad is None
        assert len(r.proof) == 64 * sum(c - 1 for c in r.counts) and len(r.places) == len(r.counts)


def test_exchange_sends_no_more_than_a_row_a_partner(spark):
    """577 leaves in blocks of 8: 73 blocks, the last subtree of 9 serving 64."""
    state = spark.range(73).select(
        F.lit("g").alias("group"), F.col("id").alias("block"), F.lit(73).cast("long").alias("blocks"),
        F.sha2(F.col("id").cast("string"), 256).alias("node"))
    out = merkle.exchange(state).collect()
    assert sorted(r.block for r in out) == list(range(73)) and len({r.node for r in out}) == 1
    assert all(len(r.places) == 3 for r in out)


def test_empty_table(spark):
    assert merkle.manifest(frame(spark, []), CELLS).collect() == []


def test_registered_query(spark, tmp_path):
    from panelkit.llm.queries import QUERIES

    rows = odd_rows()
    frame(spark, rows).select(*CELLS).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_butterfly_manifest"](spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("leaf", "string"), ("subroot", "string"), ("root", "string"),
                          ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean")]
    want = {(d, leaf, sub, root, H(proof)) for d, _, leaf, sub, root, proof in plain(rows)}
    got = got.collect()
    assert len(got) == len(rows) and {(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got} == want
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    for r in got:
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and \
            any((x[1] or "") != (x[1] or "").lower() for x in by_id[r.doc_id])
        assert r.verified == (not changed) == (r.folded_root == r.root)

"""Classifiers on held-out rows, the pipeline stage by stage, the entry."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelkit.llm import langid, pii, queries, toxicity
from panelkit.llm.common import bounded_sample, crc_mod

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def toxic_corpus(spark):
    rng = np.random.default_rng(2)
    words = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(500):
        body = rng.choice(words, rng.integers(5, 120)).tolist()
        bad = i % 5 == 0
        if bad:
            body[1:1] = rng.choice(["foulest", "fouler", "vile!"], 3).tolist()
        rows.append((i, " ".join(body), int(bad), 9.0))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, score double")


def test_toxicity_on_held_out_rows(spark):
    df = toxic_corpus(spark)
    model = toxicity.fit_toxicity(df, df, usable=crc_mod("doc_id", 5) != 0)
    assert 0 < len(model.index) < 5000  # a short list of weights
    out = df.filter(crc_mod("doc_id", 5) == 0).select(
        "toxic", toxicity.toxicity_score(model).alias("p")).collect()
    assert np.mean([(r.p >= 0.5) == r.toxic for r in out]) >= 0.97
    odd = spark.createDataFrame([(None,), ("",), ("x " * 100_000,)], "text string")
    assert all(0 <= r[0] <= 1 for r in odd.select(toxicity.toxicity_score(model)).collect())


def test_toxicity_without_two_classes(spark):
    df = toxic_corpus(spark)
    none = toxicity.fit_toxicity(df, df.limit(0))
    assert none.constant == 0.5
    assert toxicity.fit_toxicity(df, df.withColumn("toxic", F.lit(0))).constant == 0.0
    assert toxicity.fit_toxicity(df.limit(0), df).constant == 0.5


@needs_tables
def test_languages_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op9_subword_langid"](spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) >= 0.97
    assert np.mean([r.rejected for r in held]) <= 0.1


def test_language_rejects_what_has_no_letter(spark):
    rows = [(i, "the cat sat on the mat and ran", "en") for i in range(30)] + \
           [(i, "der hund und die katze sind nicht da", "de") for i in range(30, 60)] + [(60, None, "en"), (61, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_language_model(df)
    assert sorted(model.languages) == ["de", "en"]
    odd = spark.createDataFrame([("the mat and the cat",), ("die katze und der hund",), (None,), ("",), ("12 !?",)], "text string")
    got = [r.p for r in odd.select(langid.identify(model).alias("p")).collect()]
    assert [p.lang_pred for p in got] == ["en", "de", "und", "und", "und"]
    assert all(0 <= p.score <= 1 for p in got)
    empty = langid.fit_language_model(df.limit(0))
    assert odd.select(langid.identify(empty)["lang_pred"]).distinct().collect()[0][0] == "und"


def test_bounded_sample_is_the_same_every_time(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    a = {r[0] for r in bounded_sample(df, "doc_id", 500).collect()}
    assert a == {r[0] for r in bounded_sample(df.repartition(3), "doc_id", 500).collect()}
    assert 400 <= len(a) <= 600


def test_rare_language_is_learned(spark):
    rows = [(i, f"the words of text {i} are plain", "en") for i in range(12_000)]
    rows += [(20_000 + i, f"τα λόγια του κειμένου {i} είναι απλά", "el") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_language_model(docs, max_train_rows=300)
    assert model.languages == ["el", "en"]
    assert model.predict("είναι τα λόγια του κειμένου")[0] == "el"


@needs_tables
def test_pipeline_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(name)
        stage(spark, steps[-1], SF).write.parquet(path)
        steps.append(spark.read.parquet(path))
        if name != "packing":
            assert steps[-1].columns == columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [{r.doc_id: r for r in s.collect()} for s in steps[:4]]
    gone = set(rows[0]) - set(rows[1])
    known = [labels[d] for d in gone if labels.get(d) is not None]
    assert len(known) > 20 and np.mean(known) > 0.9
    from panelkit.llm.minhash import near_duplicates

    groups = near_duplicates(steps[1]).collect()
    assert set(rows[2]) == {r.component_id for r in groups}
    for d, r in rows[3].items():
        assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)
        if not pii.base_spans(rows[2][d].text):
            assert r.text == rows[2][d].text
    copies = Counter(r.doc_id for r in steps[4].select("doc_id").collect())
    assert set(copies) <= set(rows[3]) and max(copies.values()) <= 3
    size = {d: len(r.text.encode().split()) for d, r in rows[3].items()}
    assert sum(size[d] * n for d, n in copies.items()) == pytest.approx(sum(size.values()), rel=0.02)
    pieces = steps[5].collect()
    tokens = {r.doc_id: r.doc_tokens for r in pieces}
    assert Counter(r.doc_id for r in pieces if r.start == 0) == copies
    assert sum(r.length for r in pieces) == sum(tokens[d] * n for d, n in copies.items())


def test_pipeline_keeps_rows_whole(spark):
    """Null keys, repeated rows and clashing columns through every stage."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, "en", "s", 1, "p"), (None, text, "en", "s", 1, "p"), (1, text, "en", "s", 1, "p"),
            (2, None, None, None, None, "q"), (3, "", "en", None, 0, "r"), (4, "mail a1@b.org", "en", "t", 13, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id, r.row) for r in kept.collect()) == [(1, "p"), (2, "q"), (3, "r"), (4, "s")]
    masked = {r.doc_id: r.text for r in corpus_pipeline.mask_personal_data(spark, kept, SF).collect()}
    assert masked == {1: text, 2: None, 3: "", 4: "mail [EMAIL]"}
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} >= {2, 3}
    copies = Counter((r.doc_id, r.row) for r in corpus_pipeline.mix_sources(
        spark, spark.createDataFrame(
            [(None, None, "en", "s", 1, "p"), (None, None, "de", "s", 1, "p"), (7, text, "en", "s", 40, "x"),
             (7, text, "fr", "s", 40, "y"), (7, text, "fr", None, 40, "y"), (8, text, "en", "s", 40, "z"),
             (8, text, "en", "s", 40, "z")], docs.schema), SF).collect())
    assert copies[(None, "p")] == 2 and {(7, "x"), (7, "y"), (8, "z")} <= set(copies)
    assert sum(copies.values()) == 7
    unharmed = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert Counter((r.doc_id, r.row) for r in unharmed.collect()) == Counter((d, q) for d, *_, q in rows)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_near_duplicates, corpus_pipeline.mask_personal_data,
                  corpus_pipeline.mix_sources, corpus_pipeline.pack):
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_rows_without_words_stay_beside_a_repeated_row(spark):
    text = " ".join(f"w{i}" for i in range(40))
    blank = [(None, None, "a"), (None, None, "b"), (None, None, "b"), (5, "", "a"), (5, "", "c"), (6, " \n", "a")]
    schema = "doc_id long, text string, source string"
    for more, kept in (([], []), ([(1, text, "a")] * 3, [(1, text, "a")])):
        docs = spark.createDataFrame(blank + more, schema)
        got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
        assert Counter(map(tuple, got)) == Counter(blank + kept)


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


def test_entry_without_the_corpus_package(tmp_path):
    for name in ("__spark_entry__.py", "panelkit"):
        src = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(
            src, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if os.path.isdir(src) else {}))
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 60; assert not any(k[:2] == 'op' and k[2].isdigit() for k in e.queries())"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120,
                   env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})

"""Corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and applies one operator of
``panelkit.llm`` to all its predecessor kept.  All but the last return the
columns of ``docs``.  Near-duplicate and personal-data decisions join back by
document key and text hash, the mix by a fingerprint of the whole row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm.common import crc_mod
from panelkit.llm.minhash import representatives
from panelkit.llm.mixing import mix_documents
from panelkit.llm.packing import pack_documents
from panelkit.llm.pii import extract, masked
from panelkit.llm.queries import tokenizer_path
from panelkit.llm.toxicity import fit_toxicity, toxicity_score
from panelkit.session import materialize


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows beside their key, so that no column name can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_h"))


def _same(other: DataFrame):
    return F.col("_d").eqNullSafe(other["doc_id"]) & (F.col("_h") == other["text_hash"])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; learned from ``labels`` (held-out keys are
    those of the toxicity query).

    Every row is scored by its own text, whatever its key: repeated rows go or
    stay together, null and empty texts have the score of a text without
    features, a score of exactly 0.5 goes, very long texts are scored whole;
    an empty table gives an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels, usable=crc_mod("doc_id", 5) != 0)
    return docs.filter(toxicity_score(model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group; texts without words are no
    duplicates and all their rows stay."""
    keep = materialize(representatives(docs), "keep")
    rows = _keyed(docs).join(keep, _same(keep), "left_semi")
    repeated = keep.filter("shingled and rows > 1")
    if not repeated.isEmpty():  # repeated rows of a kept document
        again = _same(repeated)
        rows = rows.join(repeated, again, "left_anti").union(
            rows.join(repeated, again, "left_semi").dropDuplicates(["_d", "_h"]))
    return rows.select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text.
    Null texts stay null (``n_chars`` too), rows are never joined or dropped by
    key alone, an empty table gives an empty one."""
    more = materialize(extract(docs).filter(F.size("added") > 0).select("doc_id", "text_hash", "added")
                       .dropDuplicates(["doc_id", "text_hash"]), "added")
    none = F.lit(None).cast(more.schema["added"].dataType)
    if more.isEmpty():
        rows = _keyed(docs).withColumn("added", none)
    else:
        rows = _keyed(docs).join(more, _same(more), "left")
    rows = rows.select("row", masked(F.col("row")["text"], F.col("added")).alias("_text"))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def _fingerprint(docs: DataFrame):
    """One string per row that is equal for rows equal in every column only
    (128 bits; nulls count as values)."""
    cells = [x for c in docs.columns for x in (docs[c].isNull(), docs[c])]
    return F.concat(*[F.hex(F.xxhash64(F.lit(seed), *cells)) for seed in ("left", "right")])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Rows are told apart by all their columns, so rows of equal key, text and
    source keep their own copies; only rows equal throughout share theirs.
    Null and repeated keys, null, empty and very long texts are documents like
    any other (without words: one copy); an empty table gives an empty one.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _fingerprint(docs).alias("_f"))
    sized = rows.select(F.col("_f").alias("doc_id"), F.col("row")["text"].alias("text"),
                        F.col("row")["source"].alias("source"))
    mix = mix_documents(sized).groupBy("doc_id").agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    mix = materialize(mix.filter("copies > 0"), "mix")
    if not mix.filter("rows > 1").isEmpty():  # equal rows: their copies are given together
        rows = rows.dropDuplicates(["_f"])
    return (rows.join(mix, F.col("_f") == mix["doc_id"])
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens.  A null or empty
    text is one end token; keys may be null or repeated; an empty table gives
    no piece."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Classifier training, similarity components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

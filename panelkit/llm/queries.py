"""``opN_<name>`` queries: each applies one operator, with production
parameters, to its whole table.  ``ORACLE`` holds the DuckDB SQL of those that
SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.llm.common import crc_mod, read_documents
from panelkit.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@functools.cache
def tokenizer_path() -> str:
    """The vocabulary file that the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_rendezvous_sharding(spark, sf_dir):
    """All documents in 16 equal shards; one more shard for ``grown_shard``."""
    from panelkit.llm.sharding import shard_documents

    out = shard_documents(read_documents(spark, sf_dir, "doc_id", "text"),
                          weights=(1.0,) * 16, grown=(1.0,) * 17)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op4_entropy_mixing(spark, sf_dir):
    """All documents mixed with source weights 5, 2, 1, repeating, cap 3."""
    from panelkit.llm.mixing import mix_documents

    out = mix_documents(read_documents(spark, sf_dir, "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op10_harmonic_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens."""
    from panelkit.llm.packing import pack_documents

    return pack_documents(read_documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())


@query
def op7_ftrl_toxicity(spark, sf_dir):
    """Toxicity of all documents; rows with crc32(doc_id) mod 5 = 0 held out."""
    from panelkit.llm.toxicity import fit_toxicity, toxicity_score

    docs = read_documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels, usable=crc_mod("doc_id", 5) != 0)
    out = docs.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                      toxicity_score(model).alias("score"))
    return out.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_subword_langid(spark, sf_dir):
    """Language of all documents; rows with crc32(doc_id) mod 3 = 1 held out."""
    from panelkit.llm.langid import fit_language_model, identify

    docs = read_documents(spark, sf_dir, "doc_id", "text", "lang")
    model = fit_language_model(docs, usable=crc_mod("doc_id", 3) != 1)
    out = docs.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                      identify(model).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


@query
def op6_sorted_projections(spark, sf_dir):
    """Near-duplicate vectors of each label at cosine 0.93."""
    from panelkit.llm.embed_dedup import near_duplicates

    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op8_projection_forest(spark, sf_dir):
    """Five nearest vectors of every vec_id divisible by 50, among all rows."""
    from panelkit.llm.ann import nearest

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@query
def op3_minhash_inverted_join(spark, sf_dir):
    """Near-duplicate components of all documents at 0.75."""
    from panelkit.llm.minhash import near_duplicates

    return near_duplicates(read_documents(spark, sf_dir, "doc_id", "text"))


@query
def op1_contextual_pii(spark, sf_dir):
    """Personal data in all documents."""
    from panelkit.llm.pii import extract

    out = extract(read_documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query
def op5_fm_substrings(spark, sf_dir):
    """Words of all documents in 35-word windows that occur elsewhere."""
    from panelkit.llm.substring import repeated_spans

    out = repeated_spans(read_documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op11_butterfly_manifest(spark, sf_dir):
    """Merkle proofs of all documents, checked against rows of which every
    third (by crc32 of its doc_id) has its text lower-cased."""
    from panelkit.llm.common import lower_ascii
    from panelkit.llm.merkle import fold_proof, manifest, row_digest

    cells = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = row_digest([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in cells])
    out = manifest(read_documents(spark, sf_dir, *cells), cells,
                   carry={"tampered": F.when(crc_mod("doc_id", 3) == 0, tampered)})
    folded = fold_proof(F.coalesce("tampered", "leaf"), F.col("proof"), F.col("places"), F.col("counts"))
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
                     folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_positional_index(spark, sf_dir):
    """Words of all documents inside 10-word windows of the benchmark's items."""
    from panelkit.llm.decontamination import decontaminate

    out = decontaminate(read_documents(spark, sf_dir, "doc_id", "text"),
                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query
def op13_anchor_tree(spark, sf_dir):
    """Hard negatives of every vec_id divisible by 100, among all rows; the
    label of every seventh row is moved on by one."""
    from panelkit.llm.hard_negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(vectors, vectors.filter(F.col("vec_id") % 100 == 0))

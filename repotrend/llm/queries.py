"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotrend.llm import (
    arc_warc,
    block_knn,
    covertree,
    lattice_lm,
    lexical,
    license_scan,
    merkle,
    minhash,
    pii,
    prefix_bpe,
    pu_quality,
    spaced_seed,
    suffix_dedup,
)

BPE = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), n=4, threshold=0.8)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find_pii(_table(spark, sf_dir, "documents")))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licences(_table(spark, sf_dir, "documents"), license_scan.known_licences(spark))


def op4_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seed.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE)
    ids = prefix_bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_decoded=True)
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_arc_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_warc.page_records(spark, arc_warc.convert_pages(_table(spark, sf_dir, "pages")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"), length=400, words=51))


def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scores(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def tampered() -> dict[str, Column]:
    """What the manifest is verified against: half of the documents, by crc32 of the id, lost their line breaks."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    proofs = merkle.manifest(_table(spark, sf_dir, "documents"), received=tampered())
    return proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_knn.neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_pii": op2_pii,
    "op3_licences": op3_licences,
    "op4_covertree": op4_covertree,
    "op5_spaced_seeds": op5_spaced_seeds,
    "op6_pu_quality": op6_pu_quality,
    "op7_prefix_bpe": op7_prefix_bpe,
    "op8_arc_warc": op8_arc_warc,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_lattice_lm": op10_lattice_lm,
    "op11_merkle": op11_merkle,
    "op12_lexical": op12_lexical,
    "op13_block_knn": op13_block_knn,
}

"""The corpus pipeline: documents in, a clean, deduplicated and encoded corpus out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotrend.llm import minhash, pii, prefix_bpe, pu_quality, spaced_seed
from repotrend.llm.scratch import Scratch

ORACLE_SQL = None  # the first stage is a fitted classifier
BPE = "byte_bpe_multi_50k.tiktoken"
LEAST_WORDS = 5  # of benchmark items that remove documents


def _absent(docs: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _digest(*columns: Column) -> Column:
    """128 bits of the columns, each with its length, or - for null."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    A null or empty text has a score as any other (its features are 0), and stays or goes by it.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = pu_quality.trained(docs, labels)
    score = _absent(docs, "score")
    return pu_quality.with_scores(docs, model, score_col=score).where(F.col(score) >= pu_quality.THRESHOLD).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the least id, none last.

    A document is an id, or none, with a text, and goes by 128 bits of both; of its
    rows the one with the least hash of the other columns speaks for it.  Null and
    empty texts are like no other, so one row of each id and such a text stays.
    """
    scratch = Scratch(spark)
    key, number, row = (_absent(docs, n) for n in ("key", "number", "row"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    keyed = docs.withColumns({key: _digest(F.col("doc_id").cast("string"), F.col("text")), row: F.xxhash64(*others) if others else F.lit(0).cast("long")})
    # The operator's ids are whole numbers: each key has one of its own, in the order of the ids, as the operator
    # compares a group with its first document.
    pairs = keyed.select(F.col(key).alias("k"), F.col("doc_id").alias("i")).distinct().orderBy(F.asc_nulls_last("i"), "k")
    numbers = scratch.save(pairs.withColumn("n", F.monotonically_increasing_id()), "numbers")
    texts = keyed.select(F.col(key).alias("k"), "text").join(numbers.select("k", "n"), "k").select("n", "text")
    near = minhash.near_duplicates(texts, n=5, threshold=0.8, id_col="n").select("n", "component_id").distinct()
    least = F.min(F.struct(F.isnull("i").alias("none"), "i", "k")).alias("m")
    keep = near.join(numbers, "n").groupBy("component_id").agg(least).select(F.col("m.k").alias(key))
    rows = keyed.select(key, row).join(keep, key, "left_semi").groupBy(key).agg(F.min(row).alias(row))
    return keyed.join(rows, [key, row], "left_semi").select(*keyed.columns).dropDuplicates([key]).drop(key, row)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a passage of the benchmark go, by 128 bits of their text: the others of their id, or without one, stay.

    Items of fewer than ``LEAST_WORDS`` words are ordinary text and remove nothing; null and empty texts stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    key = _absent(docs, "key")
    keyed = docs.withColumn(key, _digest(F.col("text")))
    found = spaced_seed.contaminated(keyed.select(key, "text"), benchmark, id_col=key, least_words=LEAST_WORDS).select(key).distinct()
    return keyed.join(found, key, "left_anti").select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind; n_chars follows.  Null and empty texts stay as they are."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, n_bytes, round_trip) of each document; a null text counts as empty and has no ids."""
    path = public_tokenizers.path(BPE)
    done = prefix_bpe.encode(docs, path, public_tokenizers.PATTERN, keep_text=True, with_decoded=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.octet_length("text").cast("long").alias("n_bytes"),
                       (F.col("decoded") == F.col("text").cast("binary")).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("encode", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs

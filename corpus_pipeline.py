"""A training-corpus pipeline: each stage calls one operator and works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparge.llm import decontaminate, exact_dedup, langid, packing, simhash
from sparge.llm.common import write_stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts and texts without a letter go. The predicted language rejects nothing, nor do missing labels."""
    prototypes = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.keep_known(docs, prototypes)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space aside, the longest stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, the document with the smallest doc_id stays.

    Linked are fingerprints that differ in at most 3 bits, and texts of 5-word-shingle similarity 0.8 or more.
    """
    return simhash.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts stay; repeated rows share their fate."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, by checksum.

    Null and empty texts are one piece of the end id alone; repeated rows are packed each; other columns are not read.
    """
    return packing.piece_digests(packing.pack(docs))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

# Fingerprints, learned prototypes and packing along a curve are beyond SQL; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

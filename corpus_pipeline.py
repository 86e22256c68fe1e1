"""The corpus pipeline: quality rules, SimHash near-dedup, substring dedup, secret scans, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's result as Parquet in the shared folder and
gives the reread table to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import lexical_packing, passage_minhash, quality_repeats, secret_ownership, simhash_anchors
from postlens.llm.queries import packing_digest, tokenizer
from postlens.llm.store import written


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the edited text."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_repeats.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, that of the smallest id."""
    return simhash_anchors.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from all documents but the first; all documents stay."""
    return recounted(passage_minhash.remove_passages(docs))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret's span is masked; all documents stay."""
    return recounted(secret_ownership.mask_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences."""
    return packing_digest(lexical_packing.pack(docs, tokenizer("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("secret scans", secret_scans),
    ("packing", packing),
]

#: SQL can't express the suffix-array, fingerprint and packing stages; tests/llm holds each stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs

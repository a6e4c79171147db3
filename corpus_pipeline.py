"""From raw documents to packed training sequences, stage by stage.

Each stage takes all that its predecessor kept; what it decides takes effect: rejected and
duplicate documents go, repeated passages and secrets are taken out of the texts. Every
stage's result is written before the next one reads it, so a lost executor costs the
re-read of a file and a failed stage can be run again from its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventstrata.llm import packing, quality_trees, secrets, simhash, substrings
from eventstrata.llm.common import table
from eventstrata.llm.queries import BYTE_BPE
from eventstrata.session import scratch_path, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_trees.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.drop_passages(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, scratch_path(spark, "secret-ledger"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

# Boosted trees, components, alignment and tokenizers are beyond SQL; tests/llm compares the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; rows are pieces of packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), scratch_path(spark, name))
    return docs

"""Corpus pipeline: from raw documents to packed token sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from torqueframe.llm import stages
from torqueframe.llm.common import table, written

STAGES = [
    ("language_id", stages.language_id),
    ("exact_dedup", stages.exact_dedup),
    ("ngram_jaccard", stages.ngram_jaccard),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

# a learned classifier and a BPE vocabulary are no SQL; the stages are tested
# against brute-force versions in tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to all that the one before it kept; each result is
    written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Each takes whatever the stage before it kept. All but the last return rows of
their input, with its columns as they are."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exactdedup, langid, ngramjoin
from . import packing as _packing
from .common import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 1: documents in which no language can be told (``und``) go."""
    model = langid.fit(docs)
    if model is None:  # no language is known: only texts without a letter are rejected
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.where(langid.predicted(F.col("text"), model)["lang_pred"] != langid.UNKNOWN)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 8: of equal texts the smallest doc_id stays."""
    return exactdedup.keep_rows(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 2: of each group of near copies the smallest doc_id stays."""
    return ngramjoin.keep_rows(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 4: rows whose text leaks a benchmark item go."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"), whole_ids=False)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 10: every document in sequences of at most 2048 ids."""
    return _packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)

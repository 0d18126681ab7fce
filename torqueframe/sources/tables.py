"""Parquet tables of a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def bucketed(df: DataFrame, key: str, buckets: int, order: list[str] | None = None, name: str | None = None,
             path: str | None = None) -> DataFrame:
    """Hand ``df`` over as a table bucketed by ``key`` and sorted by it (and
    ``order``) within buckets (A5): every later grouping, window or join by ``key``
    reads it without an exchange. The files go below the shared checkpoint folder
    unless ``path`` says otherwise; whoever set that folder clears it."""
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    (df.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key, *(order or []))
       .mode("overwrite").saveAsTable(name))
    return spark.table(name)

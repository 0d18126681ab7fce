"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The lineage ends there: lost executors re-read files, not recompute."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give a worker's freed memory back to the system at the end of a task:
    Spark keeps workers for later tasks, beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


BROADCAST_ROWS = 200_000  # ids of at most this count (a few MB) are broadcast


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def having_ids(docs: DataFrame, ids: DataFrame, id_col: str, null_too: bool = False) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids`` (null as well, on request);
    broadcast if counted small, else a shuffled semi join."""
    ids = ids.select(F.col(id_col).alias("_one_of"))
    ids = F.broadcast(ids) if small_enough(ids) else ids
    own = docs[id_col]
    return docs.join(ids, own.eqNullSafe(ids["_one_of"]) if null_too else own == ids["_one_of"], "left_semi")


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids``; broadcast if counted small,
    else a shuffled anti join."""
    ids = ids.select(id_col)
    return docs.join(F.broadcast(ids) if small_enough(ids) else ids, id_col, "left_anti")

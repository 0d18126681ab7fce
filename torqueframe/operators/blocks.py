"""Training rows as numpy blocks, and sums over them.

An iterative fit reads the same rows hundreds of times and needs only sums from
them: gradients, histograms, centre sums. Here the rows are turned into blocks
once (one per Arrow batch) and kept by the executors, in memory or on their
disks. Each pass is one job that adds up a list of arrays, whose size depends on
the models and not on the rows, in a tree of tasks, as MLlib's own fits do. All
models of a search (grid points, folds, starts) share a pass, so a search costs
as many jobs as its longest fit. A lost executor's blocks are made again from the
table they came from.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..session import ensure_checkpoint_dir


class Block(NamedTuple):
    x: np.ndarray             # rows x features
    y: np.ndarray             # labels
    fold: np.ndarray          # fold of a row, -1 for none
    key: np.ndarray           # hash of the row's id
    state: np.ndarray | None  # rows x models, what a fit keeps per row


def feature_array(df: DataFrame, features: str = "features") -> Column:
    """A vector or array column as an array of doubles."""
    if isinstance(df.schema[features].dataType, ArrayType):
        return F.col(features).cast("array<double>")
    return vector_to_array(features)


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """The rows of an Arrow list column; no nulls, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width if width is not None else len(flat) // max(1, len(column)))


def _in_blocks(batches):
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column("x"))
            yield pa.RecordBatch.from_pydict({
                "width": pa.array([x.shape[1]], pa.int32()), "x": pa.array([x.tobytes()], pa.large_binary()),
                **{c: pa.array([batch.column(c).to_numpy().tobytes()], pa.large_binary()) for c in ("y", "fold", "key")}})


def _decoded(row) -> Block:
    y = np.frombuffer(row["y"], dtype=np.float64)
    return Block(np.frombuffer(row["x"], dtype=np.float64).reshape(len(y), row["width"]), y,
                 np.frombuffer(row["fold"], dtype=np.int32), np.frombuffer(row["key"], dtype=np.int64), None)


def _dealt(made: DataFrame) -> DataFrame:
    """The same blocks in the same order, over all cores, where some task has more
    than twice its part: a file read in one piece, or partitions merged by size.
    No block is cut or merged, so what is drawn from it stays."""
    counts = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    tasks = min(sum(counts), max(len(counts), made.sparkSession.sparkContext.defaultParallelism))
    if not tasks or max(counts) <= 2 * -(-sum(counts) // tasks):
        return made
    numbered = made.withColumn("number", F.monotonically_increasing_id())
    return numbered.repartitionByRange(tasks, "number").sortWithinPartitions("number").drop("number")


def _added(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b)]


class Blocks:
    """The blocks of a table; ``of`` makes them, ``done`` gives them up."""

    def __init__(self, rdd: RDD, keep: bool = True):
        self.rdd = rdd.persist(StorageLevel.MEMORY_AND_DISK) if keep else rdd

    @classmethod
    def of(cls, df: DataFrame, features: str = "features", label: str | None = None, fold: str | None = None,
           key: str | None = None, keep: bool = True) -> Blocks:
        """Rows without features or, where there is one, without a label are left out."""
        rows = df.select(feature_array(df, features).alias("x"),
                         (F.col(label).cast("double") if label else F.lit(0.0)).alias("y"),
                         F.coalesce(F.col(fold).cast("int") if fold else F.lit(None), F.lit(-1)).cast("int").alias("fold"),
                         (F.xxhash64(key) if key else F.lit(0).cast("long")).alias("key"))
        rows = rows.where("x is not null and y is not null")
        made = rows.mapInArrow(_in_blocks, "width int, x binary, y binary, fold binary, key binary")
        return cls(_dealt(made).rdd.map(_decoded), keep)

    def mapped(self, fn: Callable[[Block], Block]) -> Blocks:
        return Blocks(self.rdd.map(fn))

    def with_state(self, fn: Callable[[Block], np.ndarray]) -> Blocks:
        """Blocks with a new state, kept in the shared checkpoint folder, so that
        their lineage does not grow with the fit."""
        from pyspark.sql import SparkSession
        # a thread of its own has no active session
        ensure_checkpoint_dir(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())
        new = self.mapped(lambda b: b._replace(state=fn(b)))
        new.rdd.checkpoint()
        new.rdd.count()
        return new

    def summed(self, fn: Callable[[Block], Sequence[np.ndarray]]) -> list[np.ndarray]:
        """The sum of ``fn``'s arrays over all blocks; one job."""
        def part(blocks):
            total = None
            for b in blocks:
                own = fn(b)
                total = own if total is None else _added(total, own)
            if total is not None:
                yield total

        parts = self.rdd.mapPartitions(part)
        tasks = parts.getNumPartitions()
        some = math.ceil(math.sqrt(tasks))
        # the last sum is a task's as well: the driver gets one of each array, however many blocks there are
        for n in ([some] if tasks > 4 else []) + ([1] if tasks > 1 else []):
            parts = parts.mapPartitionsWithIndex(lambda i, own, n=n: ((i % n, x) for x in own)).reduceByKey(
                _added, n).values()
        return parts.reduce(_added)

    def done(self) -> None:
        if self.rdd.is_cached:
            self.rdd.unpersist()


def counted(y: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """tn, fp, fn, tp of boolean predictions for labels 0 and 1."""
    return np.bincount(2 * (y > 0.5).astype(np.int64) + positive.astype(np.int64), minlength=4)


def scores(counts: np.ndarray, scoring: str) -> np.ndarray:
    """A score for each last-axis quadruple of tn, fp, fn, tp; 0 where undefined."""
    tn, fp, fn, tp = np.moveaxis(np.asarray(counts, dtype=float), -1, 0)

    def share(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b > 0)

    total = tn + fp + fn + tp
    if scoring == "recall":
        return share(tp, tp + fn)
    if scoring == "precision":
        return share(tp, tp + fp)
    if scoring == "accuracy":
        return share(tn + tp, total)
    if scoring == "f1_weighted":
        return share(share(2 * tp, 2 * tp + fp + fn) * (tp + fn) + share(2 * tn, 2 * tn + fp + fn) * (tn + fp), total)
    raise ValueError(f"no score {scoring} from counts")

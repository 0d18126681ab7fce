"""Session construction and lineage checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins (runtime broadcast of
# small sides, skew-join splitting) and coalesces shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once the DataFrames that read them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "torqueframe", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one with ``DEFAULT_CONF``.

    On a cluster the session is created by the launcher; this only fills in
    settings that are not already set.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            conf["spark.driver.memory"] = os.environ.get("TF_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there. Only when it is
    unset — local tests — a fresh temporary folder is created; any other master
    without it is an error, as executors do not share a local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tf-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one.

    The input is persisted while the checkpoint is written: an eager
    checkpoint of an uncached plan would otherwise compute it twice (once to
    count, once to write the files)."""
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


@contextmanager
def short_methods(spark: SparkSession):
    """While it holds, no stage becomes one method of more than 8000 bytes, which the JVM
    never compiles: rows of many columns would pass an interpreter."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet below the checkpoint folder and read from there:
    :func:`cut_lineage` for many rows, compressed and without a cached copy."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    with short_methods(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

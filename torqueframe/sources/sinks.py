"""Sinks (A7, A8, A10, A11): overwrite-then-write tables, selected-column
exports, and one metrics table partitioned by run identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                null_value: str = "NULL") -> None:
    """Overwrite ``path`` with ``df`` (A7). CSV output writes nulls as
    ``NULL`` — the original's mixed 0/1/'NULL' flag columns are typed nullable
    integers here and only rendered at the sink."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("nullValue", null_value).csv(path)
    else:
        w.format(fmt).save(path)


def write_selected(df: DataFrame, cols: Sequence[str], path: str, fmt: str = "parquet") -> None:
    """Second sink with a projection."""
    write_table(df.select(*cols), path, fmt)


RUN_COLUMNS = ["approach", "model", "target", "scoring", "oversample", "k_features", "criterion"]


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append tagged metric rows to one table partitioned by run identity
    (A10/A11): all of ``RUN_COLUMNS`` that the rows have. Writing a run again
    replaces that run alone; a run that differs in any tag column is kept."""
    tags = [c for c in RUN_COLUMNS if c in metrics.columns]
    (metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*tags).parquet(path))

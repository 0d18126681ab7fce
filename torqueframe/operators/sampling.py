"""Deterministic stratified split, over- and under-sampling (K3–K5).

Random draws become a hash order: ``md5(id || ':' || seed)``. The size of a row's
class comes from the same chunk summary as its rank, so classes are not counted
apart and rows are never shuffled by class alone. The rank of a row inside its class in that order is
computed with the chunked scan of
:mod:`.ordered` (chunk = first ``CHUNK_HEX_DIGITS`` hex digits of the hash,
65536 chunks), so a dominant class is ranked by many tasks, not one: a class
with 10^11 rows is ~1.5·10^6 rows per chunk, while the per-class chunk
summaries (at most 65536 rows a class) stay small. Results are exact and
reproducible, and equal to the same definition written in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import attach_per_group
from .ordered import running_sums


CHUNK_HEX_DIGITS = 4


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{int(seed)}")))


def class_rank(df: DataFrame, target: str, id_col: str, seed: int, out: str = "_hrank",
               size: str | None = None) -> DataFrame:
    """1-based rank of each row inside its class in hash order; on request the
    number of rows of the class as well."""
    h = df.withColumn("_h", hash_key(id_col, seed))
    ranked = running_sums(h, [target], ["_h", id_col], chunk=F.substring("_h", 1, CHUNK_HEX_DIGITS),
                          position=out, size=size)
    return ranked.drop("_h")


def _class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("_nc"))


def stratified_split(df: DataFrame, target: str, id_col: str, test_fraction: float = 0.25,
                     seed: int = 2, out: str = "is_train") -> DataFrame:
    """Per class, ``ceil(test_fraction · n_c)`` rows (the last in hash order)
    go to test and the rest to train; adds ``is_train`` (1/0)."""
    j = class_rank(df, target, id_col, seed, size="_nc")
    n_train = F.col("_nc") - F.ceil(F.col("_nc") * F.lit(test_fraction))
    return j.withColumn(out, F.when(F.col("_hrank") <= n_train, 1).otherwise(0).cast("bigint")) \
            .drop("_hrank", "_nc")


def oversample(df: DataFrame, target: str, id_col: str, seed: int = 42, rank: str | None = None) -> DataFrame:
    """Random over-sampling to the largest class: each row is repeated
    ``floor(max/n_c)`` times plus once more for the first ``max mod n_c``
    rows of its class in hash order. Adds ``copy_index`` (0 = original) and
    keeps ``id_col`` as the original id. Every class ends with ``max`` rows.
    Rows ranked before (:func:`class_rank` with this seed) name that column as
    ``rank``, which is dropped; then no row is shuffled."""
    counts = cut_lineage(_class_counts(df, target))  # read twice below
    mx = counts.agg(F.max("_nc")).scalar()
    if rank:
        j = attach_per_group(df.withColumnRenamed(rank, "_hrank"), counts, [target], 32, materialized=True)
    else:
        j = class_rank(df, target, id_col, seed, size="_nc")
    copies = F.floor(mx / F.col("_nc")) + F.when(F.col("_hrank") <= mx % F.col("_nc"), 1).otherwise(0)
    return (j.withColumn("copy_index", F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))))
             .withColumn("copy_index", F.col("copy_index").cast("bigint"))
             .drop("_hrank", "_nc"))


def undersample(df: DataFrame, target: str, id_col: str, seed: int = 42) -> DataFrame:
    """Random under-sampling to the smallest class: the first ``min`` rows of
    each class in hash order."""
    mn = _class_counts(df, target).agg(F.min("_nc")).scalar()
    ranked = class_rank(df, target, id_col, seed)
    return ranked.filter(F.col("_hrank") <= mn).drop("_hrank")

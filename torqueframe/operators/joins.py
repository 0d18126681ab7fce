"""Joins of the reference (C1–C7) expressed for Spark.

Strategy: equi-joins are left to Catalyst/AQE — a side whose *measured* size
is under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, the rest is a
sort-merge join with skew splitting. Only lookup tables that are small by
construction (vocabularies, code tables written in code) carry an explicit
broadcast hint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def left_join_drop_collisions(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join; right columns whose name already exists on the left are
    dropped before the join (B5 done by name, not by a ``_y`` substring).
    A key with several right rows fans out (C1)."""
    on = list(on)
    keep = on + [c for c in right.columns if c not in left.columns]
    return left.join(right.select(*keep), on=on, how="left")


def left_join_null_keys(left: DataFrame, right: DataFrame, key: str,
                        null_keys_match: bool = False) -> DataFrame:
    """Left join on one key (C2). ``null_keys_match=True`` reproduces pandas,
    where a null key matches a null key; the default is SQL equality."""
    r = right.withColumnRenamed(key, "_rk")
    cond = left[key].eqNullSafe(r["_rk"]) if null_keys_match else left[key] == r["_rk"]
    return left.join(r, cond, "left").drop("_rk")


def semi_membership(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (C4)."""
    return df.join(other.select(key).distinct(), on=key, how="left_semi")


def values_not_in(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values of ``cols`` in ``df`` that do not occur in
    ``other`` (G6, set difference of values). The distinct runs first (partial
    aggregate before its shuffle); the anti join then reuses that hash
    partitioning on ``cols``."""
    cols = list(cols)
    vals = df.select(*cols).dropna().distinct()
    return vals.join(other.select(*cols), on=cols, how="left_anti")


def semi_membership_counts(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Count of matching rows of ``df`` and distinct keys of ``other`` (C4)."""
    n_match = semi_membership(df, other, key).agg(F.count(F.lit(1)).alias("c")).scalar()
    return other.agg(F.count_distinct(key).cast("bigint").alias("distinct_keys")).select(
        n_match.cast("bigint").alias("matching_rows"), "distinct_keys")


def coalesce_update(df: DataFrame, target: str, override: str, drop_override: bool = True) -> DataFrame:
    """``target`` takes ``override`` where that is not null."""
    out = df.withColumn(target, F.coalesce(F.col(override), F.col(target)))
    return out.drop(override) if drop_override else out


def mapping_table(spark: SparkSession, mapping: Mapping[str, str], key: str = "raw",
                  value: str = "mapped") -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"`{key}` string, `{value}` string")


def lookup_replace(df: DataFrame, col: str, table: DataFrame, key: str = "raw",
                   value: str = "mapped", keep_unmapped: bool = True) -> DataFrame:
    """Replace values found in a small lookup table (C7/H12); unmapped values
    stay (``keep_unmapped``) or become null. The table is small by
    construction, so it is broadcast."""
    t = F.broadcast(table.select(F.col(key).alias("_lk"), F.col(value).alias("_lv")))
    joined = df.join(t, df[col] == t["_lk"], "left")
    new = F.coalesce(F.col("_lv"), F.col(col)) if keep_unmapped else F.col("_lv")
    return joined.withColumn(col, new).drop("_lk", "_lv")


def join_back(df: DataFrame, per_group: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach a per-group result to its rows (C3); null keys drop out on both
    sides (inner equi-join)."""
    return df.join(per_group, on=list(keys), how="inner")


def _threshold(spark: SparkSession) -> int:
    v = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        return int(v)
    except ValueError:  # e.g. "10MB"
        units = {"kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "b": 1}
        s = v.strip().lower()
        for u, m in units.items():
            if s.endswith(u):
                return int(float(s[: -len(u)]) * m)
        return 10 << 20


def attach_per_group(rows: DataFrame, per_group: DataFrame, keys: Sequence[str],
                     bytes_per_group: int = 256, materialized: bool = False) -> DataFrame:
    """Join a one-row-per-group table back to its rows.

    The per-group table is written once (reliable checkpoint) and its exact
    row count is read from that copy; when ``rows · bytes_per_group`` fits
    under the broadcast threshold it is broadcast — the big side keeps its
    partitioning and is not shuffled again — otherwise it is a sort-merge
    join with AQE splitting skewed keys. The main plan reads the written
    copy instead of recomputing the aggregate."""
    from ..session import cut_lineage
    keys = list(keys)
    small_df = per_group if materialized else cut_lineage(per_group)
    n_groups = small_df.count()
    limit = _threshold(rows.sparkSession)
    small = limit > 0 and n_groups * bytes_per_group <= limit
    small_df = small_df.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:  # rows of a null group have their group's row too
        same = same & rows[k].eqNullSafe(small_df[f"_g_{k}"])
    return rows.join(F.broadcast(small_df) if small else small_df, on=same, how="inner").drop(*[f"_g_{k}" for k in keys])

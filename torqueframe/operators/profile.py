"""Table profiles (D6–D10): value counts, null / zero profiles, distinct
values, unmapped-value reports. Each is one aggregate pass; per-column
results are turned into long form with ``stack`` on the single result row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per non-null value, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_last(col)))


def _long_profile(df: DataFrame, per_col, label: str) -> DataFrame:
    cols = df.columns
    n = F.count(F.lit(1)).alias("_rows")
    wide = df.agg(n, *[F.coalesce(per_col(c).cast("bigint"), F.lit(0)).cast("bigint").alias(f"_{i}")
                       for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    stack = ", ".join(f"'{c}', '{types[c]}', `_{i}`" for i, c in enumerate(cols))
    long = wide.selectExpr("_rows", f"stack({len(cols)}, {stack}) as (column_name, column_type, {label})")
    return long.select("column_name", "column_type", label,
                       (F.try_divide(F.col(label), F.col("_rows")) * 100.0).alias(f"pct_{label}"))


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, null count, null percentage."""
    return _long_profile(df, lambda c: F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)), "n_null")


def zero_profile(df: DataFrame) -> DataFrame:
    """Per column: count and percentage of values equal to 0 (D8). Only
    numeric and string columns can equal 0 (strings compare as '0' never
    equals 0 in the original; they count 0 here too)."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)

    def is_zero(c):
        if types[c] in numeric or types[c].startswith("decimal"):
            return F.sum(F.when(F.col(c) == 0, 1).otherwise(0))
        return F.lit(0)
    return _long_profile(df, is_zero, "n_zero")


def distinct_count(df: DataFrame, col: str, out: str = "n_distinct") -> DataFrame:
    return df.agg(F.count_distinct(col).cast("bigint").alias(out))


def unmapped_report(per_key: DataFrame, mapped: str, raw: str, rows: str) -> DataFrame:
    """Keys whose mapped value is null: per raw value, the rows (summed from
    the column ``rows``) and keys that it removes (D10). One row per value, so
    no list of them is held anywhere."""
    return per_key.filter(F.col(mapped).isNull()).groupBy(F.col(raw).alias("unknown_value")).agg(
        F.sum(rows).cast("bigint").alias("rows_removed"), F.count(F.lit(1)).alias("keys_removed"))

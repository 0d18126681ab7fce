"""Column housekeeping and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import last_n, strip_char

# Placeholder plates flagged as registration errors.
PLACEHOLDER_PLATES = ["000000", "000001", "++++++"]


def lower_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def move_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    first = list(first)
    return df.select(*first, *[c for c in df.columns if c not in first])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*list(cols))


def exclude_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop rows whose value is in ``values``; nulls are kept."""
    cond = F.lit(True)
    for v in values:
        cond = cond & ~F.col(col).eqNullSafe(F.lit(v))
    return df.filter(cond)


def sales_cleanup(df: DataFrame, registration: str = "registration_number",
                  account: str = "slr_account", total: str = "total",
                  bad_accounts: Sequence = ("6", "4", "0", "1")) -> DataFrame:
    """Plate of 6 characters, account not in the excluded list (null kept),
    positive total (B7)."""
    cond = (F.length(F.col(registration)) == 6) & (F.col(total) > 0)
    for a in bad_accounts:
        cond = cond & ~F.col(account).eqNullSafe(F.lit(a))
    return df.filter(cond)


def registration_flag(df: DataFrame, col: str = "registration_number",
                      out: str = "registration_number_error_flag",
                      placeholders: Sequence[str] = PLACEHOLDER_PLATES) -> DataFrame:
    """Drop null plates; flag 1 when the length is not 6 or the plate is a
    placeholder, else 0 (B8)."""
    c = F.col(col)
    return (df.filter(c.isNotNull())
            .withColumn(out, F.when((F.length(c) != 6) | c.isin(list(placeholders)), 1)
                        .otherwise(0).cast("bigint")))


def normalise_keys(df: DataFrame, plate: str = "registration_number",
                   chassis: str = "chassis_number", chassis_len: int = 7) -> DataFrame:
    """Plate without dashes (H2), chassis reduced to its last characters (H1)."""
    out = df
    if plate in df.columns:
        out = out.withColumn(plate, strip_char(plate, "-"))
    if chassis in df.columns:
        out = out.withColumn(chassis, last_n(chassis, chassis_len))
    return out


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Nulls → 0 in numeric columns; strings stay null."""
    return df.na.fill(0)


def exclude_substrings(df: DataFrame, col: str, substrings: Sequence[str],
                       null_safe_col: str | None = None, excluded: Sequence[str] = ()) -> DataFrame:
    """Drop rows whose ``col`` contains any substring; optionally also rows
    whose ``null_safe_col`` equals one of ``excluded`` (nulls kept) (B11)."""
    cond = F.lit(True)
    for s in substrings:
        cond = cond & ~F.col(col).contains(s)
    out = df.filter(cond)
    if null_safe_col:
        out = exclude_values(out, null_safe_col, list(excluded))
    return out


def cast_like(df: DataFrame, template: DataFrame) -> DataFrame:
    """Cast the columns of ``df`` to the types of the same-named columns of
    ``template`` (B14)."""
    types = {f.name: f.dataType for f in template.schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def keep_one_target(df: DataFrame, target: str, targets: Sequence[str]) -> DataFrame:
    """Drop every target column but ``target``."""
    return df.drop(*[t for t in targets if t != target])


def constant_columns(df: DataFrame) -> list[str]:
    """Names of columns with exactly one distinct non-null value (B16): the
    least equals the greatest, from a single aggregate pass (an all-null column
    is not constant)."""
    row = df.agg(*[(F.min(F.col(c)) == F.max(F.col(c))).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c]]


def constant_column_table(df: DataFrame) -> DataFrame:
    """Distinct non-null count per column in long form: ``column_name, n_distinct``."""
    counts = df.agg(*[F.count_distinct(F.col(c)).cast("bigint").alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counts.selectExpr(f"stack({len(df.columns)}, {stack}) as (column_name, n_distinct)")


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))

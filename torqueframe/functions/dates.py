"""Date and duration expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

DAYS_PER_YEAR = 365.25


def whole_days(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (floor of the elapsed time, like
    ``Timedelta.days``), as BIGINT."""
    return F.timestamp_diff("DAY", as_col(start), as_col(end)).cast("bigint")


def date_parts(prefix: str, ts) -> list[Column]:
    """Day, month and year of a date as ``{prefix}_day`` etc. (BIGINT)."""
    c = as_col(ts)
    return [F.dayofmonth(c).cast("bigint").alias(f"{prefix}_day"),
            F.month(c).cast("bigint").alias(f"{prefix}_month"),
            F.year(c).cast("bigint").alias(f"{prefix}_year")]


def date_from_parts(y, m, d) -> Column:
    """Timestamp at midnight from numeric year, month, day; impossible dates
    give null instead of raising (``make_date`` raises under ANSI)."""
    s = F.format_string("%04d%02d%02d", as_col(y).cast("int"), as_col(m).cast("int"), as_col(d).cast("int"))
    return F.to_timestamp_ntz(F.try_to_timestamp(s, F.lit("yyyyMMdd")))


def months_to_years(c) -> Column:
    return as_col(c) / F.lit(12.0)

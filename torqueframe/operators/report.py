"""Report tables behind the original charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_counts_dense(df: DataFrame, date: str, category: str, start: str, end: str,
                         total_label: str = "Month Total") -> DataFrame:
    """Rows per (month, category) on a dense monthly calendar from ``start``
    to ``end`` (first days of months, inclusive), zeros filled, plus one
    total row per month (category = ``total_label``) (D20).

    Counts are one ``groupBy`` (partially aggregated); the calendar is
    generated per category with ``explode(sequence(...))`` from the distinct
    categories — no cross join; the month totals come from ``GROUPING SETS``
    over the dense table."""
    lo = F.to_date(F.lit(start))
    hi = F.to_date(F.lit(end))
    month = F.trunc(F.to_date(F.col(date)), "month")
    counts = (df.filter(F.col(category).isNotNull())
              .select(month.alias("month"), F.col(category).alias("category"))
              .filter((F.col("month") >= lo) & (F.col("month") <= hi))
              .groupBy("month", "category").agg(F.count(F.lit(1)).alias("n")))
    calendar = (df.select(F.col(category).alias("category")).filter(F.col("category").isNotNull())
                .distinct()
                .select("category", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month")))
    dense = calendar.join(counts, on=["month", "category"], how="left") \
                    .select("month", "category", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    rolled = dense.groupingSets([["month", "category"], ["month"]], "month", "category") \
                  .agg(F.sum("n").cast("bigint").alias("n"), F.grouping("category").alias("_g"))
    return rolled.select(
        F.date_format("month", "yyyy-MM").alias("month"),
        F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col("category")).alias("category"),
        "n")


def metrics_pivot(metrics: DataFrame, index: str | list[str], pivot: str, value: str,
                  values: list | None = None) -> DataFrame:
    """Gather a long ``metrics`` table into one comparison table (A12): one
    row per ``index`` (a column, or several such as the whole run tag), one
    column per ``pivot`` value. Two different values for one cell are an error:
    the index does not tell the runs apart."""
    g = metrics.groupBy(*([index] if isinstance(index, str) else index))
    g = g.pivot(pivot, values) if values else g.pivot(pivot)
    several = F.lit(f"several values of {value} in one cell")
    return g.agg(F.when(F.coalesce(F.min(value).eqNullSafe(F.max(value)), F.lit(True)), F.max(value))
                 .otherwise(F.raise_error(several)))

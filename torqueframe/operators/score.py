"""Per-vehicle totals, margin percentage, global scaling and scores (D1–D5,
H16–H18, H23–H26).

Global statistics (min, max, mean, std) are computed once as a one-row
aggregate and used through a *scalar subquery*: Spark runs the aggregate as a
separate job with map-side partial aggregation and inlines the single value
into the projection. No cross join, no window without partition keys (which
would move all rows into one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import (MARGIN_CLASS1_LIMITS, STOCK_CLASS1_LIMITS, STOCK_CLASS2_LIMITS,
                                 binary_target, right_closed_bucket, threshold_class)
from ..functions.numeric import exp_cdf, inverse_ratio_scale, minmax, probit, ratio


def global_stats(df: DataFrame, **aggs: Column) -> Column:
    """One scalar-subquery struct holding the named global aggregates;
    fields are read with ``stats[name]``."""
    row = df.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s"))
    return row.scalar()


def price_total(lines: DataFrame, key: str, cost: str, out: str = "price_total") -> DataFrame:
    """Sum of the line cost per key, one row per key."""
    return lines.groupBy(key).agg(F.sum(cost).alias(out))


def margin_percentage(lines: DataFrame, key: str, cost: str, margin: str,
                      out: str = "margem_percentagem") -> DataFrame:
    """``margin / sum(cost of the key) * 100`` on every line (D2). The key
    total is a grouped aggregate joined back, not an unordered window, so a
    hot key is partially aggregated before the shuffle."""
    totals = lines.groupBy(key).agg(F.sum(cost).alias("_total"))
    return (lines.join(totals, on=key, how="left")
            .withColumn(out, ratio(F.col(margin), F.col("_total")) * F.lit(100.0))
            .drop("_total"))


def minmax_score(df: DataFrame, days: str = "stock_days", margin: str = "margem_percentagem",
                 keep_norms: bool = True) -> DataFrame:
    """``score = (1 - days_norm) * margin_norm`` with global min–max scaling
    (D4). An empty range gives null instead of an error."""
    s = global_stats(df, dmin=F.min(days), dmax=F.max(days), mmin=F.min(margin), mmax=F.max(margin))
    days_norm = minmax(F.col(days), s["dmin"], s["dmax"])
    margin_norm = minmax(F.col(margin), s["mmin"], s["mmax"])
    out = df.select("*", days_norm.alias(f"{days}_norm"))
    out = out.select("*", (F.lit(1.0) - F.col(f"{days}_norm")).alias(f"inv_{days}_norm"),
                     margin_norm.alias(f"{margin}_norm"))
    out = out.withColumn("score", F.col(f"inv_{days}_norm") * F.col(f"{margin}_norm"))
    if not keep_norms:
        out = out.drop(f"{days}_norm", f"inv_{days}_norm", f"{margin}_norm")
    return out


def score_targets(df: DataFrame, days: str = "stock_days", margin: str = "margem_percentagem",
                  max_days: float = 45, min_margin: float = 3.5) -> DataFrame:
    """Score without helper columns plus the binary ``new_score`` target."""
    out = minmax_score(df, days, margin, keep_norms=False)
    return out.withColumn("new_score", binary_target(days, margin, max_days, min_margin))


def bucket_classes(df: DataFrame, days: str = "stock_days", margin: str = "margem_percentagem",
                   score: str = "score", stock1=STOCK_CLASS1_LIMITS, stock2=STOCK_CLASS2_LIMITS,
                   margin1=MARGIN_CLASS1_LIMITS, score_threshold: float = 0.7) -> DataFrame:
    """Right-closed class columns (H16); limits are parameters."""
    return df.select(
        "*",
        right_closed_bucket(days, stock1).alias("stock_class1"),
        right_closed_bucket(days, stock2).alias("stock_class2"),
        right_closed_bucket(margin, margin1, descending=True).alias("margem_class1"),
        threshold_class(score, score_threshold).alias("score_class"))


def zscore_population(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """``(x - mean) / std_pop`` over the whole table for each column (H23/H24);
    a constant column gives null."""
    aggs = {}
    for i, c in enumerate(cols):
        aggs[f"m{i}"] = F.avg(c)
        aggs[f"s{i}"] = F.stddev_pop(c)
    s = global_stats(df, **aggs)
    out = df
    for i, c in enumerate(cols):
        out = out.withColumn(c + suffix, ratio(F.col(c) - s[f"m{i}"], s[f"s{i}"]))
    return out


def alternative_day_scalings(df: DataFrame, days: str = "stock_days") -> DataFrame:
    """The three alternative day scalings (H25): ``(max·x+1)/(x+1)``, its
    min–max normalisation, and probit(exponential CDF(x)) (null where the CDF
    rounds to 1)."""
    s = global_stats(df, dmax=F.max(days))
    out = df.withColumn(f"{days}_norm_2", inverse_ratio_scale(F.col(days).cast("double"), s["dmax"]))
    s2 = global_stats(out, lo=F.min(f"{days}_norm_2"), hi=F.max(f"{days}_norm_2"))
    out = out.withColumn(f"{days}_norm_3", minmax(F.col(f"{days}_norm_2"), s2["lo"], s2["hi"]))
    return out.withColumn(f"{days}_norm_4", probit(exp_cdf(F.col(days).cast("double"))))


def tick_labels(df: DataFrame, col: str, inverted: bool = True, decimals: int = 4) -> DataFrame:
    """Min–max normalised value formatted with ``decimals`` digits (H26);
    ``inverted`` gives ``1 - norm`` (the stock-days axis)."""
    s = global_stats(df, lo=F.min(col), hi=F.max(col))
    norm = minmax(F.col(col), s["lo"], s["hi"])
    if inverted:
        norm = F.lit(1.0) - norm
    return df.withColumn(f"{col}_tick", F.format_string(f"%.{int(decimals)}f", norm))


def category_means(df: DataFrame, category: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each column per category."""
    return df.groupBy(category).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


def group_summary(df: DataFrame, keys: Sequence[str], margin: str = "margem_percentagem",
                  days: str = "stock_days") -> DataFrame:
    """Per group: number of sales, mean margin, mean stock days truncated to
    an integer (D3), broadcast back to every row of the group (E12)."""
    from .joins import attach_per_group
    keys = list(keys)
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nr_cars_sold"),
        F.avg(margin).alias("average_percentage_margin"),
        F.avg(days).cast("bigint").alias("average_stock_days"))
    return attach_per_group(df, agg, keys, bytes_per_group=64)

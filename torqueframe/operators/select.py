"""Univariate feature scores and k-best selection.

Features are turned to long form with ``stack`` (a projection, no shuffle),
then one ``groupBy`` per statistic gives per-(feature, class) partial sums;
the score of each feature is finished over that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _long(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in features)
    return df.selectExpr(f"CAST(`{target}` AS STRING) AS _y",
                         f"stack({len(features)}, {stack}) AS (feature, x)")


def chi2_scores(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """chi² of non-negative features against the class (sklearn ``chi2``):
    observed = per-class feature sum, expected = class share · feature sum."""
    long = _long(df, features, target)
    per = long.groupBy("feature", "_y").agg(F.sum("x").alias("obs"), F.count(F.lit(1)).alias("nc"))
    w = Window.partitionBy("feature")
    per = per.select("*", F.sum("obs").over(w).alias("tot"), F.sum("nc").over(w).alias("n"))
    exp = F.col("nc") / F.col("n") * F.col("tot")
    term = F.try_divide(F.pow(F.col("obs") - exp, 2), exp)
    return per.groupBy("feature").agg(F.sum(term).alias("score"))


def anova_f_scores(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One-way ANOVA F of each feature across classes (sklearn ``f_classif``);
    null with a single class, or with as many classes as rows; infinite if the
    classes explain all that varies."""
    # a null value is no observation of its feature
    long = _long(df, features, target).where("x is not null")
    per = long.groupBy("feature", "_y").agg(
        F.count(F.lit(1)).alias("nc"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"))
    g = per.groupBy("feature").agg(
        F.sum("nc").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("s"),
        F.sum("ss").alias("ss"), F.sum(F.col("s") * F.col("s") / F.col("nc")).alias("between_raw"))
    ss_between = F.col("between_raw") - F.col("s") * F.col("s") / F.col("n")
    ss_total = F.col("ss") - F.col("s") * F.col("s") / F.col("n")
    ss_within = ss_total - ss_between
    f = F.try_divide(F.try_divide(ss_between, F.col("k") - 1), F.try_divide(ss_within, F.col("n") - F.col("k")))
    parted = (ss_within <= 0) & (ss_between > 0) & (F.col("n") > F.col("k")) & (F.col("k") > 1)
    return g.select("feature", F.when(parted, F.lit(float("inf"))).otherwise(f).alias("score"))


def mutual_info_scores(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Mutual information (nats) between each discrete feature and the
    class: H(x) + H(y) − H(x, y), with n·H = n·ln n − Σ c·ln c over counts c.

    Three grouped sums of c·ln c, each partially aggregated; no window, so a
    feature of many distinct values is many tasks' work."""
    joint = _long(df, features, target).groupBy("feature", "x", "_y").agg(F.count(F.lit(1)).alias("c"))

    def plogp(sign: int, *keys: str) -> DataFrame:
        part = joint if len(keys) == 3 else joint.groupBy(*keys).agg(F.sum("c").alias("c"))
        return part.groupBy("feature").agg((F.lit(sign) * F.sum(F.col("c") * F.log("c"))).alias("t"),
                                           (F.lit(sign) * F.sum("c")).alias("n"))

    parts = plogp(-1, "feature", "x").unionByName(plogp(-1, "feature", "_y")).unionByName(
        plogp(1, "feature", "x", "_y"))
    total = parts.groupBy("feature").agg(F.sum("t").alias("t"), (-F.sum("n")).alias("n"))
    return total.select("feature", (F.log("n") + F.col("t") / F.col("n")).alias("score"))


def rank_scores(scores: DataFrame, score: str = "score", name: str = "feature",
                k: int | None = None) -> DataFrame:
    """Rank 1..n by score descending, name ascending (F5); ``k`` keeps the
    top k (F4). The score table has one row per feature."""
    w = Window.orderBy(F.desc_nulls_last(score), F.asc(name))
    out = scores.select("*", F.row_number().over(w).cast("bigint").alias("rank"))
    return out.filter(F.col("rank") <= k) if k else out


def select_k_best(df: DataFrame, scores: DataFrame, k: int, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the ``k`` best-scoring feature columns plus ``keep`` (F6). The
    chosen names (at most k) are read on the driver to shape the output."""
    names = [r["feature"] for r in rank_scores(scores, k=k).orderBy("rank").collect()]
    return df.select(*names, *keep)

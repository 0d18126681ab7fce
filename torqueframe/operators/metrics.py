"""Evaluation metrics as tables.

Every metric is an aggregate over a prediction table (ground truth,
prediction, score), so it runs where the predictions are and only counts
reach the final step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordered import running_sums


def confusion_counts(df: DataFrame, gt: str, pred: str, normalize: bool = False) -> DataFrame:
    """Long confusion matrix ``(gt, pred, n[, rate])``; ``rate`` = n / row
    total (row-normalised matrix) (D11)."""
    c = df.groupBy(F.col(gt).alias("gt"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        c = c.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy("gt")))
    return c


def binary_confusion(df: DataFrame, gt: str, pred: str, positive=1) -> DataFrame:
    """TN, FP, FN, TP and specificity TN/(TN+FP) in one row."""
    p_gt = F.col(gt) == F.lit(positive)
    p_pr = F.col(pred) == F.lit(positive)

    def cnt(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    c = df.agg(cnt(~p_gt & ~p_pr).alias("tn"), cnt(~p_gt & p_pr).alias("fp"),
               cnt(p_gt & ~p_pr).alias("fn"), cnt(p_gt & p_pr).alias("tp"))
    return c.withColumn("specificity", F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")))


def _per_label(c: DataFrame) -> DataFrame:
    # the rows are counted once; what is doubled has labels² rows
    zero = F.lit(0).cast("bigint")
    g = c.select(F.col("gt").alias("label"), F.col("n").alias("in_gt"), zero.alias("in_pred"),
                 F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(zero).alias("hit"))
    p = c.select(F.col("pred").alias("label"), zero.alias("in_gt"), F.col("n").alias("in_pred"), zero.alias("hit"))
    return g.unionByName(p).groupBy("label").agg(
        F.sum("hit").alias("tp"), F.sum("in_gt").alias("support"), F.sum("in_pred").alias("predicted"))


def class_report(df: DataFrame, gt: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per label (labels of truth or
    prediction), then ``avg/total`` weighted by support (D13). Undefined
    ratios are 0, as in the original report."""
    t = _per_label(confusion_counts(df, gt, pred))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = t.select(F.col("label").cast("string").alias("class"), prec.alias("precision"),
                   rec.alias("recall"), "support")
    per = per.withColumn("f1_score", F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        F.lit(0.0)))
    tot = per.agg(
        F.lit("avg/total").alias("class"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("precision"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("recall"),
        F.sum("support").alias("support"),
        F.try_divide(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("f1_score"))
    return per.unionByName(tot).withColumn("support", F.col("support").cast("bigint"))


def f1_summary(df: DataFrame, gt: str, pred: str) -> DataFrame:
    """Micro F1, macro F1 over the labels that occur in the predictions (as
    the original computes them), and accuracy (D12)."""
    return f1_of_counts(confusion_counts(df, gt, pred))


def f1_of_counts(c: DataFrame) -> DataFrame:
    """:func:`f1_summary` from the confusion counts."""
    t = _per_label(c).filter(F.col("predicted") > 0)
    fp = F.col("predicted") - F.col("tp")
    fn = F.col("support") - F.col("tp")
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + fp + fn), F.lit(0.0))
    s = t.agg(F.sum("tp").alias("tp"), F.sum(fp).alias("fp"), F.sum(fn).alias("fn"),
              F.avg(f1).alias("macro_f1"))
    same = F.col("gt") == F.col("pred")
    acc = c.agg(F.try_divide(F.sum(F.when(same, F.col("n")).when(~same, 0)), F.sum(F.when(same.isNotNull(), F.col("n"))))).scalar()
    return s.select(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("micro_f1"),
                    "macro_f1", acc.alias("accuracy"))


def specificity_of_counts(c: DataFrame, positive=1) -> Column:
    """:func:`binary_confusion`'s specificity, as a scalar, from the confusion counts."""
    p_gt, p_pr = F.col("gt") == F.lit(positive), F.col("pred") == F.lit(positive)
    tn, fp = (F.sum(F.when(cond, F.col("n")).otherwise(0)) for cond in (~p_gt & ~p_pr, ~p_gt & p_pr))
    return c.agg(F.try_divide(tn, tn + fp)).scalar()


def unscored(df: DataFrame, score: str) -> DataFrame:
    """How many rows have no score, and so are left out of the curve."""
    return df.agg(F.count_if(F.col(score).isNull()).alias("unscored"))


def roc_points(df: DataFrame, gt: str, score: str, positive=1) -> DataFrame:
    """ROC points per distinct score (thresholds descending): ``fpr``, ``tpr``.
    Distinct scores are first reduced by a ``groupBy`` and written once, dealt to
    ranges as Spark's own sort does (sampled bounds, as many ranges as the shuffle
    has partitions, small ones merged). A range is a chunk of the chunked scan, so
    no single task orders all thresholds and an outlier does not collapse them. Rows with a null score are no point (see
    :func:`unscored`)."""
    df = df.where(F.col(score).isNotNull())
    pos = (F.col(gt) == F.lit(positive)).cast("bigint")
    per = df.groupBy(F.col(score).alias("threshold")).agg(F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg"))
    per = cut_lineage(per.withColumn("_t", -F.col("threshold")).repartitionByRange("_t").withColumn(
        "_range", F.spark_partition_id()))  # read three times below
    ordered = running_sums(per, [], ["_t"], ["pos", "neg"], chunk=F.col("_range"), position=None)
    tot = per.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    return ordered.select("threshold", "pos", "neg",
                          F.try_divide(F.col("cum_neg"), tot["n"]).alias("fpr"),
                          F.try_divide(F.col("cum_pos"), tot["p"]).alias("tpr"))


def auc(df: DataFrame, gt: str, score: str, positive=1) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule over the points of
    :func:`roc_points` (ties grouped). Each threshold adds
    ``neg·(2·cum_pos − pos) / 2``; no lag is needed."""
    pts = roc_points(df, gt, score, positive)
    scored = df.where(F.col(score).isNotNull())
    tot = scored.agg(F.struct(F.sum((F.col(gt) == F.lit(positive)).cast("bigint")).alias("p"),
                              F.sum((F.col(gt) != F.lit(positive)).cast("bigint")).alias("n"))).scalar()
    cum_pos = F.col("tpr") * tot["p"]
    return pts.agg(F.try_divide(F.sum(F.col("neg") * (2 * cum_pos - F.col("pos")) / 2),
                                tot["p"] * tot["n"]).alias("auc"))


def mse_r2(df: DataFrame, y: str, p: str) -> DataFrame:
    """Mean squared error and R² = 1 − SSE/SST."""
    mean_y = df.agg(F.avg(y)).scalar()
    return df.agg(F.avg(F.pow(F.col(y) - F.col(p), 2)).alias("mse"),
                  (F.lit(1.0) - F.try_divide(F.sum(F.pow(F.col(y) - F.col(p), 2)),
                                             F.sum(F.pow(F.col(y) - mean_y, 2)))).alias("r2"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns in long form
    ``(col_a, col_b, corr)``: one aggregate pass over the pairs of the upper
    triangle, mirrored in the small result (D16)."""
    cols = list(cols)
    upper = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    wide = df.agg(*[F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"_{i}_{j}")
                    for i, j in upper])
    stack = ", ".join(f"'{a}', '{b}', `_{min(i, j)}_{max(i, j)}`" for i, a in enumerate(cols) for j, b in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols) ** 2}, {stack}) AS (col_a, col_b, corr)")


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson r of two columns."""
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("pearson_r"))

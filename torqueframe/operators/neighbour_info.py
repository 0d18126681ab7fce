"""Mutual information of a continuous feature and a class (K8).

The nearest-neighbour estimator: a point's radius is the distance to its k-th
neighbour of its own class, and m counts the points of all classes within less
than that. With N points, n_y of a point's class and k' = min(k, n_y - 1), the
information is psi(N) + <psi(k')> - <psi(n_y)> - <psi(m)>, not below 0.

In one dimension both steps are ordered scans. Equal values are one row with a
count throughout, so a value that a third of the rows share is no hot key. Sorted
ranges of (feature, class, value) hand k values to their neighbours; a second order
of values and interval ends gives m as a difference of running counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .ordered import running_sums
from .select import _long

RANGE_ROWS = 100_000  # distinct values in a sorted range, on average


def digamma(x: Column) -> Column:
    """psi of a positive integer or real, to about 1e-12: its series at x + 8."""
    z = x + 8.0
    s = F.log(z) - 1 / (2 * z) - 1 / (12 * z ** 2) + 1 / (120 * z ** 4) - 1 / (252 * z ** 6) + 1 / (240 * z ** 8)
    for i in range(8):
        s = s - 1 / (x + float(i))
    return s


def _ranged(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """``df`` with the number of its sorted range, written once."""
    return stored(df.repartitionByRange(max(1, math.ceil(n / RANGE_ROWS)), *order).withColumn(
        "_cut", F.spark_partition_id()))


def _radii(k: int):
    def run(pdf: pd.DataFrame, halo: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        before, after = (np.stack([[v["x"], v["w"]] for v in halo[c].iloc[0]]) if len(halo[c].iloc[0]) else np.empty((0, 2))
                         for c in ("before", "after"))
        own = pdf[["x", "w"]].to_numpy()
        # k places on either side, empty ones infinitely far
        pad = np.array([[np.inf, 0.0]])
        z = np.concatenate([np.repeat(-pad * [1, 0] + [0, 0], k - len(before), 0) if len(before) < k else np.empty((0, 2)),
                            before, own, after, np.repeat(pad, k - len(after), 0)])
        x, w = own[:, 0], own[:, 1]
        near = np.minimum(k, pdf["nc"].to_numpy() - 1)
        at = np.arange(len(own)) + k
        steps = [s for i in range(1, k + 1) for s in (-i, i)]
        value = np.stack([z[at + s, 0] for s in steps], axis=1)
        weight = np.stack([z[at + s, 1] for s in steps], axis=1)
        with np.errstate(invalid="ignore"):
            dist = np.abs(value - x[:, None])
        order = np.argsort(dist, axis=1, kind="stable")
        total = (w - 1)[:, None] + np.cumsum(np.take_along_axis(weight, order, 1), axis=1)
        first = (total >= near[:, None]).argmax(1)
        r = np.where(w - 1 >= near, 0.0, np.take_along_axis(dist, order, 1)[np.arange(len(x)), first])
        # an end that is a data value is taken from the data: x + r may miss it by a rounding
        side = np.array([s > 0 for s in steps])
        tied = dist == r[:, None]
        up = np.where((tied & side).any(1), np.where(tied & side, value, np.inf).min(1), x + r)
        down = np.where((tied & ~side).any(1), np.where(tied & ~side, value, -np.inf).max(1), x - r)
        zero = r == 0
        return pd.DataFrame({"feature": pdf["feature"], "w": pdf["w"], "nc": pdf["nc"], "near": near,
                             "lo": np.where(zero, x, down), "lo_tie": np.where(zero, 0, 2),
                             "hi": np.where(zero, x, up), "hi_tie": np.where(zero, 2, 0)})
    return run


def _halos(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        cut, rows = pdf["_cut"].to_numpy(), pdf[["x", "w"]].to_dict("records")
        out = []
        for c in np.unique(cut):
            lo, hi = np.searchsorted(cut, c, side="left"), np.searchsorted(cut, c, side="right")
            out.append((pdf["feature"].iloc[0], pdf["_y"].iloc[0], int(c), rows[max(0, lo - k):lo], rows[hi:hi + k]))
        return pd.DataFrame(out, columns=["feature", "_y", "_cut", "before", "after"])
    return run


def mutual_info_continuous(df: DataFrame, features: Sequence[str], target: str, k: int = 3) -> DataFrame:
    """(feature, score) in nats. A null value is no observation of its feature, nor
    is a row whose class the feature has only once."""
    long = _long(df, features, target).where("x is not null and _y is not null").withColumn("x", F.col("x") + 0.0)
    values = long.groupBy("feature", "_y", "x").agg(F.count(F.lit(1)).alias("w"))
    values = stored(values)
    classes = values.groupBy("feature", "_y").agg(F.sum("w").alias("nc")).where("nc > 1")
    values = values.join(classes, ["feature", "_y"])
    n = values.count()
    cut = _ranged(values, ["feature", "_y", "x"], n)
    keys = ["feature", "_y", "_cut"]
    w = Window.partitionBy(*keys)
    ends = cut.withColumn("_a", F.row_number().over(w.orderBy("x"))).withColumn(
        "_b", F.row_number().over(w.orderBy(F.col("x").desc()))).where((F.col("_a") <= k) | (F.col("_b") <= k))
    point = "array<struct<x:double,w:double>>"
    halos = ends.select(*keys, "x", F.col("w").cast("double").alias("w")).groupBy("feature", "_y").applyInPandas(
        _halos(k), f"feature string, _y string, _cut int, before {point}, after {point}")
    rows = cut.groupBy(*keys).cogroup(halos.groupBy(*keys)).applyInPandas(
        _radii(k), "feature string, w long, nc long, near long, lo double, lo_tie int, hi double, hi_tie int")
    rows = stored(rows)
    # m by row: values before the upper end less those up to the lower one
    zero, one = F.lit(0).cast("long"), F.lit(1)
    points = values.groupBy("feature", F.col("x").alias("v"), one.alias("tie")).agg(F.sum("w").alias("c"))
    asked = [rows.select("feature", F.col(e).alias("v"), F.col(f"{e}_tie").alias("tie"), zero.alias("c")) for e in ("lo", "hi")]
    events = points.unionByName(asked[0]).unionByName(asked[1]).groupBy("feature", "v", "tie").agg(F.sum("c").alias("c"))
    events = _ranged(events, ["feature", "v", "tie"], 3 * n)
    counts = running_sums(events.withColumnRenamed("_cut", "_part"), ["feature"], ["v", "tie"], ["c"],
                          chunk=F.col("_part"), position=None).select("feature", "v", "tie", "cum_c")
    counts = stored(counts)
    out = rows
    for e in ("lo", "hi"):
        own = counts.select("feature", F.col("v").alias(e), F.col("tie").alias(f"{e}_tie"), F.col("cum_c").alias(f"_{e}"))
        out = out.join(own, ["feature", e, f"{e}_tie"])
    m = F.col("_hi") - F.col("_lo")
    share = F.col("w") * (digamma(F.col("near")) - digamma(F.col("nc")) - digamma(m))
    total = out.groupBy("feature").agg(F.sum("w").alias("n"), F.sum(share).alias("s"))
    return total.select("feature", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("s") / F.col("n")).alias("score"))

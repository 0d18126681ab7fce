"""Bucketing, binary targets, keep-or-other grouping, per-row argmax."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

# Class limits of the stock-days and margin classes
# (right-closed intervals) and the score-class threshold.
STOCK_CLASS1_LIMITS = [16, 60, 100, 200]          # labels 0, 1, 2, 3, 4
STOCK_CLASS2_LIMITS = [16, 29, 117]               # labels 0, 1, 2, 3
MARGIN_CLASS1_LIMITS = [0.1, 0.206, 0.349]        # labels 3, 2, 1, 0 (descending)
SCORE_CLASS_THRESHOLD = 0.7
NEW_SCORE_MAX_DAYS = 45
NEW_SCORE_MIN_MARGIN = 3.5


def right_closed_bucket(x, limits, descending: bool = False) -> Column:
    """Class index for right-closed intervals ``(-inf, l0], (l0, l1], …``;
    null stays null. ``descending`` numbers the classes from the top."""
    x = as_col(x)
    n = len(limits)
    expr = None
    for i, lim in enumerate(limits):
        label = (n - i) if descending else i
        expr = (F.when(x <= F.lit(lim), F.lit(label)) if expr is None
                else expr.when(x <= F.lit(lim), F.lit(label)))
    last = 0 if descending else n
    return expr.when(x.isNotNull(), F.lit(last)).otherwise(F.lit(None)).cast("bigint")


def threshold_class(x, threshold: float = SCORE_CLASS_THRESHOLD) -> Column:
    """0 for ``0 <= x < t``, 1 for ``x >= t``, null otherwise (negative or null)."""
    x = as_col(x)
    return (F.when(x >= F.lit(threshold), F.lit(1))
            .when(x >= F.lit(0), F.lit(0))).cast("bigint")


def binary_target(days, margin, max_days: float = NEW_SCORE_MAX_DAYS,
                  min_margin: float = NEW_SCORE_MIN_MARGIN) -> Column:
    """1 when ``days <= max_days`` and ``margin >= min_margin``, else 0."""
    return F.when((as_col(days) <= F.lit(max_days)) & (as_col(margin) >= F.lit(min_margin)),
                  F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def keep_or_other(c, keep, other: str = "outros") -> Column:
    """Listed values and nulls pass; every other value becomes ``other``."""
    c = as_col(c)
    return F.when(c.isNull() | c.isin(list(keep)), c).otherwise(F.lit(other))


def argmax_label(cols, labels=None) -> Column:
    """Label of the column holding the row maximum; the first column wins a
    tie (so an all-zero row gives the first label)."""
    labels = list(labels or cols)
    top = F.greatest(*[as_col(c) for c in cols])
    return F.coalesce(*[F.when(as_col(c) == top, F.lit(lab)) for c, lab in zip(cols, labels)])

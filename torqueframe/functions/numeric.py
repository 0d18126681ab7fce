"""Numeric expressions: safe ratios, alternative scalings, sigmoid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col


def ratio(num, den) -> Column:
    """``num / den``; null when ``den`` is 0 or null (ANSI-safe)."""
    return F.try_divide(as_col(num), as_col(den))


def minmax(x, lo, hi) -> Column:
    """(x - lo) / (hi - lo); null when the range is empty."""
    x = as_col(x)
    return ratio(x - as_col(lo), as_col(hi) - as_col(lo))


def inverse_ratio_scale(x, x_max) -> Column:
    """``(max·x + 1) / (x + 1)``, the first alternative day scaling."""
    x = as_col(x)
    return ratio(as_col(x_max) * x + F.lit(1.0), x + F.lit(1.0))


def exp_cdf(x) -> Column:
    """CDF of the unit exponential distribution (0 for x < 0)."""
    x = as_col(x)
    return F.when(x < 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.exp(-x))


# Coefficients of Acklam's rational approximation of the
# inverse normal CDF (central region a/b, tails c/d) and the tail boundary.
PROBIT_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
PROBIT_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01]
PROBIT_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
PROBIT_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00]
PROBIT_P_LOW = 0.02425


def probit(p) -> Column:
    """Inverse of the standard normal CDF by Acklam's published rational
    approximation (relative error < 1.2e-9). p outside (0, 1) → null."""
    p = as_col(p)
    a, b, c, d, p_low = PROBIT_A, PROBIT_B, PROBIT_C, PROBIT_D, PROBIT_P_LOW

    def poly(coefs, v):
        out = F.lit(coefs[0])
        for k in coefs[1:]:
            out = out * v + F.lit(k)
        return out

    q_tail = F.sqrt(F.lit(-2.0) * F.log(p))
    lower = poly(c, q_tail) / (poly(d, q_tail) * q_tail + F.lit(1.0))
    q_up = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    upper = -poly(c, q_up) / (poly(d, q_up) * q_up + F.lit(1.0))
    q = p - F.lit(0.5)
    r = q * q
    central = poly(a, r) * q / (poly(b, r) * r + F.lit(1.0))
    return (F.when((p <= 0) | (p >= 1) | p.isNull(), F.lit(None).cast("double"))
            .when(p < p_low, lower)
            .when(p <= 1 - p_low, central)
            .otherwise(upper))


def sigmoid(x, derivative: bool = False) -> Column:
    """Logistic function, or ``x·(1-x)`` when ``derivative`` (as coded, the
    derivative takes an already-activated value)."""
    x = as_col(x)
    if derivative:
        return x * (F.lit(1.0) - x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))

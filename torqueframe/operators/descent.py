"""Gradient fits of many models at once.

A search over C values, folds and starts is one array of parameter vectors. A
pass over the blocks gives every model's loss and gradient, and the driver moves
all of them, each with its own step length; models that have converged leave the
passes. Hinge models move by Newton's method as long as their Hessians together
have at most ``HESSIANS`` entries (a few passes). Of the logistic ones only one of
each C does (the one of all rows); the models of the folds, which differ from it by
a few rows, start there and move by L-BFGS with its Hessian, whose passes need
gradients alone. Wider models and the network move by plain L-BFGS (more passes,
and memory in proportion to the weights). Losses are means over a model's training rows plus
``|w|^2 / (2 C n)``, so C has the meaning it has in the original's library; the
intercept is not penalised.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Block, Blocks, counted, feature_array, scores

HISTORY = 10
HESSIANS = 1 << 23  # entries of all Hessians of a pass, 64 MB
TILE = 1024  # rows that the network holds at a time: their layer stays in a core's cache
MARGINS = 256  # rows whose margins under all logistic models are held at a time, for the same reason
RIDGE = 1e-10  # added to the diagonal of a Hessian before it is solved
SMOOTHINGS = (1.0, 0.1, 0.01)  # widths of the parabola that rounds the hinge, one after another


def minimise(evaluate: Callable, x: np.ndarray, scale: Sequence[np.ndarray] | None = None, passes: int = 300,
             tol: float = 1e-6) -> tuple[np.ndarray, np.ndarray, int]:
    """L-BFGS on every row of ``x``. ``evaluate(x, which)`` returns the values and
    gradients of the models ``which``; ``scale`` is for each model a guess of its
    inverse Hessian, a matrix or the diagonal of one. Returns the points, their
    values and the number of passes."""
    k = len(x)
    scale = np.ones_like(x) if scale is None else scale
    x = x.copy()
    f, g = evaluate(x, np.arange(k))
    used = 1
    s_hist, y_hist = np.zeros((HISTORY, *x.shape)), np.zeros((HISTORY, *x.shape))
    rho, n_hist = np.zeros((HISTORY, k)), np.zeros(k, dtype=int)
    step, d = np.ones(k), np.zeros_like(x)
    active = np.abs(g).max(1) > tol
    fresh = active.copy()
    while active.any() and used < passes:
        for i in np.flatnonzero(active & fresh):
            d[i] = _direction(g[i], scale[i], s_hist[:, i], y_hist[:, i], rho[:, i], n_hist[i])
            if d[i] @ g[i] >= 0:  # not downhill: start again from the gradient
                n_hist[i], d[i] = 0, -_scaled(scale[i], g[i])
            step[i] = 1.0
        which = np.flatnonzero(active)
        trial = x[which] + step[which, None] * d[which]
        ft, gt = evaluate(trial, which)
        used += 1
        slope = np.einsum("ij,ij->i", g[which], d[which])
        good = np.isfinite(ft) & (ft <= f[which] + 1e-4 * step[which] * slope + 1e-15 * np.abs(f[which]))
        for j, i in enumerate(which):
            fresh[i] = good[j]
            if good[j]:
                s, y = trial[j] - x[i], gt[j] - g[i]
                if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                    at = n_hist[i] % HISTORY
                    s_hist[at, i], y_hist[at, i], rho[at, i] = s, y, 1 / (s @ y)
                    n_hist[i] += 1
                gain = f[i] - ft[j]
                x[i], f[i], g[i] = trial[j], ft[j], gt[j]
                if np.abs(g[i]).max() <= tol or gain <= 1e-14 * max(1.0, abs(f[i])):
                    active[i] = False
            else:
                step[i] *= 0.3
                if step[i] < 1e-12:
                    active[i] = False
    return x, f, used


def newton(evaluate: Callable, x: np.ndarray, passes: int = 100,
           tol: float = 1e-8) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Damped Newton steps on every row of ``x``. ``evaluate(x, which)`` returns
    values, gradients and Hessians. Results as of ``minimise``, and the last Hessians."""
    x = x.copy()
    f, g, h = evaluate(x, np.arange(len(x)))
    used, step = 1, np.ones(len(x))
    ridge = RIDGE * np.eye(x.shape[1])
    d = -np.linalg.solve(h + ridge, g[..., None])[..., 0]
    active = np.abs(g).max(1) > tol
    while active.any() and used < passes:
        which = np.flatnonzero(active)
        trial = x[which] + step[which, None] * d[which]
        ft, gt, ht = evaluate(trial, which)
        used += 1
        slope = np.einsum("ij,ij->i", g[which], d[which])
        good = np.isfinite(ft) & (ft <= f[which] + 1e-4 * step[which] * slope + 1e-14 * np.abs(f[which]))
        on = which[good]
        gain = f[on] - ft[good]
        x[on], f[on], g[on], h[on] = trial[good], ft[good], gt[good], ht[good]
        d[on] = -np.linalg.solve(ht[good] + ridge, gt[good][..., None])[..., 0]
        step[on] = 1.0
        active[on] = (np.abs(g[on]).max(1) > tol) & (gain > 1e-3 * tol * np.maximum(1e-3, np.abs(f[on])))
        off = which[~good]
        step[off] *= 0.4
        active[off] = step[off] > 1e-10
    return x, f, used, h


def _scaled(scale: np.ndarray, v: np.ndarray) -> np.ndarray:
    return scale @ v if scale.ndim == 2 else scale * v


def _direction(g, scale, s_hist, y_hist, rho, n):
    q = g.copy()
    order = [j % HISTORY for j in range(max(0, n - HISTORY), n)]
    alpha = {}
    for j in reversed(order):
        alpha[j] = rho[j] * (s_hist[j] @ q)
        q -= alpha[j] * y_hist[j]
    if order:
        s, y = s_hist[order[-1]], y_hist[order[-1]]
        gamma = (s @ y) / max(y @ _scaled(scale, y), 1e-300)
    else:
        gamma = 1.0
    q = gamma * _scaled(scale, q)
    for j in order:
        q += (alpha[j] - rho[j] * (y_hist[j] @ q)) * s_hist[j]
    return -q


def _loss(kind: str, z: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Value and derivative for the margin ``z = y f(x)``, y of -1 or 1."""
    if kind == "logistic":
        with np.errstate(over="ignore"):
            return np.logaddexp(0, -z), -1 / (1 + np.exp(z))
    u = 1 - z  # the hinge, with a parabola of ``width`` in place of its corner
    value = np.where(u <= 0, 0.0, np.where(u < width, u * u / (2 * width), u - width / 2))
    return value, -np.clip(u / width, 0, 1)


def _curvature(kind: str, z: np.ndarray, width: float) -> np.ndarray:
    """Second derivative of ``_loss``."""
    if kind == "logistic":
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return p * (1 - p)
    return ((z < 1) & (z > 1 - width)) / width


def _logistic_sums(x: np.ndarray, sign: np.ndarray, mask: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """Sums of ``_loss`` and of its gradients over the rows of each model's ``mask``
    (1 or 0). An exponential serves both, and the logarithms of a tile are one
    logarithm of a product of at most ``MARGINS`` factors between 1 and 2."""
    values, grads = np.zeros(len(w)), np.zeros_like(w)
    for at in range(0, len(x), MARGINS):
        rows, own, y = x[at:at + MARGINS], mask[at:at + MARGINS], sign[at:at + MARGINS]
        z = (rows @ w[:, :-1].T + w[:, -1]) * y
        e = np.exp(-np.abs(z))
        slope = np.where(z > 0, e, 1.0)
        slope /= 1 + e
        slope *= own
        slope *= -y
        grads[:, :-1] += slope.T @ rows
        grads[:, -1] += slope.sum(0)
        values += np.log(np.multiply.reduce(1 + e * own, axis=0)) - (np.minimum(z, 0) * own).sum(0)
    return [values, grads]


@dataclass
class LinearModel:
    kind: str  # logistic or hinge
    coefficients: np.ndarray
    intercept: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.coefficients + self.intercept

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``decision_function``, ``prediction`` and, for the logistic
        model, ``proba_1``; column arithmetic only."""
        w = F.array(*[F.lit(float(c)) for c in self.coefficients]).cast("array<double>")
        products = F.zip_with(feature_array(df, features), w, lambda a, b: a * b)
        m = F.aggregate(products, F.lit(float(self.intercept)), lambda acc, v: acc + v)
        out = df.withColumn("decision_function", m)
        if self.kind == "logistic":
            out = out.withColumn("proba_1", 1 / (1 + F.exp(-F.col("decision_function"))))
        return out.withColumn("prediction", (F.col("decision_function") > 0).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"kind": self.kind, "coefficients": self.coefficients.tolist(), "intercept": self.intercept}
        spark.createDataFrame([("LinearModel", json.dumps(meta), bytearray())],
                              "model string, settings string, arrays binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        m = json.loads(spark.read.parquet(path).first()["settings"])
        return cls(m["kind"], np.array(m["coefficients"]), m["intercept"])


@dataclass
class Fits:
    """Parameters by model (weights, then the intercept), with the number of passes."""
    weights: np.ndarray
    values: np.ndarray
    passes: int


def linear_fits(blocks: Blocks, kind: str, cs: Sequence[float], folds: Sequence[int], tol: float = 1e-7,
                passes: int = 400) -> Fits:
    """All (fold, C) models, folds outermost: one pass gives all their gradients."""
    folds_of = np.array(folds)
    c = np.tile(np.asarray(cs, dtype=float), len(folds_of))
    fold_at = np.repeat(np.arange(len(folds_of)), len(cs))

    def seen(b: Block) -> np.ndarray:
        return ((b.fold[:, None] != folds_of) | (folds_of < 0)).astype(float)

    def moments(b: Block):
        s = seen(b)
        return [s.sum(0), s.T @ (b.x ** 2)]

    n, squares = blocks.summed(moments)
    width = squares.shape[1]
    n = n[fold_at]
    reg = 1 / (c * n)
    # a diagonal of the Hessian at the start, where every row has its largest curvature
    diagonal = 0.25 * np.concatenate([squares[fold_at] / n[:, None], np.ones((len(c), 1))], axis=1)
    diagonal[:, :width] += reg[:, None]

    def first_order(w: np.ndarray, which: np.ndarray, smooth: float):
        at = fold_at[which]

        def one(b: Block):
            y = np.where(b.y > 0.5, 1.0, -1.0)[:, None]
            mask = seen(b)[:, at]
            if kind == "logistic":
                return _logistic_sums(b.x, y, mask, w)
            value, slope = _loss(kind, y * (b.x @ w[:, :-1].T + w[:, -1]), smooth)
            slope = slope * y * mask
            return [(value * mask).sum(0), np.concatenate([slope.T @ b.x, slope.sum(0)[:, None]], axis=1)]
        return one

    def penalised(w: np.ndarray, which: np.ndarray, value: np.ndarray, grad: np.ndarray):
        value, grad = value / n[which], grad / n[which, None]
        value = value + 0.5 * reg[which] * (w[:, :-1] ** 2).sum(1)
        grad[:, :-1] += reg[which, None] * w[:, :-1]
        return value, grad

    def sloped_at(smooth: float):
        return lambda w, which: penalised(w, which, *blocks.summed(first_order(w, which, smooth)))

    def curved_at(smooth: float):
        def evaluate(w: np.ndarray, which: np.ndarray):
            at = fold_at[which]

            def hessian(b: Block):
                y = np.where(b.y > 0.5, 1.0, -1.0)[:, None]
                x = np.concatenate([b.x, np.ones((len(b.y), 1))], axis=1)
                bend = np.sqrt(_curvature(kind, y * (x @ w.T), smooth) * seen(b)[:, at])
                out = np.empty((len(w), width + 1, width + 1))
                for i in range(len(w)):
                    rows = np.flatnonzero(bend[:, i])
                    own = (x if len(rows) == len(x) else x[rows]) * bend[rows, i:i + 1]
                    out[i] = own.T @ own
                return out

            slopes = first_order(w, which, smooth)
            value, grad, h = blocks.summed(lambda b: [*slopes(b), hessian(b)])
            value, grad = penalised(w, which, value, grad)
            h = h / n[which, None, None]
            h[:, np.arange(width), np.arange(width)] += reg[which, None]
            return value, grad, h
        return evaluate

    def led() -> tuple[np.ndarray, np.ndarray, int]:
        """Logistic models: Newton's method for the lead of every C, then all others from
        their lead's optimum with its Hessian."""
        lead = int(np.argmax(folds_of < 0)) * len(cs) + np.arange(len(cs))
        rest = np.setdiff1d(np.arange(len(c)), lead)
        curved, sloped = curved_at(1.0), sloped_at(1.0)
        w, f = np.zeros((len(c), width + 1)), np.zeros(len(c))
        w[lead], f[lead], used, h = newton(lambda v, at: curved(v, lead[at]), w[lead], passes, tol)
        if len(rest):
            inverse = np.linalg.inv(h + RIDGE * np.eye(width + 1))
            of = rest % len(cs)
            # a small tolerance: on many rows one row of a rare category is little of the gradient
            w[rest], f[rest], more = minimise(lambda v, at: sloped(v, rest[at]), w[lead[of]], [inverse[j] for j in of],
                                              passes, 1e-3 * tol)
            used += more
        return w, f, used

    if kind == "logistic" and len(cs) * (width + 1) ** 2 <= HESSIANS:
        w, f, used = led()
        return Fits(w, f, used + 1)
    w, used = np.zeros((len(c), width + 1)), 1
    small = kind == "hinge" and len(c) * (width + 1) ** 2 <= HESSIANS
    for smooth in (SMOOTHINGS if kind == "hinge" else (1.0,)):
        if small:
            # the hinge's kinks leave little to gain from more digits or passes
            w, f, more, _ = newton(curved_at(smooth), w, 40, max(tol, 1e-5))
        else:
            w, f, more = minimise(sloped_at(smooth), w, 1 / np.maximum(diagonal, 1e-12), passes, tol)
        used += more
    return Fits(w, f, used)


@dataclass
class LinearSearch:
    best: dict
    score: float
    scores: list[tuple[dict, float]]
    model: LinearModel
    passes: int


def linear_search(train: DataFrame, label: str, kind: str, cs: Sequence[float], fold: str = "fold", folds: int = 10,
                  scoring: str = "recall", features: str = "features", tol: float = 1e-7) -> LinearSearch:
    """K12 (``logistic``) and K13 (``hinge``): every C on all folds and all rows in
    one fit; the model is that of the best C on all rows."""
    blocks = Blocks.of(train, features, label, fold)
    try:
        fits = linear_fits(blocks, kind, cs, [*range(folds), -1], tol)
        w = fits.weights.reshape(folds + 1, len(cs), -1)

        def count(b: Block):
            out = np.zeros((folds, len(cs), 4))
            for f in range(folds):
                rows = b.fold == f
                above = b.x[rows] @ w[f, :, :-1].T + w[f, :, -1] > 0
                for j in range(len(cs)):
                    out[f, j] = counted(b.y[rows], above[:, j])
            return [out]

        mean = scores(blocks.summed(count)[0], scoring).mean(0)
    finally:
        blocks.done()
    at = int(np.argmax(np.round(mean, 12)))
    points = [{"C": float(c)} for c in cs]
    model = LinearModel(kind, w[-1, at, :-1], float(w[-1, at, -1]))
    return LinearSearch(points[at], float(mean[at]), list(zip(points, mean.tolist())), model, fits.passes)


# ---------------------------------------------------------------- a network of one hidden layer
def _logistic(a: np.ndarray) -> np.ndarray:
    """``1 / (1 + exp(-a))`` with one array of the size of ``a``."""
    out = np.clip(a, -500, 500)
    np.exp(np.negative(out, out=out), out=out)
    out += 1
    return np.reciprocal(out, out=out)


_ACTIVATIONS = {
    "identity": (lambda a: a, lambda a, h: np.ones_like(h)),
    "logistic": (lambda a: _logistic(a), lambda a, h: h * (1 - h)),
    "tanh": (np.tanh, lambda a, h: 1 - h * h),
    "relu": (lambda a: np.maximum(a, 0), lambda a, h: (a > 0).astype(float)),
}


@dataclass
class NetworkModel:
    activation: str
    hidden: np.ndarray  # features + 1 x units
    out: np.ndarray     # units + 1

    def margin(self, x: np.ndarray) -> np.ndarray:
        return _ACTIVATIONS[self.activation][0](x @ self.hidden[:-1] + self.hidden[-1]) @ self.out[:-1] + self.out[-1]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``proba_1`` and ``prediction``."""
        margin = self.margin

        @F.pandas_udf("double")
        def proba(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            return pd.Series(1 / (1 + np.exp(-np.clip(margin(np.stack(x.to_numpy())), -500, 500))))

        out = df.withColumn("proba_1", proba(feature_array(df, features)))
        return out.withColumn("prediction", (F.col("proba_1") > 0.5).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        arrays = io.BytesIO()
        np.savez_compressed(arrays, hidden=self.hidden, out=self.out)
        spark.createDataFrame([("NetworkModel", json.dumps({"activation": self.activation}), bytearray(arrays.getvalue()))],
                              "model string, settings string, arrays binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NetworkModel:
        row = spark.read.parquet(path).first()
        z = np.load(io.BytesIO(bytes(row["arrays"])))
        return cls(json.loads(row["settings"])["activation"], z["hidden"], z["out"])


@dataclass
class NetworkSearch:
    best: dict
    score: float
    scores: list[tuple[dict, float]]
    model: NetworkModel
    passes: int


def network_search(train: DataFrame, label: str, activations: Sequence[str] = ("logistic",), units: int = 100,
                   alpha: float = 1e-5, passes: int = 200, fold: str = "fold", folds: int = 10, scoring: str = "recall",
                   features: str = "features", seed: int = 2) -> NetworkSearch:
    """One hidden layer, the deviance plus ``alpha |w|^2 / (2 n)``; all
    activations and folds in the same passes."""
    blocks = Blocks.of(train, features, label, fold)
    folds_of = np.tile([*range(folds), -1], len(activations))
    act_of = np.repeat(np.arange(len(activations)), folds + 1)

    def seen(b: Block, which) -> np.ndarray:
        own = folds_of[which]
        return ((b.fold[:, None] != own) | (own < 0)).astype(float)

    try:
        every = np.arange(len(folds_of))
        n, width = blocks.summed(lambda b: [seen(b, every).sum(0), np.array([b.x.shape[1] * len(b.y), len(b.y)])])
        width = int(round(width[0] / max(1, width[1])))
        cut = (width + 1) * units
        rng = np.random.default_rng(seed)
        bound = np.sqrt(6 / (width + units))
        start = np.concatenate([rng.uniform(-bound, bound, cut), rng.uniform(-bound, bound, units + 1)])

        def split(w):
            return w[:cut].reshape(width + 1, units), w[cut:]

        def evaluate(w: np.ndarray, which: np.ndarray):
            def one(b: Block):
                values, grads = np.zeros(len(w)), np.zeros_like(w)
                mask = seen(b, which)
                y = np.where(b.y > 0.5, 1.0, -1.0)
                for at in range(0, len(y), TILE):
                    x, sign = b.x[at:at + TILE], y[at:at + TILE]
                    for i in range(len(w)):
                        own = mask[at:at + TILE, i]
                        act, slope = _ACTIVATIONS[activations[act_of[which[i]]]]
                        hidden, out = split(w[i])
                        a = x @ hidden[:-1]
                        a += hidden[-1]
                        h = act(a)
                        value, d = _loss("logistic", sign * (h @ out[:-1] + out[-1]), 1.0)
                        d = d * sign * own
                        back = np.outer(d, out[:-1])
                        back *= slope(a, h)
                        inner = grads[i, :cut].reshape(width + 1, units)
                        inner[:-1] += x.T @ back
                        inner[-1] += back.sum(0)
                        values[i] += (value * own).sum()
                        grads[i, cut:-1] += h.T @ d
                        grads[i, -1] += d.sum()
                return [values, grads]

            value, grad = blocks.summed(one)
            reg = alpha / n[which]
            return value / n[which] + 0.5 * reg * (w ** 2).sum(1), grad / n[which, None] + reg[:, None] * w

        w, _, used = minimise(evaluate, np.tile(start, (len(folds_of), 1)), None, passes, 1e-5)
        models = [NetworkModel(activations[a], *split(v)) for a, v in zip(act_of, w)]

        def count(b: Block):
            out = np.zeros((len(models), 4))
            for i, m in enumerate(models):
                rows = b.fold == folds_of[i]
                if folds_of[i] >= 0 and rows.any():
                    out[i] = counted(b.y[rows], m.margin(b.x[rows]) > 0)
            return [out]

        each = scores(blocks.summed(count)[0], scoring).reshape(len(activations), folds + 1)[:, :folds].mean(1)
    finally:
        blocks.done()
    at = int(np.argmax(np.round(each, 12)))
    points = [{"activation": a} for a in activations]
    return NetworkSearch(points[at], float(each[at]), list(zip(points, each.tolist())), models[at * (folds + 1) + folds], used)

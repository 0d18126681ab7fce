"""Decision trees and staged ensembles, all grid points and folds at once.

Features are cut at quantiles into bins (as MLlib does). A pass over the blocks
gives the histograms of every node that any tree of the search still grows; the
driver, which holds only those sums, chooses the splits. Hence

* a decision-tree grid is one growth: trees differ by fold and leaf size, and a
  smaller depth is the top of the same tree;
* a boosting search is one growth of its longest ensemble per fold: a smaller
  size is its first members, and all folds (and bags) grow in the same passes.

Bags of stumps read the sums of a split's rows from one product with the matrix of rows at
or below each bin, and score rows by the same matrix (all rounds' steps at a bin are one
number), so they keep nothing per row; other ensembles keep the sum of a row's
scores in its block's state, renewed every ``RENEWED`` rounds. With two classes both criteria come to one: the split that
maximises ``a_l a_r / (a_l + a_r) (b_l / a_l - b_r / a_r)^2``, where a sums weights
and b weighted targets (Gini for labels, Friedman's for residuals).
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

RENEWED = 10         # rounds after which boosting writes its state
CELLS = 4_000_000    # entries of a block's one-hot bin matrix held at a time
BELOW = 1 << 20      # entries of the matrix of rows at or below each bin held at a time
TILE = 1 << 19       # entries of rows x members that boosting holds at a time
SCORING_SIZES = tuple(range(10, 101, 10))  # fixed values: the ensemble sizes searched


class Edges:
    """Where each feature is cut; bins of all features are numbered in a row."""

    def __init__(self, cuts: Sequence[np.ndarray]):
        self.cuts = [np.asarray(c, dtype=np.float64) for c in cuts]
        sizes = [len(c) + 1 for c in self.cuts]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.feature = np.repeat(np.arange(len(sizes)), sizes)
        self.last = np.zeros(self.offsets[-1], dtype=bool)
        self.last[self.offsets[1:] - 1] = True

    @classmethod
    def of(cls, df: DataFrame, features: str = "features", max_bins: int = 32) -> Edges:
        """Quantiles of every feature, each the largest value of its bin. A NaN
        falls in the last bin."""
        probs = [i / max_bins for i in range(1, max_bins)]
        long = df.select(F.posexplode(feature_array(df, features)).alias("f", "v")).where(~F.isnan("v"))
        rows = long.groupBy("f").agg(F.percentile_approx("v", probs, 10_000).alias("q"), F.max("v").alias("top"),
                                     F.min("v").alias("low")).collect()
        width = df.select(F.max(F.size(feature_array(df, features)))).first()[0] or 0
        cuts: list = [np.empty(0)] * width
        for r in rows:
            # the least value is a cut as well: a rare larger one is then told apart
            own = np.unique([r["low"], *r["q"]])
            cuts[r["f"]] = own[own < r["top"]]
        return cls(cuts)

    @classmethod
    def within(cls, x: np.ndarray, max_bins: int = 32) -> Edges:
        """The same for rows at hand."""
        cuts = []
        for f in range(x.shape[1]):
            own = np.sort(x[~np.isnan(x[:, f]), f])
            if not len(own):
                cuts.append(np.empty(0))
                continue
            at = np.ceil(np.arange(1, max_bins) / max_bins * len(own)).astype(int) - 1
            cut = np.unique([own[0], *own[np.maximum(at, 0)]])
            cuts.append(cut[cut < own[-1]])
        return cls(cuts)

    @property
    def bins(self) -> int:
        return int(self.offsets[-1])

    def encode(self, x: np.ndarray) -> np.ndarray:
        """The bin of every value."""
        out = np.empty(x.shape, dtype=np.uint16 if self.bins <= 1 << 16 else np.int32)
        for f, cut in enumerate(self.cuts):
            out[:, f] = self.offsets[f] + np.searchsorted(cut, x[:, f], side="left")
        return out

    def running(self, a: np.ndarray) -> np.ndarray:
        """Sums up to each bin within its feature, along the last axis."""
        out = np.empty_like(a)
        for lo, hi in zip(self.offsets[:-1], self.offsets[1:]):
            np.cumsum(a[..., lo:hi], axis=-1, out=out[..., lo:hi])
        return out


def best_splits(a: np.ndarray, b: np.ndarray, n: np.ndarray, edges: Edges, min_rows, allowed=None):
    """For each row of the histograms (nodes x bins) the split bin (-1: none) and
    its gain; rows at or below the bin go left."""
    la, lb, ln = edges.running(a), edges.running(b), edges.running(n)
    top = edges.offsets[1] - 1  # the first feature's last bin holds the totals
    ta, tb, tn = (z[:, top:top + 1] for z in (la, lb, ln))
    ok = ~edges.last if allowed is None else ~edges.last & allowed
    return _best(la, lb, ln, ta, tb, tn, min_rows, ok)


def _best(la, lb, ln, ta, tb, tn, min_rows, ok):
    """The column of each row's best split (-1: none) and its gain, from what lies left of
    every split and from the totals."""
    if not la.shape[1]:
        return np.full(len(la), -1), np.full(len(la), -1.0)
    ra, rb, rn = ta - la, tb - lb, tn - ln
    least = np.broadcast_to(np.asarray(min_rows, dtype=float), (len(la),))[:, None]
    ok = ok & (ln >= least) & (rn >= least) & (la > 0) & (ra > 0)
    with np.errstate(all="ignore"):
        gain = np.where(ok, la * ra / (la + ra) * (lb / la - rb / ra) ** 2, -1.0)
    at = gain.argmax(1)
    best = gain[np.arange(len(la)), at]
    return np.where(best > 1e-12 * np.maximum(np.abs(ta[:, 0]), 1e-300), at, -1), best


def walk(bins: np.ndarray, split: np.ndarray, edges_feature: np.ndarray, depth: int) -> np.ndarray:
    """The node (numbered as in a heap) that each row reaches within ``depth``."""
    node = np.zeros(len(bins), dtype=np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        s = split[node]
        right = bins[rows, edges_feature[s]] > s
        node = np.where(s >= 0, 2 * node + 1 + right, node)
    return node


# ---------------------------------------------------------------- decision trees
@dataclass
class TreeGrid:
    """Trees of every (fold, leaf size): splits by heap node, and class counts."""
    edges: Edges
    folds: list[int]       # fold left out, -1 for none, by tree
    min_rows: list[int]
    split: np.ndarray      # trees x internal nodes
    counts: np.ndarray     # trees x nodes x 2
    gains: np.ndarray      # trees x internal nodes
    balanced: bool

    def weights(self, tree: int) -> np.ndarray:
        n = self.counts[tree, 0]
        return n.sum() / (2 * np.maximum(n, 1)) if self.balanced else np.ones(2)

    def probability(self, tree: int) -> np.ndarray:
        """The share of class 1 in every node, weighted."""
        w = self.counts[tree] * self.weights(tree)
        total = w.sum(1)
        return np.divide(w[:, 1], total, out=np.zeros(len(total)), where=total > 0)


def grow(blocks: Blocks, edges: Edges, folds: Sequence[int], min_rows: Sequence[int], depth: int,
         balanced: bool = True) -> TreeGrid:
    """All trees of ``folds`` x ``min_rows`` over blocks of bins, a level a pass.

    Trees of a fold differ only below a split that a leaf size forbids: nodes of
    equal fold and splits above hold the same rows, and one of them is counted."""
    trees = [(f, m) for f in folds for m in min_rows]
    split = np.full((len(trees), 2 ** depth - 1), -1, dtype=np.int64)
    gains = np.zeros(split.shape)
    counts = np.zeros((len(trees), 2 ** (depth + 1) - 1, 2))
    grid = TreeGrid(edges, [f for f, _ in trees], [m for _, m in trees], split, counts, gains, balanced)
    feature, bins = edges.feature, edges.bins
    least = np.array([m for _, m in trees])
    rows_of = np.zeros(counts.shape[:2], dtype=np.int64)  # by node; equal numbers in a level are equal rows
    for level in range(depth):
        first = 2 ** level - 1
        if level:
            parents = (np.arange(first, 2 * first + 1) - 1) // 2
            growing = split[:, parents] >= 0
        else:
            growing = np.ones((len(trees), 1), dtype=bool)
        if not growing.any():
            break
        tree_of, node_of = np.nonzero(growing)
        if level:
            above = (node_of + first - 1) // 2
            same_rows = np.stack([rows_of[tree_of, above], split[tree_of, above], node_of % 2], axis=1)
        else:
            same_rows = np.array(grid.folds)[tree_of][:, None]
        _, counted_at, same = np.unique(same_rows, axis=0, return_index=True, return_inverse=True)
        rows_of[tree_of, node_of + first] = same = same.ravel()
        starts = np.concatenate([[0], np.cumsum(np.bincount(tree_of[counted_at], minlength=len(trees)))])
        counted_at = np.sort(counted_at)  # the first of equal nodes, by tree
        place = np.full(growing.shape, -1)
        place[tree_of[counted_at], node_of[counted_at]] = np.arange(len(counted_at))
        read = place[tree_of[counted_at], node_of[counted_at]][np.argsort(same[counted_at])][same]

        def histogram(b: Block, split=split, place=place, starts=starts, level=level, first=first):
            out = np.zeros((starts[-1], bins, 2))
            label = (b.y > 0.5).astype(np.int64)
            for t, (fold, _) in enumerate(trees):
                size = starts[t + 1] - starts[t]
                if not size:
                    continue
                rows = np.flatnonzero(b.fold != fold) if fold >= 0 else np.arange(len(b.y))
                node = walk(b.x[rows], split[t], feature, level) - first
                at = np.where(node >= 0, place[t][np.maximum(node, 0)], -1)
                rows, at = rows[at >= 0], at[at >= 0] - starts[t]
                cell = ((at[:, None] * bins + b.x[rows]) * 2 + label[rows][:, None]).ravel()
                out[starts[t]:starts[t + 1]] = np.bincount(cell, minlength=size * bins * 2).reshape(size, bins, 2)
            return [out]

        h = blocks.summed(histogram)[0][read]
        totals = h[:, :edges.offsets[1]].sum(1)
        counts[tree_of, node_of + first] = totals
        w = np.stack([grid.weights(t) for t in range(len(trees))])[tree_of]
        a = h[..., 0] * w[:, :1] + h[..., 1] * w[:, 1:]
        b = h[..., 1] * w[:, 1:]
        at, gain = best_splits(a, b, h.sum(2), edges, least[tree_of])
        split[tree_of, node_of + first] = at
        gains[tree_of, node_of + first] = np.where(at >= 0, gain, 0)
        left = edges.running(np.moveaxis(h, 2, 0))
        for k in np.flatnonzero(at >= 0):
            own = left[:, k, at[k]]
            node = node_of[k] + first
            counts[tree_of[k], 2 * node + 1], counts[tree_of[k], 2 * node + 2] = own, totals[k] - own
    return grid


def tree_scores(blocks: Blocks, grid: TreeGrid, depths: Sequence[int], scoring: str) -> np.ndarray:
    """Mean score over the folds for (depth, leaf size)."""
    held = [t for t, f in enumerate(grid.folds) if f >= 0]
    share = {t: grid.probability(t) for t in held}

    def count(b: Block):
        out = np.zeros((len(held), len(depths), 4))
        for i, t in enumerate(held):
            rows = np.flatnonzero(b.fold == grid.folds[t])
            for j, d in enumerate(depths):
                node = walk(b.x[rows], grid.split[t], grid.edges.feature, d)
                out[i, j] = counted(b.y[rows], share[t][node] > 0.5)
        return [out]

    each = scores(blocks.summed(count)[0], scoring)
    sizes = list(dict.fromkeys(grid.min_rows))
    return np.stack([each[[i for i, t in enumerate(held) if grid.min_rows[t] == m]].mean(0) for m in sizes], axis=1)


# ---------------------------------------------------------------- fitted models
class StagedModel:
    """An ensemble of trees as arrays: members x trees x nodes.

    ``kind`` says how leaf scores become a probability: ``tree`` (a leaf's share),
    ``boost`` (logistic of their sum) or ``samme`` (logistic of their mean, averaged
    over the bags)."""

    def __init__(self, kind: str, edges: Edges, split: np.ndarray, leaf: np.ndarray, depth: int, init: float = 0.0,
                 rate: float = 1.0, sizes: np.ndarray | None = None, importance: np.ndarray | None = None):
        self.kind, self.edges, self.split, self.leaf, self.depth = kind, edges, split, leaf, depth
        self.init, self.rate = init, rate
        self.sizes = np.full(split.shape[1], split.shape[0]) if sizes is None else sizes
        self.importance = np.zeros(len(edges.cuts)) if importance is None else importance

    def first(self, size: int) -> StagedModel:
        """The ensemble of the first ``size`` members."""
        return StagedModel(self.kind, self.edges, self.split[:size], self.leaf[:size], self.depth, self.init, self.rate,
                           np.minimum(self.sizes, size), self.importance)

    def probability(self, x: np.ndarray) -> np.ndarray:
        bins = self.edges.encode(x)
        total = np.full((len(x), self.split.shape[1]), self.init)
        for s, v in zip(self.split, self.leaf):
            total += self.rate * leaf_scores(bins, s, v, self.edges.feature, self.depth)
        if self.kind == "tree":
            return total[:, 0]
        if self.kind == "samme":
            total = total / np.maximum(self.sizes, 1)
        with np.errstate(over="ignore"):
            return (1 / (1 + np.exp(-total))).mean(1)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``proba_1`` and ``prediction``."""
        probability = self.probability

        @F.pandas_udf("double")
        def proba(x: pd.Series) -> pd.Series:
            return pd.Series(probability(np.stack(x.to_numpy()))) if len(x) else pd.Series([], dtype=float)

        out = df.withColumn("proba_1", proba(feature_array(df, features)))
        return out.withColumn("prediction", (F.col("proba_1") > 0.5).cast("double"))

    def packed(self) -> tuple[str, bytes]:
        """Settings as JSON, and the arrays."""
        arrays = io.BytesIO()
        np.savez_compressed(arrays, split=self.split, leaf=self.leaf, sizes=self.sizes, importance=self.importance,
                            **{f"cut{i}": c for i, c in enumerate(self.edges.cuts)})
        meta = {"kind": self.kind, "depth": self.depth, "init": self.init, "rate": self.rate, "width": len(self.edges.cuts)}
        return json.dumps(meta), arrays.getvalue()

    def save(self, spark: SparkSession, path: str) -> None:
        """One row, overwriting ``path``."""
        settings, arrays = self.packed()
        spark.createDataFrame([("StagedModel", settings, bytearray(arrays))],
                              "model string, settings string, arrays binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StagedModel:
        row = spark.read.parquet(path).first()
        return cls.unpacked(row["settings"], bytes(row["arrays"]))

    @classmethod
    def unpacked(cls, settings: str, arrays: bytes) -> StagedModel:
        m = json.loads(settings)
        z = np.load(io.BytesIO(arrays))
        edges = Edges([z[f"cut{i}"] for i in range(m["width"])])
        return cls(m["kind"], edges, z["split"], z["leaf"], m["depth"], m["init"], m["rate"], z["sizes"], z["importance"])


def leaf_scores(bins: np.ndarray, split: np.ndarray, leaf: np.ndarray, feature: np.ndarray, depth: int) -> np.ndarray:
    """Rows x trees: the score of the leaf that a row reaches."""
    if depth == 1:
        s = split[:, 0]
        low, high = (np.where(s >= 0, leaf[:, side], leaf[:, 0]) for side in (1, 2))
        return np.where(bins[:, feature[s]] > s, high, low)
    columns = np.ascontiguousarray(bins.T)
    return np.stack([np.broadcast_to(tree_values(columns, s, v, feature), len(bins)) for s, v in zip(split, leaf)], axis=1)


def tree_values(columns: np.ndarray, split: np.ndarray, leaf: np.ndarray, feature: np.ndarray, node: int = 0):
    """The score of the leaf that each row (a column here) reaches: whole columns are
    compared, a node at a time. A tree of one leaf gives one number."""
    s = split[node] if node < len(split) else -1
    if s < 0:
        return leaf[node]
    low, high = (tree_values(columns, split, leaf, feature, 2 * node + side) for side in (1, 2))
    return np.where(columns[feature[s]] > s, high, low)


def node_masks(columns: np.ndarray, split: np.ndarray, feature: np.ndarray, level: int) -> dict[int, np.ndarray]:
    """By node of a level: which rows (columns here) reach it."""
    masks: dict[int, np.ndarray] = {0: np.ones(columns.shape[1], dtype=bool)}
    for _ in range(level):
        below = {}
        for node, own in masks.items():
            if split[node] >= 0:
                right = columns[feature[split[node]]] > split[node]
                below[2 * node + 1], below[2 * node + 2] = own & ~right, own & right
        masks = below
    return masks


def importances(split: np.ndarray, gains: np.ndarray, edges: Edges) -> np.ndarray:
    """Each feature's share of all impurity removed; the shares sum to one."""
    used = split >= 0
    total = np.bincount(edges.feature[split[used]], weights=gains[used], minlength=len(edges.cuts))
    return total / total.sum() if total.sum() > 0 else total


@dataclass
class Search:
    """The chosen parameters, their mean score, all scores and the model fitted
    with them on every training row."""
    best: dict
    score: float
    scores: list[tuple[dict, float]]
    model: StagedModel


def _chosen(points: Sequence[dict], mean: Sequence[float]) -> int:
    """The first of the best points, as a grid search takes it."""
    return int(np.argmax(np.round(np.asarray(mean, dtype=float), 12)))


def tree_search(train: DataFrame, label: str, fold: str = "fold", folds: int = 10, scoring: str = "recall",
                min_rows: Sequence[int] = (3, 5, 7, 9, 10, 15, 20, 30), depths: Sequence[int] = (3, 5, 6),
                balanced: bool = True, features: str = "features") -> Search:
    """Every (depth, leaf size) on all folds, from one growth."""
    edges = Edges.of(train, features)
    blocks = Blocks.of(train, features, label, fold, keep=False).mapped(lambda b: b._replace(x=edges.encode(b.x)))
    try:
        return searched(blocks, edges, folds, scoring, min_rows, depths, balanced)
    finally:
        blocks.done()


def searched(blocks, edges: Edges, folds: int, scoring: str, min_rows: Sequence[int], depths: Sequence[int],
             balanced: bool = True) -> Search:
    """``tree_search`` over anything that sums functions of blocks of bins."""
    grid = grow(blocks, edges, [*range(folds), -1], min_rows, max(depths), balanced)
    mean = tree_scores(blocks, grid, depths, scoring)
    points = [{"max_depth": d, "min_samples_leaf": m} for d in depths for m in min_rows]
    at = _chosen(points, mean.ravel())
    best = points[at]
    t = next(i for i, (f, m) in enumerate(zip(grid.folds, grid.min_rows)) if f < 0 and m == best["min_samples_leaf"])
    d = best["max_depth"]
    split = grid.split[t][:2 ** d - 1]
    model = StagedModel("tree", edges, split[None, None], grid.probability(t)[:2 ** (d + 1) - 1][None, None], d,
                        importance=importances(split, grid.gains[t][:2 ** d - 1], edges))
    return Search(best, float(mean.ravel()[at]), list(zip(points, mean.ravel().tolist())), model)


# ---------------------------------------------------------------- boosting
@dataclass
class Member:
    """One ensemble of a search: the fold it must not see, and for a bag its seed
    and the features it may use."""
    fold: int = -1
    bag: int | None = None
    features: np.ndarray | None = None


_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, i + 1)) for i in range(18)])


def multiplicity(key: np.ndarray, bag) -> np.ndarray:
    """How often a bag drew each row: Poisson(1) of a hash of the row's key, the
    same whenever a task runs. A row for each, if there are several bags."""
    step = [(int(i) + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF for i in np.atleast_1d(bag)]
    step = np.array(step, dtype=np.uint64)
    z = key.view(np.uint64) + (step[0] if np.ndim(bag) == 0 else step[:, None])
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2 ** 53
    return np.searchsorted(_POISSON, u, side="right").astype(float)


def _rows(b: Block, first: int, last: int) -> Block:
    return Block(*[None if part is None else part[first:last] for part in b])


def _weights(b: Block, members: Sequence[Member]) -> np.ndarray:
    """Members x rows."""
    folds = np.array([m.fold for m in members])[:, None]
    out = ((b.fold != folds) | (folds < 0)).astype(float)
    bags = sorted({m.bag for m in members if m.bag is not None})
    if bags:
        drawn = np.concatenate([multiplicity(b.key, bags), np.ones((1, len(b.y)))])
        place = {bag: i for i, bag in enumerate(bags)}
        out *= drawn[[place.get(m.bag, len(bags)) for m in members]]
    return out


def _leaf(kind: str, stats: np.ndarray) -> np.ndarray:
    """Scores of leaves from their sums: Newton's step of the deviance, or the log
    odds of the weighted classes."""
    if kind == "boost":
        return np.divide(stats[..., 1], stats[..., 2], out=np.zeros(stats.shape[:-1]), where=np.abs(stats[..., 2]) > 1e-150)
    eps = np.finfo(float).eps
    p = np.divide(stats[..., 1], stats[..., 0], out=np.full(stats.shape[:-1], 0.5), where=stats[..., 0] > 0)
    p = np.clip(p, eps, 1)
    q = np.clip(np.divide(stats[..., 0] - stats[..., 1], stats[..., 0], out=np.full(stats.shape[:-1], 0.5),
                          where=stats[..., 0] > 0), eps, 1)
    return np.log(p) - np.log(q)


def bin_matrix(bins: np.ndarray, edges: Edges, below: bool) -> np.ndarray:
    """A row for each bin but the last of a feature: 1 where a data row (a column here) is in
    it or, with ``below``, at or below it. A last row is for totals: the last bin of the
    first feature or, with ``below``, all rows."""
    out = np.empty((edges.bins - len(edges.cuts) + 1, len(bins)))
    columns, at = np.ascontiguousarray(bins.T), 0
    compare = np.less_equal if below else np.equal
    for f, (lo, hi) in enumerate(zip(edges.offsets[:-1], edges.offsets[1:] - 1)):
        compare(columns[f], np.arange(lo, hi, dtype=bins.dtype)[:, None], out=out[at:at + hi - lo])
        at += hi - lo
    out[-1] = 1 if below else columns[0] == edges.offsets[1] - 1
    return out


def binned_sums(bins: np.ndarray, columns: Callable[[np.ndarray], np.ndarray], edges: Edges, below: bool) -> np.ndarray:
    """What ``columns`` makes of the ``bin_matrix``, summed over the rows of each of its rows."""
    matrix = bin_matrix(bins, edges, below)
    return columns(matrix) @ matrix.T


@dataclass
class Staged:
    """What ``boost`` grew: rounds x members x nodes."""
    split: np.ndarray
    leaf: np.ndarray
    gains: np.ndarray
    init: np.ndarray   # by member
    sizes: np.ndarray  # rounds after which a member was perfect, else all


def boost(blocks: Blocks, edges: Edges, members: Sequence[Member], rounds: int, kind: str = "boost", depth: int = 3,
          rate: float = 0.1) -> Staged:
    """``rounds`` trees for each of ``members``, one pass a level.

    ``boost``: gradient boosting of the deviance with Newton leaves. ``samme``: the
    real-valued AdaBoost on class probabilities; a perfect tree is its last."""
    members = list(members)
    m, nodes, inner = len(members), 2 ** (depth + 1) - 1, 2 ** depth - 1
    split = np.full((rounds, m, inner), -1, dtype=np.int64)
    gains = np.zeros(split.shape)
    leaf = np.zeros((rounds, m, nodes))
    sizes = np.full(m, rounds)
    rate = rate if kind == "boost" else 1.0
    allowed = None
    if any(x.features is not None for x in members):
        allowed = np.stack([np.isin(edges.feature, x.features) if x.features is not None else np.ones(edges.bins, bool)
                            for x in members])
    feature = edges.feature
    cut_bins = np.flatnonzero(~edges.last)
    if kind == "boost":  # starts at the log odds of the training rows
        pos, n = blocks.summed(lambda b: [_weights(b, members) @ (b.y > 0.5), _weights(b, members).sum(1)])
        init = np.log(np.maximum(pos, 1e-9) / np.maximum(n - pos, 1e-9))
    else:
        init = np.zeros(m)
    since = 0
    alive = np.ones(m, dtype=bool)
    # bags of stumps are many; elsewhere bins are added up, and equal splits stay in the order that gives
    below = stumps = depth == 1 and kind == "samme" and any(x.bag is not None for x in members)
    steps = np.zeros((m, len(cut_bins) + 1))  # of stumps: what all rounds add to rows at or below a bin, and to all
    steps[:, -1] = init
    step = max(1, min(TILE // m, BELOW // (len(cut_bins) + 1) if below else CELLS // max(1, edges.bins)))
    constant = None  # sums of the weights at the roots: the same in every round of ``boost``

    def totals(b: Block, columns: np.ndarray, since: int, upto: int) -> np.ndarray:
        out = b.state.T.copy() if b.state is not None else np.repeat(init[:, None], len(b.y), axis=1)
        for r in range(since, upto):
            for i in range(m):
                out[i] += rate * tree_values(columns, split[r, i], leaf[r, i], feature)
        return out

    owned = blocks
    for r in range(rounds):
        if not stumps and r and r % RENEWED == 0:
            old, owned = owned, owned.with_state(
                lambda b, since=since, r=r: np.ascontiguousarray(totals(b, np.ascontiguousarray(b.x.T), since, r).T))
            if old is not blocks:
                old.done()
            since = r
        used = np.flatnonzero(steps.any(0))  # the bins where a stump of some member splits
        growing = alive[:, None].copy()
        for level in range(depth):
            first = 2 ** level - 1
            if level:
                growing = split[r][:, (np.arange(first, 2 * first + 1) - 1) // 2] >= 0
            if not growing.any():
                break
            which, node_of = np.nonzero(growing)
            known = kind == "boost" and level == 0 and constant is not None

            def sums(b: Block, r=r, level=level, first=first, which=which, node_of=node_of, since=since, known=known):
                """By class with ``below``, else by channel: nodes x rows of the matrix."""
                parts = [np.flatnonzero(b.y <= 0.5), np.flatnonzero(b.y > 0.5)] if below else [None]
                shape = (len(which), len(cut_bins) + 1)
                out = []
                for label, own in enumerate(parts):
                    rows = b if own is None else Block(*[None if z is None else z[own] for z in b])
                    total = np.zeros((1 if below else 2 if kind == "samme" else 3 - known, *shape))
                    for at in range(0, len(rows.y), step):
                        total += tile(_rows(rows, at, at + step), label).reshape(total.shape)
                    out += list(total)
                return [np.stack(out)]

            def tile(b: Block, label: int, r=r, level=level, first=first, which=which, node_of=node_of,
                     since=since, known=known, used=used):
                columns = np.ascontiguousarray(b.x.T) if not stumps else None

                def channels(matrix: np.ndarray) -> np.ndarray:
                    total = steps[:, used] @ matrix[used] if stumps else totals(b, columns, since, r)
                    weight = _weights(b, members)
                    if below:  # rows of one class
                        total *= 0.5 - label
                        ch = [weight * np.exp(np.clip(total, -300, 300, out=total), out=total)]
                    elif kind == "samme":
                        y = (b.y > 0.5).astype(float)
                        w = weight * np.exp(np.clip((0.5 - y) * total, -300, 300))
                        ch = [w, w * y]
                    else:
                        with np.errstate(over="ignore"):
                            p = 1 / (1 + np.exp(-total))
                        slope, bend = weight * ((b.y > 0.5) - p), weight * p * (1 - p)
                        ch = [slope, bend] if known else [weight, slope, bend]
                    if level == 0:
                        ch = ch if len(which) == m else [z[which] for z in ch]
                    else:
                        masks = [node_masks(columns, split[r, i], feature, level) for i in range(m)]
                        own = np.stack([masks[i][j + first] for i, j in zip(which, node_of)])
                        ch = [z[which] * own for z in ch]
                    return ch[0] if len(ch) == 1 else np.concatenate(ch)

                return binned_sums(b.x, channels, edges, below)

            h = owned.summed(sums)[0]
            if below:
                h = np.stack([h[0] + h[1], h[1]])
                (la, lb), (ta, tb) = h[:, :, :-1], h[:, :, -1:]
                ok = np.ones(len(cut_bins), dtype=bool) if allowed is None else allowed[which][:, cut_bins]
                place, gain = _best(la, lb, la, ta, tb, ta, 1e-300, ok)
                at = np.where(place >= 0, cut_bins[place], -1) if len(cut_bins) else place
                totals_here = h[:, :, -1].T
                chosen = np.flatnonzero(at >= 0)
                low = h[:, chosen, place[chosen]].T
            else:
                if known:
                    h = np.concatenate([constant[None], h])
                elif kind == "boost" and level == 0:
                    constant = h[0]
                every = np.zeros((*h.shape[:2], edges.bins))  # last bins but the first feature's are not needed
                every[:, :, cut_bins], every[:, :, edges.offsets[1] - 1] = h[:, :, :-1], h[:, :, -1]
                at, gain = best_splits(every[0], every[1], every[0], edges, 1e-300, None if allowed is None else allowed[which])
                totals_here = every[:, :, :edges.offsets[1]].sum(2).T
                chosen = np.flatnonzero(at >= 0)
                low = edges.running(every)[:, chosen, at[chosen]].T
            split[r, which, node_of + first] = at
            gains[r, which, node_of + first] = np.where(at >= 0, gain, 0)
            leaf[r, which, node_of + first] = _leaf(kind, totals_here)
            high = totals_here[chosen] - low
            for side, stats in ((1, low), (2, high)):
                leaf[r, which[chosen], 2 * (node_of[chosen] + first) + side] = _leaf(kind, stats)
            if kind == "samme":
                wrong = np.minimum(totals_here[:, 1], totals_here[:, 0] - totals_here[:, 1])
                wrong[chosen] = sum(np.minimum(s[:, 1], s[:, 0] - s[:, 1]) for s in (low, high))
                done = wrong <= 1e-15 * totals_here[:, 0]
                sizes[which[done]] = r + 1
                alive[which[done]] = False
            if stumps:
                steps[which, -1] += rate * leaf[r, which, np.where(at >= 0, 2, 0)]
                steps[which[chosen], place[chosen]] += rate * (leaf[r, which[chosen], 1] - leaf[r, which[chosen], 2])
    if owned is not blocks:
        owned.done()
    return Staged(split, leaf, gains, init, sizes)


def staged_scores(blocks: Blocks, edges: Edges, members: Sequence[Member], grown: Staged, kind: str, depth: int,
                  rate: float, sizes: Sequence[int], folds: int, scoring: str) -> np.ndarray:
    """Folds x sizes: the score of every size on the rows its members never saw."""
    own = {f: np.array([i for i, x in enumerate(members) if x.fold == f]) for f in range(folds)}
    rate = rate if kind == "boost" else 1.0

    def count(b: Block):
        out = np.zeros((folds, len(sizes), 4))
        for f in range(folds):
            rows = np.flatnonzero(b.fold == f)
            if not len(rows) or not len(own[f]):
                continue
            x = b.x[rows]
            total = np.broadcast_to(grown.init[own[f]], (len(rows), len(own[f]))).copy()
            for r in range(max(sizes)):
                total += rate * leaf_scores(x, grown.split[r, own[f]], grown.leaf[r, own[f]], edges.feature, depth)
                if r + 1 in sizes:
                    t = total / np.minimum(grown.sizes[own[f]], r + 1) if kind == "samme" else total
                    with np.errstate(over="ignore"):
                        p = (1 / (1 + np.exp(-t))).mean(1)
                    out[f, list(sizes).index(r + 1)] = counted(b.y[rows], p > 0.5)
        return [out]

    return scores(blocks.summed(count)[0], scoring)


def _staged_model(kind: str, edges: Edges, grown: Staged, members: np.ndarray, size: int, depth: int, rate: float):
    pick = grown.split[:size, members], grown.leaf[:size, members]
    return StagedModel(kind, edges, pick[0], pick[1], depth, float(grown.init[members].mean()),
                       rate if kind == "boost" else 1.0, np.minimum(grown.sizes[members], size),
                       importances(pick[0], grown.gains[:size, members], edges))


def staged_search(train: DataFrame, label: str, kind: str, sizes: Sequence[int] = SCORING_SIZES, fold: str = "fold",
                  folds: int = 10, scoring: str = "recall", depth: int | None = None, rate: float = 0.1,
                  bags: int = 0, max_features: float = 0.5, final_bags: int = 10, key: str | None = None,
                  features: str = "features", seed: int = 0) -> Search:
    """K14 (``samme``, stumps), K15 (``boost``, depth 3) and, with ``bags``, K17: every
    size on all folds from one growth of the largest, and the best size on all rows.

    A search with bags grows ``bags`` ensembles a fold, each on rows drawn with
    repetition and a share of the features; the model returned then has
    ``final_bags`` on all features, as the library defaults of the original's last
    fit have it."""
    depth = depth or (3 if kind == "boost" else 1)
    edges = Edges.of(train, features)
    blocks = Blocks.of(train, features, label, fold, key, keep=False).mapped(lambda b: b._replace(x=edges.encode(b.x)))
    width = len(edges.cuts)
    rng = np.random.default_rng(seed)

    def some():
        return np.sort(rng.choice(width, max(1, int(width * max_features)), replace=False))

    if bags:
        drawn = [some() for _ in range(bags)]
        members = [Member(f, i, drawn[i]) for f in range(folds) for i in range(bags)]
        members += [Member(-1, bags + i) for i in range(final_bags)]
    else:
        members = [Member(f) for f in [*range(folds), -1]]
    try:
        grown = boost(blocks, edges, members, max(sizes), kind, depth, rate)
        mean = staged_scores(blocks, edges, members, grown, kind, depth, rate, sizes, folds, scoring).mean(0)
    finally:
        blocks.done()
    points = [{"n_estimators": s} for s in sizes]
    at = _chosen(points, mean)
    last = np.array([i for i, x in enumerate(members) if x.fold < 0])
    model = _staged_model(kind, edges, grown, last, sizes[at], depth, rate)
    return Search(points[at], float(mean[at]), list(zip(points, mean.tolist())), model)

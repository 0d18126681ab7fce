"""Random forests over a whole grid (K11), for training sets of bounded size.

A forest's trees do not depend on each other, and a deep tree soon has more nodes
than rows. Where the binned training rows are known to fit a task (``fits``, a
counted bound), they are broadcast once and every task grows a few of the trees of
all folds. One forest a fold serves the grid: fewer trees are its first ones, a
smaller depth cuts every tree there. Larger tables go through MLlib's forest,
which grows by passes over the rows.
"""

from __future__ import annotations

import io
import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Blocks, counted, feature_array, scores
from .trees import Edges, Search, multiplicity

VALUES = 1 << 26  # binned values (rows x features) that may be broadcast, a byte each: 64 MB
DRAWS = 4         # feature draws for a node before it stays a leaf
CHUNK = 5         # trees of a task


def fits(rows: int, width: int) -> bool:
    return rows * width <= VALUES


def grow_tree(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, n_bins: int, depth: int, tried: int,
              rng: np.random.Generator):
    """(feature, bin, child, share, level, gain) by node; ``child`` is the left
    child's number, the right one follows, -1 marks a leaf. Rows whose bin is at
    most the node's go left; every split is the best by Gini of ``tried`` features."""
    rows = np.flatnonzero(weight > 0)
    x, w, wy = bins[rows], weight[rows], weight[rows] * y[rows]
    node = np.zeros(len(rows), dtype=np.int64)
    feature, cut, child, level, gains = [-1], [-1], [-1], [0], [0.0]
    total = [(w.sum(), wy.sum())]
    active = np.array([0])
    for d in range(depth):
        if not len(active):
            break
        place = np.full(len(child), -1)
        place[active] = np.arange(len(active))
        found_f, found_b = np.full(len(active), -1), np.full(len(active), -1)
        found_g = np.zeros(len(active))
        stats = np.array([total[a] for a in active])
        open_ = (stats[:, 1] > 1e-12 * stats[:, 0]) & (stats[:, 0] - stats[:, 1] > 1e-12 * stats[:, 0])
        for _ in range(DRAWS):
            seek = np.flatnonzero(open_ & (found_f < 0))
            if not len(seek):
                break
            local = np.full(len(active), -1)
            local[seek] = np.arange(len(seek))
            at = place[node]
            at = np.where(at >= 0, local[at], -1)
            own = np.flatnonzero(at >= 0)
            feats = rng.random((len(seek), x.shape[1])).argpartition(tried - 1, axis=1)[:, :tried]
            feats.sort(axis=1)  # equal gains go to the first feature
            a = at[own]
            cell = ((a[:, None] * tried + np.arange(tried)) * n_bins + x[own[:, None], feats[a]]).ravel()
            size = len(seek) * tried * n_bins
            la = np.bincount(cell, np.repeat(w[own], tried), size).reshape(len(seek), tried, n_bins).cumsum(2)
            lb = np.bincount(cell, np.repeat(wy[own], tried), size).reshape(len(seek), tried, n_bins).cumsum(2)
            ta, tb = stats[seek, 0][:, None, None], stats[seek, 1][:, None, None]
            ra, rb = ta - la, tb - lb
            with np.errstate(all="ignore"):
                gain = np.where((la > 1e-9) & (ra > 1e-9), la * ra / (la + ra) * (lb / la - rb / ra) ** 2, -1.0)
            flat = gain.reshape(len(seek), -1)
            best = flat.argmax(1)
            good = flat[np.arange(len(seek)), best] > 1e-12 * stats[seek, 0]
            found_f[seek[good]] = feats[good, best[good] // n_bins]
            found_b[seek[good]] = best[good] % n_bins
            found_g[seek[good]] = flat[good, best[good]]
        split = np.flatnonzero(found_f >= 0)
        first = len(child)
        for i, s in enumerate(split):
            a = active[s]
            feature[a], cut[a], child[a], gains[a] = int(found_f[s]), int(found_b[s]), first + 2 * i, float(found_g[s])
        feature += [-1] * (2 * len(split))
        cut += [-1] * (2 * len(split))
        child += [-1] * (2 * len(split))
        gains += [0.0] * (2 * len(split))
        level += [d + 1] * (2 * len(split))
        start = np.full(first, -1)
        start[active[split]] = first + 2 * np.arange(len(split))
        moving = np.flatnonzero(start[node] >= 0)
        f, b = np.array(feature)[node[moving]], np.array(cut)[node[moving]]
        node[moving] = start[node[moving]] + (x[moving, f] > b)
        sums = np.stack([np.bincount(node, w, len(child)), np.bincount(node, wy, len(child))], axis=1)
        total += [tuple(v) for v in sums[first:]]
        active = np.arange(first, len(child))
    t = np.array(total)
    share = np.divide(t[:, 1], t[:, 0], out=np.zeros(len(t)), where=t[:, 0] > 0)
    return (np.array(feature), np.array(cut), np.array(child), share, np.array(level), np.array(gains))


def reached(tree, bins: np.ndarray, depth: int) -> np.ndarray:
    """The share of class 1 in the node where each row ends, at most ``depth`` deep."""
    feature, cut, child, share = tree[:4]
    node = np.zeros(len(bins), dtype=np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        go = child[node] >= 0
        if not go.any():
            break
        node = np.where(go, child[node] + (bins[rows, feature[node]] > cut[node]), node)
    return share[node]


class ForestModel:
    """The mean of the trees' shares, cut at ``depth``."""

    def __init__(self, edges: Edges, trees: list, depth: int):
        self.edges, self.trees, self.depth = edges, trees, depth

    @property
    def importance(self) -> np.ndarray:
        total = np.zeros(len(self.edges.cuts))
        for feature, _, child, _, level, gain in self.trees:
            used = (child >= 0) & (level < self.depth)
            total += np.bincount(feature[used], gain[used], len(total))
        return total / total.sum() if total.sum() > 0 else total

    def probability(self, x: np.ndarray) -> np.ndarray:
        bins = self.edges.encode(x) - self.edges.offsets[:-1]
        return np.mean([reached(t, bins, self.depth) for t in self.trees], axis=0)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``proba_1`` and ``prediction``."""
        probability = self.probability

        @F.pandas_udf("double")
        def proba(x: pd.Series) -> pd.Series:
            return pd.Series(probability(np.stack(x.to_numpy()))) if len(x) else pd.Series([], dtype=float)

        out = df.withColumn("proba_1", proba(feature_array(df, features)))
        return out.withColumn("prediction", (F.col("proba_1") > 0.5).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        arrays = io.BytesIO()
        np.savez_compressed(arrays, **{f"t{i}_{j}": a for i, t in enumerate(self.trees) for j, a in enumerate(t)},
                            **{f"cut{i}": c for i, c in enumerate(self.edges.cuts)})
        meta = {"depth": self.depth, "trees": len(self.trees), "width": len(self.edges.cuts)}
        spark.createDataFrame([("ForestModel", json.dumps(meta), bytearray(arrays.getvalue()))],
                              "model string, settings string, arrays binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        row = spark.read.parquet(path).first()
        m, z = json.loads(row["settings"]), np.load(io.BytesIO(bytes(row["arrays"])))
        return cls(Edges([z[f"cut{i}"] for i in range(m["width"])]),
                   [tuple(z[f"t{i}_{j}"] for j in range(6)) for i in range(m["trees"])], m["depth"])


def forest_search(train: DataFrame, label: str, fold: str = "fold", folds: int = 10, scoring: str = "recall",
                  sizes: Sequence[int] = (10, 25, 50, 100), depths: Sequence[int] = (5, 10, 20), key: str | None = None,
                  features: str = "features", seed: int = 2) -> Search:
    """Every (depth, size) on all folds from one forest a fold, with balanced class
    weights, rows drawn with repetition and a square root of the features a node.

    Raises ValueError if the rows do not fit (see ``fits``)."""
    edges = Edges.of(train, features)
    width = len(edges.cuts)
    if not fits(train.count(), width):
        raise ValueError("too many rows to broadcast: use MLlib's forest")
    blocks = Blocks.of(train, features, label, fold, key, keep=False)
    own = blocks.rdd.map(lambda b: (  # bounded by the check above
        (edges.encode(b.x) - edges.offsets[:-1]).astype(np.uint8), b.y > 0.5, b.fold.astype(np.int16), b.key)).collect()
    bins, y, fold_of, keys = (np.concatenate(c) for c in zip(*own))
    del own
    sc = train.sparkSession.sparkContext
    held = sc.broadcast((bins, y, fold_of, keys))
    n_bins = max(len(c) + 1 for c in edges.cuts)
    tried, most, deep = max(1, int(np.sqrt(width))), max(sizes), max(depths)

    def grown(job):
        f, trees = job
        x, y, fold_of, keys = held.value
        rows = fold_of != f if f >= 0 else np.ones(len(y), dtype=bool)
        n = np.bincount(y[rows].astype(int), minlength=2)
        balance = n.sum() / (2 * np.maximum(n, 1))
        label = y.astype(float)
        test = x[fold_of == f]
        segment = np.searchsorted(sizes, trees[0], side="right")
        votes, kept = np.zeros((len(depths), len(test))), []
        for t in trees:
            w = multiplicity(keys, seed * 100_003 + t) * balance[y.astype(int)] * rows
            tree = grow_tree(x, label, w, n_bins, deep, tried, np.random.default_rng([seed, f + 1, t]))
            if f < 0:
                kept.append((t, tree))
            else:
                for i, d in enumerate(depths):
                    votes[i] += reached(tree, test, d)
        return f, int(segment), votes, kept

    chunks = []
    for lo, hi in zip([0, *sizes[:-1]], sizes):  # no chunk reaches over a size
        chunks += [range(a, min(a + CHUNK, hi)) for a in range(lo, hi, CHUNK)]

    def told(votes_of):  # a fold's votes meet in a task: the driver gets counts, not a number a row
        f, own = votes_of
        y, fold_of = held.value[1:3]
        votes = np.zeros((len(sizes), len(depths), int((fold_of == f).sum())))
        for _, segment, v in sorted(own, key=lambda o: o[0]):
            votes[segment] += v
        running = votes.cumsum(0)
        return f, [[counted(y[fold_of == f], running[j, i] / s > 0.5) for j, s in enumerate(sizes)]
                   for i in range(len(depths))]

    count = np.zeros((folds, len(depths), len(sizes), 4))
    jobs = [(f, list(c)) for c in chunks for f in range(folds)]
    by_fold = sc.parallelize(jobs, len(jobs)).map(lambda job: (job[0], (job[1][0], *grown(job)[1:3])))
    for f, own in by_fold.groupByKey(folds).map(told).collect():
        count[f] = own
    results = sc.parallelize([(-1, list(c)) for c in chunks], len(chunks)).map(grown).collect()
    held.unpersist()
    mean = scores(count, scoring).mean(0)
    points = [{"max_depth": d, "n_estimators": s} for d in depths for s in sizes]
    at = int(np.argmax(np.round(mean.ravel(), 12)))
    final = sorted((p for r in results for p in r[3]), key=lambda p: p[0])
    model = ForestModel(edges, [t for i, t in final if i < points[at]["n_estimators"]], points[at]["max_depth"])
    return Search(points[at], float(mean.ravel()[at]), list(zip(points, mean.ravel().tolist())), model)

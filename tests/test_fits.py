"""Batched fits against plain versions and MLlib."""

import threading
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from torqueframe.operators import blocks as B
from torqueframe.operators import descent, forest, lloyd, trees
from torqueframe.operators.blocks import Block
from torqueframe.plans import training


def data(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((n, 4)), 2)
    x[:, 3] = rng.random(n) < 0.3
    logit = 1.5 * x[:, 0] - x[:, 1] * x[:, 3] + 0.5 * np.sin(3 * x[:, 2])
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(float)
    return x, y, np.arange(n) % 3


@pytest.fixture(scope="module")
def train(spark):
    x, y, fold = data()
    rows = [(i, [float(v) for v in x[i]], float(y[i]), int(fold[i])) for i in range(len(y))]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double, fold int").repartition(3)
    return df.withColumn("features", array_to_vector("x")).cache()


def plain_tree(bins, y, w, edges, least, depth, node=0, out=None):
    """Recursive growth by the Gini criterion, trying every bin."""
    out = {} if out is None else out
    a, b = w.sum(), (w * y).sum()
    out[node] = (-1, b / a if a else 0.0)
    best = (1e-12 * a, -1)
    for f in range(len(edges.cuts)):
        for s in range(edges.offsets[f], edges.offsets[f + 1] - 1):
            left = bins[:, f] <= s
            if min(left.sum(), (~left).sum()) < least:
                continue
            la, lb = w[left].sum(), (w * y)[left].sum()
            ra, rb = a - la, b - lb
            gain = la * ra / (la + ra) * (lb / la - rb / ra) ** 2
            if gain > best[0] * (1 + 1e-9):
                best = (gain, s)
    if depth and best[1] >= 0:
        out[node] = (best[1], out[node][1])
        left = bins[:, edges.feature[best[1]]] <= best[1]
        for side, rows in ((1, left), (2, ~left)):
            plain_tree(bins[rows], y[rows], w[rows], edges, least, depth - 1, 2 * node + side, out)
    return out


def test_edges(spark):
    df = spark.createDataFrame([([float(i), 0.0 if i < 99 else 5.0, 1.0, float("nan") if i == 3 else 2.0],) for i in range(100)],
                               "features array<double>")
    e = trees.Edges.of(df, max_bins=8)
    assert [len(c) for c in e.cuts] == [8, 1, 0, 0] and e.cuts[1].tolist() == [0.0]
    bins = e.encode(np.array([[0.0, 0.0, 1, 2], [99.0, 5.0, 1, np.nan]]))
    assert bins[0].tolist() == [0, e.offsets[1], e.offsets[2], e.offsets[3]]
    assert bins[1].tolist() == [8, e.offsets[1] + 1, e.offsets[2], e.offsets[3]]


def test_tree_grid_equals_single_trees(train):
    x, y, fold = data()
    edges = trees.Edges.of(train)
    bl = B.Blocks.of(train, label="y", fold="fold").mapped(lambda b: b._replace(x=edges.encode(b.x)))
    grid = trees.grow(bl, edges, [0, 2, -1], [3, 25], 4)
    bins = edges.encode(x)
    for t, (f, m) in enumerate(zip(grid.folds, grid.min_rows)):
        rows = fold != f
        n = np.bincount(y[rows].astype(int), minlength=2)
        w = (n.sum() / (2 * n))[y[rows].astype(int)]
        want = plain_tree(bins[rows], y[rows], w, edges, m, 4)
        for node in want:
            if node < 15:
                assert grid.split[t, node] == want[node][0], (f, m, node)
            assert grid.probability(t)[node] == pytest.approx(want[node][1])
    got = trees.tree_scores(bl, grid, [2, 4], "accuracy")
    manual = np.zeros((2, 2))
    for j, d in enumerate((2, 4)):
        for i, m in enumerate((3, 25)):
            accs = []
            for t in [t for t in range(6) if grid.min_rows[t] == m and grid.folds[t] >= 0]:
                rows = fold == grid.folds[t]
                p = grid.probability(t)[trees.walk(bins[rows], grid.split[t], edges.feature, d)] > 0.5
                accs.append((p == (y[rows] > 0.5)).mean())
            manual[j, i] = np.mean(accs)
    assert np.allclose(got, manual)
    bl.done()


def test_tree_search_model(spark, train, tmp_path):
    found = trees.tree_search(train, "y", folds=3, scoring="accuracy", min_rows=(3, 10), depths=(2, 3))
    assert len(found.scores) == 4 and found.score == max(s for _, s in found.scores)
    out = found.model.transform(train).select("id", "y", "proba_1", "prediction").toPandas()
    assert ((out["proba_1"] > 0.5) == (out["prediction"] == 1)).all() and (out["y"] == out["prediction"]).mean() > 0.65
    assert found.model.importance.sum() == pytest.approx(1) and found.model.importance.argmax() == 0
    found.model.save(spark, str(tmp_path / "m"))
    again = trees.StagedModel.load(spark, str(tmp_path / "m"))
    x = data()[0]
    assert (again.probability(x) == found.model.probability(x)).all()


def plain_ada(bins, y, edges, rounds, w):
    """AdaBoost on class probabilities of stumps, as a plain loop."""
    score = np.zeros(len(y))
    w = w.astype(float).copy()
    eps = np.finfo(float).eps
    for _ in range(rounds):
        t = plain_tree(bins, y, w, edges, 1, 1)
        s = t[0][0]
        node = np.zeros(len(y), dtype=int) if s < 0 else 1 + (bins[:, edges.feature[s]] > s)
        p = np.clip([t[i][1] if i in t else 0 for i in range(3)], eps, 1)[node]
        q = np.clip([1 - t[i][1] if i in t else 0 for i in range(3)], eps, 1)[node]
        h = np.log(p) - np.log(q)
        score += h
        w = w * np.exp((0.5 - y) * h)
        w /= w.sum()
    return 1 / (1 + np.exp(-score / rounds))


def plain_boost(bins, y, edges, rounds, depth, rate):
    f = np.full(len(y), np.log(y.sum() / (len(y) - y.sum())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        res, hess = y - p, p * (1 - p)
        t = plain_tree(bins, res, np.ones(len(y)), edges, 1, depth)
        split = np.array([t.get(i, (-1, 0))[0] for i in range(2 ** depth - 1)])
        node = trees.walk(bins, split, edges.feature, depth)
        for leaf in np.unique(node):
            f[node == leaf] += rate * res[node == leaf].sum() / hess[node == leaf].sum()
    return 1 / (1 + np.exp(-f))


def test_boosting_equals_plain_loops(train, monkeypatch):
    monkeypatch.setattr(trees, "RENEWED", 3)
    x, y, fold = data()
    edges = trees.Edges.of(train)
    bins = edges.encode(x)
    bl = B.Blocks.of(train, label="y", fold="fold").mapped(lambda b: b._replace(x=edges.encode(b.x)))
    members = [trees.Member(1), trees.Member(-1)]
    for kind, depth, want in (("samme", 1, lambda r, n: plain_ada(bins[r], y[r], edges, n, np.ones(r.sum()))),
                              ("boost", 2, lambda r, n: plain_boost(bins[r], y[r], edges, n, 2, 0.1))):
        grown = trees.boost(bl, edges, members, 7, kind, depth)
        for i, rows in enumerate((fold != 1, fold > -1)):
            model = trees._staged_model(kind, edges, grown, np.array([i]), 7, depth, 0.1)
            assert np.allclose(model.probability(x[rows]), want(rows, 7), atol=1e-9)
            # a prefix equals a fit of that size
            assert np.allclose(model.first(4).probability(x[rows]), want(rows, 4), atol=1e-9)
        again = trees.boost(bl, edges, members[1:], 4, kind, depth)
        assert (again.split[:, 0] == grown.split[:4, 1]).all() and np.allclose(again.leaf[:, 0], grown.leaf[:4, 1])
    bl.done()


def test_staged_search_and_bags(train):
    found = trees.staged_search(train, "y", "samme", sizes=(2, 5), folds=3, scoring="accuracy")
    assert [p["n_estimators"] for p, _ in found.scores] == [2, 5] and found.score > 0.6
    bags = trees.staged_search(train, "y", "samme", sizes=(2, 4), folds=3, scoring="accuracy", bags=4, final_bags=3, key="id")
    assert bags.model.split.shape[1] == 3 and bags.score > 0.6
    boost = trees.staged_search(train, "y", "boost", sizes=(2, 4), folds=3, scoring="f1_weighted")
    assert boost.model.split.shape[:2] == (boost.best["n_estimators"], 1)


def test_perfect_stump_ends_an_ensemble(spark):
    df = spark.createDataFrame([([float(i)], float(i >= 10), 0) for i in range(20)], "features array<double>, y double, fold int")
    edges = trees.Edges.of(df)
    bl = B.Blocks.of(df, label="y").mapped(lambda b: b._replace(x=edges.encode(b.x)))
    grown = trees.boost(bl, edges, [trees.Member(-1)], 5, "samme", 1)
    assert grown.sizes.tolist() == [1] and (grown.split[1:] == -1).all()
    p = trees._staged_model("samme", edges, grown, np.array([0]), 5, 1, 1.0).probability(np.array([[3.0], [15.0]]))
    assert p[0] < 1e-6 and p[1] > 1 - 1e-6


def test_multiplicity_is_poisson():
    c = trees.multiplicity(np.arange(100_000, dtype=np.int64) * 7919, 3)
    assert c.mean() == pytest.approx(1, abs=0.02) and c.var() == pytest.approx(1, abs=0.03)
    assert (c != trees.multiplicity(np.arange(100_000, dtype=np.int64) * 7919, 4)).mean() > 0.3


@pytest.mark.parametrize("hessians", [1 << 23, 0])
def test_logistic_path_equals_mllib(train, monkeypatch, hessians):
    monkeypatch.setattr(descent, "HESSIANS", hessians)  # Newton's steps, and L-BFGS beyond the bound
    x, y, fold = data()
    bl = B.Blocks.of(train, label="y", fold="fold")
    cs = [0.01, 1.0, 50.0]
    fits = descent.linear_fits(bl, "logistic", cs, [0, -1])
    for i, (f, c) in enumerate([(f, c) for f in (0, -1) for c in cs]):
        own = train.where(f"fold <> {f}")
        n = int((fold != f).sum())
        m = LogisticRegression(labelCol="y", regParam=1 / (c * n), standardization=False, tol=1e-10, maxIter=300).fit(own)
        assert np.allclose(fits.weights[i, :-1], m.coefficients.toArray(), atol=1e-4)
        assert fits.weights[i, -1] == pytest.approx(m.intercept, abs=1e-4)
    bl.done()


def test_hinge_path_is_no_worse_than_mllib(train):
    x, y, _ = data()
    bl = B.Blocks.of(train, label="y", fold="fold")
    cs = [0.05, 2.0, 100.0]
    fits = descent.linear_fits(bl, "hinge", cs, [-1])

    def objective(w, b, c):
        margin = np.where(y > 0.5, 1, -1) * (x @ w + b)
        return np.maximum(0, 1 - margin).mean() + (w ** 2).sum() / (2 * c * len(y))

    for i, c in enumerate(cs):
        m = LinearSVC(labelCol="y", regParam=1 / (c * len(y)), standardization=False, maxIter=40).fit(train)
        own = objective(fits.weights[i, :-1], fits.weights[i, -1], c)
        assert own <= objective(m.coefficients.toArray(), m.intercept, c) * (1 + 2e-3)
    bl.done()


def test_linear_and_network_search(spark, train, tmp_path):
    found = descent.linear_search(train, "y", "logistic", [0.1, 1.0], folds=3, scoring="accuracy")
    out = found.model.transform(train).select("x", "proba_1", "prediction", "decision_function").toPandas()
    m = found.model.margin(np.stack(out["x"]))
    assert np.allclose(out["decision_function"], m) and ((m > 0) == (out["prediction"] == 1)).all()
    assert np.allclose(out["proba_1"], 1 / (1 + np.exp(-m))) and found.score > 0.65
    found.model.save(spark, str(tmp_path / "l"))
    assert np.allclose(descent.LinearModel.load(spark, str(tmp_path / "l")).coefficients, found.model.coefficients)
    net = descent.network_search(train, "y", ("logistic", "tanh"), units=6, passes=60, folds=3, scoring="accuracy")
    p = net.model.transform(train).select("y", "proba_1", "prediction").toPandas()
    assert net.score > 0.65 and (p["y"] == p["prediction"]).mean() > 0.65 and len(net.scores) == 2
    net.model.save(spark, str(tmp_path / "n"))
    again = descent.NetworkModel.load(spark, str(tmp_path / "n"))
    assert np.allclose(again.margin(data()[0]), net.model.margin(data()[0]))


def test_boosting_holds_few_rows_at_a_time(train, monkeypatch):
    edges = trees.Edges.of(train)
    bl = B.Blocks.of(train, "features", "y", "fold").mapped(lambda b: b._replace(x=edges.encode(b.x)))
    members = [trees.Member(f) for f in range(3)] + [trees.Member(-1, 5, np.array([0, 2]))]
    seen, write = [], trees.binned_sums
    local = [B.Block(*z) for z in bl.rdd.collect()]

    class Here:  # the same blocks in this process, where the sizes can be seen
        def summed(self, fn):
            return [sum(z) for z in zip(*map(fn, local))]

    monkeypatch.setattr(trees, "binned_sums", lambda bins, *z: (seen.append(len(bins)), write(bins, *z))[1])
    whole = {k: trees.boost(Here(), edges, members, 5, k, d) for k, d in (("samme", 1), ("boost", 2))}
    monkeypatch.setattr(trees, "TILE", 4 * 50)
    seen.clear()
    for k, d in (("samme", 1), ("boost", 2)):
        again = trees.boost(Here(), edges, members, 5, k, d)
        assert (again.split == whole[k].split).all() and np.allclose(again.leaf, whole[k].leaf)
    assert max(seen) <= 50
    bl.done()


def plain_lloyd(x, c, rounds):
    for _ in range(rounds):
        near = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        c = np.stack([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
    return c, ((x[:, None] - c) ** 2).sum(2).min(1).sum()


def blobs(n, seed=3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, 2)) * 0.3 + np.array([[0, 0], [5, 0], [0, 5]])[np.arange(n) % 3]


def test_lloyd_equals_a_plain_loop(spark):
    x = blobs(300)
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "features array<double>").repartition(4)
    bl = B.Blocks.of(df).mapped(lambda b: b._replace(fold=np.zeros(len(b.y), dtype=np.int32)))
    fits = [lloyd.Fit(0, x[[0, 1, 2, 3]].copy()), lloyd.Fit(0, x[[5, 8]].copy())]
    want = [plain_lloyd(x, f.centres, 6) for f in fits]
    for f, (c, cost) in zip(lloyd.run(bl, fits, 6, tol=0), want):
        assert np.allclose(f.centres, c) and f.cost == pytest.approx(cost)
    bl.done()
    small = lloyd.kmeans(df, 3, n_init=4, batch=0.5, max_iter=15)
    assert small.cost < 1.3 * plain_lloyd(x, x[[0, 1, 2]], 20)[1]
    got = small.transform(df).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in got) == [100, 100, 100]


def test_blocks_are_dealt_to_all_tasks(spark):
    n = 12 * 10_000
    df = spark.range(n, numPartitions=1).select(F.array(F.col("id").cast("double")).alias("features"))
    lone = df.union(df.where("false"))
    bl = B.Blocks.of(lone, keep=False)
    sizes = bl.rdd.mapPartitions(lambda b: [sum(len(x.y) for x in b)]).collect()
    assert len(sizes) == min(12, max(1, spark.sparkContext.defaultParallelism)) and max(sizes) <= n / 2
    firsts = bl.rdd.map(lambda b: (float(b.x[0, 0]), len(b.y))).collect()
    assert firsts == [(float(i), 10_000) for i in range(0, n, 10_000)]  # none is cut, merged or moved past another
    empty = B.Blocks.of(df.where("false"), keep=False)
    assert empty.rdd.count() == 0


def test_sums_reach_the_driver_once(spark, monkeypatch):
    added, calls = B._added, []

    def watched(a, b):
        calls.append(1)  # seen here only if the driver itself adds
        return added(a, b)

    monkeypatch.setattr(B, "_added", watched)
    for tasks in (1, 3, 12):
        df = spark.range(120, numPartitions=tasks).select(F.array(F.col("id").cast("double")).alias("features"))
        got = B.Blocks.of(df, keep=False).summed(lambda b: [b.x.sum(0), np.array([len(b.y)])])
        assert got[0].tolist() == [7140.0] and got[1].tolist() == [120] and not calls


def test_gap_statistic_names_its_k(spark):
    rows = [(float(a), float(b)) for a, b in blobs(240)] + [(None, 1.0)]
    got = lloyd.gap_statistic(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], range(1, 7)).toPandas()
    assert got["k"].tolist() == [1, 2, 3, 4, 5, 6]
    assert got.loc[got["chosen"], "k"].tolist() == [3] and got["largest"].sum() == 1 and got["gap"].idxmax() >= 2


def test_scores():
    counts = np.array([[5, 1, 2, 4], [3, 0, 0, 0]])
    assert B.scores(counts, "recall").tolist() == [pytest.approx(4 / 6), 0.0]
    assert B.scores(counts, "precision")[0] == pytest.approx(0.8)
    assert B.scores(counts, "accuracy").tolist() == [0.75, 1.0]
    f1, f0 = 2 * 4 / (8 + 1 + 2), 2 * 5 / (10 + 1 + 2)
    assert B.scores(counts, "f1_weighted")[0] == pytest.approx((f1 * 6 + f0 * 6) / 12)


def test_forest_tree_equals_a_plain_one():
    """With every feature tried and no repetition, a forest's tree is the plain tree."""
    x, y, _ = data(200)
    edges = trees.Edges.within(x, 8)
    bins = edges.encode(x)
    want = plain_tree(bins, y, np.ones(len(y)), edges, 1, 5)
    split = np.array([want.get(i, (-1, 0))[0] for i in range(31)])
    share = np.array([want.get(i, (-1, 0))[1] for i in range(63)])
    local = bins - edges.offsets[:-1]
    tree = forest.grow_tree(local, y, np.ones(len(y)), 9, 5, 4, np.random.default_rng(0))
    for d in (1, 3, 4):
        assert np.allclose(forest.reached(tree, local, d), share[trees.walk(bins, split, edges.feature, d)])


def test_forest_search(spark, train, tmp_path):
    found = forest.forest_search(train, "y", folds=3, scoring="accuracy", sizes=(3, 8), depths=(2, 12), key="id")
    assert len(found.scores) == 4 and found.score > 0.65 and len(found.model.trees) == found.best["n_estimators"]
    assert found.model.importance.argmax() == 0
    out = found.model.transform(train).select("y", "prediction").toPandas()
    assert (out["y"] == out["prediction"]).mean() > 0.7
    found.model.save(spark, str(tmp_path / "f"))
    again = forest.ForestModel.load(spark, str(tmp_path / "f"))
    assert np.allclose(again.probability(data()[0]), found.model.probability(data()[0]))


def test_equal_nodes_of_a_tree_grid_are_counted_once():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 4))
    edges = trees.Edges.within(x)
    block = Block(edges.encode(x), (x[:, 0] + x[:, 1] > 0).astype(float), np.arange(3000) % 5, None, None)
    nodes = []

    class Here:
        def summed(self, fn):
            out = fn(block)
            nodes.append(len(out[0]))
            return out

    grid = trees.grow(Here(), edges, [*range(5), -1], (1, 2, 3, 4), 3)
    assert nodes[:2] == [6, 12]  # for each fold, not for each of the 24 trees
    alone = trees.grow(Here(), edges, [3], (4,), 3)
    t = next(i for i, (f, m) in enumerate(zip(grid.folds, grid.min_rows)) if (f, m) == (3, 4))
    assert np.array_equal(grid.split[t], alone.split[0]) and np.array_equal(grid.counts[t], alone.counts[0])


def test_forest_takes_a_byte_a_value():
    assert forest.fits(250_000, 91) and not forest.fits(10_000_000, 91)
    assert max(len(c) + 1 for c in trees.Edges.within(np.random.default_rng(0).normal(size=(5000, 2))).cuts) <= 256


def test_network_holds_few_rows_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 6))
    block = Block(x, (x[:, 0] > 0).astype(float), np.arange(20_000) % 10, None, None)

    class Here:
        def summed(self, fn):
            return fn(block)

        def done(self):
            pass

    monkeypatch.setattr(descent.Blocks, "of", classmethod(lambda cls, *a, **k: Here()))

    def found():
        return descent.network_search(None, "y", passes=3)

    tracemalloc.start()
    tiled = found()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6  # a layer of all rows is 16 MB
    monkeypatch.setattr(descent, "TILE", 1 << 20)
    whole = found()
    assert np.allclose(tiled.model.hidden, whole.model.hidden) and np.allclose(tiled.model.out, whole.model.out)


def test_vote_searches_several_models_at_a_time(spark, monkeypatch):
    both = threading.Barrier(2, timeout=30)

    def fit(name, *rest):
        both.wait()
        return training.Fitted({"name": name}, None, [], name)

    monkeypatch.setattr(training, "fit", fit)
    found = training.vote(spark.range(1), "y", "id", 1, voters=("dt", "lr"))
    assert found.best == {"dt": {"name": "dt"}, "lr": {"name": "lr"}} and list(found.model.members) == ["dt", "lr"]


def test_only_one_model_of_each_c_has_a_hessian(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=(900, 3)), np.eye(4)[rng.integers(0, 4, 900)]])
    y = (rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 3])))).astype(float)
    rows = [([float(v) for v in a], float(b), i % 5) for i, (a, b) in enumerate(zip(x, y))]
    bl = B.Blocks.of(spark.createDataFrame(rows, "features array<double>, y double, fold int"), label="y", fold="fold")
    hessians, summed = [], bl.summed

    def counted(fn):
        out = summed(fn)
        hessians.extend(len(a) for a in out if a.ndim == 3)
        return out

    bl.summed = counted
    cs, folds = [0.1, 1.0, 20.0], [0, 1, 2, 3, 4, -1]
    fits = descent.linear_fits(bl, "logistic", cs, folds)
    assert hessians and max(hessians) <= len(cs)  # not one for each of the folds as well
    for i, (f, c) in enumerate((f, c) for f in folds for c in cs):
        own = np.arange(900) % 5 != f
        p = 1 / (1 + np.exp(-(x[own] @ fits.weights[i, :-1] + fits.weights[i, -1])))
        slope = x[own].T @ (p - y[own]) / own.sum() + fits.weights[i, :-1] / (c * own.sum())
        assert np.abs(slope).max() < 1e-6 and abs((p - y[own]).mean()) < 1e-6
    bl.done()


def test_stumps_keep_no_score_a_row(train):
    """Ensembles of stumps hold a number a bin and member, however many rows and rounds."""
    edges = trees.Edges.of(train)
    bl = B.Blocks.of(train, "features", "y", "fold").mapped(lambda b: b._replace(x=edges.encode(b.x)))
    local = [B.Block(*z) for z in bl.rdd.collect()]
    assert all(b.x.dtype == np.uint16 for b in local)

    class Here:
        def summed(self, fn):
            return [sum(z) for z in zip(*map(fn, local))]

        def with_state(self, fn):
            raise AssertionError("scores of all rows and members are written")

    members = [trees.Member(f, i, np.array([0, 1 + i])) for f in range(3) for i in range(2)]
    whole = trees.boost(Here(), edges, members, 2 * trees.RENEWED + 3, "samme", 1)
    assert (whole.split[-1] >= 0).any()
    for i, x in enumerate(members):  # shared passes give what each member gives alone
        alone = trees.boost(Here(), edges, [x], 5, "samme", 1)
        assert (alone.split[:, 0] == whole.split[:5, i]).all() and np.allclose(alone.leaf[:, 0], whole.leaf[:5, i])
    bl.done()


def test_a_boosting_pass_sums_only_what_it_needs(train, monkeypatch):
    edges = trees.Edges.of(train)
    bl = B.Blocks.of(train, "features", "y", "fold").mapped(lambda b: b._replace(x=edges.encode(b.x)))
    local = [B.Block(*z) for z in bl.rdd.collect()]
    bl.done()
    shapes, write = [], trees.binned_sums

    class Here:
        def summed(self, fn):
            return [sum(z) for z in zip(*map(fn, local))]

    def sums(*z):
        out = write(*z)
        shapes.append(out.shape)
        return out

    monkeypatch.setattr(trees, "binned_sums", sums)
    trees.boost(Here(), edges, [trees.Member(f) for f in range(4)], 3, "boost", 2)
    assert {w for _, w in shapes} == {edges.bins - len(edges.cuts) + 1}  # no column for a feature's last bin
    assert min(k for k, _ in shapes) == 8  # roots of later rounds: their weights are known
    shapes.clear()
    trees.boost(Here(), edges, [trees.Member(f, f) for f in range(4)], 3, "samme", 1)
    assert max(k for k, _ in shapes) == 4  # bags: one number a row and member, not two


def test_lloyd_measures_only_centres_that_bounds_leave(monkeypatch):
    monkeypatch.setattr(lloyd, "SLICE", 256)
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 1, (8192, 3))
    x[:300] = x[0]  # copies, and centres that stand in the same place: ties go to the first
    own = B.Block(x, np.zeros(len(x)), np.zeros(len(x), dtype=np.int32), np.zeros(len(x), dtype=np.int64), None)
    (block,) = lloyd.placed(iter([own._replace(x=z) for z in np.split(x, 4)]))
    assert sorted(map(tuple, block.x)) == sorted(map(tuple, x))
    volume = np.mean([np.prod(z.max(0) - z.min(0)) for z in np.split(block.x, 32)])
    assert volume < 0.1  # of 1, which unordered rows nearly fill
    measured, write = [], lloyd.nearest

    def nearest(columns, square, c, *room):
        measured.append(len(c) * columns.shape[1])
        return write(columns, square, c, *room)

    class Here:
        def summed(self, fn):
            return fn(block)

    monkeypatch.setattr(lloyd, "nearest", nearest)
    start = x[rng.choice(len(x), 29, replace=False)]
    start[7] = start[3]
    fits = [lloyd.Fit(0, start.copy())]
    want = plain_lloyd(x, start, 5)
    (fit,) = lloyd.run(Here(), fits, 5, tol=0)
    assert np.allclose(fit.centres, want[0]) and fit.cost == pytest.approx(want[1])
    assert sum(measured) < 0.6 * 6 * 29 * len(x)

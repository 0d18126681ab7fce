"""Chunked scans and aggregate-based operators against plain re-statements."""

import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from torqueframe.functions.numeric import probit
from torqueframe.operators import clustering, history, metrics, ordered, quantiles


def _pandas_history(pdf):
    out = []
    for _, g in pdf.sort_values(["k", "t"]).groupby("k"):
        g = g.copy()
        n = len(g)
        x = g["new_score"].astype(float).values
        pos = np.arange(1, n + 1)
        dyn = np.where(pos == 1, 0.0, np.cumsum(x) / pos)
        g["number_prev_sales"] = pos - 1
        g["last_score"] = np.r_[np.nan, x[:-1]]
        g["average_score_dynamic"] = dyn
        g["average_score_dynamic_std"] = np.std(dyn)
        g["prev_average_score_dynamic"] = np.r_[np.nan, dyn[:-1]]
        g["q1_score_global"] = np.quantile(x, 0.25)
        if n == 1:
            for c in ["number_prev_sales", "last_score", "average_score_dynamic", "average_score_dynamic_std",
                      "prev_average_score_dynamic", "q1_score_global"]:
                g[c] = 0
        out.append(g.fillna(0))
    return pd.concat(out)


@pytest.mark.parametrize("chunk_div", [None, 1, 7])
def test_history_matches_pandas(spark, chunk_div):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 5)}", i, rnd.randint(0, 1)) for i in range(400)]
    pdf = pd.DataFrame(rows, columns=["k", "t", "new_score"])
    df = spark.createDataFrame(pdf).withColumn("margem_percentagem", F.lit(1.0)).withColumn("stock_days", F.lit(1))
    chunk = None if chunk_div is None else F.floor(F.col("t") / chunk_div)
    got = history.config_history(df, ["k"], ["t"], chunk=chunk).toPandas().sort_values(["k", "t"])
    exp = _pandas_history(pdf)
    for c in ["number_prev_sales", "last_score", "average_score_dynamic", "average_score_dynamic_std",
              "prev_average_score_dynamic", "q1_score_global"]:
        np.testing.assert_allclose(got[c].astype(float).values, exp[c].astype(float).values, atol=1e-9)


def test_running_sums_and_positions(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), i, rnd.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    out = ordered.running_sums(df, ["k"], ["t"], ["x"], chunk=F.floor(F.col("t") / 13)).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "t", "x"]).sort_values(["k", "t"])
    pdf["cum_x"] = pdf.groupby("k")["x"].cumsum()
    pdf["_pos"] = pdf.groupby("k").cumcount() + 1
    m = out.merge(pdf, on=["k", "t"], suffixes=("", "_e"))
    np.testing.assert_allclose(m["cum_x"], m["cum_x_e"])
    assert (m["_pos"] == m["_pos_e"]).all()
    pos = ordered.sorted_positions(df, [F.asc("t")], F.floor(F.col("t") / 50)).toPandas()
    assert (pos.sort_values("t")["position"].values == np.arange(1, 301)).all()


def test_probit_against_stdlib(spark):
    ps = [1e-6, 0.01, 0.02425, 0.3, 0.5, 0.9, 0.99, 1 - 1e-6]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(probit("p")).collect()]
    for p, g in zip(ps, got):
        assert g == pytest.approx(statistics.NormalDist().inv_cdf(p), abs=1e-8)
    assert spark.createDataFrame([(1.0,)], "p double").select(probit("p")).collect()[0][0] is None


def test_silhouette_against_pairs(spark):
    rnd = np.random.default_rng(1)
    pts = rnd.normal(size=(40, 3))
    lab = rnd.integers(0, 3, size=40)
    df = spark.createDataFrame([(i, pts[i].tolist(), int(lab[i])) for i in range(40)],
                               "id int, v array<double>, c int")
    got = clustering.silhouette_samples(df, "v", "c", "id").toPandas().set_index("id")["silhouette"]
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    for i in range(40):
        own = lab == lab[i]
        a = d2[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else 0
        b = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s = 0.0 if own.sum() == 1 else (b - a) / max(a, b)
        assert got[i] == pytest.approx(s, abs=1e-9)


@pytest.mark.parametrize("prune,tile", [(None, 2048), (True, 2048), (True, 16), (False, 16)])
def test_knn_exact_against_brute_force(spark, monkeypatch, prune, tile):
    """Both paths, and tiles small enough that hot buckets split into many
    (train block, query block) tiles; a third of the train points sit in one
    tight cluster."""
    from torqueframe.operators import neighbors
    monkeypatch.setattr(neighbors, "TILE_ROWS", tile)
    rnd = np.random.default_rng(5)
    tr = rnd.normal(size=(120, 6))
    tr[:40] = tr[:40] * 0.01 + 0.3
    qu = rnd.normal(size=(30, 6)) * 1.5
    lab = rnd.integers(0, 3, size=120)
    train = spark.createDataFrame([(i, tr[i].tolist(), int(lab[i])) for i in range(120)],
                                  "id int, v array<double>, y int")
    queries = spark.createDataFrame([(1000 + j, qu[j].tolist(), -1) for j in range(30)],
                                    "id int, v array<double>, y int")
    got = neighbors.knn_neighbours(train, queries, "v", "id", k=4, prune=prune).toPandas()
    for j in range(30):
        d = ((tr - qu[j]) ** 2).sum(1)
        exp = sorted(np.argsort(d, kind="stable")[:4].tolist())
        assert sorted(got[got.qid == 1000 + j].tid.tolist()) == exp


def test_history_hot_key_struct_chunk(spark):
    """One configuration holds a third of the rows; chunks are a struct
    (t, id bucket): it keeps the whole leading order key, so it is
    non-decreasing in the (t, id) order and splits a hot (key, t) further."""
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 9)}"
        rows.append((k, rnd.randint(0, 40), i, rnd.randint(0, 1)))
    pdf = pd.DataFrame(rows, columns=["k", "t", "id", "new_score"])
    df = spark.createDataFrame(pdf).withColumn("margem_percentagem", F.lit(1.0)).withColumn("stock_days", F.lit(1))
    chunk = F.struct(F.col("t").alias("a"), F.floor(F.col("id") / 50).alias("b"))
    got = history.config_history(df, ["k"], ["t", "id"], chunk=chunk).toPandas().sort_values(["k", "t", "id"])
    exp = _pandas_history(pdf.sort_values(["k", "t", "id"]).assign(t=lambda x: x["t"] * 1000 + x["id"]))
    np.testing.assert_allclose(got["average_score_dynamic"].values, exp["average_score_dynamic"].values, atol=1e-9)
    np.testing.assert_allclose(got["number_prev_sales"].values, exp["number_prev_sales"].values)
    np.testing.assert_allclose(got["prev_average_score_dynamic"].values, exp["prev_average_score_dynamic"].values,
                               atol=1e-9)


def test_knn_null_vectors(spark):
    """A null train vector is never a neighbour; a null query gets none."""
    from torqueframe.operators import neighbors
    train = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, None, 1), (3, [1.0, 0.0], 1), (4, [5.0, 5.0], 1)],
                                  "id int, v array<double>, y int")
    queries = spark.createDataFrame([(10, [0.1, 0.0], -1), (11, None, -1)], "id int, v array<double>, y int")
    got = neighbors.knn_neighbours(train, queries, "v", "id", k=2, label="y").orderBy("qid", "d2").toPandas()
    assert got.qid.tolist() == [10, 10] and got.tid.tolist() == [1, 3]


@pytest.mark.parametrize("prune", [False, True])
def test_knn_ties_break_by_id(spark, monkeypatch, prune):
    """Equal distances are ordered by train id across tiles, as (d2, tid)."""
    from torqueframe.operators import neighbors
    monkeypatch.setattr(neighbors, "TILE_ROWS", 2)
    rows = [(i, [1.0, 1.0], i % 2) for i in range(20, 0, -1)] + [(100, [9.0, 9.0], 1)]
    train = spark.createDataFrame(rows, "id int, v array<double>, y int")
    queries = spark.createDataFrame([(500, [0.0, 0.0], -1), (501, [9.0, 8.0], -1)], "id int, v array<double>, y int")
    got = neighbors.knn_neighbours(train, queries, "v", "id", k=3, prune=prune).toPandas()
    assert sorted(got[got.qid == 500].tid.tolist()) == [1, 2, 3]
    assert sorted(got[got.qid == 501].tid.tolist()) == [1, 2, 100]


def test_history_of_large_configurations_takes_bracketed_quantiles(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(k, i, float(rng.normal()) if i % 7 else None) for k, n in (("a", 900), ("b", 40), ("c", 1)) for i in range(n)]
    rows += [(None, i, 1.0) for i in range(3)] + [("d", i, None) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, t int, new_score double").withColumns(
        {"margem_percentagem": F.lit(1.0), "stock_days": F.lit(2.0)})
    want = history.config_history(df, ["k"], ["t"], chunk=F.floor(F.col("t") / 50)).toPandas()
    monkeypatch.setattr(history, "PERCENTILE_ROWS", 100)
    monkeypatch.setattr(quantiles, "FEW", 60)
    got = history.config_history(df, ["k"], ["t"], chunk=F.floor(F.col("t") / 50)).toPandas()
    a, b = (x.sort_values(["k", "t"]).reset_index(drop=True) for x in (want, got))
    pd.testing.assert_frame_equal(a, b)
    assert history.without_configuration(df, ["k"]).first()[0] == 3


def test_roc_points_of_many_ranges(spark):
    rng = np.random.default_rng(4)
    gt, score = rng.integers(0, 2, 3000), np.concatenate([rng.normal(size=2000).round(2), np.full(999, 0.5), [1e9]])
    df = spark.createDataFrame([(int(g), float(s)) for g, s in zip(gt, score)], "gt int, score double")
    got = {r.threshold: (r.fpr, r.tpr) for r in metrics.roc_points(df.repartition(5), "gt", "score").collect()}
    for t in np.unique(score):
        up = score >= t
        assert got[t] == pytest.approx(((up & (gt == 0)).sum() / (gt == 0).sum(), (up & (gt == 1)).sum() / (gt == 1).sum()))
    assert len(got) == len(np.unique(score))

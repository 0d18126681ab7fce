"""Pivot index, continuous mutual information, exact quantiles, sparse blocks,
routed fill and the bucketed hand-over, against plain versions."""

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from torqueframe.operators import encode, neighbour_info, ordered, pivots, quantiles
from torqueframe.operators.score import price_total
from torqueframe.operators.options import first_per_key
from torqueframe.sources.tables import bucketed


def vectors(spark, x, label, fold=None):
    rows = [(i, None if v is None else [float(c) for c in v], int(label[i]), int(fold[i]) if fold is not None else 0)
            for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>, label int, fold int").repartition(3).cache()


def nearest(x, ids, q, k, spared):
    near = sorted((sum((a - b) ** 2 for a, b in zip(x[t], q)), t) for t in ids if not spared(t))
    return near[:k]


def test_pivot_search_is_exact_and_prunes(spark, monkeypatch):
    monkeypatch.setattr(pivots, "TILE", 64)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 3)) * 0.05 + rng.integers(0, 5, (600, 1)) * 4
    x[:40] = x[0]  # many copies in one place
    df = vectors(spark, x, np.zeros(600))
    index = pivots.build(df, "v", "id", "label")
    queries = df.where("id % 4 = 0")
    got = pivots.search(index, queries, "v", "id", 7).cache()
    by = defaultdict(list)
    for r in got.where("rank > 0").collect():
        by[r["qid"]].append((r["rank"], r["tid"], r["d2"]))
    assert len(by) == 150
    for q, own in by.items():
        want = nearest(x, range(600), x[q], 7, lambda t: False)
        assert [t for _, t, _ in sorted(own)] == [t for _, t in want]
        assert np.allclose([d for _, _, d in sorted(own)], [d for d, _ in want])
    assert got.agg(pivots.measured(got)).first()[0] < 0.5 * 150 * 600


def test_knn_grid(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((150, 2))
    label = (x[:, 0] + 0.4 * rng.standard_normal(150) > 0).astype(int) + (x[:, 1] > 1)
    fold = np.arange(150) % 3
    df = vectors(spark, [*x[:149], None], label, fold)
    got = {r["k"]: r["score"] for r in pivots.knn_grid(df, "v", "id", "label", ks=(1, 2, 5, 9)).collect()}
    for k in (1, 2, 5, 9):
        hits = defaultdict(list)
        for q in range(149):
            near = nearest(x, range(149), x[q], k, lambda t: fold[t] == fold[q])
            votes = Counter(label[t] for _, t in near)
            told = min(votes, key=lambda v: (-votes[v], v))
            hits[fold[q]].append(told == label[q])
        assert got[k] == pytest.approx(np.mean([np.mean(h) for h in hits.values()]))


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def plain_information(x, y, k):
    keep = [i for i in range(len(x)) if x[i] is not None and sum(y[j] == y[i] and x[j] is not None for j in range(len(x))) > 1]
    total = 0.0
    for i in keep:
        same = [j for j in keep if y[j] == y[i]]
        kk = min(k, len(same) - 1)
        r = sorted(abs(x[j] - x[i]) for j in same if j != i)[kk - 1]
        m = sum(abs(x[j] - x[i]) < r if r > 0 else x[j] == x[i] for j in keep)
        total += psi(kk) - psi(len(same)) - psi(m)
    return max(0.0, psi(len(keep)) + total / len(keep))


def test_mutual_information_of_continuous_features(spark, monkeypatch):
    monkeypatch.setattr(neighbour_info, "RANGE_ROWS", 23)
    rng = np.random.default_rng(2)
    n = 240
    y = rng.integers(0, 3, n)
    y[0] = 9  # a class of one row
    y[1:4] = 7  # fewer rows than k
    a = rng.integers(-512, 512, n) / 256 + y  # exact in binary: no rounding in distances
    b = rng.integers(0, 4, n).astype(float)   # few values, all tied
    c = [None if i % 9 == 0 else float(v) for i, v in enumerate(rng.integers(0, 3000, n) / 8)]
    df = spark.createDataFrame([(float(a[i]), float(b[i]), c[i], int(y[i])) for i in range(n)], "a double, b double, c double, y int")
    got = {r["feature"]: r["score"] for r in neighbour_info.mutual_info_continuous(df, ["a", "b", "c"], "y").collect()}
    assert got["a"] > 0.1
    for name, x in (("a", a), ("b", b), ("c", c)):
        assert got[name] == pytest.approx(plain_information(list(x), list(y), 3), abs=1e-9), name


def test_digamma(spark):
    got = spark.range(1, 60).select("id", neighbour_info.digamma(F.col("id")).alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(psi(r["id"]), abs=1e-11)


@pytest.mark.parametrize("few", [10, 1_000_000])
def test_exact_quantiles(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = np.random.default_rng(3)
    groups = {"all": rng.lognormal(0, 3, 4000), "tied": np.repeat([1.0, 2.0, 2.0, 5.0], 300), None: np.array([3.0]),
              "two": np.array([-1.0, 4.0])}
    rows = [(g, float(v)) for g, own in groups.items() for v in own] + [("all", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(5)] for r in quantiles.exact_quantiles(df, ["g"], "x", qs).collect()}
    assert set(got) == {"all", "tied", None, "two"}
    for g, own in groups.items():
        assert np.allclose(got[g], np.quantile(own, qs), rtol=1e-12)


def test_one_group_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 50)
    df = spark.range(20_000).select(F.lit(1).alias("g"), F.pmod(F.col("id") * 7919, F.lit(20_011)).cast("double").alias("x"))
    want = np.quantile([i * 7919 % 20_011 for i in range(20_000)], [0.5, 0.99])
    got = quantiles.exact_quantiles(df, ["g"], "x", [0.5, 0.99]).first()
    assert [got["q0"], got["q1"]] == want.tolist()


def test_sparse_blocks_beyond_a_thousand_categories(spark):
    df = spark.range(10_000).select((F.col("id") % 5000).cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    model = encode.sparse_one_hot(df, ["a", "b"])
    new = df.unionByName(spark.createDataFrame([(None, "0"), ("unseen", "2")], "a string, b string"))
    out = encode.reverse_sparse(model.transform(new), ["a", "b"])
    assert out.where("a <=> a_value and b <=> b_value").count() == 10_001
    assert out.where("a_value is null").count() == 2 and out.select("a_ohe").first()[0].size == 5000


def test_routed_fill_equals_the_plain_one(spark):
    rng = np.random.default_rng(4)
    rows = [(["hot", "b", "c", None][min(3, int(rng.exponential(0.7)))], i, None if rng.random() < 0.6 else f"v{i}",
             None if rng.random() < 0.8 else i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, t long, a string, n long")
    want = sorted(map(str, ordered.fill_forward_backward(df, ["k"], ["t"], ["a", "n"]).collect()))
    for hot in (1_000_000, 100, 0):
        got = ordered.fill_routed(df, ["k"], ["t"], ["a", "n"], "t", hot_rows=hot, ranges=8)
        assert got.columns == df.columns and sorted(map(str, got.collect())) == want


def test_bucketed_lines_need_no_exchange(spark, tmp_path):
    lines = spark.range(2000).select((F.col("id") % 97).alias("vehicle"), "id", (F.col("id") * 1.5).alias("cost"))
    own = bucketed(lines, "vehicle", 4, ["id"], path=str(tmp_path / "lines"))
    for df in (price_total(own, "vehicle", "cost"), first_per_key(own, "vehicle", ["id"]),
               price_total(own, "vehicle", "cost").join(first_per_key(own, "vehicle", ["id"]), "vehicle")):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan, plan
    assert price_total(own, "vehicle", "cost").agg(F.sum("price_total")).first()[0] == pytest.approx(1.5 * 1999 * 1000)


def test_probes_of_many_cells_come_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(pivots, "PROBES", 100)
    rng = np.random.default_rng(6)
    x, centres = rng.standard_normal((50, 4)), rng.standard_normal((30, 4))
    pdf = pd.DataFrame({"qid": range(50), "qv": list(x), "qgrp": 0, "radius": 1.0})
    at, cells = np.repeat(np.arange(50), 30), np.tile(np.arange(30), 50).astype(np.int32)
    pieces = list(pivots._asked(pdf, at, cells, centres))
    assert max(map(len, pieces)) == 100
    got = pd.concat(pieces)
    assert got["qid"].tolist() == at.tolist() and got["cell"].tolist() == cells.tolist()
    assert np.allclose(got["dq"], np.linalg.norm(x[at] - centres[cells], axis=1))


def test_sparse_reversal_does_not_widen_rows(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("a"))
    out = encode.reverse_sparse(encode.sparse_one_hot(df, ["a"]).transform(df), ["a"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "vector_to_array" not in plan and plan.count("1499") == 0  # no dense vector, no name in the plan
    assert out.where("a <=> a_value").count() == 3000
    dense = spark.createDataFrame([(Vectors.dense([0.0, 1.0]),), (Vectors.dense([0.0, 0.0]),)], ["b_ohe"])
    names = {"ml_attr": {"attrs": {"binary": [{"idx": 0, "name": "x"}, {"idx": 1, "name": "y"}]}}}
    dense = dense.withColumn("b_ohe", F.col("b_ohe").alias("b_ohe", metadata=names))
    assert sorted(map(str, (r["b_value"] for r in encode.reverse_sparse(dense, ["b"]).collect()))) == ["None", "y"]


def test_quantiles_read_their_input_once(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 50)
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"))
    got = quantiles.exact_quantiles(df.mapInArrow(passed, df.schema), ["g"], "x", [0.5]).collect()
    assert {r["g"]: r["q0"] for r in got} == {0: 2499.0, 1: 2500.0} and read.value == 5000


def test_members_and_weights_read_sales_once(spark, monkeypatch):
    from torqueframe.plans import catalog
    from torqueframe.plans import standins as si
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    own = spark.range(200).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 7).alias("l_partkey"),
        (F.col("id") % 5).alias("l_suppkey"), (F.col("id") * 300.0).alias("l_extendedprice"),
        (F.col("id") * 11 % 900).alias("stock_days"), (F.col("id") * 7 % 11).cast("double").alias("margem_percentagem"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("new_score"))
    monkeypatch.setattr(si, "sales", lambda s, d: own.mapInArrow(counted, own.schema))
    for name in ("run_report", "soft_vote", "run_comparison", "class_weights", "cv_folds"):
        before = read.value
        assert catalog.QUERIES[name](spark, "").collect()
        assert read.value - before == 200, name


def test_running_sums_deal_rows_once(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"))
    kept = {c: spark.conf.get(c, None) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = ordered.running_sums(df, ["k"], ["id"], ["id"], chunk=F.floor(F.col("id") / 50), size="n")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: (r["_pos"], r["n"], r["cum_id"]) for r in out.collect()}
    finally:
        for c, v in kept.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert plan.count("Exchange hashpartitioning") == 4  # the rows once, the chunk summary three times
    for k in (0, 1, 2):  # 0 is the null key
        own = list(range(k, 400, 3))
        assert [got[i] for i in own] == [(p + 1, len(own), sum(own[:p + 1])) for p in range(len(own))]


def test_a_tile_orders_few_pairs():
    import tracemalloc

    import numpy as np
    import pandas as pd

    from torqueframe.operators import neighbors

    rng = np.random.default_rng(4)
    tv, qv = rng.normal(size=(2000, 8)), rng.normal(size=(1500, 8))
    tv[:40] = tv[40]           # copies: ties go to the smaller id
    qv[:5] = tv[40]
    tv[50], qv[6] = 1e160, 1e160  # their squares overflow, their distance is 0
    tv[60] = np.nan
    ids = rng.permutation(2000)
    t = pd.DataFrame({"tid": ids, "tv": list(tv), "tp": 0.0, "label": ids % 3})
    q = pd.DataFrame({"qid": np.arange(1500), "qv": list(qv), "p": 0.0, "r": np.inf, "r2": np.inf})
    tracemalloc.start()
    out = neighbors._tile_top_k(5, True)(q, t)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # three arrays of all pairs are 72 MB
    for i in [*range(10), 700, 1499]:
        d2 = np.zeros(len(tv))
        for j in range(8):
            d2 += (qv[i, j] - tv[:, j]) ** 2
        order = np.lexsort((ids, d2))[:5]
        order = order[np.isfinite(d2[order])]
        own = out[out["qid"] == i]
        assert own["tid"].tolist() == ids[order].tolist() and own["d2"].tolist() == d2[order].tolist()
        assert own["label"].tolist() == (ids[order] % 3).tolist()


def test_a_query_reaches_a_tile_of_cells_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 16))  # nothing to prune: every query asks nearly every cell
    df = vectors(spark, x, np.zeros(400))
    index = pivots.build(df, "v", "id", "label")
    assert len(index.pivots) == 20 and index.tile.max() == 0
    pdf = pd.DataFrame({"qid": range(50), "qv": list(x[:50]), "qgrp": -1, "radius": np.inf})
    at, cells = np.repeat(np.arange(50), 20), np.tile(np.arange(20), 50).astype(np.int32)
    sent = pd.concat(pivots._by_tile(pdf, at, cells, index.pivots, index.tile))
    assert sent["qid"].tolist() == list(range(50)) and all(len(c) == 20 for c in sent["cells"])
    monkeypatch.setattr(pivots, "TILE", 64)
    assert np.bincount(pivots._grouped(index.pivots, index.size), index.size).max() <= max(64, index.size.max())
    measured = []
    monkeypatch.setattr(pivots, "_distance", lambda a, b: measured.append(len(a)) or ((a - b) ** 2).sum(1))
    points = pd.DataFrame({"tid": range(400), "tv": list(x), "label": 0, "grp": -1, "cell": 0, "dp": np.linalg.norm(x, axis=1)})
    asked = pdf.assign(cells=[np.array([0])] * 50, dqs=[np.array([np.linalg.norm(v)]) for v in x[:50]])
    rows, cols, d2, looked = pivots._nearest(points, asked, 5)
    assert looked.tolist() == [400] * 50 and sum(measured) < 50 * 8  # of 20,000 pairs few are measured by coordinate
    for q in range(50):
        want = nearest(x, range(400), x[q], 5, lambda t: False)
        assert cols[rows == q].tolist() == [t for _, t in want] and np.allclose(d2[rows == q], [d for d, _ in want])

"""The vector search against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from torqueframe.llm import vectorscan


def rows_of(spark, rows, kind=FloatType()):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(kind)),
                         StructField("list", StringType()), StructField("rows", IntegerType())])
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "clash", 1)
                                  for i, v in rows], schema)


def valid(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def exact(rows, every, k, kind=np.float32):
    """Per query row (id, place) its k nearest (id, score), as a plain loop finds them."""
    own = [(i, np.asarray(v, kind).astype(float)) for i, v in rows if valid(v)]
    out = []
    for at, (qid, q) in enumerate(own):
        if qid is None or qid % every:
            continue
        near = [(float(np.sqrt(((q - x) ** 2).sum())), i) for n, (i, x) in enumerate(own) if n != at and len(x) == len(q)]
        near.sort(key=lambda t: (t[0], t[1] is None, t[1] or 0))
        out.append((qid, near[:k]))
    return out


def search(spark, rows, kind=FloatType(), every=10, k=10, **kw):
    index = vectorscan.build(rows_of(spark, rows, kind), k=k, **kw)
    found = vectorscan.search(index, vectorscan.member_queries(index, every), k).collect()
    by = defaultdict(list)
    for r in found:
        by[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return index, {q: sorted(v) for q, v in by.items()}


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    x = np.where(rng.random((n, 1)) < 0.5, rng.standard_normal((n, dim)),
                 centres[rng.integers(12, size=n)] + 0.05 * rng.standard_normal((n, dim)))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("dim", [64, 13])
def test_recall_and_exact_scores(spark, monkeypatch, dim):
    monkeypatch.setattr(vectorscan, "CHUNK", 60)
    monkeypatch.setattr(vectorscan, "BATCH", 7)
    x = clustered(1500, dim, dim)
    rows = list(enumerate(x))
    index, got = search(spark, rows)
    want = exact(rows, 10, 10)
    assert index.probes[dim] < len(index.centroids[dim])
    hit = 0
    for q, near in want:
        own = got[q]
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [s for _, _, s in own] == sorted(s for _, _, s in own)
        true = {i: s for s, i in near}
        hit += sum(i in true for _, i, _ in own)
        x32 = x.astype(np.float32).astype(float)
        for _, i, s in own:
            assert i != q and s == pytest.approx(np.sqrt(((x32[i] - x32[q]) ** 2).sum()), rel=1e-14)
    assert hit >= 0.93 * sum(len(near) for _, near in want)


def test_all_lists_give_the_exact_answer(spark, monkeypatch):
    monkeypatch.setattr(vectorscan, "RISK", 1e-9)
    rows = list(enumerate(clustered(700, 24, 5)))
    rows += [(1000 + i, rows[i % 3][1]) for i in range(200)]  # copies: ties go to the smaller id
    _, got = search(spark, rows, target=1.0)
    # a target of 1 covers the rows that were tried; the others of their kind are covered here as well
    want = exact(rows, 10, 10)
    same = sum([i for _, i, _ in got[q]] == [i for _, i in near] for q, near in want)
    assert same >= 0.95 * len(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2]), (10, [1, 2]), (10, [1, 2]), (None, [1, 2.5]), (None, [1, 2]), (20, None), (30, []), (40, [0, 0]),
            (50, [nan, 1]), (60, [inf, 1]), (70, [None, 1]), (80, [1, 2, 3]), (90, [1, 2, 3.5]), (-100, [5, 5]),
            (7, [-0.0, 1]), (110, [3e38, -3e38])]
    _, got = search(spark, rows)
    flat = Counter((q, i, s) for q, v in got.items() for _, i, s in v)
    assert flat == Counter((q, i, s) for q, near in exact(rows, 10, 10) for s, i in near)
    assert [r for r, _, _ in got[0]] == list(range(1, 8))
    assert [i for _, i, _ in got[0]][:3] == [10, 10, None]
    assert [(i, round(s, 3)) for _, i, s in got[80]] == [(90, 0.5)]


def test_few_rows_in_the_probed_lists(spark, monkeypatch):
    monkeypatch.setattr(vectorscan, "probes", lambda chunks, centroids, counts, k, target: {d: 1 for d in centroids})
    rows = list(enumerate(clustered(300, 8, 1)))
    _, got = search(spark, rows, k=100)
    for q, near in exact(rows, 10, 100):
        assert len(got[q]) == 100


def test_many_copies_and_doubles(spark, monkeypatch):
    monkeypatch.setattr(vectorscan, "CHUNK", 50)
    v = [0.1] * 9
    rows = [(i, v) for i in range(400)] + [(1000 + i, x) for i, x in enumerate(clustered(200, 9, 2))]
    _, got = search(spark, rows, DoubleType(), every=100, k=5)
    assert got[0] == [(n, n, 0.0) for n in range(1, 6)]
    assert got[300] == [(n + 1, n, 0.0) for n in range(5)]


@pytest.mark.parametrize("rows", [[], [(100, [1.0, 2.0])], [(100, None)]])
def test_no_neighbours(spark, rows):
    assert search(spark, rows)[1] == {}


def test_quantiles():
    rng = np.random.default_rng(0)
    for dim, seen in [(64, 8), (64, 40), (20, 16), (9, 8)]:
        x = rng.standard_normal((200_000, dim)) ** 2
        share = x[:, :seen].sum(1) / x.sum(1)
        assert np.mean(share > vectorscan.passing(dim, seen, 0.01)) == pytest.approx(0.01, abs=0.002)


def test_rotation():
    r = vectorscan.rotation(33)
    assert np.allclose(r @ r.T, np.eye(33)) and (r == vectorscan.rotation(33)).all()

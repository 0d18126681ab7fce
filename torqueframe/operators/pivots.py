"""Exact nearest neighbours with a pivot index.

Training points lie in cells, each around its nearest pivot and between the least
and the largest distance from it. For a query at distance d from a pivot, the
triangle inequality puts every point of the cell at least ``d - outer`` and
``inner - d`` away, and since the pivot is the cell's nearest, at least half of d
less the distance to the query's own nearest pivot. A query searches its nearest
cells first, which gives it a radius, then only cells whose bound lies within
that, and in a cell only points whose distance from the pivot differs from its
own by no more. Small cells share a tile, which a query reaches once with its vector;
large ones and their queries are cut into tiles of bounded size. One search for the
largest k serves every smaller one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import lloyd
from .blocks import Blocks

MAX_PIVOTS = 1024
TILE = 2048  # points, and queries, that a task compares
PROBES = 1 << 14  # (query, cell) rows, each with the query's vector, that a task holds at a time
SLICE = 256  # queries of a tile whose distances are held at a time


@dataclass
class PivotIndex:
    rows: DataFrame      # tid, tv, label, grp, cell, dp
    pivots: np.ndarray
    size: np.ndarray     # per cell
    inner: np.ndarray
    outer: np.ndarray
    tile: np.ndarray     # of a cell
    kinds: dict


def _norms(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x ** 2).sum(1)[:, None] + (p ** 2).sum(1) - 2 * (x @ p.T), 0))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of row pairs, summed coordinate by coordinate."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += (a[:, j] - b[:, j]) ** 2
    return out


def build(train: DataFrame, vec: str, id_col: str, label: str | None = None, group: str | None = None,
          rounds: int = 4, seed: int = 0) -> PivotIndex:
    """Points without a vector are left out. ``group`` (a fold, for instance) is
    what a query can ask to be spared."""
    rows = train.where(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("tid"), F.col(vec).cast("array<double>").alias("tv"),
        (F.col(label) if label else F.lit(0)).alias("label"),
        (F.col(group).cast("int") if group else F.lit(-1)).alias("grp"))
    blocks = Blocks.of(rows, "tv").mapped(lambda b: b._replace(fold=np.zeros(len(b.y), dtype=np.int32)))
    try:
        n = rows.count()
        k = max(1, min(MAX_PIVOTS, math.ceil(math.sqrt(n))))
        start = lloyd.sampled(blocks, lloyd.SAMPLE, n, seed)
        if len(start):
            fit = lloyd.Fit(0, lloyd.spread_start(start, k, np.random.default_rng(seed)))
            pivots = lloyd.run(blocks, [fit], rounds)[0].centres
        else:
            pivots = np.zeros((1, 1))
    finally:
        blocks.done()

    def placed(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["tv"].to_numpy())
                d = _norms(x, pivots)
                cell = d.argmin(1)
                # as measured pair by pair, so that a query's distance compares with it
                own = np.sqrt(_distance(x, pivots[cell]))
                yield pdf.assign(cell=cell.astype(np.int32), dp=own)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    made = rows.mapInPandas(placed, f"tid {kinds['tid']}, tv array<double>, label {kinds['label']}, grp int, cell int, dp double")
    made = cut_lineage(made)
    cells = made.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("dp").alias("lo"), F.max("dp").alias("hi")).collect()
    size, inner, outer = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in cells:
        size[r["cell"]], inner[r["cell"]], outer[r["cell"]] = r["n"], r["lo"], r["hi"]
    return PivotIndex(made, pivots, size, inner, outer, _grouped(pivots, size), kinds)


def _grouped(pivots: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The tile of every cell: cells next to each other on the axis of the pivots' largest
    spread share one as long as they have at most ``TILE`` points together."""
    axis = np.linalg.svd(np.nan_to_num(pivots - pivots.mean(0)), full_matrices=False)[2][0]
    tile, held, out = 0, 0, np.zeros(len(size), dtype=np.int32)
    for cell in np.argsort(np.nan_to_num(pivots @ axis), kind="stable"):
        if held and held + size[cell] > TILE:
            tile, held = tile + 1, 0
        out[cell], held = tile, held + size[cell]
    return out


def _nearest(points: pd.DataFrame, queries: pd.DataFrame, k: int):
    """Positions of the queries and points of a tile that are among the k nearest, their
    squared distances, and how many points each query looked at.

    A matrix product gives every distance to within a rounding bound; pairs that it does not
    put behind the radius or behind k others are measured coordinate by coordinate, and
    those alone are ordered."""
    x, dp = np.stack(points["tv"].to_numpy()), points["dp"].to_numpy()
    grp, tid = points["grp"].to_numpy(), points["tid"].to_numpy()
    cells, cell_of = np.unique(points["cell"].to_numpy(), return_inverse=True)
    qv, qgrp = np.stack(queries["qv"].to_numpy()), queries["qgrp"].to_numpy()
    radius = queries["radius"].to_numpy() * (1 + 1e-9) + 1e-9
    asked, from_pivot = queries["cells"].to_numpy(), queries["dqs"].to_numpy()
    square = np.einsum("ij,ij->i", x, x)
    most = square[np.isfinite(square)].max(initial=0.0)
    found, looked = [], []
    for at in range(0, len(qv), SLICE):
        own, r = qv[at:at + SLICE], radius[at:at + SLICE]
        row = np.repeat(np.arange(len(own)), [len(c) for c in asked[at:at + SLICE]])
        cell, d = np.concatenate(asked[at:at + SLICE]), np.concatenate(from_pivot[at:at + SLICE])
        place = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
        here = cells[place] == cell
        dq = np.full((len(own), len(cells)), np.nan)  # of cells that a query does not ask
        dq[row[here], place[here]] = d[here]
        near = np.abs(dq[:, cell_of] - dp) <= r[:, None]
        near &= (grp != qgrp[at:at + SLICE, None]) | (qgrp[at:at + SLICE, None] < 0)
        looked.append(near.sum(1))
        norm = np.einsum("ij,ij->i", own, own)
        about = norm[:, None] + square - 2 * (own @ x.T)
        unsure = ~np.isfinite(about)  # an overflow says nothing of the distance
        about[unsure | ~near] = np.inf
        slack = 8 * (x.shape[1] + 8) * np.finfo(float).eps * (norm + most)
        limit = r * r
        many = np.flatnonzero((about <= (limit + slack)[:, None]).sum(1) > k)
        if len(many):
            limit[many] = np.minimum(limit[many], np.partition(about[many], k - 1, axis=1)[:, k - 1])
        limit += slack
        limit[~np.isfinite(limit)] = np.inf
        rows, cols = np.nonzero(near & (unsure | (about <= limit[:, None])))
        d2 = np.zeros(len(rows))
        for lo in range(0, len(rows), PROBES):
            d2[lo:lo + PROBES] = _distance(own[rows[lo:lo + PROBES]], x[cols[lo:lo + PROBES]])
        keep = np.sqrt(d2) <= r[rows]
        rows, cols, d2 = rows[keep], cols[keep], d2[keep]
        order = np.lexsort((tid[cols], d2, rows))
        rows, cols, d2 = rows[order], cols[order], d2[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        found.append((at + rows[first], cols[first], d2[first]))
    return *(np.concatenate(c) for c in zip(*found)), np.concatenate(looked)


def _tiles(index: PivotIndex, asked: DataFrame, load: DataFrame, k: int) -> DataFrame:
    """The k nearest points of every (query, tile) of ``asked``, cut by ``load``, the queries
    of each tile; a row without a point carries the number of points that were looked at."""
    spark = index.rows.sparkSession
    points = np.bincount(index.tile, index.size, index.tile.max() + 1)
    parts = np.maximum(1, np.ceil(points / TILE)).astype(np.int32)
    of_cell = spark.createDataFrame(pa.table({"cell": np.arange(len(index.tile), dtype=np.int32), "tile": index.tile,
                                              "parts": parts[index.tile]}))
    load = cut_lineage(load.select("tile", F.ceil(F.col("n") / TILE).cast("int").alias("batches")).join(
        of_cell.select("tile", "parts").distinct(), "tile"))
    own = index.rows.join(F.broadcast(of_cell.select("cell", "tile")), "cell").join(F.broadcast(load), "tile").withColumn(
        "part", F.pmod(F.xxhash64("tid"), F.col("parts")).cast("int")).withColumn(
        "batch", F.explode(F.expr("sequence(0, batches - 1)"))).drop("parts", "batches")
    ask = asked.join(F.broadcast(load), "tile").withColumn("batch", F.pmod(F.xxhash64("qid"), F.col("batches")).cast("int")).withColumn(
        "part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts", "batches")
    keys = ["tile", "part", "batch"]

    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({c: pd.array([], dtype=object) for c in ("qid", "tid", "label", "d2")})
        with np.errstate(all="ignore"):
            rows, cols, d2, looked = _nearest(points, queries, k)
        none, qid = np.full(len(queries), None, dtype=object), queries["qid"].to_numpy()
        return pd.DataFrame({"qid": np.concatenate([qid[rows], qid]), "d2": np.concatenate([d2, looked.astype(float)]),
                             **{c: pd.array([*points[c].to_numpy()[cols].tolist(), *none], dtype=object) for c in ("tid", "label")}})[
            ["qid", "tid", "label", "d2"]]

    kinds = {**index.kinds, "qid": dict(asked.dtypes)["qid"]}
    return own.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInPandas(
        run, f"qid {kinds['qid']}, tid {kinds['tid']}, label {kinds['label']}, d2 double")


def _asked(pdf: pd.DataFrame, at: np.ndarray, cells: np.ndarray, pivots: np.ndarray):
    """Rows ``at`` of the queries with the cell that each asks, a bounded number at
    a time: a batch of queries may ask every cell, each time with its vector."""
    for lo in range(0, len(at), PROBES):
        cell = cells[lo:lo + PROBES]
        out = pdf.iloc[at[lo:lo + PROBES]].copy()
        out["cell"] = cell
        out["dq"] = np.sqrt(_distance(np.stack(out["qv"].to_numpy()), pivots[cell]))
        yield out[["qid", "qv", "qgrp", "radius", "cell", "dq"]]


def _by_tile(pdf: pd.DataFrame, at: np.ndarray, cells: np.ndarray, pivots: np.ndarray, tile: np.ndarray):
    """``_asked`` with a row for each tile, which lists the cells asked there."""
    order = np.lexsort((cells, tile[cells], at))
    at, cells, lo = at[order], cells[order], 0
    for piece in _asked(pdf, at, cells, pivots):
        own, there = at[lo:lo + len(piece)], tile[cells[lo:lo + len(piece)]]
        lo += len(piece)
        first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (there[1:] != there[:-1])])
        yield piece.iloc[first][["qid", "qv", "qgrp", "radius"]].assign(
            tile=there[first], cells=np.split(piece["cell"].to_numpy(), first[1:]), dqs=np.split(piece["dq"].to_numpy(), first[1:]))


def search(index: PivotIndex, queries: DataFrame, vec: str, id_col: str, k: int, group: str | None = None) -> DataFrame:
    """(qid, tid, label, d2, rank): the k nearest points of every query with a
    vector, ties to the smaller id; points of the query's own group are passed
    over. A row of null ``tid`` tells how many distances a query took (``d2``)."""
    pivots, size, inner, outer, tile = index.pivots, index.size, index.inner, index.outer, index.tile
    q = queries.where(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("qid"), F.col(vec).cast("array<double>").alias("qv"),
        (F.col(group).cast("int") if group else F.lit(-1)).alias("qgrp"))
    qid = dict(q.dtypes)["qid"]
    spare = 2 if group is None else 4  # how many times k the first cells hold

    def first_cells(d: np.ndarray) -> np.ndarray:
        order = np.argsort(d, kind="stable")
        order = order[size[order] > 0]
        return order[:np.searchsorted(np.cumsum(size[order]), spare * k) + 1]

    def probe(first: bool, bare: bool = False):
        """The tiles that each query asks; ``bare`` names them without the queries."""
        def run(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                d = _norms(np.stack(pdf["qv"].to_numpy()), pivots)
                at, cells = [], []
                for i in range(len(pdf)):
                    own = first_cells(d[i])
                    if not first:
                        r = pdf["radius"].iloc[i] * (1 + 1e-9) + 1e-9
                        least = np.maximum.reduce([d[i] - outer, inner - d[i], (d[i] - d[i].min()) / 2])
                        own = np.setdiff1d(np.flatnonzero((size > 0) & (least <= r)), own)
                    at.append(np.full(len(own), i))
                    cells.append(own)
                at, cells = np.concatenate(at), np.concatenate(cells).astype(np.int32)
                if bare:
                    asked = np.unique(at.astype(np.int64) * (tile.max() + 1) + tile[cells]) % (tile.max() + 1)
                    number, n = np.unique(asked, return_counts=True)
                    yield pd.DataFrame({"tile": number.astype(np.int32), "n": n})
                else:
                    yield from _by_tile(pdf, at, cells, pivots, tile)
        return run

    schema = f"qid {qid}, qv array<double>, qgrp int, radius double, tile int, cells array<int>, dqs array<double>"

    def found(asking: DataFrame, first: bool) -> DataFrame:
        load = asking.mapInPandas(probe(first, bare=True), "tile int, n long").groupBy("tile").agg(F.sum("n").alias("n"))
        return _tiles(index, asking.mapInPandas(probe(first), schema), load, k)

    w = Window.partitionBy("qid").orderBy("d2", "tid")

    def best(rows: DataFrame) -> DataFrame:
        points = rows.where("tid is not null").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        looked = rows.where("tid is null").groupBy("qid", "tid", "label").agg(F.sum("d2").alias("d2"))
        return points.unionByName(looked.withColumn("rank", F.lit(0)))

    start = q.withColumn("radius", F.lit(float("inf"))).select("qid", "qv", "qgrp", "radius")
    near = cut_lineage(best(found(start, True)))
    radius = near.where(F.col("rank") == k).select("qid", F.sqrt("d2").alias("radius"))
    again = q.join(radius, "qid", "left").na.fill(float("inf"), ["radius"]).select("qid", "qv", "qgrp", "radius")
    more = found(again, False)
    return best(near.drop("rank").unionByName(more))


def predictions_by_k(found: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(qid, k, predicted): the majority label of the first k of ``search``, for
    every k; equal votes go to the smallest label."""
    labels = found.where("rank > 0").groupBy("qid").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "label"))), lambda x: x["label"].cast("double")).alias("labels"))
    wanted = [int(x) for x in ks]

    @F.pandas_udf("array<double>")
    def votes(rows: pd.Series) -> pd.Series:
        out = []
        for own in rows:
            own = np.asarray(own)
            names, code = np.unique(own, return_inverse=True)
            running = np.cumsum(code[:, None] == np.arange(len(names)), axis=0)
            out.append([float(names[running[min(k, len(own)) - 1].argmax()]) for k in wanted])
        return pd.Series(out)

    each = F.arrays_zip(F.array(*[F.lit(k) for k in wanted]).alias("k"), votes("labels").alias("predicted"))
    return labels.select("qid", F.explode(each).alias("v")).select("qid", "v.k", "v.predicted")


def knn_grid(train: DataFrame, vec: str, id_col: str, label: str, fold: str = "fold",
             ks: Sequence[int] = tuple(range(1, 50))) -> DataFrame:
    """(k, score): mean accuracy over the folds of a vote of the k nearest points of
    the other folds, for every k from one search of the largest."""
    index = build(train, vec, id_col, label, fold)
    told = predictions_by_k(search(index, train, vec, id_col, max(ks), fold), ks)
    truth = train.select(F.col(id_col).alias("qid"), F.col(label).cast("double").alias("_truth"), F.col(fold).alias("fold"))
    hit = told.join(truth, "qid").groupBy("fold", "k").agg(
        F.avg((F.col("predicted") == F.col("_truth")).cast("double")).alias("a"))
    return hit.groupBy("k").agg(F.avg("a").alias("score"))


def measured(found: DataFrame) -> Column:
    """How many distances a search took, as an aggregate over its result."""
    return F.sum(F.when(F.col("tid").isNull(), F.col("d2")))

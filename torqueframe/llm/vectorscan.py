"""Approximate nearest neighbours by an adaptive dimension scan.

An inverted-file index: vectors belong to the list of their nearest centroid.
They are rotated by one random orthogonal matrix and stored in chunks, column
block by column block (``BLOCK_DIMS`` components of all vectors of a chunk are one
piece of memory). A query scans its nearest lists block by block. After a block
of d of D components, the partial squared distance of a vector at distance r is
r^2 times a Beta(d/2, (D-d)/2) variable, whatever the data, since the rotation is
random. So a candidate whose partial distance passes that law's upper quantile
for the query's bound is abandoned: the hypothesis that it is near enough is
rejected at a level of ``RISK``, shared among the blocks. The bound of a query is
its k-th distance in its first lists, found by a scan of these alone. Survivors
are measured exactly, in double precision, on the original vectors.

The centroids are fitted on a sample of at most ``SAMPLE_VALUES`` components (2^24;
every row is indexed). The number of lists to probe is read off the exact
neighbours of about ``TRIED`` rows of the table, found by a scan of all of it: the
least number that covers ``target`` of them. A query with fewer than k rows in
those lists scans all others too.

A list is cut into chunks of about ``CHUNK`` rows, and the queries of a list into
batches: a task sees one chunk and one batch, however large the list. Nulls,
zero vectors, and vectors that hold a null or a non-finite component take no
part; vectors are compared with those of equal length. Repeated rows are rows of
their own; a row is never its own neighbour, but a copy of it may be. Null ids
are found but ask nothing. An empty table gives no rows. Other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

import math
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BLOCK_DIMS = 8
CHUNK = 2048             # rows of a chunk, on average
BATCH = 4096             # queries that meet a chunk in one task, on average
PAIRS = 1 << 18          # partial distances held at a time
SAMPLE_VALUES = 1 << 24  # components in the sample that centroids are fitted on
MAX_LISTS = 4096
TRIED = 256              # rows whose exact neighbours tell how many lists to probe
RISK = 0.001             # chance that a true neighbour fails any of its tests
ROUNDS = 10              # of Lloyd's algorithm


class Index(NamedTuple):
    """``chunks`` (dim, list, part, rows, ids, no_id, blocks, vectors), ``lists``
    (dim, list, parts, rows), and per dimension the centroids and probes."""
    chunks: DataFrame
    lists: DataFrame
    centroids: dict[int, np.ndarray]
    probes: dict[int, int]


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=64)
def passing(dim: int, seen: int, level: float) -> float:
    """The share of a squared distance that ``seen`` of ``dim`` rotated
    components exceed with probability ``level``: a Beta quantile, by numeric
    integration over the angle whose squared sine is the share."""
    if seen >= dim:
        return 1.0
    t = np.linspace(0, np.pi / 2, 20_001)[1:-1]
    log = (seen - 1) * np.log(np.sin(t)) + (dim - seen - 1) * np.log(np.cos(t))
    cdf = np.cumsum(np.exp(log - log.max()))
    at = min(np.searchsorted(cdf, cdf[-1] * (1 - level)) + 1, len(t) - 1)
    return float(np.sin(t[at]) ** 2)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids, less each row's own norm."""
    return (centroids ** 2).sum(1) - 2 * (x @ centroids.T)


def _stepped(x: np.ndarray, most: int):
    """Slices of ``x`` such that ``most`` values a row stay within PAIRS."""
    step = max(1, PAIRS // max(1, most))
    for at in range(0, len(x), step):
        yield slice(at, at + step)


def lloyd(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centroids of ``x`` by Lloyd's algorithm; an empty cluster keeps its own."""
    c = x[np.sort(np.random.default_rng(seed).choice(len(x), k, replace=False))].copy()
    for _ in range(ROUNDS if k > 1 else 1):
        sums, counts = np.zeros_like(c), np.zeros(k)
        for s in _stepped(x, k):
            own = _nearest(x[s], c).argmin(1)
            np.add.at(sums, own, x[s])
            counts += np.bincount(own, minlength=k)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


def taking_part(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, vec) of the vectors that take part."""
    kind = "float" if dict(rows.dtypes)[vec_col] == "array<float>" else "double"
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind}>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)).select(
        "vec_id", F.size("vec").alias("dim"), "vec")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def fit(rows: DataFrame, counts: dict[int, int]) -> dict[int, np.ndarray]:
    """Centroids by dimension, each fitted in a task of its own on a sample of
    the rows of ``taking_part``, of which there are ``counts``."""
    rate = F.lit(0.0)
    for dim, n in counts.items():
        rate = F.when(F.col("dim") == dim, min(1.0, SAMPLE_VALUES / dim / n)).otherwise(rate)
    chance = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.select("dim", "vec", chance.alias("_c")).where(F.col("_c") < rate)

    def one(own: pa.Table) -> pa.Table:
        dim = own["dim"][0].as_py()
        x = _matrix(own["vec"], dim).astype(np.float64)
        k = max(1, min(MAX_LISTS, math.ceil(math.sqrt(counts[dim])), len(x) // 8))
        return pa.table({"dim": pa.array([dim], pa.int32()), "lists": pa.array([k], pa.int32()),
                         "centroids": pa.array([lloyd(x, k).tobytes()], pa.binary())})

    fitted = sample.groupBy("dim").applyInArrow(one, "dim int, lists int, centroids binary").collect()
    return {r["dim"]: np.frombuffer(r["centroids"], dtype=np.float64).reshape(r["lists"], r["dim"]) for r in fitted}


def assigned(rows: DataFrame, centroids: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with the list of the nearest centroid."""
    def run(batches):
        for batch in batches:
            lists = np.zeros(batch.num_rows, dtype=np.int32)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = _matrix(batch.column("vec").take(pa.array(at)), int(dim)).astype(np.float64)
                c = centroids.get(int(dim))  # a rare dimension may have no sampled row: one list
                if c is not None:
                    lists[at] = np.concatenate([_nearest(x[s], c).argmin(1) for s in _stepped(x, len(c))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists)], names=["vec_id", "dim", "vec", "list"])

    kind = dict(rows.dtypes)["vec"]
    return rows.select("vec_id", "dim", "vec").mapInArrow(run, f"vec_id long, dim int, vec {kind}, list int")


CHUNKS = ("dim int, list int, part int, rows int, ids binary, no_id array<int>, blocks array<binary>, vectors binary")


def _chunk(own: pa.Table) -> pa.Table:
    dim = own["dim"][0].as_py()
    x = _matrix(own["vec"], dim)
    turned = (x.astype(np.float64) @ rotation(dim)).astype(x.dtype)
    blocks = [np.ascontiguousarray(turned[:, a:a + BLOCK_DIMS].T).tobytes() for a in range(0, dim, BLOCK_DIMS)]
    ids = own["vec_id"].combine_chunks()
    return pa.table({
        **{c: pa.array([own[c][0].as_py()], pa.int32()) for c in ("dim", "list", "part")},
        "rows": pa.array([len(x)], pa.int32()), "ids": pa.array([ids.fill_null(0).to_numpy().tobytes()], pa.binary()),
        "no_id": pa.array([np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)).tolist()], pa.list_(pa.int32())),
        "blocks": pa.array([blocks], pa.list_(pa.binary())), "vectors": pa.array([x.tobytes()], pa.binary())})


def build(rows: DataFrame, k: int = 10, target: float = 0.96, id_col: str = "vec_id",
          vec_col: str = "embedding") -> Index:
    """An index of all vectors that take part, for searches of ``k`` neighbours."""
    rows = taking_part(rows, id_col, vec_col)
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    centroids = fit(rows, counts)
    placed = written(assigned(rows, centroids), "vectors-assigned")
    lists = placed.groupBy("dim", "list").agg(F.count(F.lit(1)).alias("rows"))
    lists = written(lists.withColumn("parts", F.ceil(F.col("rows") / CHUNK).cast("int")), "vectors-lists")
    dealt = placed.withColumn("_row", F.monotonically_increasing_id()).join(
        lists.drop("rows"), ["dim", "list"]).withColumn("part", F.pmod(F.xxhash64("_row"), F.col("parts")).cast("int"))
    chunks = written(dealt.drop("_row", "parts").groupBy("dim", "list", "part").applyInArrow(_chunk, CHUNKS),
                     "vectors-chunks")
    return Index(chunks, lists, centroids, probes(chunks, centroids, counts, k, target))


def _kind(vectors: bytes, rows: int, dim: int):
    return np.float32 if len(vectors) == 4 * rows * dim else np.float64


def _member_rows(chunks: DataFrame, chosen) -> DataFrame:
    """Rows of the index as queries: those that ``chosen(ids, no_id, list, part)``
    marks in a chunk."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], dtype=np.int64)
                x = np.frombuffer(r["vectors"], _kind(r["vectors"], r["rows"], r["dim"])).reshape(r["rows"], r["dim"])
                for at in np.flatnonzero(chosen(ids, r["no_id"], r["list"], r["part"])).tolist():
                    out.append({"query_id": int(ids[at]), "dim": r["dim"], "own_list": r["list"], "own_part": r["part"],
                                "own_pos": at, "vec": x[at].astype(np.float64).tobytes()})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_QUERY)

    return chunks.select("dim", "list", "part", "rows", "ids", "no_id", "vectors").mapInArrow(run, _QUERY_DDL)


_QUERY_DDL = "query_id long, dim int, own_list int, own_part int, own_pos int, vec binary"
_QUERY = pa.schema([("query_id", pa.int64()), ("dim", pa.int32()), ("own_list", pa.int32()), ("own_part", pa.int32()),
                    ("own_pos", pa.int32()), ("vec", pa.binary())])


def member_queries(index: Index, every: int = 100) -> DataFrame:
    """As queries, the indexed rows whose id ``every`` divides."""
    def chosen(ids, no_id, lst, part):
        mark = ids % every == 0
        mark[no_id] = False
        return mark

    return written(_member_rows(index.chunks, chosen).withColumn("qid", F.monotonically_increasing_id()), "vector-queries")


def probes(chunks: DataFrame, centroids: dict[int, np.ndarray], counts: dict[int, int], k: int,
           target: float) -> dict[int, int]:
    """By dimension, the least number of nearest lists that hold ``target`` of the
    k exact neighbours of about TRIED rows."""
    rates = {dim: min(1.0, TRIED / n) for dim, n in counts.items()}

    def tried(dim):
        def chosen(ids, no_id, lst, part):
            return np.random.default_rng([dim, lst, part]).random(len(ids)) < rates[dim]
        return chosen

    out = {}
    for dim, c in centroids.items():
        own = _member_rows(chunks.where(F.col("dim") == dim), tried(dim)).collect()
        if len(c) == 1 or not own:
            out[dim] = len(c)
            continue
        q = np.stack([np.frombuffer(r["vec"]) for r in own])

        def run(batches, dim=dim, q=q):
            best_d = np.full((len(q), k + 1), np.inf)
            best_l = np.full((len(q), k + 1), -1)
            for batch in batches:
                for r in batch.to_pylist():
                    x = np.frombuffer(r["vectors"], _kind(r["vectors"], r["rows"], dim)).reshape(-1, dim).astype(np.float64)
                    d = np.maximum((q ** 2).sum(1)[:, None] + (x ** 2).sum(1) - 2 * (q @ x.T), 0)
                    d = np.concatenate([best_d, np.sort(d, axis=1)[:, :k + 1]], axis=1)
                    lists = np.concatenate([best_l, np.full((len(q), d.shape[1] - k - 1), r["list"])], axis=1)
                    order = np.argsort(d, axis=1, kind="stable")[:, :k + 1]
                    best_d, best_l = np.take_along_axis(d, order, 1), np.take_along_axis(lists, order, 1)
            i, j = np.nonzero(best_l >= 0)
            yield pa.RecordBatch.from_pydict({"q": pa.array(i, pa.int32()), "list": pa.array(best_l[i, j], pa.int32()),
                                              "d": pa.array(best_d[i, j], pa.float64())})

        found = chunks.where(F.col("dim") == dim).select("list", "rows", "vectors").mapInArrow(
            run, "q int, list int, d double")
        w = Window.partitionBy("q").orderBy("d", "list")
        found = found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1).select("q", "list", "d").collect()
        # the row itself is its own nearest; it says nothing of the others
        nth = np.argsort(np.argsort(_nearest(q, c), axis=1, kind="stable"), axis=1)
        by_q: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["q"], r["d"])):
            by_q.setdefault(r["q"], []).append(nth[r["q"], r["list"]])
        ranks = np.sort([x for own_ranks in by_q.values() for x in own_ranks[1:]])
        out[dim] = int(ranks[max(0, math.ceil(target * len(ranks)) - 1)]) + 1 if len(ranks) else len(c)
    return out


class _Tested:
    """One chunk, scanned for batches of queries."""

    def __init__(self, row):
        self.dim, self.rows = int(row["dim"]), int(row["rows"])
        kind = _kind(row["vectors"], self.rows, self.dim)
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.no_id = np.zeros(self.rows, dtype=bool)
        self.no_id[list(row["no_id"])] = True
        self.blocks = [np.frombuffer(b, kind).reshape(-1, self.rows).astype(np.float64) for b in row["blocks"]]
        self.x = np.frombuffer(row["vectors"], kind).reshape(self.rows, self.dim)
        self.reach = max(math.sqrt(float(sum((b ** 2).sum(0) for b in self.blocks).max())), 0.0)
        seen = np.cumsum([len(b) for b in self.blocks])
        level = RISK / max(1, len(seen) - 1)
        self.share = [math.sqrt(passing(self.dim, int(s), level)) for s in seen]

    def scan(self, q: np.ndarray, bound: np.ndarray, own: np.ndarray, k: int):
        """(query, position, distance) of up to k rows for each of ``q`` that the
        tests leave; ``own`` is a query's own position here or -1."""
        turned = q @ rotation(self.dim)
        # stored components are rounded: what that may change is added to a bound
        slack = 1e-6 * (np.sqrt((q ** 2).sum(1)) + self.reach)
        at, i, j, p = 0, None, None, np.zeros((len(q), self.rows))
        for b, share in zip(self.blocks, self.share):
            part = turned[:, at:at + len(b)]
            limit = (bound * share + slack) ** 2
            if i is None:  # all pairs, until most are abandoned
                p += (part ** 2).sum(1)[:, None] + (b ** 2).sum(0) - 2 * (part @ b)
                left = ~(p > limit[:, None])
                if left.sum() * 4 < left.size:
                    i, j = np.nonzero(left)
                    p = p[i, j]
            else:
                p = p + ((part[i] - b.T[j]) ** 2).sum(1)
                left = ~(p > limit[i])
                i, j, p = i[left], j[left], p[left]
            at += len(b)
        if i is None:
            p[np.arange(len(q))[own >= 0], own[own >= 0]] = np.inf
            if self.rows > k:  # no bound yet: the k nearest here are one
                kth = np.sqrt(np.maximum(np.partition(p, k - 1, axis=1)[:, k - 1], 0))
                left &= ~(p > ((kth + slack) ** 2)[:, None])
            i, j = np.nonzero(left)
        other = j != own[i]
        i, j = i[other], j[other]
        d = np.empty(len(i))
        for s in _stepped(i, self.dim):
            d[s] = np.sqrt(((q[i[s]] - self.x[j[s]].astype(np.float64)) ** 2).sum(1))
        order = np.lexsort((j, self.ids[j], self.no_id[j], d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.searchsorted(i, i, side="left")
        near = np.arange(len(i)) - first < k
        return i[near], j[near], d[near]


FOUND = "qid long, list int, part int, pos int, vec_id long, score double"


def scanned(index: Index, queries: DataFrame, first: int, last: dict[int, int], k: int) -> DataFrame:
    """The k best of every chunk of the lists ``first`` to ``last`` (excluded) in
    the order of distance from a query, below its ``bound``."""
    centroids = index.centroids
    schema = pa.schema([("qid", pa.int64()), ("dim", pa.int32()), ("list", pa.int32()), ("own_list", pa.int32()),
                        ("own_part", pa.int32()), ("own_pos", pa.int32()), ("bound", pa.float64()), ("vec", pa.binary())])

    def probe(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                c = centroids.get(dim, np.zeros((1, dim)))
                for s in _stepped(np.empty(own.num_rows), max(len(c), dim)):
                    some = own.slice(s.start, s.stop - s.start)
                    q = np.stack([np.frombuffer(v) for v in some.column("vec").to_pylist()])
                    lists = np.argsort(_nearest(q, c), axis=1, kind="stable")[:, first:last.get(dim, 1)]
                    rows = some.take(pa.array(np.repeat(np.arange(len(q)), lists.shape[1])))
                    cols = [pa.array(lists.ravel(), pa.int32()) if f.name == "list" else rows.column(f.name)
                            for f in schema]
                    yield pa.RecordBatch.from_arrays(cols, schema=schema)

    asked = queries.select("qid", "dim", "own_list", "own_part", "own_pos", "bound", "vec").mapInArrow(
        probe, "qid long, dim int, list int, own_list int, own_part int, own_pos int, bound double, vec binary")
    load = asked.groupBy("dim", "list").agg(F.count(F.lit(1)).alias("_n")).join(index.lists, ["dim", "list"]).select(
        "dim", "list", "parts", F.ceil(F.col("_n") / BATCH).cast("int").alias("_batches"))
    load = written(load, "vector-load")
    asked = asked.join(load, ["dim", "list"]).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).withColumn(
        "batch", F.pmod(F.xxhash64("qid"), F.col("_batches")).cast("int")).drop("parts", "_batches")
    chunks = index.chunks.join(load.drop("parts"), ["dim", "list"]).withColumn(
        "batch", F.explode(F.expr("sequence(0, _batches - 1)"))).drop("_batches")
    keys = ["dim", "list", "part", "batch"]

    def run(chunk: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = {"qid": [], "list": [], "part": [], "pos": [], "vec_id": [], "score": []}
        if len(chunk) and len(own):
            row = chunk.iloc[0]
            tested = _Tested(row)
            for s in _stepped(np.empty(len(own)), max(tested.rows, tested.dim)):
                some = own.iloc[s]
                here = (some["own_list"] == row["list"]) & (some["own_part"] == row["part"])
                with np.errstate(all="ignore"):  # a square beyond a double is infinite: never abandoned
                    i, j, d = tested.scan(np.stack([np.frombuffer(v) for v in some["vec"]]),
                                          some["bound"].to_numpy(), np.where(here, some["own_pos"], -1), k)
                out["qid"].append(some["qid"].to_numpy()[i])
                out["pos"].append(j)
                out["score"].append(d)
            for c in ("qid", "pos", "score"):
                out[c] = np.concatenate(out[c])
            ids = pd.Series(tested.ids[out["pos"]], dtype="Int64")
            out.update(list=int(row["list"]), part=int(row["part"]), vec_id=ids.mask(tested.no_id[out["pos"]]))
        return pd.DataFrame(out)

    return chunks.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy("score", F.col("vec_id").asc_nulls_last(), "list", "part", "pos")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each of ``queries``."""
    lists = {dim: len(c) for dim, c in index.centroids.items()}
    seeds = max([math.ceil(math.sqrt(p)) for p in index.probes.values()], default=1)
    names = [c for c in FOUND.replace(",", "").split() if c not in ("long", "int", "double")]
    near = written(best(scanned(index, queries.withColumn("bound", F.lit(float("inf"))), 0,
                                {d: min(seeds, n) for d, n in lists.items()}, k), k), "vector-seeds")
    if any(p > seeds for p in index.probes.values()):
        bound = near.where(F.col("rank") == k).select("qid", F.col("score").alias("bound"))
        bounded = queries.join(bound, "qid", "left").na.fill(float("inf"), ["bound"])
        more = scanned(index, bounded, seeds, index.probes, k)
        near = written(best(near.select(*names).unionByName(more.select(*names)), k), "vector-near")
    full = near.where(F.col("rank") == k).select("qid")
    short = written(queries.join(full, "qid", "left_anti").withColumn("bound", F.lit(float("inf"))), "vector-short")
    if any(max(index.probes[d], seeds) < n for d, n in lists.items()) and not short.isEmpty():
        # too few rows in the probed lists of some dimension: all lists, again from the first of them
        again = scanned(index, short, 0, lists, k)
        kept = near.join(short.select("qid"), "qid", "left_anti")
        near = kept.select(*names).unionByName(again.select(*names))
        near = best(near, k)
    return near.join(queries.select("qid", "query_id"), "qid").select("query_id", F.col("rank").cast("int").alias("rank"),
                                                                      "vec_id", "score")

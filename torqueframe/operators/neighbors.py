"""Exact k-nearest-neighbour vote without comparing all pairs.

For any unit direction ``u``, ``|u·x − u·q| ≤ ‖x − q‖``. With ``p = u·x``
(here the coordinate of largest variance):

1. Train and query points are put in one global order of ``p`` (chunked
   scan); each query reads the 2k train points next to it in that order
   (an equi-join on positions) and takes the k-th smallest distance as a
   radius ``r`` — an upper bound of its true k-th neighbour distance.
2. Every true neighbour then has ``|p_x − p_q| ≤ r``: buckets of ``p``
   (each query exploded over the buckets its band touches) hold the only
   candidates that can qualify.
3. Each bucket is cut into tiles of at most about ``TILE_ROWS`` train and
   query rows (id-hash blocks, the number from the bucket's counts), so a
   hot bucket is spread over many groups. A tile computes exact distances
   in numpy (``applyInPandas`` on a cogroup) and emits only its k smallest
   (distance, id) per query; a window keeps the k smallest over all tiles,
   then a majority vote (ties to the smallest label).

When the train side fits in ``BRUTE_FORCE_TILES`` tiles (a size check),
steps 1–2 are skipped: one bucket, every query against every train point in
those tiles. On high-dimensional data with no structure the band prunes
nothing and this is also what the pruned path does, at a higher price.

The result is exact; the number of candidates follows the data, with no cap,
and no pair becomes a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import attach_per_group
from .ordered import running_sums


def _sqdist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def best_axis(df: DataFrame, vec: str) -> Column:
    """Index (0-based) of the coordinate with the largest variance, as a
    scalar subquery."""
    var = df.select(F.posexplode(F.col(vec)).alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("v"))
    return var.agg(F.max_by("i", "v")).scalar()


def knn_neighbours(train: DataFrame, queries: DataFrame, vec: str, id_col: str, k: int = 5,
                   label: str | None = None, prune: bool | None = None) -> DataFrame:
    """``(qid, tid, d2[, label])`` for the k nearest train points of every query.

    ``prune=None`` decides by a size check: when the train side fits in
    :data:`BRUTE_FORCE_TILES` tiles, every query meets every train point in
    those tiles (exact, a handful of stages); otherwise the band bound of the
    module docstring first narrows the buckets each query must visit."""
    # a null vector has no distance to anything: it is never a neighbour and
    # a query without one gets no neighbours
    t = train.filter(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("tid"), F.col(vec).cast("array<double>").alias("tv"),
        *([F.col(label).alias("label")] if label else []))
    q = queries.filter(F.col(vec).isNotNull()).select(
        F.col(id_col).alias("qid"), F.col(vec).cast("array<double>").alias("qv"))
    n_train = t.count() if prune is not True else None
    if prune is None:
        prune = n_train > BRUTE_FORCE_TILES * TILE_ROWS
    if not prune:
        # one bucket; its tile counts are known from the size checks
        inf = F.lit(float("inf"))
        n_tiles = (-(-max(n_train, 1) // TILE_ROWS), -(-max(q.count(), 1) // TILE_ROWS))
        qb = q.select("qid", "qv", F.lit(0.0).alias("p"), inf.alias("r"), inf.alias("r2"), F.lit(0).cast("long").alias("b"))
        tb = t.select("*", F.lit(0.0).alias("p"), F.lit(0).cast("long").alias("b"))
        return _tiled(qb, tb, k, label, n_tiles)
    axis = best_axis(t.select(F.col("tv").alias("v")), "v")
    # scalar subqueries are projected into columns before use in generators
    t = t.withColumn("_ax", axis + 1).withColumn("p", F.element_at("tv", F.col("_ax"))).drop("_ax")
    q = q.withColumn("_ax", axis + 1).withColumn("p", F.element_at("qv", F.col("_ax"))).drop("_ax")

    # 1. positions of train points in p order; each query's insertion position
    both = (t.select(F.lit(1).alias("is_train"), F.col("tid").alias("id"), "p")
            .unionByName(q.select(F.lit(0).alias("is_train"), F.col("qid").alias("id"), "p")))
    rng = both.agg(F.struct(F.min("p").alias("lo"), F.max("p").alias("hi"))).scalar()
    width = F.try_divide(rng["hi"] - rng["lo"], F.lit(4096.0))
    chunk = F.coalesce(F.floor(F.try_divide(F.col("p") - rng["lo"], width)), F.lit(0))
    ranked = running_sums(both, [], ["p", "is_train", "id"], ["is_train"], chunk=chunk, position=None)
    tpos = ranked.filter("is_train = 1").select(F.col("id").alias("tid"), F.col("cum_is_train").alias("pos"))
    qpos = ranked.filter("is_train = 0").select(F.col("id").alias("qid"), F.col("cum_is_train").alias("pos"))
    near = qpos.select("qid", F.explode(F.sequence(F.col("pos") - k + 1, F.col("pos") + k)).alias("pos"))
    seed = (near.join(tpos, "pos").join(t.select("tid", "tv"), "tid").join(q.select("qid", "qv"), "qid")
            .select("qid", _sqdist(F.col("qv"), F.col("tv")).alias("d2")))
    w = Window.partitionBy("qid").orderBy("d2")
    radius = (seed.select("qid", F.row_number().over(w).alias("rn"), "d2")
              .groupBy("qid").agg(F.max(F.when(F.col("rn") <= k, F.col("d2"))).alias("r2")))

    # 2. band join on p with buckets of the median radius
    qr = q.join(radius, "qid").withColumn("r", F.sqrt("r2"))
    def bucket_width() -> Column:
        # a fresh scalar subquery per use; the same subquery Column cannot be
        # shared by two DataFrames
        return F.greatest(qr.agg(F.percentile_approx("r", 0.5)).scalar(), F.lit(1e-9))
    qr = qr.withColumn("_bw", bucket_width())
    # the band is clamped to the buckets the train points span (no train
    # point lies outside), so an outlier query with a huge radius explodes
    # into at most that many rows
    tr = t.agg(F.struct(F.min("p").alias("lo"), F.max("p").alias("hi"))).scalar()
    qr = qr.withColumn("_tlo", tr["lo"]).withColumn("_thi", tr["hi"])
    b_lo = F.greatest(F.floor((F.col("p") - F.col("r")) / F.col("_bw")), F.floor(F.col("_tlo") / F.col("_bw")))
    b_hi = F.least(F.floor((F.col("p") + F.col("r")) / F.col("_bw")), F.floor(F.col("_thi") / F.col("_bw")))
    qb = (qr.filter(b_lo <= b_hi)
          .select("qid", "qv", "p", "r", "r2",
                  F.explode(F.sequence(b_lo.cast("long"), b_hi.cast("long"))).alias("b")))
    tb = t.withColumn("_bw", bucket_width()).withColumn("b", F.floor(F.col("p") / F.col("_bw")).cast("long")).drop("_bw")

    return _tiled(qb, tb, k, label)


def _tiled(qb: DataFrame, tb: DataFrame, k: int, label: str | None,
           n_tiles: tuple[int, int] | None = None) -> DataFrame:
    """Exact k nearest per query among the (query, train) pairs that share a
    bucket ``b``, evaluated tile by tile. ``n_tiles`` = (train blocks, query
    blocks) when there is a single bucket of known size."""
    # 3. tiles: a bucket is cut into ceil(n/TILE_ROWS) train blocks and as
    #    many query blocks (by id hash); each tile meets in one group, so no
    #    group exceeds about TILE_ROWS rows a side however hot the bucket.
    #    Only buckets with both train and query rows are kept.
    if n_tiles is None:
        counts = (tb.groupBy("b").agg(F.count(F.lit(1)).alias("_nt"))
                  .join(qb.groupBy("b").agg(F.count(F.lit(1)).alias("_nq")), "b")
                  .select("b", F.ceil(F.col("_nt") / TILE_ROWS).cast("int").alias("nt"),
                          F.ceil(F.col("_nq") / TILE_ROWS).cast("int").alias("nq")))
        counts = cut_lineage(counts)
        tb = attach_per_group(tb, counts, ["b"], bytes_per_group=24, materialized=True)
        qb = attach_per_group(qb, counts, ["b"], bytes_per_group=24, materialized=True)
    else:
        sizes = [F.lit(n_tiles[0]).alias("nt"), F.lit(n_tiles[1]).alias("nq")]
        tb, qb = tb.select("*", *sizes), qb.select("*", *sizes)
    tt = tb.select(
        "b", "tid", "tv", F.col("p").alias("tp"), *(["label"] if label else []),
        F.pmod(F.xxhash64("tid"), F.col("nt")).cast("int").alias("tblock"),
        F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qblock"))
    qq = qb.select(
        "b", "qid", "qv", "p", "r", "r2",
        F.pmod(F.xxhash64("qid"), F.col("nq")).cast("int").alias("qblock"),
        F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("tblock"))
    fields = {f.name: f.dataType.simpleString() for f in tt.schema.fields + qq.schema.fields}
    schema = f"qid {fields['qid']}, tid {fields['tid']}, d2 double" + (f", label {fields['label']}" if label else "")
    blk = ["b", "tblock", "qblock"]
    cand = qq.groupBy(*blk).cogroup(tt.groupBy(*blk)).applyInPandas(_tile_top_k(k, label is not None), schema)
    wk = Window.partitionBy("qid").orderBy("d2", "tid")
    return (cand.select("*", F.row_number().over(wk).alias("rn")).filter(F.col("rn") <= k)
            .drop("rn"))


TILE_ROWS = 2048
BRUTE_FORCE_TILES = 4
SLICE_ROWS = 256   # queries of a tile whose distances are held at a time


def _tile_top_k(k: int, with_label: bool):
    """The k smallest (d2, tid) per query of one tile among its pairs that pass the
    band and radius tests. A matrix product gives every distance to within a
    rounding bound; pairs that the bound does not put behind k others get their
    exact squared distance (summed over coordinates in order like the column
    expression), and those alone are ordered."""
    import numpy as np
    import pandas as pd

    names = ["qid", "tid", "d2"] + (["label"] if with_label else [])

    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({c: pd.Series(dtype="float64" if c == "d2" else "int64") for c in names})
        qv = np.stack(q["qv"].to_numpy()).astype("float64")
        tv = np.stack(t["tv"].to_numpy()).astype("float64")
        p, r, r2 = (q[c].to_numpy("float64") for c in ("p", "r", "r2"))
        tp, tid = t["tp"].to_numpy("float64"), t["tid"].to_numpy()
        with np.errstate(all="ignore"):
            t_norm = np.einsum("ij,ij->i", tv, tv)
            most = t_norm[np.isfinite(t_norm)].max(initial=0.0)
            found = []
            for at in range(0, len(qv), SLICE_ROWS):
                own = qv[at:at + SLICE_ROWS]
                near = np.abs(tp[None, :] - p[at:at + SLICE_ROWS, None]) <= r[at:at + SLICE_ROWS, None]
                norm = np.einsum("ij,ij->i", own, own)
                about = norm[:, None] + t_norm - 2 * (own @ tv.T)
                unsure = ~np.isfinite(about)  # an overflow says nothing of the distance
                about[unsure | ~near] = np.inf
                limit = (np.partition(about, k - 1, axis=1)[:, k - 1] if k < len(tv) else np.full(len(own), np.inf))
                limit = limit + 8 * (qv.shape[1] + 8) * np.finfo(float).eps * (norm + most)
                limit[~np.isfinite(limit)] = np.inf
                rows, cols = np.nonzero(near & (unsure | (about <= limit[:, None])))
                if 4 * len(rows) > about.size:  # equal or nearly equal distances: no pair is left out
                    d2 = np.zeros(about.shape)
                    for j in range(qv.shape[1]):
                        diff = own[:, j, None] - tv[None, :, j]
                        d2 += diff * diff
                    d2 = d2[rows, cols]
                else:
                    d2 = np.zeros(len(rows))
                    for j in range(qv.shape[1]):
                        diff = own[rows, j] - tv[cols, j]
                        d2 += diff * diff
                keep = np.isfinite(d2) & (d2 <= r2[at + rows])
                rows, cols, d2 = rows[keep], cols[keep], d2[keep]
                order = np.lexsort((tid[cols], d2, rows))
                rows, cols, d2 = rows[order], cols[order], d2[order]
                first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
                found.append((at + rows[first], cols[first], d2[first]))
        rows, cols, dist = (np.concatenate(c) for c in zip(*found))
        out = {"qid": q["qid"].to_numpy()[rows], "tid": tid[cols], "d2": dist}
        if with_label:
            out["label"] = t["label"].to_numpy()[cols]
        return pd.DataFrame(out)

    return run


def knn_vote(train: DataFrame, queries: DataFrame, vec: str, id_col: str, label: str, k: int = 5) -> DataFrame:
    """Majority label of the k nearest train points (ties → smallest label)."""
    nn = knn_neighbours(train, queries, vec, id_col, k, label)
    votes = nn.groupBy("qid", "label").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("qid").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "label"))["label"].alias("predicted_label")) \
        .withColumnRenamed("qid", id_col)

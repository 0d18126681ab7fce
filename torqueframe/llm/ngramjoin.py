"""Near-duplicate join on word n-grams: MinHash banding, then exact Jaccard.

Words are runs of digits, letters and other non-ASCII characters of the
lower-cased text; a text's set has its distinct runs of ``k`` words (one of all
its words if it has fewer). Texts with equal sets are one class from then on.
Rows per band and bands are chosen for a target recall at the threshold; band
hashes are shuffled, and classes that share one are candidates. Candidates that
hang together are verified on their full sets, in blocks of at most
``BLOCK_SETS`` sets and about ``BLOCK_SHINGLES`` n-grams, and only between
sizes that can reach the threshold; a block returns counts and a spanning
forest, not pairs. So links are exact for every candidate pair.

Null, empty and wordless texts have no n-grams, and no link. Repeated rows and
ids are rows of their own. An empty table has no rows. Other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import having_ids, release, without_ids, written
from .components import components

BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 20
TASK_SHINGLES = 1 << 22
_SIGNATURE = "rid long, doc_id long, fp1 long, fp2 long, n int, bands array<long>"
_SETS = "doc_id long, fp1 long, fp2 long, n int, shingles array<long>"


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """The least number of bands of ``rows`` rows that finds a pair at the
    threshold with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes per document and each document's first index."""
    words, _, _, at = T.word_hashes(data, offsets)
    sh, first = T.shingle_hashes(words, at, k)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((sh, doc))
    sh = sh[order]
    new = np.ones(len(sh), dtype=bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    return sh[new], np.searchsorted(doc[new], np.arange(len(first)))


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


def _prints(sh: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _sums(T.mix(sh), first), _sums(T.mix(sh ^ np.uint64(0x5DEECE66D5DEECE6)), first)


def band_hashes(sh: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Matrix of documents with n-grams by bands."""
    full = np.flatnonzero(np.diff(first))
    starts = first[:-1][full]
    factors = T.mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    out = np.zeros((len(full), bands), dtype=np.uint64)
    if len(full):
        for i, f in enumerate(factors):
            low = np.minimum.reduceat(sh * f, starts)
            out[:, i // rows] = T.mix(out[:, i // rows] + low + np.uint64(i))
    return out


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))


def signatures(docs: DataFrame, k: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    def signed(batches):
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, data, offsets in T.runs(batch.column(1), 1 << 18, lower=True):
                n = len(offsets) - 1
                sh, first = distinct_shingles(data, offsets, k)
                fp1, fp2 = _prints(sh, first)
                size = np.diff(first)
                band = band_hashes(sh, first, bands, rows)
                at = np.concatenate([[0], np.cumsum((size > 0) * bands)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rid, rid + n)), batch.column(0).slice(row, n), pa.array(fp1), pa.array(fp2),
                     pa.array(size.astype(np.int32)), _lists(band.ravel(), at)],
                    names=["rid", "doc_id", "fp1", "fp2", "n", "bands"])
                rid += n
        release()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(signed, _SIGNATURE)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """The sets of (doc_id, text) rows."""
    def sets(batches):
        for batch in batches:
            for row, data, offsets in T.runs(batch.column(1), lower=True):
                sh, first = distinct_shingles(data, offsets, k)
                fp1, fp2 = _prints(sh, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(fp1)), pa.array(fp1), pa.array(fp2),
                     pa.array(np.diff(first).astype(np.int32)), _lists(sh, first)],
                    names=["doc_id", "fp1", "fp2", "n", "shingles"])
        release()

    return docs.mapInArrow(sets, _SETS)


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every one of ``b``."""
    def columns(sets, kinds):
        size = [len(s) for s in sets]
        flat = np.concatenate(sets)
        at = np.searchsorted(kinds, flat)
        at[at == len(kinds)] = 0
        hit = kinds[at] == flat
        return np.repeat(np.arange(len(sets)), size)[hit], at[hit]

    kinds, seen = np.unique(np.concatenate([*a, *(b if b is not a else [])]), return_counts=True)
    kinds = kinds[seen > 1]
    out = np.zeros((len(a), len(b)), dtype=np.float64)
    if not len(kinds):
        return out
    ra, ca = columns(a, kinds)
    rb, cb = (ra, ca) if b is a else columns(b, kinds)
    step = 1 << 13
    for lo in range(0, len(kinds), step):
        def dense(rows, cols, n):
            m = np.zeros((n, min(step, len(kinds) - lo)), dtype=np.float32)
            own = (cols >= lo) & (cols < lo + step)
            m[rows[own], cols[own] - lo] = 1
            return m
        x = dense(ra, ca, len(a))
        out += x @ (x if b is a else dense(rb, cb, len(b))).T
    return out


def _verify(threshold: float):
    """Per task of blocks: (rep, links, root) of each set that has links."""
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        for key, task in pdf.groupby(["comp", "lo", "hi", "i", "j"], sort=False):
            task = task.drop_duplicates(["rep", "side"])
            one = key[1] == key[2] and key[3] == key[4]
            left = task if one else task[task["side"] == 0]
            right = left if one else task[task["side"] == 1]
            if not len(left) or not len(right) or (one and len(left) < 2):
                continue
            a = [np.asarray(s) for s in left["shingles"]]
            b = a if one else [np.asarray(s) for s in right["shingles"]]
            na, nb = left["n"].to_numpy(float), right["n"].to_numpy(float)
            both = overlaps(a, b)
            linked = both >= threshold * (na[:, None] + nb[None, :] - both) - 1e-9
            if one:
                np.fill_diagonal(linked, False)
            ca, cb = left["copies"].to_numpy(), right["copies"].to_numpy()
            reps = np.concatenate([left["rep"].to_numpy(), [] if one else right["rep"].to_numpy()]).astype(np.int64)
            links = np.concatenate([linked @ cb, [] if one else linked.T @ ca]).astype(np.int64)
            full = np.zeros((len(reps), len(reps)), dtype=bool) if not one else linked
            if not one:
                full[:len(a), len(a):] = linked
                full[len(a):, :len(a)] = linked.T
            root = np.full(len(reps), -1)
            for s in np.argsort(reps):
                if root[s] >= 0 or not links[s]:
                    continue
                front = np.zeros(len(reps), dtype=bool)
                front[s] = True
                while front.any():
                    root[front] = s
                    front = full[front].any(axis=0) & (root < 0)
            out += [(int(r), int(n), int(reps[t])) for r, n, t in zip(reps, links, root) if n]
        return pd.DataFrame(out, columns=["rep", "links", "root"]).astype("int64")
    return verify


def _blocks(members: DataFrame) -> DataFrame:
    """Rows (rep, comp, lo, hi, i, j, side): the block pairs that a set goes to."""
    units = members.groupBy("comp", "size_class").agg(F.count(F.lit(1)).alias("sets"))
    hold = F.greatest(F.lit(8), F.least(F.lit(BLOCK_SETS), F.floor(
        F.lit(float(BLOCK_SHINGLES)) / F.pow(F.lit(1.25), F.col("size_class") + 1))))
    units = units.withColumn("blocks", F.ceil(F.col("sets") / hold).cast("int"))
    up = units.select("comp", (F.col("size_class") - 1).alias("size_class"), F.col("blocks").alias("above"))
    down = units.select("comp", (F.col("size_class") + 1).alias("size_class"), F.col("blocks").alias("below"))
    units = units.join(up, ["comp", "size_class"], "left").join(down, ["comp", "size_class"], "left")
    rows = members.join(units, ["comp", "size_class"]).withColumn(
        "own", F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int"))
    c, every = F.col("size_class"), lambda n: F.sequence(F.lit(0), n - 1)
    none = F.array().cast("array<struct<lo:int,hi:int,i:int,j:int,side:int>>")
    row = lambda lo, hi, i, j, side: F.struct(lo.alias("lo"), hi.alias("hi"), i.alias("i"),
                                              j.alias("j"), side.alias("side"))
    within = F.transform(every(F.col("blocks")), lambda j: row(
        c, c, F.least("own", j), F.greatest("own", j), (F.col("own") > j).cast("int")))
    higher = F.when(F.col("above").isNull(), none).otherwise(F.transform(
        every(F.coalesce("above", F.lit(1))), lambda j: row(c, c + 1, F.col("own"), j, F.lit(0))))
    lower = F.when(F.col("below").isNull(), none).otherwise(F.transform(
        every(F.coalesce("below", F.lit(1))), lambda i: row(c - 1, c, i, F.col("own"), F.lit(1))))
    return rows.select("rep", "doc_id", "fp1", "fp2", "n", "copies", "comp",
                       F.explode(F.concat(within, higher, lower)).alias("b")).select("*", "b.*").drop("b")


def classes(docs: DataFrame, k: int = 5, threshold: float = 0.8, recall: float = 0.9999, rows: int = 5,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id that links lead
    to), copy_of (smallest doc_id with the same set), n_links (other documents
    at or over the threshold), n_shingles, and component (of the class: two
    classes have one class_id if ids repeat), fp1, fp2 and rid of the set and row."""
    bands = bands_for(threshold, recall, rows)
    signed = written(signatures(docs, k, bands, rows, id_col, text_col), "signatures")
    reps = written(signed.where("n > 0").groupBy("fp1", "fp2", "n").agg(
        F.min(F.struct("rid", "doc_id", "bands")).alias("r"), F.min("doc_id").alias("copy_of"),
        F.count(F.lit(1)).alias("copies")).select(
        F.col("r.rid").alias("rep"), "r.doc_id", "r.bands", "fp1", "fp2", "n", "copy_of", "copies"), "sets")
    keys = reps.select("rep", F.explode("bands").alias("band"))
    hubs = keys.groupBy("band").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    near = keys.join(hubs.select("band", "hub"), "band").where("rep <> hub")
    candidate = written(components(near.select(F.col("hub").alias("u"), F.col("rep").alias("v"))), "candidates")
    members = written(reps.drop("bands").join(
        candidate.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep").withColumn(
        "size_class", F.floor(F.log("n") / F.log(F.lit(1.25)) + 1e-9).cast("int")), "members")
    total = members.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, math.ceil(3 * total / TASK_SHINGLES), docs.sparkSession.sparkContext.defaultParallelism)
    texts = having_ids(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")),
                       members.select("doc_id"), "doc_id", null_too=True)
    sets = shingle_sets(texts, k)
    blocks = _blocks(members)
    same = (sets["doc_id"].eqNullSafe(blocks["doc_id"])) & (sets["fp1"] == blocks["fp1"]) & (
        sets["fp2"] == blocks["fp2"]) & (sets["n"] == blocks["n"])
    work = blocks.join(sets, same).select(
        blocks["rep"], blocks["n"], "copies", "comp", "lo", "hi", "i", "j", "side", "shingles").withColumn(
        "task", F.pmod(F.xxhash64("comp", "lo", "hi", "i", "j"), F.lit(tasks)))
    linked = written(work.groupBy("task").applyInPandas(_verify(threshold), "rep long, links long, root long"), "links")
    joined = components(linked.select(F.col("root").alias("u"), F.col("rep").alias("v")))
    comp = reps.select("rep", "copy_of").join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    named = written(comp, "classes")
    ids = named.groupBy("component").agg(F.min("copy_of").alias("class_id"))
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    info = reps.select("rep", "fp1", "fp2", "n", "copies", "copy_of").join(
        named.select("rep", "component"), "rep").join(ids, "component").join(links, "rep", "left").select(
        "fp1", "fp2", "n", "component", "class_id", "copy_of", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = signed.where("n > 0").join(info, ["fp1", "fp2", "n"]).select(
        "doc_id", "class_id", "copy_of", "n_links", F.col("n").alias("n_shingles"), "component", "fp1", "fp2", "rid")
    alone = signed.where("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(0).cast("long").alias("n_links"),
        F.col("n").alias("n_shingles"), F.col("rid").alias("component"), "fp1", "fp2", "rid")
    return out.unionByName(alone)


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row with the smallest
    doc_id, and every row without n-grams; all columns as they are."""
    found = written(classes(docs, id_col=id_col, text_col=text_col, **parameters), "near-classes")
    mark = F.col("n_shingles").eqNullSafe(F.lit(0)) | F.col("doc_id").eqNullSafe(F.col("class_id"))
    gone = found.where(~mark).select(F.col("doc_id").alias(id_col)).distinct()
    twice = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1 or doc_id is null")
    if twice.isEmpty():
        return without_ids(docs, gone, id_col)
    # an id with several rows does not tell them apart: their sets do
    first = found.where("n_shingles > 0").groupBy("component").agg(
        F.min(F.struct(mark.cast("int") * -1, "doc_id", "fp1", "fp2")).alias("r")).select("r.doc_id", "r.fp1", "r.fp2")
    prints = docs.withColumn("_set", _set_prints(F.col(text_col), parameters.get("k", 5)))
    match = prints[id_col].cast("long").eqNullSafe(first["doc_id"]) & (prints["_set.fp1"] == first["fp1"]) & (
        prints["_set.fp2"] == first["fp2"])
    kept = prints.where("_set.n > 0").join(first, match, "left_semi").withColumns(
        {"_fp1": F.col("_set.fp1"), "_fp2": F.col("_set.fp2")})
    kept = kept.dropDuplicates([id_col, "_fp1", "_fp2"]).drop("_set", "_fp1", "_fp2")
    return kept.unionByName(prints.where("_set.n = 0").drop("_set"))


def _set_prints(text, k: int):
    @F.arrow_udf("fp1 long, fp2 long, n int")
    def prints(t: pa.Array) -> pa.Array:
        parts = [[], [], []]
        for _, data, offsets in T.runs(t, lower=True):
            sh, first = distinct_shingles(data, offsets, k)
            for p, x in zip(parts, (*_prints(sh, first), np.diff(first))):
                p.append(x)
        cols = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
        return pa.StructArray.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2].astype(np.int32))], names=["fp1", "fp2", "n"])
    return prints(F.coalesce(text.cast("string"), F.lit("")))

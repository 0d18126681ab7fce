"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

Every row is a leaf. Per source the leaves stand in ascending doc_id; as long
as more than one node remains, every 16 consecutive ones become one parent. The
roots of the sources, in the order of the sources, are the leaves of a tree of
the same kind over them, whose root is the dataset's.

A parent hashes its children one after another and keeps a copy of the hash
state before each of them. To fold a changed child into the root, that state
resumes with the replacement and the siblings to the right; nothing to the left
is hashed again. Three levels make a block of at most 4096 nodes, which is one
group of a Spark job, so a hot source is spread over its blocks; each job turns
blocks into single nodes, and the few jobs run up the tree and down again. OpenSSL
states cannot be written to a table, so what lies above a block is handed down
as the digests left and right of its path: the states before the path's slots
are made from the left ones once per block and copied for each of its rows.

A null doc_id comes first among the leaves of its source, a null source first
among the sources, null and empty values differ (`-` against `0:`). Rows of
equal doc_id stand in the order of their leaf digests; rows equal in both are
interchangeable, and each has a slot of its own. A lone leaf is the root of its
source, and a lone source's root that of the dataset. An empty table gives no
rows. Columns other than the five hashed are not read, so names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

RUN = 16                   # children of a parent
LEVELS = 3                 # levels of a block
BLOCK = RUN ** LEVELS      # nodes of a block
RANGE_ROWS = 100_000       # rows of one sorted range, on average
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _coded(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Lowercase hex SHA-256 over the five values, each with its length."""
    return F.sha2(F.concat(*map(_coded, (doc_id, source, lang, n_chars, text))), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaves(docs: DataFrame, changed: Column | None = None, text: Column | None = None) -> DataFrame:
    """doc_id, source, leaf and, where ``changed`` holds, ``new_leaf``: the
    digest with ``text`` in place of the row's own (else null)."""
    own = [F.col(c) for c in HASHED]
    new = F.lit(None).cast("string")
    if changed is not None:
        new = F.when(changed, leaf_digest(*own[:-1], text))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       leaf_digest(*own).alias("leaf"), new.alias("new_leaf"))


def positions(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with their position ``pos`` from 0 among those of equal ``keys``
    in ascending ``order`` (nulls first), and the number ``n`` of those.

    Ranges of the whole order are sorted by a task each; equal rows are told
    apart by a number, so that many of them do not make one large range."""
    rows = written(rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())), "merkle-rows")
    ranges = max(1, math.ceil(rows.count() / RANGE_ROWS))
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order, "_tie")]
    dealt = rows.repartitionByRange(ranges, *by).withColumn("_cut", F.spark_partition_id())
    dealt = written(dealt, "merkle-ranges")
    every = Window.partitionBy(*(keys or [F.lit(0)]))
    before = every.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = dealt.groupBy(*keys, "_cut").agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_cut").alias("_k_cut"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"), F.sum("_n").over(every).alias("n"))
    local = F.row_number().over(Window.partitionBy(*keys, "_cut").orderBy(*by[len(keys):])) - 1
    same = F.col("_cut") == F.col("_k_cut")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    numbered = dealt.withColumn("_local", local).join(cuts, same)
    kept = [c for c in rows.columns if c != "_tie"]
    return numbered.select(*kept, (F.col("_first") + F.col("_local")).cast("long").alias("pos"), F.col("n").cast("long"))


class Run:
    """A parent: the copied hash states before its children, and their digests."""

    def __init__(self, children: Sequence[bytes]):
        state = hashlib.sha256()
        self.before = []
        for c in children:
            self.before.append(state.copy())
            state.update(c)
        self.children = b"".join(children)
        self.digest = state.hexdigest().encode()

    def right(self, slot: int) -> bytes:
        return self.children[64 * (slot + 1):]

    def left(self, slot: int) -> bytes:
        return self.children[:64 * slot]


def resumed(state, value: bytes, right: bytes) -> bytes:
    """The parent's digest when ``value`` follows ``state``."""
    state = state.copy()
    state.update(value)
    state.update(right)
    return state.hexdigest().encode()


def depth(n: int) -> int:
    d = 0
    while n > 1:
        n, d = -(-n // RUN), d + 1
    return d


def grown(digests: Sequence[bytes], n: int) -> list[list[Run]]:
    """The levels over a block's ``digests`` in a tree of ``n`` such nodes."""
    levels: list[list[Run]] = []
    for _ in range(min(LEVELS, depth(n))):
        levels.append([Run(digests[i:i + RUN]) for i in range(0, len(digests), RUN)])
        digests = [r.digest for r in levels[-1]]
    return levels


def _raised(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    n = int(pdf["n"].iloc[0])
    top = [d.encode() for d in pdf["digest"]]
    levels = grown(top, n)
    digest = levels[-1][0].digest if levels else top[0]
    return pd.DataFrame({"tree": [pdf["tree"].iloc[0]], "pos": [int(pdf["pos"].iloc[0]) // BLOCK],
                         "n": [-(-n // BLOCK)], "digest": [digest.decode()]})


def climb(nodes: DataFrame) -> list[DataFrame]:
    """From nodes (tree, pos, n, digest), those and every third level above
    them up to the roots, each written once. A job takes all trees up."""
    out = [written(nodes, "merkle-level")]
    most = out[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        own = out[-1].select("tree", "pos", "n", "digest")
        up = own.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).applyInPandas(
            _raised, "tree string, pos long, n long, digest string")
        out.append(written(up, "merkle-level"))
        most = math.ceil(most / BLOCK)
    return out


def _steps(levels: list[list[Run]], at: int):
    """(run, slot) on the way up from node ``at`` of a block."""
    for runs in levels:
        yield runs[at // RUN], at % RUN
        at //= RUN


PATHS = "tree string, pos long, lefts array<string>, rights array<string>, subroot string, root string"


def _lowered(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    levels = grown([d.encode() for d in nodes["digest"]], int(nodes["n"].iloc[0]))
    up = above.iloc[0]
    lefts, rights = [], []
    for at in range(len(nodes)):
        steps = list(_steps(levels, at))
        lefts.append([run.left(slot).decode() for run, slot in steps] + list(up["lefts"]))
        rights.append([run.right(slot).decode() for run, slot in steps] + list(up["rights"]))
    return pd.DataFrame({"tree": nodes["tree"], "pos": nodes["pos"], "lefts": lefts, "rights": rights,
                         "subroot": up["subroot"], "root": up["root"]})


def descend(levels: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The paths of the lowest but one of ``levels`` (of the lowest, if it is
    the only one) from those of the roots: per node the digests to the left and
    right at each level up to the dataset's root."""
    for nodes in levels[-2:0:-1]:
        down = nodes.select("tree", "pos", "n", "digest").groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block"))
        paths = written(down.cogroup(paths.groupBy("tree", "pos")).applyInPandas(_lowered, PATHS), "merkle-paths")
    return paths


class Manifest(NamedTuple):
    """Levels of all source trees, lowest first (the lowest with the columns of
    ``leaves``), and of the tree over sources (the lowest with ``source``)."""
    documents: list[DataFrame]
    sources: list[DataFrame]


def build(rows: DataFrame) -> Manifest:
    """The manifest of the rows of ``leaves``."""
    own = positions(rows, ["source"], ["doc_id", "leaf"])
    documents = climb(own.select(F.col("source").alias("tree"), "pos", "n", F.col("leaf").alias("digest"),
                                 F.col("doc_id").cast("string").alias("doc_id"), "new_leaf"))
    tops = documents[-1].select(F.col("tree").alias("source"), F.col("digest").alias("subroot"))
    tops = positions(tops, [], ["source"])
    sources = climb(tops.select(F.lit("").alias("tree"), "pos", "n", F.col("subroot").alias("digest"), "source"))
    return Manifest(documents, sources)


def source_paths(manifest: Manifest) -> DataFrame:
    """Per source its path through the tree over sources, in PATHS' columns."""
    levels = manifest.sources
    none = F.array().cast("array<string>")
    top = levels[-1].select("tree", "pos", none.alias("lefts"), none.alias("rights"), F.col("digest").alias("subroot"),
                            F.col("digest").alias("root"))
    if len(levels) == 1:  # a lone source
        return levels[0].select(F.col("source").alias("tree"), "pos", none.alias("lefts"), none.alias("rights"),
                                F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    above = descend(levels, top)

    def own(nodes: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        low = _lowered(nodes, up)
        return low.assign(tree=nodes["source"], pos=0, subroot=nodes["digest"])

    block = F.expr(f"pos div {BLOCK}").alias("block")
    return written(levels[0].groupBy("tree", block).cogroup(above.groupBy("tree", "pos")).applyInPandas(own, PATHS),
                   "merkle-sources")


AUDIT = ("doc_id string, leaf string, subroot string, root string, proof_sha256 string, n_siblings long, "
         "folded_root string, verified boolean")


def _audited(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    leaf = [d.encode() for d in nodes["digest"]]
    levels = grown(leaf, int(nodes["n"].iloc[0]))
    up = above.iloc[0]
    over = [(hashlib.sha256(x.encode()), y.encode()) for x, y in zip(up["lefts"], up["rights"])]
    shared = "".join(x + y for x, y in zip(up["lefts"], up["rights"])).encode()
    tails: dict[int, bytes] = {}  # by parent: the siblings of all levels above it
    proofs, siblings, folded = [], [], []
    for at, (own, new) in enumerate(zip(leaf, nodes["new_leaf"])):
        steps = list(_steps(levels, at))
        if at // RUN not in tails:
            tails[at // RUN] = b"".join(r.left(s) + r.right(s) for r, s in steps[1:]) + shared
        others = steps[0][0].left(steps[0][1]) + steps[0][0].right(steps[0][1]) if steps else b""
        proof = hashlib.sha256(others)
        proof.update(tails[at // RUN])
        proofs.append(proof.hexdigest())
        siblings.append((len(others) + len(tails[at // RUN])) // 64)
        value = own if new is None else new.encode()
        for run, slot in steps:
            value = resumed(run.before[slot], value, run.right(slot))
        for state, right in over:
            value = resumed(state, value, right)
        folded.append(value.decode())
    root = up["root"]
    return pd.DataFrame({"doc_id": nodes["doc_id"], "leaf": nodes["digest"], "subroot": up["subroot"],
                         "root": root, "proof_sha256": proofs, "n_siblings": siblings, "folded_root": folded,
                         "verified": [f == root for f in folded]})


def audit(manifest: Manifest) -> DataFrame:
    """One row per document: its leaf, the roots above it, the digest of its
    proof, and the root folded from ``new_leaf`` where there is one."""
    levels = manifest.documents
    paths = descend(levels, source_paths(manifest))
    block = F.expr(f"pos div {BLOCK}").alias("block")
    rows = levels[0].groupBy("tree", block).cogroup(paths.groupBy("tree", "pos")).applyInPandas(_audited, AUDIT)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))  # text until here: pandas has no null long

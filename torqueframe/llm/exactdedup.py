"""Exact dedup of incoming documents against immutable snapshots.

Texts are equal when identical after every run of ASCII white space becomes
one space; null counts as empty. A snapshot never changes, so each bucket of
its digests gets a static binary fuse filter once. Incoming digests are grouped
among themselves (a hot text is one row from then on) and screened by the
filters. Only positives join the exact buckets, and their bytes are compared
there. Nothing but digests is shuffled, apart from the texts of positives.

Equal rows stay as the smallest doc_id (null only if all are null). Rows that
repeat that doc_id too are marked kept alike; ``keep_rows`` returns one of
them. Empty and null texts are one class. An empty table gives no rows. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fuse
from .common import having_ids, written

BUCKET_KEYS = 1 << 16  # digests a bucket and its filter hold on average

# [\x20\x09-\x0D]+ but for lone spaces, which are their own replacement
_BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _BLANKS, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = normalised(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("_t")).select(
        "doc_id", F.sha2(F.col("_t"), 256).alias("text_sha256"))


def _classes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("text_sha256").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("text_sha256")
    return rows.withColumn("key", key).withColumn("bucket", F.pmod(key, F.lit(buckets)))


def snapshot_filters(members: DataFrame, buckets: int) -> DataFrame:
    """One filter per snapshot and bucket from distinct (snapshot, text_sha256)."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"snapshot": [pdf["snapshot"].iloc[0]], "bucket": [pdf["bucket"].iloc[0]],
                             "filter": [fuse.build(pdf["key"].to_numpy())]})

    return _bucketed(members, buckets).select("snapshot", "bucket", "key").groupBy("snapshot", "bucket").applyInPandas(
        one, "snapshot int, bucket long, filter binary")


def screen(batch: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The text_sha256 of ``batch`` that some snapshot's filter lets through."""
    def one(keys: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        hit = pd.Series(False, index=keys.index)
        for data in own["filter"]:
            hit |= fuse.contains(data, keys["key"].to_numpy())
        return keys.loc[hit, ["text_sha256"]]

    keys = _bucketed(batch.select("text_sha256"), buckets)
    return keys.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(one, "text_sha256 string")


def same_bytes(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of pairs (text_sha256, first_id, old_id), those with equal normalised bytes."""
    ids = pairs.select(F.col("first_id").alias("doc_id")).union(pairs.select("old_id"))
    texts = having_ids(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ids, "doc_id", null_too=True)
    texts = texts.select("doc_id", normalised(F.col("text")).alias("t"))
    texts = texts.withColumn("text_sha256", F.sha2("t", 256))
    a = texts.select(F.col("doc_id").alias("a_id"), F.col("t").alias("new_t"), F.col("text_sha256").alias("a_sha"))
    b = texts.select(F.col("doc_id").alias("b_id"), F.col("t").alias("old_t"), F.col("text_sha256").alias("b_sha"))
    new = (pairs["text_sha256"] == a["a_sha"]) & pairs["first_id"].eqNullSafe(a["a_id"])
    old = (pairs["text_sha256"] == b["b_sha"]) & pairs["old_id"].eqNullSafe(b["b_id"])
    return pairs.join(a, new).join(b, old).where("new_t = old_t").select("text_sha256").distinct()


def dedup(docs: DataFrame, snapshots: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The table is taken as it came in: equal ranges of doc_id are ``snapshots``
    immutable snapshots, and the last range is the incoming batch."""
    rows = written(digests(docs, id_col, text_col), "digests")
    cuts = rows.agg(F.percentile_approx("doc_id", [i / (snapshots + 1) for i in range(1, snapshots + 1)], 1000)
                    .alias("c"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(1, math.ceil(cuts["n"] / BUCKET_KEYS))
    place = F.lit(0)
    for c in cuts["c"] or []:
        place = place + F.when(F.col("doc_id") > c, 1).otherwise(0)
    rows = rows.withColumn("snapshot", F.when(F.col("doc_id").isNull(), snapshots).otherwise(place).cast("int"))
    old, new = rows.where(F.col("snapshot") < snapshots), rows.where(F.col("snapshot") == snapshots)
    filters = written(snapshot_filters(old.select("snapshot", "text_sha256").distinct(), buckets), "fuse-filters")
    exact = written(_classes(old), "exact-buckets")
    batch = written(_classes(new), "batch-classes")
    maybe = screen(batch, filters, buckets)
    pairs = written(batch.join(maybe, "text_sha256").join(
        exact.select("text_sha256", F.col("first_id").alias("old_id"), F.col("n").alias("old_n")), "text_sha256"),
        "positives")
    matched = pairs.join(same_bytes(docs, pairs, id_col, text_col), "text_sha256", "left_semi")
    merged = matched.select("text_sha256", F.least("first_id", "old_id").alias("keep_id"),
                            (F.col("n") + F.col("old_n")).alias("group_size"))
    merged = written(merged, "merged-classes")
    alone = exact.unionByName(batch).join(merged, "text_sha256", "left_anti").select(
        "text_sha256", F.col("first_id").alias("keep_id"), F.col("n").alias("group_size"))
    classes = merged.unionByName(alone)
    return rows.join(classes, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_rows(docs: DataFrame, snapshots: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = written(dedup(docs, snapshots, id_col, text_col).where("kept")
                   .groupBy("keep_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")), "kept-ids")
    names = {c.lower() for c in docs.columns}
    sha = "text_sha256" if "text_sha256" not in names else "text_sha256_of_dedup"
    kept = kept.select(F.col("keep_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_sha"), "n")
    own = docs.withColumn(sha, F.sha2(normalised(F.col(text_col)), 256))
    match = own[id_col].eqNullSafe(F.col("_keep_id")) & (own[sha] == F.col("_keep_sha"))
    once = own.join(kept.where("n = 1"), match, "left_semi").drop(sha)
    again = kept.where("n > 1")
    if again.isEmpty():
        return once
    return once.unionByName(own.join(again, match, "left_semi").dropDuplicates([id_col, sha]).drop(sha))

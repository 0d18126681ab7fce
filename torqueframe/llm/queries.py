"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chatformat, decontam, divergence, exactdedup, langid, merkle, ngramjoin, packing, pii, suffixdedup, tokenids,
               toxicity, vectorscan)
from .common import scratch_path, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of the doc_id as text leaves ``fold``; false for a null id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(False))


@query
def op1_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = langid.fit(docs.where(~held_out(4, 2)))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(4, 2).alias("held_out"), "language.lang_pred", "language.score")


@query
def op2_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return ngramjoin.classes(table(spark, d, "documents")).select(
        "doc_id", "class_id", "copy_of", "n_links", "n_shingles")


@query
def op3_suffix_array_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return suffixdedup.digest(docs, suffixdedup.repeats(docs))


@query
def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op5_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    rows = chatformat.repair(table(spark, d, "conversations"))
    return rows.withColumn("rendered_sha256", F.sha2(F.concat("head", "text", "tail"), 256)).drop("text")


@query
def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = toxicity.fit(docs, table(spark, d, "labels").where(~held_out(5, 0)))
    out = docs.select("doc_id", held_out(5, 0).alias("held_out"), toxicity.scored(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op7_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, d, "documents")))


@query
def op8_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exactdedup.dedup(table(spark, d, "documents"))


SQL["op8_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), c AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT t.doc_id, c.keep_id, c.group_size, t.doc_id = c.keep_id AS kept, t.text_sha256
FROM t JOIN c USING (text_sha256)
"""


@query
def op9_token_ids(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    tokenids.write_ids(table(spark, d, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenids.read_documents(spark, path)


@query
def op10_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


@query
def op11_vector_scan(spark: SparkSession, d: str) -> DataFrame:
    index = vectorscan.build(table(spark, d, "embeddings"), k=10)
    found = vectorscan.search(index, vectorscan.member_queries(index, every=100), k=10)
    return found.select("query_id", "rank", "vec_id", "score")


@query
def op12_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(table(spark, d, "documents"), min_docs=30, top=50)


SQL["op12_source_divergence"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), occurrence AS (
  SELECT rid, lang, source, unnest(terms) AS term FROM doc
), kept AS (
  SELECT lang, term, count(*) AS n FROM occurrence GROUP BY lang, term HAVING count(DISTINCT rid) >= 30
), size AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), grp AS (
  SELECT DISTINCT lang, source FROM doc
), cell AS (
  SELECT g.lang, g.source, k.term, count(o.rid) AS n
  FROM grp g JOIN kept k USING (lang) LEFT JOIN occurrence o
    ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
  GROUP BY ALL
), total AS (
  SELECT lang, source, sum(n) AS n FROM cell GROUP BY lang, source
), p AS (
  SELECT c.lang, c.source, c.term, c.n,
    1 + (1000000000::HUGEINT * (c.n + 5)) // (t.n + 5 * s.v) AS p, 1 + (1000000000::HUGEINT * (k.n + 5)) // (s.n + 5 * s.v) AS q
  FROM cell c JOIN total t USING (lang, source) JOIN size s USING (lang) JOIN kept k USING (lang, term)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of ``docs``; where 5 divides the crc32 of the doc_id as text, also
    those after text's A-Z became lower case."""
    return merkle.leaves(docs, held_out(5, 0), merkle.lower_ascii(F.col("text")))


@query
def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.audit(merkle.build(tampered_leaves(table(spark, d, "documents"))))


SQL["op13_merkle_manifest"] = r"""
WITH RECURSIVE coded AS (
  SELECT doc_id, source, text,
    CASE WHEN doc_id IS NULL THEN '-' ELSE octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END AS body,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    -- crc32 bit by bit: a code of a character, or -1 for one shift of the register
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
          lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END),
      4294967295) AS crc
  FROM documents
), leaf AS (
  SELECT doc_id, source, sha256(head || body) AS leaf,
    CASE WHEN crc % 5 = 0 AND text IS NOT NULL
         THEN sha256(head || octet_length(encode(low)) || ':' || low) ELSE sha256(head || body) END AS value
  FROM coded
), placed AS (
  SELECT *, row_number() OVER () AS rid,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaf
), node AS (
  SELECT 0 AS lvl, source, idx, n, leaf AS digest FROM placed
  UNION ALL
  SELECT lvl + 1, source, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM node WHERE n > 1 GROUP BY lvl, source, idx // 16, n
), subroot AS (
  SELECT source, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM node WHERE n = 1
), top AS (
  SELECT 0 AS lvl, idx, n, digest FROM subroot
  UNION ALL
  SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY lvl, idx // 16, n
), node_step AS (
  SELECT a.lvl, a.source, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM node a JOIN node b ON a.lvl = b.lvl AND a.source IS NOT DISTINCT FROM b.source AND a.idx // 16 = b.idx // 16
  WHERE a.n > 1 GROUP BY ALL
), top_step AS (
  SELECT a.lvl, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM top a JOIN top b ON a.lvl = b.lvl AND a.idx // 16 = b.idx // 16 WHERE a.n > 1 GROUP BY ALL
), step AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY part, lvl) AS k, l, r FROM (
    SELECT p.rid, 0 AS part, s.lvl, s.l, s.r FROM placed p JOIN node_step s
      ON p.source IS NOT DISTINCT FROM s.source AND s.idx = p.idx // (16 ** s.lvl)::BIGINT
    UNION ALL
    SELECT p.rid, 1, s.lvl, s.l, s.r FROM placed p JOIN subroot t ON p.source IS NOT DISTINCT FROM t.source
      JOIN top_step s ON s.idx = t.idx // (16 ** s.lvl)::BIGINT)
), fold AS (
  SELECT rid, 0 AS k, value FROM placed
  UNION ALL
  SELECT f.rid, f.k + 1, sha256(s.l || f.value || s.r) FROM fold f JOIN step s ON s.rid = f.rid AND s.k = f.k + 1
), folded AS (
  SELECT rid, arg_max(value, k) AS folded_root FROM fold GROUP BY rid
), proof AS (
  SELECT p.rid, sha256(coalesce(string_agg(s.l || s.r, '' ORDER BY s.k), '')) AS proof_sha256,
    coalesce(sum(length(s.l) + length(s.r)) // 64, 0)::BIGINT AS n_siblings
  FROM placed p LEFT JOIN step s USING (rid) GROUP BY p.rid
)
SELECT p.doc_id, p.leaf, t.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root, q.proof_sha256, q.n_siblings,
  f.folded_root, f.folded_root = (SELECT digest FROM top WHERE n = 1) AS verified
FROM placed p JOIN subroot t ON p.source IS NOT DISTINCT FROM t.source JOIN folded f USING (rid) JOIN proof q USING (rid)
"""

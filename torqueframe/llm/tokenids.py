"""Token ids in files of bit-plane-shuffled blocks.

Documents are dealt by ranges of (doc_id, text hash) to shards, so the shards
in order hold all ids in ascending doc_id order. A shard's ids are cut into
blocks of a fixed size. Each block is transposed into byte planes (or bit
planes), every plane is compressed with zstandard, and stored with its block's
row of the chunk index: shard, chunk, number of ids, plane sizes, and which
documents have which of its ids. The container is Parquet, so any store that
Spark can write will do and a lost task's files are never seen.

Null text is empty (only the end id); null doc_ids come first; repeated rows
are documents of their own; an empty table gives empty files. Other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import tokenizer

BLOCKS = ("shard int, chunk int, n_ids int, kind string, plane_bytes array<int>, planes binary, docs array<struct<"
          "doc_id:long, ordinal:int, doc_start:long, n_tokens:long, at:int, length:int>>")
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("ordinal", pa.int32()), ("doc_start", pa.int64()),
                            ("n_tokens", pa.int64()), ("at", pa.int32()), ("length", pa.int32())]))
_SCHEMA = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int32()), ("kind", pa.string()),
                     ("plane_bytes", pa.list_(pa.int32())), ("planes", pa.binary()), ("docs", _DOCS)])


def shuffle_planes(ids: np.ndarray, kind: str = "byte", level: int = 3) -> list[bytes]:
    """The planes of a block of ids, least significant first, compressed."""
    import zstandard
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        raw = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        raw = raw.T
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(np.ascontiguousarray(p).tobytes()) for p in raw]


def join_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    """Inverse of ``shuffle_planes``."""
    import zstandard
    unpack = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(unpack.decompress(p), dtype=np.uint8) for p in planes]
    if kind == "bit":
        bits = np.unpackbits(np.stack(rows), axis=1, count=n, bitorder="little").T
        raw = np.packbits(bits, axis=1, bitorder="little")
    else:
        raw = np.stack(rows).T
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, words_keep_space: bool = False,
              block_ids: int = 1 << 16, shard_docs: int = 8192, kind: str = "byte", id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Encode every text and write the files; ``shard_docs`` documents a shard on average."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shards = max(1, math.ceil(docs.select("doc_id").count() / shard_docs))

    def encoded(batches):
        shard = TaskContext.get().partitionId()
        tok = tokenizer(tokenizer_path, words_keep_space)
        end = np.array([end_id], dtype="<u4")
        held: list[np.ndarray] = []
        have = chunk = ordinal = 0
        start = 0
        marks: list[dict] = []

        def block():
            nonlocal held, have, chunk, marks
            planes = shuffle_planes(np.concatenate(held), kind)
            row = pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (shard, chunk, have, kind, [len(p) for p in planes], b"".join(planes), marks), _SCHEMA)],
                schema=_SCHEMA)
            held, have, marks, chunk = [], 0, [], chunk + 1
            return row

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, ids in tok.documents(batch.column(1)):
                ids = np.concatenate([ids.astype("<u4"), end])
                at = 0
                while at < len(ids):
                    n = min(len(ids) - at, block_ids - have)
                    marks.append({"doc_id": doc_ids[i], "ordinal": ordinal, "doc_start": start,
                                  "n_tokens": len(ids), "at": have, "length": n})
                    held.append(ids[at:at + n])
                    at, have = at + n, have + n
                    if have == block_ids:
                        yield block()
                ordinal, start = ordinal + 1, start + len(ids)
        if have:
            yield block()
        tok.close()

    (docs.repartitionByRange(shards, F.col("doc_id"), F.xxhash64("text"))
         .sortWithinPartitions("doc_id", F.xxhash64("text"))
         .mapInArrow(encoded, BLOCKS).write.parquet(path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32, shard and first chunk."""
    files = spark.read.schema(BLOCKS).parquet(path)
    sizes = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # one row per shard, not per document
    before = sizes.select(F.col("shard").alias("_s"), (
        F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("_before"))
    schema = ("shard int, chunk int, doc_id long, ordinal int, doc_start long, n_tokens long, ids_crc32 long, "
              "part binary")
    types = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("doc_id", pa.int64()), ("ordinal", pa.int32()),
                       ("doc_start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                       ("part", pa.binary())])

    def decoded(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out: list[list] = [[] for _ in types]
                planes, at = [], 0
                for n in row["plane_bytes"]:
                    planes.append(row["planes"][at:at + n])
                    at += n
                ids = join_planes(planes, row["n_ids"], row["kind"])
                for d in row["docs"]:
                    part = ids[d["at"]:d["at"] + d["length"]]
                    whole = d["length"] == d["n_tokens"]
                    for c, v in zip(out, (row["shard"], row["chunk"], d["doc_id"], d["ordinal"], d["doc_start"],
                                          d["n_tokens"], zlib.crc32(part) if whole else None,
                                          None if whole else part.tobytes())):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, types)], schema=types)

    parts = files.mapInArrow(decoded, schema)
    # only a document that crosses a block's end comes in parts: one per block at most
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "part")))
    split = (parts.where("part is not null").groupBy("shard", "ordinal")
             .agg(F.min("chunk").alias("chunk"), F.first("doc_id").alias("doc_id"),
                  F.first("doc_start").alias("doc_start"), F.first("n_tokens").alias("n_tokens"),
                  F.aggregate(ordered, F.to_binary(F.lit(""), F.lit("utf-8")),
                              lambda acc, x: F.concat(acc, x["part"])).alias("_all"))
             .withColumn("ids_crc32", F.crc32("_all")))
    cols = ["shard", "chunk", "doc_id", "doc_start", "n_tokens", "ids_crc32"]
    rows = parts.where("part is null").select(cols).unionByName(split.select(cols))
    return (rows.join(before, rows["shard"] == before["_s"])
            .select("doc_id", (F.col("doc_start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32",
                    "shard", "chunk"))

"""Cost-balanced packing of token ids into fixed-length sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n`` (attention stays
within a piece). Documents are cut at every full sequence; what remains of
each goes, in descending cost, to the sequence of lowest cost that has room,
and is cut where that is full. A block of documents of one partition is packed
at a time, so nothing is shuffled. The tokens that fill no whole sequence at a
block's end go to sequences whose lengths are powers of two: nothing is padded.

Null text is empty (only the end id). Repeated rows and doc_ids are documents
of their own, a null doc_id stays null, an empty table has no pieces. Columns
other than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import tokenizer

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, cost double")


def assign(sizes: list[int], seq_len: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Place remainders (each below ``seq_len``): rows of (item, start within
    it, length, sequence, offset), and sequences filled without a gap."""
    total = sum(sizes)
    room = [seq_len] * (total // seq_len)
    left = total % seq_len
    while left:  # the binary digits of the rest, largest first
        room.append(1 << (left.bit_length() - 1))
        left -= room[-1]
    used = [0] * len(room)
    heap = [(0.0, s) for s in range(len(room))]
    rows = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at, left = 0, sizes[item]
        while left:
            cost, s = heap[0]
            n = min(left, room[s] - used[s])
            rows.append((item, at, n, s, used[s]))
            used[s] += n
            at, left = at + n, left - n
            if used[s] < room[s]:
                heapq.heapreplace(heap, (cost + linear * n + quadratic * n * n, s))
            else:
                heapq.heappop(heap)
    return rows


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, seq_len: int = 2048, block_docs: int = 4096,
         linear: float = 1.0, quadratic: float = 1.0 / 2048, words_keep_space: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; see the module for the method and ``PIECES``.

    ``block_docs`` bounds what a task holds: so many remainders, each shorter
    than a sequence. ``sequence_id`` is unique over all partitions."""
    schema = pa.schema([(c.split()[0], pa.float64() if c.endswith("double") else pa.int64())
                        for c in PIECES.split(", ")])

    def packed(batches):
        base, n_seq = TaskContext.get().partitionId() << 40, 0
        tok = tokenizer(tokenizer_path, words_keep_space)
        end = np.array([end_id], dtype="<u4")
        out: list[list] = [[] for _ in schema]
        rest: list[tuple] = []  # (doc_id, tokens, start, ids)

        def put(*row):
            for c, v in zip(out, row):
                c.append(v)

        def flush():
            nonlocal n_seq, rest, out
            rows = assign([len(r[3]) for r in rest], seq_len, linear, quadratic)
            filled: dict[int, int] = {}
            for _, _, n, s, _ in rows:
                filled[s] = filled.get(s, 0) + n
            for item, at, n, s, offset in rows:
                doc, tokens, start, ids = rest[item]
                put(doc, start + at, n, zlib.crc32(ids[at:at + n]), tokens, base + n_seq + s, offset, filled[s],
                    linear * n + quadratic * n * n)
            n_seq += len(filled)
            rest = []
            got, out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)],
                                                  schema=schema), [[] for _ in schema]
            return got

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for row, ids in tok.documents(batch.column(1)):
                ids = np.concatenate([ids.astype("<u4"), end])
                whole = len(ids) // seq_len * seq_len
                for at in range(0, whole, seq_len):
                    put(doc_ids[row], at, seq_len, zlib.crc32(ids[at:at + seq_len]), len(ids), base + n_seq, 0,
                        seq_len, linear * seq_len + quadratic * seq_len * seq_len)
                    n_seq += 1
                if whole < len(ids):
                    rest.append((doc_ids[row], len(ids), whole, ids[whole:].copy()))
                if len(rest) >= block_docs or len(out[0]) >= 1 << 14:
                    yield flush()
        yield flush()
        tok.close()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(packed, PIECES)

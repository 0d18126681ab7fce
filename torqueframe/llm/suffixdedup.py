"""Removal of long repeated byte strings by longest-previous-factor arrays.

A string of ``size`` bytes that starts at two places is a repeat. Texts are
UTF-8 bytes; matches never cross documents, and are judged on the input.

1. Every start of a ``size``-byte window has an anchor: the place, within the
   window, of the ``gram``-byte string with the least hash (the first of equals).
   Equal windows have equal anchors, so only anchors with equal strings need be
   compared, and there are only about 2 / (size - gram) of them a byte.
2. An anchor's context holds all windows that it can anchor. Where contexts are
   equal, all of an anchor's windows are repeats: one row of counts tells, however
   many copies there are.
3. Contexts that differ but share their anchor's string are kept, one of each
   kind, if they share one of ``PARTS`` longer strings as well; any window that two
   of them share holds one of those. What is left comes together in blocks. A block is sorted into suffix order; the previous and next
   smaller positions there give each window's longest earlier match, its LPF.
   Windows whose LPF reaches ``size`` are later copies, and point at an earlier one.
4. A string with more than ``BLOCK`` kinds of context is too much for a block: its
   windows are shuffled by their hashes instead, with the same result.

With ``keep_first`` the first copy in order of (doc_id, position) stays; without
it every copy goes. Null text is empty. Repeated rows are copies of each other.
An empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import release, small_enough, written

BLOCK = 4096  # contexts in a block, about: a block's suffix order takes some 100 MB
PARTS = 8  # strings that a context must share one of; each is size - (size - gram) / PARTS long
DEPTH = 64  # bytes to which suffixes are ordered before their windows' fingerprints tell
PIECE = 1 << 22  # bytes of a very long text that are worked on at a time


def _span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """As ``span_hashes``, for arrays of any shape, as signed numbers."""
    return T.span_hashes(data, start.ravel(), end.ravel()).view(np.int64).reshape(start.shape)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values."""
    n = len(x) - w + 1
    pad = -len(x) % w
    rows = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def _anchors(data: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int, gram: int, first: int, last: int):
    """Anchors of the windows that start in [first, last): arrays of the
    anchor's place, its first and last window start, string hash and context
    hash. begin and end: the document's border for every byte."""
    n = len(data) - size + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    places = np.arange(len(data) - gram + 1)
    grams = T.span_hashes(data, places, places + gram)
    low = np.uint64((1 << 28) - 1)
    least = sliding_min((grams & ~low) | places.astype(np.uint64), size - gram + 1)
    at = (least & low).astype(np.int64)
    starts = np.arange(n)
    ok = (starts + size <= end[:n]) & (starts >= first) & (starts < last)
    starts, at = starts[ok], at[ok]
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (begin[starts[1:]] != begin[starts[:-1]])
    one = np.flatnonzero(new)
    a, s0 = at[one], starts[one]
    s1 = starts[np.append(one[1:], len(at)) - 1]
    lo, hi = np.maximum(a - (size - gram), begin[a]), np.minimum(a + size, end[a])
    context = T.mix(T.span_hashes(data, lo, hi) + (a - lo).astype(np.uint64) * np.uint64(1 << 20)
                    + (hi - a).astype(np.uint64))
    return a, s0, s1, grams[a], context


def text_anchors(data: np.ndarray, offsets: np.ndarray, size: int, gram: int):
    """(document, place, first and last window start in it, string, context) arrays of a run of documents."""
    length = np.diff(offsets)
    if len(length) > 1 or not len(length) or length[0] <= PIECE:
        doc = np.repeat(np.arange(len(length)), length)
        begin, end = offsets[doc], offsets[doc + 1]
        a, s0, s1, g, c = _anchors(data, begin, end, size, gram, 0, len(data))
        d = doc[a] if len(a) else a
        return d, a - offsets[d], s0 - offsets[d], s1 - offsets[d], g, c
    parts = []
    n = len(data)
    for p in range(0, n, PIECE):  # pieces see all that their windows and contexts reach
        lo, hi = max(0, p - size), min(n, p + PIECE + 2 * size)
        own = data[lo:hi]
        a, s0, s1, g, c = _anchors(own, np.zeros(len(own), np.int64), np.full(len(own), len(own)), size, gram,
                                   p - lo, p - lo + PIECE)
        parts.append([a + lo, s0 + lo, s1 + lo, g, c])
    a, s0, s1, g, c = (np.concatenate(x) for x in zip(*parts))
    new = np.ones(len(a), dtype=bool)  # one anchor may serve windows of two pieces
    new[1:] = a[1:] != a[:-1]
    one = np.flatnonzero(new)
    s1 = s1[np.append(one[1:], len(a)) - 1] if len(a) else s1
    return np.zeros(len(one), np.int64), a[one], s0[one], s1, g[one], c[one]


def suffix_ranks(data: np.ndarray, begin: np.ndarray, count: np.ndarray, depth: int) -> np.ndarray:
    """Ranks by their first ``depth`` bytes of the suffixes that start in the
    runs [begin, begin + count), by prefix doubling. Only the places that the
    runs reach are ranked on the way."""
    first = min(8, depth)
    length = count + depth - first
    edge = np.cumsum(length)
    place = np.repeat(begin - (edge - length), length) + np.arange(int(edge[-1]) if len(edge) else 0)
    wide = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    key = np.zeros(len(place), dtype=np.uint64)
    for i in range(first):
        key = (key << np.uint64(8)) | wide[place + i]

    def ranked(key):
        order = np.argsort(key)
        in_order = key[order]
        step = np.zeros(len(key), dtype=np.uint64)
        step[1:] = in_order[1:] != in_order[:-1]
        rank = np.empty(len(key), dtype=np.uint64)
        rank[order] = np.cumsum(step)
        return rank

    rank, have = ranked(key), first
    while have < depth:
        jump = min(have, depth - have)
        after = np.zeros(len(rank), dtype=np.uint64)
        after[:max(0, len(rank) - jump)] = rank[jump:]
        rank, have = ranked((rank << np.uint64(32)) | after), have + jump
    start = np.repeat(edge - length - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return rank[start]


def _smaller(position: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place of a suffix order: the nearest place before it whose
    position is smaller (-1: none), and the least lcp on the way. lcp[i] is that
    of i - 1 and i. All places jump at once along what others have found."""
    n = len(position)
    at, low = np.arange(n) - 1, lcp.copy()
    todo = np.flatnonzero(at >= 0)
    while len(todo):
        todo = todo[position[at[todo]] > position[todo]]
        via = at[todo]
        low[todo] = np.minimum(low[todo], low[via])
        at[todo] = at[via]
        todo = todo[at[todo] >= 0]
    low[at < 0] = 0
    return at, low


def longest_previous(rank: np.ndarray, window: np.ndarray, position: np.ndarray,
                     size: int) -> tuple[np.ndarray, np.ndarray]:
    """LPF of suffixes, cut at ``size`` (0: below it), and the index of the
    earlier suffix that gives it (-1: none).

    Suffixes are in order of ``rank`` and, where that ends, of ``window``, the
    fingerprint of their first ``size`` bytes; ``position`` is their order in the
    text. In suffix order the longest earlier match of each is its previous or
    its next smaller position. Only matches of ``size`` bytes count, and those
    lie together, so the order need not go on to their last byte."""
    order = np.lexsort((position, window, rank))
    pos, r = position[order], window[order]
    lcp = np.zeros(len(order), dtype=np.int64)
    lcp[1:] = np.where(r[1:] == r[:-1], size, 0)
    before, low_b = _smaller(pos, lcp)
    back = np.zeros_like(lcp)
    back[1:] = lcp[1:][::-1]
    after, low_a = _smaller(pos[::-1], back)
    after, low_a = (len(order) - 1 - after)[::-1], low_a[::-1]
    after = np.where(low_a > 0, after, -1)
    best = np.where(low_b >= low_a, before, after)
    low = np.maximum(low_b, low_a)
    lpf, source = np.zeros(len(order), np.int64), np.full(len(order), -1)
    lpf[order] = low
    source[order] = np.where(low > 0, order[best], -1)
    return lpf, source


_ANCHOR = ("doc_id long, th long, place int, s0 int, s1 int, gram long, context long")


def _runs(flags: np.ndarray, first: int, size: int) -> list[dict]:
    """Byte spans covered by the flagged window starts; the first flag is of start ``first``."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"lo": int(first + a), "hi": int(first + b - 1 + size)} for a, b in zip(edge[::2], edge[1::2])]


def repeats(docs: DataFrame, size: int = 400, gram: int = 128, keep_first: bool = False, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Rows (doc_id, th, spans): byte spans that repeats cover, per text that
    has any; th is the hash of the text. Spans may touch and overlap."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).withColumn("th", F.xxhash64("t"))
    reach = size - gram

    def found(batches):
        for batch in batches:
            for row, data, offsets in T.runs(batch.column(2)):
                d, a, s0, s1, g, c = text_anchors(data, offsets, size, gram)
                where = pa.array(d + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(where), batch.column(1).take(where),
                     *[pa.array(x.astype(np.int32)) for x in (a, s0, s1)],
                     pa.array(g.view(np.int64)), pa.array(c.view(np.int64))],
                    names=["doc_id", "th", "place", "s0", "s1", "gram", "context"])
        release()

    anchors = written(source.where(F.octet_length("t") >= size).select("doc_id", "th", "t").mapInArrow(found, _ANCHOR),
                      "anchors")
    kinds = anchors.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "place", "s0", "s1")).alias("first"))
    grams = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all")).where("all > 1")
    kinds = written(kinds.join(grams.drop("all"), "gram"), "contexts")
    work = written(kinds.where("kinds > 1").select("gram", "context", "first.*"), "unlike-contexts")

    # the bytes of one context of each kind
    by_text = work.groupBy("doc_id", "th").agg(F.collect_list(
        F.struct("gram", "context", "place", "s0", "s1")).alias("a"))
    texts = _texts(source, by_text).dropDuplicates(["doc_id", "th"])
    cut = ("gram long, context long, doc_id long, place int, s0 int, s1 int, bytes binary, parts array<long>")
    step = math.ceil(reach / PARTS)

    def contexts(batches):
        types = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary(), pa.list_(pa.int64())]
        for batch in batches:
            for text, doc_id, own in zip(batch.column(1), batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                raw = text.as_py().encode()
                data = np.frombuffer(raw, dtype=np.uint8)
                at = np.array([x["place"] for x in own], dtype=np.int64)[:, None]
                # a window that starts d before the anchor holds the part number d // step
                lo, hi = at - step * np.arange(PARTS), at + size - step * np.arange(1, PARTS + 1)
                ok = (lo >= 0) & (hi <= len(raw))
                parts = _span_hashes(data, np.where(ok, lo, 0), np.where(ok, hi, 1))
                rows = [(x["gram"], x["context"], doc_id, x["place"], x["s0"], x["s1"],
                         raw[max(0, x["place"] - reach):x["place"] + size],
                         [p if o else None for p, o in zip(ps, os)])
                        for x, ps, os in zip(own, parts.tolist(), ok.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=[c.split()[0] for c in cut.split(", ")])

    held = texts.join(by_text, texts["doc_id"].eqNullSafe(by_text["doc_id"]) & (texts["th"] == by_text["th"])).select(
        texts["doc_id"], "t", "a").mapInArrow(contexts, cut)
    held = written(held, "context-bytes")
    parts = held.select("gram", "context", F.posexplode("parts").alias("i", "part")).where("part is not null")
    shared = parts.groupBy("gram", "i", "part").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    alike = written(parts.join(shared, ["gram", "i", "part"]).select("gram", "context").distinct(), "alike-contexts")
    kinds_left = alike.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    alike = written(alike.join(kinds_left, "gram"), "contexts-to-compare")
    held = held.drop("parts").join(alike, ["gram", "context"])
    few, many = held.where(F.col("kinds") <= BLOCK), held.where(F.col("kinds") > BLOCK)
    blocks = max(1, math.ceil(2 * alike.count() / BLOCK))
    span = "gram long, context long, spans array<struct<lo:int,hi:int>>"

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "place"], na_position="first").reset_index(drop=True)
        data = np.frombuffer(b"".join(pdf["bytes"]), dtype=np.uint8)
        length = pdf["bytes"].str.len().to_numpy()
        base = np.cumsum(length) - length
        lead = np.minimum(pdf["place"].to_numpy(), reach)  # bytes of the context before the anchor
        one = (base + lead - (pdf["place"] - pdf["s0"]).to_numpy()).astype(np.int64)
        count = (pdf["s1"] - pdf["s0"] + 1).to_numpy().astype(np.int64)
        which = np.repeat(np.arange(len(pdf)), count)
        starts = np.repeat(one - (np.cumsum(count) - count), count) + np.arange(count.sum())
        rank = suffix_ranks(data, one, count, min(DEPTH, size))
        window = T.span_hashes(data, starts, starts + size)
        lpf, earlier = longest_previous(rank, window, np.arange(len(starts)), size)
        flag = lpf >= size
        if not keep_first:
            flag[earlier[flag]] = True
        bounds = np.searchsorted(which, np.arange(len(pdf) + 1))
        out = [(g, c, _runs(flag[bounds[i]:bounds[i + 1]], s0, size))
               for i, (g, c, s0) in enumerate(zip(pdf["gram"], pdf["context"], pdf["s0"] - pdf["place"]))
               if flag[bounds[i]:bounds[i + 1]].any()]
        return pd.DataFrame(out, columns=["gram", "context", "spans"])

    marked = few.withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks))).groupBy("block").applyInPandas(block, span)
    if not alike.where(F.col("kinds") > BLOCK).isEmpty():
        marked = marked.unionByName(_by_windows(many, size, reach, keep_first))
    marked = written(marked, "marked-contexts")
    own = anchors.join(kinds.select("gram", "context", "n", F.struct("first.doc_id", "first.th", "first.place").alias("f")),
                       ["gram", "context"])
    whole = F.array(F.struct(F.col("s0").alias("lo"), (F.col("s1") + size).alias("hi")))
    twin = F.col("n") > 1
    if keep_first:
        twin = twin & ~(F.struct("doc_id", "th", "place").eqNullSafe(F.col("f")))
    twins = own.where(twin).select("doc_id", "th", whole.alias("spans"))
    rest = own.where(~twin).join(marked, ["gram", "context"]).select("doc_id", "th", F.transform(
        "spans", lambda x: F.struct((x["lo"] + F.col("place")).alias("lo"), (x["hi"] + F.col("place")).alias("hi"))).alias("spans"))
    # rows that repeat a text under one id have the same spans: each is kept once
    return twins.unionByName(rest).groupBy("doc_id", "th").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def _texts(source: DataFrame, ids: DataFrame) -> DataFrame:
    """The (doc_id, t, th) rows of ``source`` whose doc_id and th are in ``ids``."""
    ids = ids.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    ids = F.broadcast(ids) if small_enough(ids) else ids
    return source.join(ids, source["doc_id"].eqNullSafe(ids["_id"]) & (source["th"] == ids["_th"]), "left_semi")


def _by_windows(many: DataFrame, size: int, reach: int, keep_first: bool) -> DataFrame:
    """As a block does, for strings with any number of contexts: windows meet by hash."""
    def hashed(batches):
        for batch in batches:
            rows = batch.to_pylist()
            lists = []
            for x in rows:
                data = np.frombuffer(x["bytes"], dtype=np.uint8)
                one = min(x["place"], reach) - (x["place"] - x["s0"]) + np.arange(x["s1"] - x["s0"] + 1)
                lists.append(T.span_hashes(data, one, one + size).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in rows], t) for c, t in (("gram", pa.int64()), ("context", pa.int64()),
                                                                ("doc_id", pa.int64()), ("place", pa.int32()),
                                                                ("s0", pa.int32()))]
                + [pa.array(lists, pa.list_(pa.int64()))], names=["gram", "context", "doc_id", "place", "s0", "w"])

    rows = many.select("gram", "context", "doc_id", "place", "s0", "s1", "bytes").mapInArrow(
        hashed, "gram long, context long, doc_id long, place int, s0 int, w array<long>")
    rows = written(rows, "windows").select("gram", "context", "doc_id", "place", "s0", F.posexplode("w").alias("i", "w"))
    rows = rows.withColumn("at", F.struct("doc_id", (F.col("s0") + F.col("i")).alias("s"), "context"))
    twice = rows.groupBy("gram", "w").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("one")).where("c > 1")
    hit = rows.join(twice, ["gram", "w"])
    if keep_first:
        hit = hit.where(~F.col("at").eqNullSafe(F.col("one")))
    lo = F.col("s0") + F.col("i") - F.col("place")
    return hit.groupBy("gram", "context").agg(F.collect_list(
        F.struct(lo.cast("int").alias("lo"), (lo + size).cast("int").alias("hi"))).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes in spans."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def remove(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left of a text's bytes without its merged spans."""
    at, out = 0, []
    for lo, hi in spans:
        out.append(raw[at:lo])
        at = hi
    return b"".join((*out, raw[at:]))


def digest(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = written(found, "repeats")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).withColumn("th", F.xxhash64("t"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def cleaned(batches):
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw, runs = text.as_py().encode(), merged(spans)
                rows.append((doc_id, len(raw), sum(b - a for a, b in runs), len(runs),
                             hashlib.sha256(remove(raw, runs)).hexdigest()))
            cols = list(zip(*rows)) or [[]] * 5
            types = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=[c.split()[0] for c in out.split(", ")])

    texts = _texts(source, found)
    hit = texts.join(found, texts["doc_id"].eqNullSafe(found["doc_id"]) & (texts["th"] == found["th"])).select(
        texts["doc_id"], "t", "spans").mapInArrow(cleaned, out)
    ids = found.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    ids = F.broadcast(ids) if small_enough(ids) else ids
    clean = source.join(ids, source["doc_id"].eqNullSafe(ids["_id"]) & (source["th"] == ids["_th"]), "left_anti").select(
        "doc_id", F.octet_length("t").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("t", 256).alias("kept_sha256"))
    return hit.unionByName(clean)

"""How far the sources of a language differ in their use of terms.

Terms are runs of A-Z, a-z and all code points from U+0080 on, with A-Z made
lower case; null text, lang and source are read as ''. A language keeps the V
terms that stand in at least ``min_docs`` of its documents. A group (lang,
source) of N kept occurrences gives a kept term of count c the share
``p = 1 + floor(10^9 (c + 5) / (N + 5 V))``.

Shares depend on the count alone, so a group is stored as count levels: per
(group, count) the bitset of the term ids with that count, in words of 64 ids.
For two groups the AND of two levels' words and its popcount give the number of
terms with that pair of counts, to be multiplied by |p - q|. Terms absent from
one or both groups need no bitset: a level's total and V less the joint cells
count them. The sum over all cells is the L1 distance of the groups' shares.

Everything is one pass over the texts, which leaves one row per task and
(group, term), and joins and sums of integers after it; a hot source or language
is many words, and a join that all groups of a language take part in is
salted by its counted size. Products that could pass 64 bits are decimals.

A group without kept terms has the same share for all of them; a language
without any has distances of 0 and no term rows; a lone source has no pairs.
Repeated rows are documents of their own. An empty table gives no rows. Only
lang, source and text are read, so other names cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, small_enough, written

SCALE = 1_000_000_000
PRIOR = 5
WORD_TERMS = 48         # term ids per word of 64 bits, on average
HELD = 300_000          # counts that a task holds before it hands them on
PIECE = 1 << 20         # bytes of a text split into terms at a time
TASK_CELLS = 20_000_000  # pairs of levels that a task of the word join compares, on average

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TALLY = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()),
                    ("docs", pa.int64())])


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about ``PIECE`` bytes that end at a space."""
    at = 0
    while len(data) - at > PIECE:
        end = data.find(b" ", at + PIECE)
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:] if at else data


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, a list for each of its pieces."""
    for piece in _pieces(text.translate(_TABLE)):
        yield piece.split()


def _tallied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (lang, source, term) of a task's rows, occurrences and documents; a
    row without a term for each group."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def rows():
        out: list[list] = [[], [], [], [], []]
        for (lang, source), (n, docs) in held.items():
            size = len(n) + 1
            out[0] += [lang] * size
            out[1] += [source] * size
            out[2] += [None, *(t.decode("utf-8", "replace") for t in n)]
            out[3] += [0, *n.values()]
            out[4] += [0, *(docs[t] for t in n)]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _TALLY)], schema=_TALLY)

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for i, text in enumerate(batch.column("text")):
            n, docs = held.setdefault((langs[i], sources[i]), (Counter(), Counter()))
            own: set[bytes] = set()
            for piece in terms(text.as_py()):
                n.update(piece)
                own.update(piece)
            docs.update(own)
            if i % 256 == 0 and sum(len(n) for n, _ in held.values()) > HELD:
                yield rows()
    if held:
        yield rows()
    release()


def tallies(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of the whole table; a row of null term for every group."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    rows = docs.select(text("lang"), text("source"), text("text").cast("binary").alias("text"))
    per_task = rows.mapInArrow(_tallied, "lang string, source string, term string, n long, docs long")
    return written(per_task.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
                   "divergence-tallies")


def share(count: str, total: str, terms_kept: str) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR V)), exact; null if V is 0."""
    return F.expr(f"cast(1 + (cast({count} + {PRIOR} as decimal(20, 0)) * {SCALE}BD) div "
                  f"nullif(cast({total} + {PRIOR} * {terms_kept} as decimal(20, 0)), 0) as long)")


def kept_terms(rows: DataFrame, min_docs: int = 30) -> DataFrame:
    """The terms each language keeps: (lang, term, total, v, lang_n, word, bit).

    ``v`` and ``lang_n`` are the number of the language's kept terms and of their
    occurrences. Terms are dealt by hash to buckets of about ``WORD_TERMS``; a
    bucket of more than 64 goes on in another word."""
    kept = rows.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = written(kept.select("lang", "term", "total"), "divergence-kept")
    langs = written(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n")),
                    "divergence-langs")
    langs = F.broadcast(langs) if small_enough(langs) else langs
    buckets = F.expr(f"(v + {WORD_TERMS - 1}) div {WORD_TERMS}")
    dealt = kept.join(langs, "lang").withColumn("_buckets", buckets).withColumn(
        "_bucket", F.pmod(F.xxhash64("term"), F.col("_buckets")))
    dealt = dealt.repartition("lang", "_bucket")  # said outright: a partitioning by lang would do for the window too
    slot = F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy("term")) - 1
    dealt = dealt.withColumn("_slot", slot)
    return dealt.select("lang", "term", "total", "v", "lang_n",
                        F.expr("_bucket + (_slot div 64) * _buckets").alias("word"), F.expr("_slot % 64").alias("bit"))


class Levels(NamedTuple):
    """``bitmaps`` (lang, source, word, n, bits): of the terms of a word, those that
    the group has ``n`` times. ``groups`` (gid, lang, source, v, lang_n, total,
    present, p0): kept occurrences and terms of every group, and the share of an
    absent term. ``counts`` (lang, source, term, n, total): kept terms as rows."""
    bitmaps: DataFrame
    groups: DataFrame
    counts: DataFrame


def levels(docs: DataFrame, min_docs: int = 30) -> Levels:
    rows = tallies(docs)
    kept = written(kept_terms(rows, min_docs), "divergence-terms")
    counts = written(rows.where("n > 0").select("lang", "source", "term", "n").join(
        kept.select("lang", "term", "total", "word", "bit"), ["lang", "term"]), "divergence-counts")
    bitmaps = written(counts.groupBy("lang", "source", "word", "n").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")), "divergence-bitmaps")
    sizes = bitmaps.groupBy("lang", "source").agg(
        F.sum(F.col("n") * F.bit_count("bits")).alias("total"), F.sum(F.bit_count("bits")).alias("present"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.first("lang_n").alias("lang_n"))
    groups = rows.where("term is null").select("lang", "source").join(langs, "lang", "left").join(
        sizes, ["lang", "source"], "left").na.fill(0, ["v", "lang_n", "total", "present"])
    groups = groups.withColumn("p0", F.coalesce(share("0", "total", "v"), F.lit(0).cast("long")))
    groups = groups.withColumn("gid", F.monotonically_increasing_id())
    return Levels(bitmaps, written(groups, "divergence-groups"), counts.drop("word", "bit"))


def _salted(a: DataFrame, b: DataFrame, per_task: int = 2_000_000) -> DataFrame:
    """``a`` joined to ``b`` on lang (``b_lang``), with each language in as many
    parts of ``a`` as its number of pairs asks for, and ``b`` once for each."""
    size = a.groupBy("lang").agg(F.count(F.lit(1)).alias("_a")).join(
        b.groupBy(F.col("b_lang").alias("lang")).agg(F.count(F.lit(1)).alias("_b")), "lang")
    size = written(size.select("lang", F.ceil(F.col("_a") * F.col("_b") / per_task).cast("int").alias("_parts")),
                   "divergence-parts")
    size = F.broadcast(size) if small_enough(size) else size  # else a hot language would be one task's rows
    a = a.join(size, "lang").withColumn("_part", F.pmod(F.xxhash64("gid", "p"), F.col("_parts")).cast("int"))
    b = b.join(size.select(F.col("lang").alias("b_lang"), "_parts"), "b_lang").withColumn(
        "b_part", F.explode(F.expr("sequence(0, _parts - 1)"))).drop("_parts")
    return a.join(b, (F.col("lang") == F.col("b_lang")) & (F.col("_part") == F.col("b_part")))


def distances(lv: Levels) -> DataFrame:
    """(a, b, value): the L1 distance of every two groups of a language, a < b."""
    own = lv.groups.select("lang", "source", "gid", "v", "total", "p0")
    placed = lv.bitmaps.join(own, ["lang", "source"]).select(
        "lang", "word", "gid", share("n", "total", "v").alias("p"), "p0", "bits")
    placed = written(placed, "divergence-placed")
    pairs = placed.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum(F.col("n") * F.col("n"))).first()[0] or 0
    tasks = max(placed.sparkSession.sparkContext.defaultParallelism, math.ceil(pairs / TASK_CELLS))

    def renamed(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(f"b_{c}") for c in df.columns])

    left, right = placed.repartition(tasks, "lang", "word"), renamed(placed).repartition(tasks, "b_lang", "b_word")
    same = (F.col("lang") == F.col("b_lang")) & (F.col("word") == F.col("b_word")) & (F.col("gid") < F.col("b_gid"))

    def f(p: str, q: str) -> Column:
        return F.abs(F.col(p) - F.col(q))

    # a joint term was counted as absent from either group in the level sums
    cells = left.join(right, same).select(
        F.col("gid").alias("a"), F.col("b_gid").alias("b"),
        (F.bit_count(F.col("bits").bitwiseAND(F.col("b_bits")))
         * (f("p", "b_p") - f("p", "b_p0") - f("p0", "b_p") + f("p0", "b_p0"))).alias("value"))
    sums = placed.groupBy("lang", "gid", "p").agg(F.sum(F.bit_count("bits")).alias("terms"))
    groups = lv.groups.select("lang", "gid", "v", "present", "p0")
    absent = _salted(sums, renamed(groups.select("lang", "gid", "p0"))).where("gid <> b_gid").select(
        F.least("gid", "b_gid").alias("a"), F.greatest("gid", "b_gid").alias("b"),
        (F.col("terms") * f("p", "b_p0")).alias("value"))
    neither = _salted(groups.withColumn("p", F.col("p0")), renamed(groups)).where("gid < b_gid").select(
        F.col("gid").alias("a"), F.col("b_gid").alias("b"),
        ((F.col("v") - F.col("present") - F.col("b_present")) * f("p0", "b_p0")).alias("value"))
    parts = [d.groupBy("a", "b").agg(F.sum("value").alias("value")) for d in (cells, absent, neither)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("a", "b").agg(F.sum("value").alias("value"))


def pair_rows(lv: Levels) -> DataFrame:
    """Per group its language's other sources by distance, farthest first."""
    d = written(distances(lv), "divergence-pairs")
    both = d.unionByName(d.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    a = lv.groups.select(F.col("gid").alias("a"), "lang", "source")
    b = lv.groups.select(F.col("gid").alias("b"), F.col("source").alias("item"))
    return _ranked(both.join(a, "a").join(b, "b"), "pair")


def term_rows(lv: Levels, top: int = 50) -> DataFrame:
    """Per group the ``top`` terms that it has more of than its language."""
    own = lv.groups.select("lang", "source", "v", "lang_n", F.col("total").alias("group_n"))
    rows = lv.counts.join(own, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        (share("n", "group_n", "v") - share("total", "lang_n", "v")).alias("value")).where("value > 0")
    return _ranked(rows, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(w).alias("rank"))


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    lv = levels(docs, min_docs)
    return pair_rows(lv).unionByName(term_rows(lv, top))

"""Benchmark decontamination with built-in functions only.

A benchmark item is a bag of 5-word shingles; a document leaks it if some window
of as many shingles reaches the similarity threshold. Windows of a document are
taken item-sized: sizes come in geometric classes, each item is in the class
below its own size. Every window gets a 64-bit SimHash of its bag. The
fingerprints are cut into radius + 1 blocks, and windows meet items that share
a block: two within the radius must (at least one block has no differing bit),
so no such pair is lost. Pairs within the radius are verified by the exact
weighted Jaccard similarity of window and item, a shingle's weight being its
number of occurrences.

Only windows that begin at a shingle of some item are taken, and only where
enough of their shingles are in some item. Neither loses a leak: moving a
window on to its next such shingle loses none of the item's, and a window with
fewer cannot reach the threshold.

Words are runs of digits, letters and other non-ASCII characters of the
lower-cased text. Null and empty texts, and items or documents below five
words, have no shingle and no leak. An item is compared whole, however long;
only over ``MAX_ITEM`` shingles, which no row can hold, would it be searched in
parts of at least that many. Of rows repeating id and text, and of items
repeating an id, one finding is given per (doc_id, item_id); a null id is an id.
An empty table on either side gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import having_ids, small_enough, written

NARROW = 8192  # bags that simhash counts in lanes of 16 bits; larger ones have lanes of 32
MAX_ITEM = 1 << 28  # more shingles do not fit an array of Spark
_WORDS = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def with_shingles(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with their text column ``t`` replaced by ``sh``, the hashes of
    all runs of k words in order (none below k words)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col("t").cast("string"), F.lit(""))), F.lit(_WORDS), F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), F.size("_w") - k),
                       lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(k)]))
    return rows.withColumn("_w", words).withColumn(
        "sh", F.when(F.size("_w") >= k, runs).otherwise(F.array().cast("array<bigint>"))).drop("_w", "t")


def with_simhash(rows: DataFrame, name: str, bag: str = "bag", lane: int = 16) -> DataFrame:
    """Add the 64-bit SimHash of an array of hashes: bit i is set if it is in
    more than half of the array.

    ``lane`` longs count 64 / ``lane`` bit positions each, in lanes of that many
    bits. They are a column of their own, so they are summed once and read
    ``lane`` times. The lane's width does not change the fingerprint."""
    lanes = sum(1 << at for at in range(0, 64, lane))
    top = lane - 2
    zero = F.struct(*[F.lit(0).cast("long").alias(f"c{t}") for t in range(lane)])
    sums = F.aggregate(F.col(bag), zero, lambda acc, h: F.struct(*[
        (acc[f"c{t}"] + F.shiftright(h, t).bitwiseAND(F.lit(lanes))).alias(f"c{t}") for t in range(lane)]))
    rows = rows.withColumn("_sums", sums)
    # a lane over half carries into its bit ``top``
    rows = rows.withColumn("_carry", (F.lit(1 << top) - (F.floor(F.size(bag) / 2) + 1)).cast("long") * F.lit(lanes))
    bits = [F.shiftleft(F.shiftright(F.col("_sums")[f"c{t}"] + F.col("_carry"), top).bitwiseAND(F.lit(lanes)), t)
            for t in range(lane)]
    while len(bits) > 1:
        bits = [x.bitwiseOR(y) for x, y in zip(bits[::2], bits[1::2])]
    return rows.withColumn(name, bits[0]).drop("_sums", "_carry")


def class_of(size: Column, ratio: float) -> Column:
    """The largest class size that is not over ``size``."""
    step = F.floor(F.log(size) / F.log(F.lit(ratio)) + 1e-9)
    return F.least(size, F.greatest(F.lit(1), F.ceil(F.pow(F.lit(ratio), step) - 1e-9))).cast("int")


def blocks_of(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 1 blocks that tile 64 bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _block(print_: Column, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(print_, at).bitwiseAND(F.lit((1 << bits) - 1))


def _repeated(bag: Column) -> Column:
    """The shingles that occur more than once."""
    s = F.array_sort(bag)
    return F.array_distinct(F.array_compact(F.zip_with(
        s, F.slice(s, 2, F.greatest(F.lit(0), F.size(bag) - 1)), lambda x, y: F.when(x == y, x))))


def overlap(a: Column, b: Column) -> Column:
    """Sum over shingles of the lesser number of occurrences."""
    both = F.array_intersect(a, b)
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    more = F.aggregate(F.array_intersect(_repeated(a), _repeated(b)), F.lit(0), lambda acc, x: acc - 1 + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return F.when(plain, F.size(both)).otherwise(F.size(both) + more)


def text_leaks(docs: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8, radius: int = 19,
               ratio: float = 1.08, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, item_id, similarity, start_word, n_words) of every
    leak; the best window of each id, text (by its hash) and item."""
    items = with_shingles(benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("t")), k)
    parts = F.greatest(F.lit(1), F.floor(F.size("sh") / MAX_ITEM).cast("int"))  # the last has the remainder too
    items = items.withColumn("part", F.explode(F.sequence(F.lit(1), parts)))
    before = (F.col("part") - 1) * MAX_ITEM
    items = items.withColumn("bag", F.slice("sh", before + 1, F.when(F.col("part") < parts, F.lit(MAX_ITEM)).otherwise(
        F.size("sh") - before))).drop("sh", "part")
    items = items.withColumn("m", F.size("bag")).withColumn("size", class_of(F.greatest(F.lit(1), "m"), ratio))
    items = written(items, "benchmark-items").where("m > 0")
    wanted = written(items.select(F.explode("bag").alias("g")).distinct(), "benchmark-shingles")
    near = F.broadcast(wanted) if small_enough(wanted) else wanted
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most log(longest) / log(ratio)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    if not sizes:
        return docs.sparkSession.createDataFrame([], StructType([
            StructField("doc_id", docs.schema[id_col].dataType), StructField("text_key", LongType()),
            StructField("item_id", benchmark.schema[item_col].dataType),
            StructField("similarity", DoubleType()), StructField("start_word", IntegerType()),
            StructField("n_words", IntegerType())]))
    lane = 16 if max(sizes) * ratio < NARROW else 32  # an item is less than ratio times its class
    items = written(with_simhash(items, "item_print", lane=lane), "benchmark-prints")
    # documents with any shingle of the benchmark; then their texts once more
    # (a plain explode would add a filter on the size of sh, and compute sh for it again)
    some = with_shingles(source, k).select("doc_id", F.explode_outer("sh").alias("g")).join(near, "g", "left_semi")
    some = written(some.select("doc_id").distinct(), "benchmark-documents")
    own = having_ids(source, some, "doc_id", null_too=True).withColumn("text_key", F.xxhash64("t"))
    own = with_shingles(own, k).dropDuplicates(["doc_id", "text_key"])
    own = written(own.withColumn("key", F.xxhash64("doc_id", "text_key")), "benchmark-candidates")
    hits = own.select("key", F.posexplode("sh").alias("p", "g")).join(near, "g", "left_semi").groupBy("key").agg(
        F.array_sort(F.collect_list("p")).alias("hits"))
    # of a window that begins at the i-th hit, as many hits as needed are in it if the last of them is
    held = {n: max(1, math.ceil(n - (1 - threshold) * ratio * n - 1)) for n in sorted(sizes)}
    need = F.array(*[F.struct(F.lit(n).alias("size"), F.lit(h).alias("held")) for n, h in held.items()])
    enough = lambda p, i: F.filter(need, lambda s: F.get("hits", i + s["held"] - 1) < p + s["size"])["size"]
    starts = hits.select("key", F.explode(F.transform("hits", lambda p, i: F.struct(
        p.alias("p"), enough(p, i).alias("sizes")))).alias("s"))
    places = starts.select("key", "s.p", F.explode("s.sizes").alias("size"))
    # joined place by place: an explode holds all its rows at once, so none carries the shingles of a document
    windows = places.hint("merge").join(own.select("key", "sh"), "key").select(
        "key", "p", "size", F.slice("sh", F.col("p") + 1, F.col("size")).alias("bag"))
    windows = written(with_simhash(windows, "print", lane=lane).drop("bag"), "window-prints")
    blocks = blocks_of(radius)
    cut = lambda c: F.array(*[_block(F.col(c), at, bits) for at, bits in blocks])
    left = windows.select("key", "p", "size", "print", F.posexplode(cut("print")).alias("block", "value"))
    right = items.select("item_id", "size", "item_print", F.posexplode(cut("item_print")).alias("block", "value"),
                         "m", "bag")
    right = right.select(F.xxhash64("item_id", "bag").alias("item_key"), "size", "item_print", "block", "value", "m")
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    first = F.lit(True)  # a pair counts in the first block that it shares
    for b, (at, bits) in enumerate(blocks):
        first = first & ((F.col("block") <= b) | (_block(differ, at, bits) != 0))
    right = F.broadcast(right) if small_enough(right) else right
    pairs = left.join(right, ["size", "block", "value"]).where(
        (F.bit_count(differ) <= radius) & first).select("key", "p", "item_key", "m")
    pairs = written(pairs, "window-pairs")
    kinds = items.select(F.xxhash64("item_id", "bag").alias("item_key"), "item_id", "m", "bag").dropDuplicates(["item_key"])
    # windows first: rows with bags look small when compressed, and would be broadcast
    found = pairs.hint("merge").join(own.select("key", "doc_id", "text_key", "sh"), "key").select(
        "doc_id", "text_key", "item_key", "p", F.slice("sh", F.col("p") + 1, F.col("m")).alias("window")).join(
        kinds, "item_key")
    both = overlap(F.col("window"), F.col("bag"))
    found = found.withColumn("similarity", both / (F.size("window") + F.col("m") - both).cast("double"))
    best = F.max_by(F.struct("similarity", "p", F.size("window").alias("n")),
                    F.struct("similarity", -F.col("p"), -F.size("window")))
    found = found.where(F.col("similarity") >= threshold).groupBy("doc_id", "text_key", "item_id").agg(best.alias("b"))
    return found.select("doc_id", "text_key", "item_id", "b.similarity", F.col("b.p").alias("start_word"),
                        (F.col("b.n") + k - 1).alias("n_words"))


def leaks(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words) of every leak; the
    best window of each document and item. Parameters as of ``text_leaks``."""
    best = F.max_by(F.struct("similarity", "start_word", "n_words"),
                    F.struct("similarity", -F.col("start_word"), -F.col("n_words")))
    return text_leaks(docs, benchmark, **parameters).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.*")


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               whole_ids: bool = True, **parameters) -> DataFrame:
    """The rows of ``docs`` whose id leaks no item, with all their columns; or,
    without ``whole_ids``, those whose own text leaks none, whatever the other
    rows of their id hold."""
    found = text_leaks(docs, benchmark, id_col=id_col, text_col=text_col, **parameters)
    found = written(found.select("doc_id", *([] if whole_ids else ["text_key"])).distinct(), "leaking-ids")
    found = F.broadcast(found) if small_enough(found) else found
    same = docs[id_col].eqNullSafe(found["doc_id"])
    if not whole_ids:
        same &= F.xxhash64(docs[text_col]) == found["text_key"]
    return docs.join(found, same, "left_anti")

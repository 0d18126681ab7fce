"""Ordered scans within a key that do not put a whole key into one task.

A window ``partitionBy(key).orderBy(t)`` sends every row of a key to one task
and sorts it there; a key holding a third of the data would then run on one
core. Here the order is cut into *chunks* — a coarse, order-preserving
function of the order columns (for example the day of a timestamp). Each
``(key, chunk)`` is scanned locally by its own window, one small summary row
per ``(key, chunk)`` carries counts, sums and boundary values, a window over
those summary rows (one row per chunk, so the work per key is bounded by the
number of chunks, not by the rows) turns them into offsets, and the offsets
are joined back on ``(key, chunk)`` — the same keys the local window is
already hash-partitioned on, so the big side is not shuffled again.

With ``chunk=None`` the whole key is one chunk and the result is the plain
window (used in tests as the reference behaviour).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

CHUNK = "_chunk"
PLACE = "_place"


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def with_chunk(df: DataFrame, chunk: Column | None) -> DataFrame:
    return df.withColumn(CHUNK, chunk if chunk is not None else F.lit(0))


def quantile_chunk(df: DataFrame, col: str, n: int) -> Column:
    """Chunk number of a numeric column: ``n`` ranges of about equal counts.

    The n - 1 approximate quantiles come to the driver; a value's chunk is the
    number of them below it, found by bisection (0 for null)."""
    cuts = df.agg(F.percentile_approx(F.col(col).cast("double"), [i / n for i in range(1, n)], 100 * n)).first()[0]
    cuts = sorted(set(cuts or []))
    x, last = F.col(col).cast("double"), len(cuts)

    def below(lo: int, hi: int) -> Column:  # the number of cuts below x, known to be in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x > F.lit(cuts[mid]), below(mid + 1, hi)).otherwise(below(lo, mid))
    return below(0, last)


def local_window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def chunk_window(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(CHUNK)


def fill_forward_backward(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                          cols: Sequence[str], chunk: Column | None = None) -> DataFrame:
    """Within each key, in ``order``: replace a null by the last non-null value
    before it, and a still-null value (leading nulls) by the first non-null
    value after it. An all-null key stays null; non-null values never change.

    Rows whose key is null are passed through unfilled (a null key is no
    group). ``order`` must be a total order within the key.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    base = with_chunk(df, chunk)
    ordk = _order_struct(order)
    w = local_window(keys, order)
    prev_w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # "first non-null at or after the row" is the last non-null up to the row
    # in the reversed order: a growing frame, linear in the partition. (An
    # unbounded-following frame is re-aggregated for every row: quadratic.)
    # Descending with nulls last is the exact reverse of the ascending order.
    next_w = (Window.partitionBy(*keys, CHUNK).orderBy(*[F.col(c).desc() for c in order])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    summary_aggs = []
    for c in cols:
        has = F.col(c).isNotNull()
        summary_aggs.append(F.max_by(F.col(c), F.when(has, ordk)).alias(f"_last_{c}"))
        summary_aggs.append(F.min_by(F.col(c), F.when(has, ordk)).alias(f"_first_{c}"))
    summary = base.groupBy(*keys, CHUNK).agg(*summary_aggs)
    cw = chunk_window(keys)
    before = cw.rowsBetween(Window.unboundedPreceding, -1)
    # later chunks, nearest last: the reversed chunk order, growing frame
    after = (Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = summary.select(
        *keys, CHUNK,
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_f_{c}") for c in cols],
        *[F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_carry_b_{c}") for c in cols])

    scanned = base.select(
        "*",
        *[F.last(c, ignorenulls=True).over(prev_w).alias(f"_ff_{c}") for c in cols],
        *[F.last(c, ignorenulls=True).over(next_w).alias(f"_bf_{c}") for c in cols])
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    joined = scanned.join(offsets, on=[*keys, CHUNK], how="left")
    out = joined.select(
        *[c for c in df.columns if c not in cols],
        *[F.when(keyed, F.coalesce(F.col(f"_ff_{c}"), F.col(f"_carry_f_{c}"),
                                   F.col(f"_bf_{c}"), F.col(f"_carry_b_{c}")))
          .otherwise(F.col(c)).alias(c) for c in cols])
    return out.select(*df.columns)


def _whole(col: str, forward, keys: Sequence[str]) -> Column:
    """The sum over all chunks of a key as two growing frames: up to this chunk,
    and those after it in the reversed order."""
    back = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc())
    upto = F.sum(col).over(forward.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return upto + F.coalesce(F.sum(col).over(back.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


HOT_ROWS = 1_000_000  # rows of a key that one task may order


def fill_routed(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                chunk_col: str, hot_rows: int = HOT_ROWS, ranges: int = 64) -> DataFrame:
    """:func:`fill_forward_backward` for keys of very different sizes: one count per
    key (a partial aggregate) tells which exceed ``hot_rows``; only their rows go
    through chunks (``ranges`` of the numeric ``chunk_col``, the first of ``order``),
    the rest through one plain window each way."""
    keys, order, cols = list(keys), list(order), list(cols)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    hot = cut_lineage(df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > hot_rows).select(*keys))
    any_hot = not hot.isEmpty()
    cool = df.where(known)
    if any_hot:
        cool = cool.join(hot, keys, "left_anti")
    frame = (Window.unboundedPreceding, Window.currentRow)
    up = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
    down = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(*frame)
    out = cool.select("*", *[F.last(c, ignorenulls=True).over(up).alias(f"_ff_{c}") for c in cols],
                      *[F.last(c, ignorenulls=True).over(down).alias(f"_bf_{c}") for c in cols])
    out = out.select(*[F.coalesce(F.col(f"_ff_{c}"), F.col(f"_bf_{c}")).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
    if any_hot:
        rows = df.where(known).join(hot, keys, "left_semi")
        out = out.unionByName(fill_forward_backward(rows, keys, order, cols, quantile_chunk(rows, chunk_col, ranges)))
    return out.unionByName(df.where(~known))


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 cols: Sequence[str] = (), chunk: Column | None = None,
                 position: str | None = "_pos", size: str | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` (as ``cum_{c}``) and the 1-based
    position (``position``) of each row inside its key, in ``order``; on request
    the number of rows of the key (``size``), from the same chunk summary.
    ``keys`` may be empty (one global order); then only the per-chunk
    summary — one row per chunk — is ordered globally."""
    keys, order, cols = list(keys), list(order), list(cols)
    # key and chunk as one value that is never null: rows of a null key are kept, and the
    # join below finds the rows dealt as the window dealt them
    base = with_chunk(df, chunk).withColumn(PLACE, F.struct(*keys, CHUNK)).drop(CHUNK)
    summary = base.groupBy(PLACE).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in cols])
    summary = summary.select(*[F.col(PLACE)[c].alias(c) for c in [*keys, CHUNK]], *summary.columns)
    cw = (Window.partitionBy(*keys).orderBy(CHUNK) if keys else Window.orderBy(CHUNK))
    before = cw.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        F.col(PLACE).alias("_at"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        *([_whole("_n", cw, keys).alias("_of")] if size else []),
        *[F.sum(f"_s_{c}").over(before).alias(f"_o_{c}") for c in cols])
    w = Window.partitionBy(PLACE).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.select("*", F.row_number().over(w).alias("_rn"),
                        *[F.sum(c).over(run).alias(f"_l_{c}") for c in cols])
    joined = local.join(offsets, on=F.col(PLACE) == F.col("_at"), how="inner")
    sel = [*df.columns]
    if position:
        sel.append((F.col("_rn") + F.col("_n0")).cast("bigint").alias(position))
    if size:
        sel.append(F.col("_of").cast("bigint").alias(size))
    sel += [(F.col(f"_l_{c}") + F.coalesce(F.col(f"_o_{c}"), F.lit(0))).alias(f"cum_{c}") for c in cols]
    return joined.select(*sel)


def sorted_positions(df: DataFrame, order: Sequence[Column], chunk: Column | None = None,
                     position: str = "position") -> DataFrame:
    """Global 1-based position of each row in ``order`` (a list of sort
    Columns, nulls placement stated), computed with a chunked scan instead of
    a single-task global window. ``chunk`` must be non-decreasing in that order;
    without it, the rows are dealt to ranges of the whole sort key as Spark's own
    sort does (sampled bounds, ``spark.sql.shuffle.partitions`` ranges, small ones
    merged) and written once, and a range is a chunk."""
    if chunk is None:
        with_c = cut_lineage(df.repartitionByRange(*order).withColumn(CHUNK, F.spark_partition_id()))
    else:
        with_c = with_chunk(df, chunk)
    w = Window.partitionBy(CHUNK).orderBy(*order)
    summary = with_c.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = summary.select(CHUNK, F.coalesce(F.sum("_n").over(
        Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_n0"))
    local = with_c.select("*", F.row_number().over(w).alias("_rn"))
    out = local.join(offsets, on=CHUNK, how="inner")
    return out.select(*df.columns, (F.col("_rn") + F.col("_n0")).cast("bigint").alias(position))

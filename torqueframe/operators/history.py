"""Sales-history features per configuration.

For every sale, ordered by sell date inside its configuration:

* ``number_prev_sales`` = position − 1, ``prev_sales_check`` = position > 1
* ``last_score`` / ``last_margin`` / ``last_stock_days`` = previous sale's value
* ``average_score_dynamic`` = running mean of the score including the current
  sale, forced to 0 on the first sale
* ``average_score_dynamic_std`` = population std of that running mean over the
  whole configuration (constant per configuration)
* ``prev_average_score_dynamic[_std]`` = previous sale's value of the two above
* ``average/min/max/q1/median/q3_score_global`` over the whole configuration,
  future sales included (as the original computes them)
* configurations with a single sale get 0 in every history column, and every
  remaining null becomes 0.

Positions and running sums use the chunked scan of :mod:`.ordered`. The
per-sale rows are then written once (as Parquet), so the statistics
pass and the final join both read that copy instead of recomputing the
scan, the offsets and the windows. The per-configuration statistics are one
``groupBy`` with map-side partial aggregation. They are broadcast back to the rows when the number of
configurations (estimated first with one HyperLogLog pass over the key
columns) fits the broadcast threshold — the rows then keep their
(configuration, chunk) partitioning and are not shuffled again — and merge-
joined otherwise, with AQE splitting a skewed configuration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .joins import attach_per_group
from .ordered import CHUNK, chunk_window, local_window, with_chunk
from .quantiles import exact_quantiles as bracketed_quantiles

PERCENTILE_ROWS = 1_000_000  # sales of a configuration whose scores one buffer may hold

HISTORY_COLUMNS = [
    "prev_sales_check", "number_prev_sales", "last_score", "last_margin", "last_stock_days",
    "average_score_dynamic", "average_score_dynamic_std", "prev_average_score_dynamic",
    "prev_average_score_dynamic_std", "average_score_global", "min_score_global",
    "max_score_global", "q3_score_global", "median_score_global", "q1_score_global",
]


def without_configuration(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows have a null key, and so no history."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return df.agg(F.count_if(~known).alias("without_configuration"))


def config_history(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   score: str = "new_score", margin: str = "margem_percentagem",
                   days: str = "stock_days", chunk: Column | None = None,
                   exact_quantiles: bool = True) -> DataFrame:
    """Append :data:`HISTORY_COLUMNS` to ``df``.

    ``keys`` is the configuration, ``order`` a total order of sales inside it
    (sell date first, then a unique tie-break). ``chunk`` must be a
    non-decreasing function of ``order`` (e.g. ``to_date(sell_date)``).
    Rows with a null key are dropped (a null key is no configuration;
    :func:`without_configuration` counts them).

    Quantiles are exact. Where some configuration has more than
    ``PERCENTILE_ROWS`` sales they come from :func:`.quantiles.exact_quantiles`,
    whose state is bounded, else from Spark's ``percentile``; the values are equal.
    """
    keys, order = list(keys), list(order)
    notnull = F.lit(True)
    for k in keys:
        notnull = notnull & F.col(k).isNotNull()
    base = with_chunk(df.filter(notnull), chunk)
    ordk = F.struct(*[F.col(c) for c in order])
    x = F.col(score).cast("double")

    # 1. one summary row per (configuration, chunk) → offsets from earlier chunks
    summary = base.groupBy(*keys, CHUNK).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(x).alias("_s"),
        F.max_by(F.struct(x.alias("v"), F.col(margin).cast("double").alias("m"),
                          F.col(days).cast("double").alias("d")), ordk).alias("_tail"))
    before = chunk_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *keys, CHUNK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s0"),
        F.lag("_tail", 1).over(chunk_window(keys)).alias("_prev_tail"))

    # 2. local scan inside each chunk, shifted by the offsets; the offsets
    #    join uses the (configuration, chunk) partitioning the window needs
    w = local_window(keys, order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.join(offsets, on=[*keys, CHUNK], how="inner").select(
        "*",
        F.row_number().over(w).alias("_rn"),
        F.sum(x).over(run).alias("_cs"),
        F.lag(x, 1).over(w).alias("_lv"),
        F.lag(F.col(margin).cast("double"), 1).over(w).alias("_lm"),
        F.lag(F.col(days).cast("double"), 1).over(w).alias("_ld"))
    pos = (F.col("_rn") + F.col("_n0")).cast("bigint")
    cum = F.col("_cs") + F.col("_s0")
    first_local = F.col("_rn") == 1
    rows = local.select(
        *df.columns,
        pos.alias("_pos"),
        (pos - 1).alias("number_prev_sales"),
        F.when(pos > 1, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("prev_sales_check"),
        F.when(first_local, F.col("_prev_tail.v")).otherwise(F.col("_lv")).alias("last_score"),
        F.when(first_local, F.col("_prev_tail.m")).otherwise(F.col("_lm")).alias("last_margin"),
        F.when(first_local, F.col("_prev_tail.d")).otherwise(F.col("_ld")).alias("last_stock_days"),
        F.when(pos == 1, F.lit(0.0)).otherwise(cum / pos).alias("average_score_dynamic"),
        # running mean at the previous sale: S(i-1)/(i-1), 0 at the 2nd sale
        F.when(pos == 1, F.lit(None).cast("double")).when(pos == 2, F.lit(0.0))
         .otherwise((cum - x) / (pos - 1)).alias("prev_average_score_dynamic"))

    # 3. whole-configuration statistics, partially aggregated before the
    #    shuffle; attached with a broadcast when the number of
    #    configurations (checked first) is small enough, else a merge join
    rows = stored(rows)
    aggs = [F.count(F.lit(1)).alias("_size"), F.stddev_pop("average_score_dynamic").alias("_dyn_std"),
            F.avg(x).alias("_avg"), F.min(x).alias("_min"), F.max(x).alias("_max")]
    qs = [0.75, 0.5, 0.25]
    # positions run to the size of the configuration
    largest = rows.agg(F.max("_pos")).first()[0] or 0 if exact_quantiles else 0
    if largest > PERCENTILE_ROWS:
        found = bracketed_quantiles(rows.withColumn("_x", x), keys, "_x", qs).select(
            *keys, F.array("q0", "q1", "q2").alias("_q"))
        stats = rows.groupBy(*keys).agg(*aggs).join(found, keys, "left")
    else:
        q = F.percentile(x, qs) if exact_quantiles else F.percentile_approx(x, qs, 10000).cast("array<double>")
        stats = rows.groupBy(*keys).agg(*aggs, q.alias("_q"))
    out = attach_per_group(rows, stats, keys, bytes_per_group=160)
    multi = F.col("_size") > 1

    def hist(c: Column) -> Column:
        return F.when(multi, c)

    out = out.select(
        *df.columns,
        hist(F.col("prev_sales_check")).alias("prev_sales_check"),
        hist(F.col("number_prev_sales")).alias("number_prev_sales"),
        hist(F.col("last_score")).alias("last_score"),
        hist(F.col("last_margin")).alias("last_margin"),
        hist(F.col("last_stock_days")).alias("last_stock_days"),
        hist(F.col("average_score_dynamic")).alias("average_score_dynamic"),
        hist(F.col("_dyn_std")).alias("average_score_dynamic_std"),
        hist(F.col("prev_average_score_dynamic")).alias("prev_average_score_dynamic"),
        hist(F.when(F.col("_pos") > 1, F.col("_dyn_std"))).alias("prev_average_score_dynamic_std"),
        hist(F.col("_avg")).alias("average_score_global"),
        hist(F.col("_min")).alias("min_score_global"),
        hist(F.col("_max")).alias("max_score_global"),
        hist(F.col("_q")[0]).alias("q3_score_global"),
        hist(F.col("_q")[1]).alias("median_score_global"),
        hist(F.col("_q")[2]).alias("q1_score_global"))
    ints = {"prev_sales_check", "number_prev_sales"}
    return out.select(*df.columns, *[
        F.coalesce(F.col(c), F.lit(0).cast("bigint" if c in ints else "double")).alias(c)
        for c in HISTORY_COLUMNS])

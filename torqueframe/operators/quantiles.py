"""Exact quantiles of groups of any size.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer.
Here a sketch (``percentile_approx``, bounded state) brackets each wanted rank; the
rows in the bracket are counted, and the next round sketches only them. A bracket
of one value is the answer; one of at most ``FEW`` rows is sorted. A round narrows a
bracket about ``STEPS / 3`` times, so three rounds do for any table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, stored

FEW = 100_000
STEPS = 200
ACCURACY = 10_000
ROUNDS = 8


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, qs: Sequence[float]) -> DataFrame:
    """``keys``, then ``q0``, ``q1``, ...: the quantiles ``qs`` of the non-null values
    of ``col`` in each group, linearly interpolated between ranks. Null keys are a
    group; a group without values has no row."""
    keys = list(keys)
    # read twice a round: the input may be a join
    rows = stored(df.where(F.col(col).isNotNull()).select(*keys, (F.col(col).cast("double") + 0.0).alias("_x")))
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    # two ranks (from 0) for every quantile
    at = [F.floor(F.lit(float(q)) * (F.col("_n") - 1)) for q in qs]
    wanted = F.array(*[F.struct(F.lit(2 * i + j).alias("t"), F.least(a + j, F.col("_n") - 1).cast("long").alias("rank"))
                       for i, a in enumerate(at) for j in (0, 1)])
    state = state.withColumn("_w", F.explode(wanted)).select(
        *keys, "_n", "_lo", "_hi", F.col("_w.t").alias("_t"), F.col("_w.rank").alias("_rank"), F.col("_n").alias("_m"))
    state = cut_lineage(state)

    small = state.count() <= FEW  # a few rows a group: the rows themselves then stay where they are

    def inside(targets: DataFrame) -> DataFrame:
        t = targets.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            same = same & rows[k].eqNullSafe(t[f"_k_{k}"])
        return rows.join(F.broadcast(t) if small else t, same & (rows["_x"] >= t["_lo"]) & (rows["_x"] <= t["_hi"])).drop(
            *[f"_k_{k}" for k in keys])

    wide = (F.col("_lo") < F.col("_hi")) & (F.col("_m") > FEW)
    for _ in range(ROUNDS):
        active = state.where(wide)
        if active.isEmpty():
            break
        grid = [i / STEPS for i in range(STEPS + 1)]
        sketch = inside(active).groupBy(*keys, "_t", "_rank", "_lo", "_hi", "_m").agg(
            F.percentile_approx("_x", grid, ACCURACY).alias("_s"))
        place = F.floor((F.col("_rank") + 0.5) / F.col("_m") * STEPS).cast("int")
        low = F.element_at("_s", F.greatest(place - 1, F.lit(0)) + 1)
        high = F.element_at("_s", F.least(place + 2, F.lit(STEPS)) + 1)
        bracket = cut_lineage(sketch.select(*keys, "_t", "_rank", "_lo", "_hi", "_m",
                                            F.greatest(low, F.col("_lo")).alias("_nlo"), F.least(high, F.col("_hi")).alias("_nhi")))
        told = inside(bracket).groupBy(*keys, "_t", "_rank", "_lo", "_hi", "_m", "_nlo", "_nhi").agg(
            F.count_if(F.col("_x") < F.col("_nlo")).alias("_below"),
            F.count_if((F.col("_x") >= F.col("_nlo")) & (F.col("_x") <= F.col("_nhi"))).alias("_in"))
        # a rank outside what the sketch promised keeps its old bracket
        ok = (F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_in"))
        narrowed = told.select(
            *keys, "_t", F.when(ok, F.col("_rank") - F.col("_below")).otherwise(F.col("_rank")).alias("_rank"),
            F.when(ok, F.col("_nlo")).otherwise(F.col("_lo")).alias("_lo"),
            F.when(ok, F.col("_nhi")).otherwise(F.col("_hi")).alias("_hi"),
            F.when(ok, F.col("_in")).otherwise(F.col("_m")).alias("_m"))
        state = cut_lineage(state.where(~wide).select(*keys, "_t", "_rank", "_lo", "_hi", "_m").unionByName(narrowed))
    one = state.where("_lo = _hi").select(*keys, "_t", F.col("_lo").alias("_v"))
    w = Window.partitionBy(*keys, "_t").orderBy("_x")
    sorted_ = inside(state.where("_lo < _hi")).withColumn("_r", F.row_number().over(w) - 1).where("_r = _rank").select(
        *keys, "_t", F.col("_x").alias("_v"))
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = one.unionByName(sorted_).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_t", "_v"))).alias("_v"))
    own = n.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    found = found.join(own, same)
    out = []
    for i, q in enumerate(qs):
        place = F.lit(float(q)) * (F.col("_n") - 1)
        a, b = F.col("_v")[F.lit(2 * i)], F.col("_v")[F.lit(2 * i + 1)]
        out.append((a + (b - a) * (place - F.floor(place))).alias(f"q{i}"))
    return found.select(*keys, *out)

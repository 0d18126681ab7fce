"""After-sales visit operators: fill within a vehicle, warranty and contract
flags, abandonment, regular-visit percentage (E1, B17–B20, D22–D23)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DAYS_PER_YEAR, whole_days
from .ordered import fill_forward_backward

# Warranty years per brand code.
WARRANTY_YEARS = {101: 5, 701: 2}


def fill_within(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                chunk: Column | None = None) -> DataFrame:
    """Forward then backward fill inside each key."""
    return fill_forward_backward(df, [key], order, cols, chunk)


def warranty_table(spark: SparkSession, years: Mapping[int, int] = WARRANTY_YEARS) -> DataFrame:
    return spark.createDataFrame([(int(k), int(v)) for k, v in years.items()],
                                 "nlr_code bigint, warranty_years bigint")


def warranty_flags(df: DataFrame, years: DataFrame, arrival: str = "vehicle_in_date",
                   reg_dates: Sequence[str] = ("registration_date_pse", "registration_date_vhe"),
                   code: str = "nlr_code",
                   outs: Sequence[str] = ("warranty_visit_pse", "warranty_visit_vhe")) -> DataFrame:
    """Keep the brand codes of the years table (B19) and flag a visit 1 when
    ``arrival < registration + 365·years days`` (strict), 0 otherwise, null
    when the registration date or the arrival is null (B17, B18). The years
    table has one row per brand code and is broadcast."""
    y = F.broadcast(years.select(F.col(code).alias("_code"), F.col("warranty_years").alias("_wy")))
    out = df.join(y, df[code] == y["_code"], "inner")
    for reg, name in zip(reg_dates, outs):
        limit = F.timestamp_add("DAY", F.col("_wy") * 365, F.col(reg))
        flag = (F.when(F.col(reg).isNull() | F.col(arrival).isNull(), F.lit(None))
                .when(F.col(arrival) < limit, F.lit(1)).otherwise(F.lit(0)))
        out = out.withColumn(name, flag.cast("bigint"))
    return out.drop("_code", "_wy")


def contract_flag(df: DataFrame, arrival: str = "vehicle_in_date", end: str = "cm_date_end",
                  age: str = "anos_viatura", years: str = "cm_years", kms: str = "kms",
                  km_limit: str = "cm_km", out: str = "contract_visit") -> DataFrame:
    """1 when ``arrival <= end and age <= years and kms <= km_limit``, null
    when there is no contract end or no arrival, else 0 (B20). The contract
    start is not tested, as in the original."""
    cond = (F.col(arrival) <= F.col(end)) & (F.col(age) <= F.col(years)) & (F.col(kms) <= F.col(km_limit))
    flag = (F.when(F.col(end).isNull() | F.col(arrival).isNull(), F.lit(None))
            .when(cond, F.lit(1)).otherwise(F.lit(0)))
    return df.withColumn(out, flag.cast("bigint"))


def abandoned_per_group(df: DataFrame, keys: Sequence[str], as_of, arrival: str = "vehicle_in_date",
                        years: float = 2.0, out: str = "abandoned") -> DataFrame:
    """Per group: null if any arrival is null, else 0 when the last visit is
    at most ``years`` (whole days / 365.25) before ``as_of``, else 1 (D22).
    Groups with a null key are dropped."""
    keys = list(keys)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    g = df.filter(cond).groupBy(*keys).agg(
        F.max(arrival).alias("_last"),
        F.bool_or(F.col(arrival).isNull()).alias("_has_null"))
    yrs = whole_days(F.col("_last"), as_of_c) / F.lit(DAYS_PER_YEAR)
    flag = (F.when(F.col("_has_null"), F.lit(None))
            .when(yrs <= F.lit(years), F.lit(0)).otherwise(F.lit(1)))
    return g.select(*keys, flag.cast("bigint").alias(out))


def regular_percentage(df: DataFrame, keys: Sequence[str], as_of, reg_date: str,
                       arrival: str = "vehicle_in_date", out: str = "regular",
                       tie_break: Sequence[str] = ()) -> DataFrame:
    """Per group (D23): expected visits = years from the registration date of
    the earliest visit to ``as_of`` minus 1. Null registration → status
    ``NULL``; expected < 1 → status ``<2years``; else status ``pct`` with
    ``min(100, visits / expected · 100)``. Two typed columns replace the
    original's mixed column: ``{out}_status`` and ``{out}_pct``. The earliest visit is the first by
    arrival (nulls last), then ``tie_break``."""
    keys = list(keys)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    g = df.filter(cond).groupBy(*keys).agg(
        F.min_by(F.col(reg_date), F.struct(F.col(arrival).isNull(), F.col(arrival),
                                           *[F.col(c) for c in tie_break])).alias("_reg"),
        F.count(F.lit(1)).alias("_n"))
    expected = whole_days(F.col("_reg"), as_of_c) / F.lit(DAYS_PER_YEAR) - F.lit(1.0)
    status = (F.when(F.col("_reg").isNull(), F.lit("NULL"))
              .when(expected < 1, F.lit("<2years")).otherwise(F.lit("pct")))
    pct = F.when(expected >= 1, F.least(F.lit(100.0), F.col("_n") / expected * F.lit(100.0)))
    return g.select(*keys, status.alias(f"{out}_status"), pct.alias(f"{out}_pct"))

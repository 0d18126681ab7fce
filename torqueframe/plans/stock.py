"""Option extraction to one scored row per vehicle (entry 2 of the original:
text clean → per-vehicle features → colour names → drop unknown → stock days,
margin %, score → date parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_parts, whole_days
from ..functions.numeric import ratio
from ..functions.text import COLOUR_REPLACEMENTS, INTERIOR_REPLACEMENTS, remove_suffix_text, replace_chain
from ..operators import clean, joins, options, score, vocab
from ..session import stored


PRICE_ONLY = "preço de venda"  # fixed value: the option text of a price line
MODEL_SUFFIX = " - não utilizar"  # fixed value


def clean_lines(lines: DataFrame, drop=("cdint", "cdcor")) -> DataFrame:
    """B12, H3–H5, B4, B9 on raw option lines: lower-case texts, no price-only
    lines, no model suffix, symbols of interior and colour replaced, code
    columns dropped, and lines with any missing value left out."""
    low = lines.withColumns({c: F.lower(c) for c in ("opcional", "cor", "interior")})
    out = clean.exclude_values(low, "opcional", [PRICE_ONLY])
    out = out.withColumns({
        "modelo": remove_suffix_text("modelo", MODEL_SUFFIX),
        "interior": replace_chain("interior", INTERIOR_REPLACEMENTS),
        "cor": replace_chain("cor", COLOUR_REPLACEMENTS)})
    return clean.drop_nulls(clean.drop_columns(out, list(drop)))


def vehicle_table(spark: SparkSession, lines: DataFrame, meta: DataFrame, vehicle: str,
                  line_order, sell_col: str, feature_kwargs: dict) -> DataFrame:
    """``lines``: raw option lines with ``opcional, cor, interior, modelo,
    custo`` and ``sell_col`` (cleaned here first); ``meta``: per vehicle ``buy_date`` and
    ``margem``. Vehicles with an unknown colour are dropped (B13)."""
    feats = options.vehicle_features(clean_lines(lines), vehicle, line_order, "opcional", "cor", "interior",
                                     "modelo", "custo", extra_aggs=[F.max(sell_col).alias("sell_date")],
                                     **feature_kwargs)
    canon = joins.mapping_table(spark, vocab.COLOUR_CANONICAL)
    v = joins.lookup_replace(feats, "cor_exterior", canon)
    v = joins.lookup_replace(v, "cor_interior", canon)
    v = v.filter(F.col("cor_interior").isNotNull() & F.col("cor_exterior").isNotNull())
    v = v.join(meta, on=vehicle, how="left")
    v = v.withColumn("stock_days", whole_days("buy_date", "sell_date")) \
         .withColumn("margem_percentagem", ratio(F.col("margem"), F.col("price_total")) * F.lit(100.0))
    # min-max scaling is two passes (global min/max, then every row): write
    # the per-vehicle rows once so neither pass re-reads and re-aggregates
    # the option lines
    v = score.minmax_score(stored(v))
    return v.select("*", *date_parts("buy", "buy_date"), *date_parts("sell", "sell_date"))

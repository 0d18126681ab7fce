"""Registered queries: each binds operators to the shared test tables.

Every callable takes ``(spark, folder)`` and returns a DataFrame over the
whole tables. Doubles are rounded to 6 digits in the output so results can
be compared with the SQL oracle across engines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import encode, history, metrics, ordered, profile, sampling, score, select
from . import standins as si
from ..functions.text import last_n, strip_char
from ..operators import clean, joins
from ..operators import visits as V
from . import segmentation as seg
from ..operators import options
from . import stock
from ..functions.dates import date_from_parts, date_parts
from ..functions.classes import keep_or_other as _keep_or_other
from ..functions.numeric import ratio
from ..functions.text import INTERIOR_REPLACEMENTS, remove_suffix_text, replace_chain
from ..operators import report, clustering
from ..operators import models as M
from ..session import cut_lineage, ensure_checkpoint_dir, stored
from . import modelling as ML
from ..operators import grouped, lloyd, neighbors, neighbour_info, pivots, quantiles
from ..operators.prepare import Preparation
from . import runs
from . import training as T

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def query_as(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- sales / history
@query
def config_history(spark: SparkSession, d: str) -> DataFrame:
    """E2–E8 per configuration, ordered by sell date (flagship)."""
    s = si.sales(spark, d)
    # chunk = (sell date, range of 2^20 order keys): non-decreasing in the sale
    # order, and a configuration hot on one day is split without limit
    chunk = F.struct(F.to_date("sell_date").alias("day"), F.floor(F.col("l_orderkey") / (1 << 20)).alias("keys"))
    h = history.config_history(s, si.CONFIG, si.SALE_ORDER, score="new_score",
                               margin="margem_percentagem", days="stock_days", chunk=chunk)
    return rounded(h.select(*si.SALE_KEY, *si.CONFIG, "new_score", *history.HISTORY_COLUMNS))


@query
def config_summary(spark: SparkSession, d: str) -> DataFrame:
    """Sales count, mean margin, truncated mean days per configuration."""
    s = si.sales(spark, d)
    out = score.group_summary(s, si.CONFIG)
    return rounded(out.select(*si.SALE_KEY, *si.CONFIG, F.col("nr_cars_sold").cast("bigint").alias("nr_cars_sold"),
                              "average_percentage_margin", "average_stock_days"))


@query
def stock_days(spark: SparkSession, d: str) -> DataFrame:
    """Whole days between buy and sell."""
    s = si.sales(spark, d)
    return rounded(s.select(*si.SALE_KEY, "buy_date", "sell_date", "stock_days"))


@query
def binary_target(spark: SparkSession, d: str) -> DataFrame:
    """new_score = days <= limit and margin >= 3.5 (limits as parameters)."""
    s = si.sales(spark, d)
    return s.groupBy("new_score").agg(F.count(F.lit(1)).alias("n"))


@query
def minmax_score(spark: SparkSession, d: str) -> DataFrame:
    """Global min–max scaling and score."""
    s = si.sales(spark, d)
    out = score.minmax_score(s)
    return rounded(out.select(*si.SALE_KEY, "stock_days_norm", "inv_stock_days_norm",
                              "margem_percentagem_norm", "score"))


@query
def bucket_classes(spark: SparkSession, d: str) -> DataFrame:
    """Right-closed stock, margin and score classes."""
    s = score.minmax_score(si.sales(spark, d), keep_norms=False)
    out = score.bucket_classes(s.withColumn("margem_percentagem", F.col("margem_percentagem") / 20))
    return out.groupBy("stock_class1", "stock_class2", "margem_class1", "score_class") \
              .agg(F.count(F.lit(1)).alias("n"))


@query
def zscore_pop(spark: SparkSession, d: str) -> DataFrame:
    """Z-scores with the population std over the whole table."""
    s = si.sales(spark, d)
    out = score.zscore_population(s, ["stock_days", "margem_percentagem", "l_extendedprice"], suffix="_z")
    return rounded(out.select(*si.SALE_KEY, "stock_days_z", "margem_percentagem_z", "l_extendedprice_z"))


@query
def alt_scaling(spark: SparkSession, d: str) -> DataFrame:
    """(max·x+1)/(x+1) and its min–max normalisation."""
    s = si.sales(spark, d)
    out = score.alternative_day_scalings(s)
    return rounded(out.select(*si.SALE_KEY, "stock_days_norm_2", "stock_days_norm_3"))


@query
def probit_scaling(spark: SparkSession, d: str) -> DataFrame:
    """H25 third scaling: probit(exponential CDF(days)); null where the CDF is 1."""
    s = si.sales(spark, d)
    out = score.alternative_day_scalings(s)
    return rounded(out.select(*si.SALE_KEY, "stock_days", "stock_days_norm_4"))


@query
def tick_labels(spark: SparkSession, d: str) -> DataFrame:
    """Inverted normalised stock days as 4-decimal labels."""
    s = si.sales(spark, d).select("stock_days").distinct()
    return score.tick_labels(s, "stock_days")


@query
def category_means(spark: SparkSession, d: str) -> DataFrame:
    """Mean score, stock days and margin per category."""
    s = score.minmax_score(si.sales(spark, d), keep_norms=False)
    return rounded(score.category_means(s, "cfg_type", ["score", "stock_days", "margem_percentagem"]))


@query
def pearson_margin_days(spark: SparkSession, d: str) -> DataFrame:
    """Pearson r of margin and stock days."""
    return rounded(metrics.pearson(si.sales(spark, d), "margem_percentagem", "stock_days"))


@query
def one_hot(spark: SparkSession, d: str) -> DataFrame:
    """One-hot columns of the part type."""
    s = si.sales(spark, d).select(*si.SALE_KEY, "cfg_type")
    return encode.one_hot(s, ["cfg_type"])


@query
def reverse_one_hot(spark: SparkSession, d: str) -> DataFrame:
    """Rebuild the colour word from its one-hot block."""
    s = si.sales(spark, d).select(*si.SALE_KEY, "cfg_colour")
    oh = encode.one_hot(s, ["cfg_colour"])
    return encode.reverse_one_hot(oh, ["cfg_colour"], strip="")


_FEATURES = ["stock_days", "margem_percentagem", "l_linenumber", "l_extendedprice"]


@query
def chi2_score(spark: SparkSession, d: str) -> DataFrame:
    """K6: chi² of non-negative features against new_score."""
    return rounded(select.chi2_scores(si.sales(spark, d), _FEATURES, "new_score"))


@query
def anova_f(spark: SparkSession, d: str) -> DataFrame:
    """K7: ANOVA F of features across new_score classes."""
    return rounded(select.anova_f_scores(si.sales(spark, d), _FEATURES, "new_score"))


@query
def mutual_info(spark: SparkSession, d: str) -> DataFrame:
    """K8: mutual information of discrete features and new_score."""
    s = si.sales(spark, d).withColumn("stock_years", F.floor(F.col("stock_days") / 365))
    return rounded(select.mutual_info_scores(s, ["stock_years", "margem_percentagem", "l_linenumber"],
                                             "new_score"))


@query
def k_best_columns(spark: SparkSession, d: str) -> DataFrame:
    """keep the 2 best feature columns by ANOVA F, in long form
    (sale key, feature, value) so the output shape does not depend on the
    chosen names."""
    s = si.sales(spark, d)
    kept = select.select_k_best(s, select.anova_f_scores(s, _FEATURES, "new_score"), 2, keep=si.SALE_KEY)
    feats = [c for c in kept.columns if c not in si.SALE_KEY]
    long = kept.select(*si.SALE_KEY, *[F.col(c).cast("double").alias(c) for c in feats]).unpivot(
        si.SALE_KEY, feats, "feature", "value")
    return rounded(long)


# Stand-in targets for the one-target drop (B15): the sales table carries the
# real target and two alternative ones.
_TARGETS = ["new_score", "fast_sale", "high_margin"]


@query
def keep_one_target(spark: SparkSession, d: str) -> DataFrame:
    """Drop every target column but one (here ``fast_sale``)."""
    s = si.sales(spark, d).select(
        *si.SALE_KEY, "stock_days", "margem_percentagem", "new_score",
        (F.col("stock_days") <= 90).cast("bigint").alias("fast_sale"),
        (F.col("margem_percentagem") >= 5).cast("bigint").alias("high_margin"))
    return rounded(clean.keep_one_target(s, "fast_sale", _TARGETS))


@query
def cast_back(spark: SparkSession, d: str) -> DataFrame:
    """Columns that came back from resampling as double / string are
    cast to the types of the original table."""
    s = si.sales(spark, d).select(*si.SALE_KEY, "stock_days", "margem_percentagem", "new_score")
    resampled = s.select(*si.SALE_KEY, F.col("stock_days").cast("double").alias("stock_days"),
                         "margem_percentagem", F.col("new_score").cast("string").alias("new_score"))
    return rounded(clean.cast_like(resampled, s))


@query
def top_k_rank(spark: SparkSession, d: str) -> DataFrame:
    """features ranked by ANOVA F, top 3."""
    return rounded(select.rank_scores(select.anova_f_scores(si.sales(spark, d), _FEATURES, "new_score"), k=3))


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    """K3: deterministic 75/25 split per class in md5 order."""
    s = si.sales(spark, d).withColumn("sale_id", F.concat_ws(":", *si.SALE_KEY))
    out = sampling.stratified_split(s, "new_score", "sale_id", 0.25, seed=2)
    return out.select("sale_id", "new_score", "is_train")


@query
def oversample(spark: SparkSession, d: str) -> DataFrame:
    """K4: random over-sampling to the largest class, per-row copy counts."""
    s = si.sales(spark, d).withColumn("sale_id", F.concat_ws(":", *si.SALE_KEY))
    out = sampling.oversample(s, "new_score", "sale_id", seed=42)
    return out.groupBy("sale_id", "new_score").agg(F.count(F.lit(1)).alias("copies"))


@query
def undersample(spark: SparkSession, d: str) -> DataFrame:
    """K5: random under-sampling to the smallest class."""
    s = si.sales(spark, d).withColumn("sale_id", F.concat_ws(":", *si.SALE_KEY))
    return sampling.undersample(s, "new_score", "sale_id", seed=42).select("sale_id", "new_score")


# ---------------------------------------------------------------- visits / segmentation


@query
def normalise_keys(spark: SparkSession, d: str) -> DataFrame:
    """H1/H2: plate without dashes, chassis reduced to its last 7 characters."""
    v = si.visits(spark, d)
    r = F.col("registration_number")
    dashed = F.concat(F.substring(r, 1, 2), F.lit("-"), F.substring(r, 3, 2), F.lit("-"), F.substring(r, 5, 10))
    return v.select("o_orderkey", strip_char(dashed, "-").alias("registration_number"),
                    last_n("chassis_number", 7).alias("chassis_number"))


@query
def null_safe_exclude(spark: SparkSession, d: str) -> DataFrame:
    """Drop accounts 4 and 6, keep null accounts."""
    v = si.visits(spark, d).select("o_orderkey", "slr_document_account")
    return clean.exclude_values(v, "slr_document_account", [4, 6])


# Stand-in exclusion lists for B11: customer names containing these strings
# and two provenance codes (a null provenance is kept).
_EXCLUDED_NAME_PARTS = ["11", "7"]
_EXCLUDED_PROVENANCE = [701, 999]


@query
def model_exclusions(spark: SparkSession, d: str) -> DataFrame:
    """Drop names containing any listed part and two provenance codes,
    null-safe."""
    v = si.visits(spark, d).select("o_orderkey", "customer", "nlr_code")
    return clean.exclude_substrings(v, "customer", _EXCLUDED_NAME_PARTS,
                                    null_safe_col="nlr_code", excluded=_EXCLUDED_PROVENANCE)


@query
def unmatched_plates(spark: SparkSession, d: str) -> DataFrame:
    """Plates seen in visits that have no contract (set difference)."""
    return joins.values_not_in(si.visits(spark, d), si.contracts(spark, d), ["registration_number"])


@query
def key_error_flag(spark: SparkSession, d: str) -> DataFrame:
    """Drop null plates, flag wrong length and placeholder plates."""
    v = si.visits(spark, d)
    plate = F.when(F.col("priority") == "3-MEDIUM", F.substring("registration_number", 2, 10)) \
             .otherwise(F.col("registration_number"))
    v = v.select("o_orderkey", plate.alias("registration_number"))
    return clean.registration_flag(v)


@query
def sales_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """Plate of length 6, account not in 6/4/0/1 (null kept), total > 0."""
    v = si.visits(spark, d).select("o_orderkey", "registration_number",
                                   F.col("slr_document_account").cast("string").alias("slr_account"), "total")
    return rounded(clean.sales_cleanup(v))


@query
def ffill_bfill(spark: SparkSession, d: str) -> DataFrame:
    """Forward then backward fill of priority and registration date
    within each plate, in visit order."""
    v = si.visits(spark, d).select("o_orderkey", "registration_number", "priority", "registration_date_pse")
    # a plate of over a million visits goes through 64 ranges of the order key
    return ordered.fill_routed(v, ["registration_number"], ["o_orderkey"], ["priority", "registration_date_pse"],
                               "o_orderkey")


@query
def contract_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Visits left-joined to contracts on the plate, removal date
    overriding the end date, colliding columns taken from the left."""
    v = si.visits(spark, d).select("o_orderkey", "registration_number", "chassis_number")
    c = seg.contracts_clean(si.contracts(spark, d))
    return rounded(joins.left_join_drop_collisions(v, c, ["registration_number"]))


@query
def tail_key_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Left join on the 7-character chassis; null keys do not match."""
    v = si.visits(spark, d).select("o_orderkey", last_n("chassis_number", 7).alias("chassis_number"))
    c = si.contracts(spark, d).select("chassis_number", "cm_years")
    return rounded(joins.left_join_null_keys(v, c, "chassis_number"))


@query
def semi_membership(spark: SparkSession, d: str) -> DataFrame:
    """C4: contracts whose chassis visits brand 701; count and distinct chassis of that brand."""
    v = si.visits(spark, d).where(F.col("nlr_code") == 701).select(last_n("chassis_number", 7).alias("chassis_number"))
    c = si.contracts(spark, d).select("chassis_number")
    return joins.semi_membership_counts(c, v, "chassis_number")


@query
def warranty_flag(spark: SparkSession, d: str) -> DataFrame:
    """Warranty visit flags for the two brand codes."""
    v = si.visits(spark, d)
    out = V.warranty_flags(v, V.warranty_table(spark))
    return out.select("o_orderkey", "nlr_code", "warranty_visit_pse", "warranty_visit_vhe")


@query
def contract_flag(spark: SparkSession, d: str) -> DataFrame:
    """Contract visit flag after the contract join."""
    v = si.visits(spark, d).drop("chassis_number")
    j = joins.left_join_drop_collisions(v, seg.contracts_clean(si.contracts(spark, d)), ["registration_number"])
    return V.contract_flag(j).select("o_orderkey", "contract_visit")


@query
def abandoned_flag(spark: SparkSession, d: str) -> DataFrame:
    """Abandoned per (customer, plate) as of 2001-08-01."""
    return V.abandoned_per_group(si.visits(spark, d), ["customer", "registration_number"], si.AS_OF)


@query
def regular_pct(spark: SparkSession, d: str) -> DataFrame:
    """Regular-visit percentage per (customer, plate)."""
    v = si.visits(spark, d)
    return rounded(V.regular_percentage(v, ["customer", "registration_number"], si.AS_OF,
                                        "registration_date_pse", tie_break=["o_orderkey"]))


@query
def joinback_agg(spark: SparkSession, d: str) -> DataFrame:
    """Per-group abandonment joined back to the visits."""
    v = si.visits(spark, d)
    ab = V.abandoned_per_group(v, ["customer", "registration_number"], si.AS_OF)
    return joins.join_back(v.select("o_orderkey", "customer", "registration_number"), ab,
                           ["customer", "registration_number"])


@query
def segmentation_flags(spark: SparkSession, d: str) -> DataFrame:
    """Entry 1 end to end: warranty, contract and abandonment flags per visit."""
    v = si.visits(spark, d).drop("chassis_number")
    out = seg.segmentation(v, si.contracts(spark, d), V.warranty_table(spark), si.AS_OF)
    return out.select("o_orderkey", "warranty_visit_pse", "warranty_visit_vhe", "contract_visit", "abandoned")


@query
def visit_merge(spark: SparkSession, d: str) -> DataFrame:
    """Entry 1, first half: both visit extracts cleaned, filled, joined to
    their contracts by plate or chassis, stacked and sorted."""
    v, c = si.raw_visits(spark, d), si.contracts(spark, d)
    out = seg.visit_merge(v.where(F.col("nlr_code") == 101), v.where(F.col("nlr_code") == 701),
                          c.drop("chassis_number"), seg.contracts_clean(c.drop("registration_number")), "o_orderkey")
    return rounded(out.select(
        "position", "o_orderkey", *seg.SORT_KEYS, "chassis_number", "registration_number_error_flag",
        "registration_date_pse", "nlr_code", "cm_years", "cm_km", "cm_date_start", "cm_date_end"))


# ---------------------------------------------------------------- option lines / vehicles

_FEATURE_KW = dict(flag_words=si.FLAG_WORDS, exterior_vocab=si.EXTERIOR_VOCAB,
                   interior_vocab=si.INTERIOR_VOCAB, model_lead=si.MODEL_LEAD)


def _vehicles(spark, d, lines=None, **kw):
    kwargs = dict(_FEATURE_KW)
    kwargs.update(kw)
    return options.vehicle_features(si.option_lines(spark, d) if lines is None else lines, "l_orderkey", si.LINE_ORDER,
                                    "opcional", "cor", "interior", "modelo", "custo", **kwargs)


@query
def token_flags(spark: SparkSession, d: str) -> DataFrame:
    """H7: equipment flags per vehicle from option-line tokens."""
    return _vehicles(spark, d).select("l_orderkey", *si.FLAG_WORDS)


@query
def first_vocab_match(spark: SparkSession, d: str) -> DataFrame:
    """H8: exterior colour = first vocabulary word in the first line."""
    return _vehicles(spark, d).select("l_orderkey", "cor_exterior")


@query
def ruleset_override(spark: SparkSession, d: str) -> DataFrame:
    """H9: interior colour, as coded and with the intended rule list."""
    a = _vehicles(spark, d).select("l_orderkey", F.col("cor_interior").alias("cor_interior_as_coded"))
    b = _vehicles(spark, d, ruleset="intended").select("l_orderkey", F.col("cor_interior").alias("cor_interior_intended"))
    return a.join(b, "l_orderkey")


@query
def last_line_max(spark: SparkSession, d: str) -> DataFrame:
    """Wheel size of the last line naming one, largest in that line."""
    return _vehicles(spark, d).select("l_orderkey", "jantes")


@query
def model_shorten(spark: SparkSession, d: str) -> DataFrame:
    """Shortened model of the first line."""
    return _vehicles(spark, d).select("l_orderkey", "modelo")


@query
def price_total(spark: SparkSession, d: str) -> DataFrame:
    """Summed line cost per vehicle."""
    return rounded(score.price_total(si.option_lines(spark, d), "l_orderkey", "custo"))


@query
def margin_pct(spark: SparkSession, d: str) -> DataFrame:
    """Vehicle margin over the vehicle's summed cost, on every line."""
    lines = si.option_lines(spark, d).join(si.orders_meta(spark, d), "l_orderkey")
    out = score.margin_percentage(lines, "l_orderkey", "custo", "margem")
    return rounded(out.select("l_orderkey", *si.LINE_ORDER[:-1], "margem_percentagem"))


@query
def first_per_key(spark: SparkSession, d: str) -> DataFrame:
    """First option line of each vehicle (keep-first de-duplication)."""
    lines = si.option_lines(spark, d).select("l_orderkey", *si.LINE_ORDER, "opcional", "custo")
    return rounded(options.first_per_key(lines, "l_orderkey", si.LINE_ORDER))


@query
def unmapped_report(spark: SparkSession, d: str) -> DataFrame:
    """Unknown exterior colours: one row per raw value, with the lines
    and vehicles that it removes."""
    lines = si.option_lines(spark, d).withColumn("cor_first", F.lower("cor"))
    feats = _vehicles(spark, d, lines=lines, first_line_cols=["cor_first"])
    return profile.unmapped_report(feats, "cor_exterior", "cor_first", "n_lines")


@query
def vehicle_scores(spark: SparkSession, d: str) -> DataFrame:
    """Entry 2 end to end: one scored feature row per vehicle."""
    lines = si.raw_option_lines(spark, d)
    v = stock.vehicle_table(spark, lines, si.orders_meta(spark, d), "l_orderkey", si.LINE_ORDER,
                            "l_shipdate", _FEATURE_KW)
    return rounded(v.select("l_orderkey", *si.FLAG_WORDS, "cor_exterior", "cor_interior", "jantes", "modelo",
                            "price_total", "stock_days", "margem_percentagem", "score",
                            "buy_day", "buy_month", "buy_year", "sell_day", "sell_month", "sell_year"))


@query
def vehicle_handover(spark: SparkSession, d: str) -> DataFrame:
    """A5: cleaned option lines handed over once as a table bucketed by vehicle; totals (D1), margin
    percentage (D2) and first line (E9) read it without an exchange."""
    from ..sources.tables import bucketed
    lines = stock.clean_lines(si.raw_option_lines(spark, d)).join(
        si.orders_meta(spark, d).select("l_orderkey", "margem"), "l_orderkey")
    own = bucketed(lines, "l_orderkey", spark.sparkContext.defaultParallelism, si.LINE_ORDER)
    totals = own.groupBy("l_orderkey").agg(F.sum("custo").alias("price_total"), F.first("margem").alias("margem"))
    totals = totals.withColumn("margem_percentagem", ratio(F.col("margem"), F.col("price_total")) * 100.0)
    first = options.first_per_key(own, "l_orderkey", si.LINE_ORDER).select("l_orderkey", "opcional")
    return rounded(totals.join(first, "l_orderkey").drop("margem"))


# ---------------------------------------------------------------- profiles, sets, sorts


def _visits_profiled(spark, d):
    v = si.visits(spark, d)
    return v.select("customer", "registration_number", "vehicle_in_date", "nlr_code", "kms",
                    "slr_document_account", "priority", F.lit(1).cast("bigint").alias("source_rank"))


@query
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts per priority, nulls excluded."""
    return profile.value_counts(si.visits(spark, d), "priority")


@query
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    """Type, null count and null % per column."""
    return rounded(profile.null_profile(_visits_profiled(spark, d)))


@query
def zero_profile(spark: SparkSession, d: str) -> DataFrame:
    """Count and % of zeros per column."""
    return rounded(profile.zero_profile(_visits_profiled(spark, d)))


@query
def constant_columns(spark: SparkSession, d: str) -> DataFrame:
    """Distinct non-null values per column (1 = constant)."""
    return clean.constant_column_table(_visits_profiled(spark, d))


@query
def distinct_count(spark: SparkSession, d: str) -> DataFrame:
    """Number of distinct plates."""
    return profile.distinct_count(si.visits(spark, d), "registration_number")


@query
def union_missing_cols(spark: SparkSession, d: str) -> DataFrame:
    """Union of two extracts by name; missing columns become null."""
    v = si.visits(spark, d)
    a = v.filter(F.col("nlr_code") == 101).select("o_orderkey", "registration_number", "kms",
                                                  F.lit(1).cast("bigint").alias("source_rank"))
    b = v.filter(F.col("nlr_code") == 701).select("o_orderkey", "registration_number", "total",
                                                  F.lit(2).cast("bigint").alias("source_rank"))
    return rounded(a.unionByName(b, allowMissingColumns=True))


@query
def sort_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    """Key columns first, rows sorted by them ascending with nulls
    last; the global position is part of the result."""
    v = clean.move_first(si.visits(spark, d).select("o_orderkey", "customer", "slr_document_account",
                                                    "registration_number"),
                         ["customer", "slr_document_account", "registration_number"])
    order = [F.asc_nulls_last("customer"), F.asc_nulls_last("slr_document_account"),
             F.asc_nulls_last("registration_number"), F.asc("o_orderkey")]
    return ordered.sorted_positions(v, order)


@query
def head_preview(spark: SparkSession, d: str) -> DataFrame:
    """first five visits after an explicit sort."""
    v = si.visits(spark, d).select("o_orderkey", "customer", "vehicle_in_date")
    return v.orderBy(F.desc_nulls_last("vehicle_in_date"), F.asc("o_orderkey")).limit(5)


@query
def keep_or_other(spark: SparkSession, d: str) -> DataFrame:
    """Keep listed priorities, others → 'outros', null stays."""
    v = si.visits(spark, d)
    return v.select("o_orderkey", _keep_or_other("priority", ["1-URGENT", "2-HIGH"]).alias("priority_new"))


_COLOUR_GROUPS = [("warm", ["red", "hot"]), ("cool", ["blue", "cold"]), ("size", ["large", "small"]),
                  ("outros", ["red", "new"])]


@query
def group_map(spark: SparkSession, d: str) -> DataFrame:
    """List grouping; a value in two lists takes the later one,
    unlisted values → null."""
    s = si.sales(spark, d).select(*si.SALE_KEY, "cfg_colour")
    return options.group_map(s, "cfg_colour", options.group_table(spark, _COLOUR_GROUPS))


@query
def lookup_map(spark: SparkSession, d: str) -> DataFrame:
    """Canonical names by lookup, unmapped values kept."""
    s = si.sales(spark, d).select(*si.SALE_KEY, "cfg_colour")
    t = joins.mapping_table(spark, {"red": "vermelho", "blue": "azul", "old": "antigo"})
    return joins.lookup_replace(s, "cfg_colour", t)


@query_as("date_parts")
def date_parts_query(spark: SparkSession, d: str) -> DataFrame:
    """Day, month, year of buy and sell dates, and the sell date
    rebuilt from its parts."""
    s = si.sales(spark, d).select(*si.SALE_KEY, "buy_date", "sell_date")
    s = s.select(*si.SALE_KEY, *date_parts("buy", "buy_date"), *date_parts("sell", "sell_date"))
    return s.withColumn("sell_date_rebuilt", date_from_parts("sell_year", "sell_month", "sell_day"))


@query
def symbol_replace(spark: SparkSession, d: str) -> DataFrame:
    """H3/H4/H5: lower-case, ordered symbol replacement and suffix removal on
    whole document texts; length and md5 of the result."""
    t = table_docs(spark, d)
    out = replace_chain(F.lower("text"), INTERIOR_REPLACEMENTS)
    out = remove_suffix_text(out, " - não utilizar")
    return t.select("doc_id", F.length(out).cast("bigint").alias("n_chars_clean"), F.md5(out).alias("md5_clean"))


def table_docs(spark, d):
    from ..sources.tables import table
    return table(spark, d, "documents")


# ---------------------------------------------------------------- metrics
def _predictions(spark, d):
    from ..sources.tables import table
    lab = table(spark, d, "labels")
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id").select("doc_id", F.col("quality").alias("gt"),
                                           F.col("toxic").alias("pred"), F.col("n_chars").cast("double").alias("score"))


@query
def confusion(spark: SparkSession, d: str) -> DataFrame:
    """Confusion counts with row-normalised rates."""
    return rounded(metrics.confusion_counts(_predictions(spark, d), "gt", "pred", normalize=True))


@query
def binary_confusion(spark: SparkSession, d: str) -> DataFrame:
    """TN, FP, FN, TP and specificity."""
    return rounded(metrics.binary_confusion(_predictions(spark, d), "gt", "pred"))


@query
def f1_report(spark: SparkSession, d: str) -> DataFrame:
    """Micro and macro F1 over predicted labels, accuracy."""
    return rounded(metrics.f1_summary(_predictions(spark, d), "gt", "pred"))


@query
def class_report(spark: SparkSession, d: str) -> DataFrame:
    """Precision, recall, F1, support per class and weighted average."""
    return rounded(metrics.class_report(_predictions(spark, d), "gt", "pred"))


@query
def roc_points(spark: SparkSession, d: str) -> DataFrame:
    """ROC points per distinct score threshold."""
    return rounded(metrics.roc_points(_predictions(spark, d), "gt", "score"))


@query
def auc(spark: SparkSession, d: str) -> DataFrame:
    """Area under the ROC curve."""
    return rounded(metrics.auc(_predictions(spark, d), "gt", "score"))


def _priced_lines(spark, d):
    from ..sources.tables import table
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey)


@query
def mse_r2(spark: SparkSession, d: str) -> DataFrame:
    """MSE and R² of list price × quantity against the line price (in
    thousands)."""
    j = _priced_lines(spark, d).select((F.col("l_extendedprice") / 1000).alias("y"),
                                       (F.col("l_quantity") * F.col("p_retailprice") / 1000).alias("pred"))
    return rounded(metrics.mse_r2(j, "y", "pred"))


@query
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Pearson correlation of all pairs of line measures."""
    from ..sources.tables import table
    li = table(spark, d, "lineitem")
    return rounded(metrics.correlation_matrix(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query
def simple_regression(spark: SparkSession, d: str) -> DataFrame:
    """K26 (one feature): slope and intercept of price on quantity."""
    j = _priced_lines(spark, d)
    return rounded(j.agg(F.regr_slope("l_extendedprice", "l_quantity").alias("slope"),
                         F.regr_intercept("l_extendedprice", "l_quantity").alias("intercept")))


@query
def dense_calendar_total(spark: SparkSession, d: str) -> DataFrame:
    """Orders per month × priority on a dense calendar plus month totals."""
    from ..sources.tables import table
    o = table(spark, d, "orders")
    return report.monthly_counts_dense(o, "o_orderdate", "o_orderpriority", "1995-01-01", "2001-08-01")


@query
def silhouette_squared(spark: SparkSession, d: str) -> DataFrame:
    """Squared-Euclidean silhouette per vector, clusters = labels."""
    from ..sources.tables import table
    e = table(spark, d, "embeddings")
    return rounded(clustering.silhouette_samples(e, "embedding", "label", "vec_id"))


@query
def cluster_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Vectors per cluster."""
    from ..sources.tables import table
    return clustering.cluster_sizes(table(spark, d, "embeddings"), "label")


@query
def sigmoid_values(spark: SparkSession, d: str) -> DataFrame:
    """Logistic function and its derivative of the scaled margin."""
    from ..functions.numeric import sigmoid
    s = si.sales(spark, d).select(*si.SALE_KEY, (F.col("margem_percentagem") - 5).alias("x"))
    return rounded(s.select(*si.SALE_KEY, sigmoid("x").alias("sig"),
                            sigmoid(sigmoid("x"), derivative=True).alias("sig_deriv")))


# ---------------------------------------------------------------- modelling (checked in SQL)


def _sale_id(s: DataFrame) -> DataFrame:
    return s.withColumn("sale_id", F.concat_ws(":", *[F.col(c).cast("string") for c in si.SALE_KEY]))


def _split_sales(spark, d) -> DataFrame:
    """Key, id and class of every sale, split; written before the split, which reads
    its rows twice, and after it, as weights and folds read them again."""
    s = stored(_sale_id(si.sales(spark, d)).select(*si.SALE_KEY, "sale_id", "new_score"))
    return stored(sampling.stratified_split(s, "new_score", "sale_id", 0.25, seed=2))


@query
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    """K9: balanced class weight of every training row of the split."""
    s = _split_sales(spark, d)
    return rounded(M.balanced_weights(s.where("is_train = 1"), "new_score").select(*si.SALE_KEY, "new_score", "weight"))


@query
def cv_folds(spark: SparkSession, d: str) -> DataFrame:
    """K9: stratified fold of every training row, dealt after the split."""
    s = _split_sales(spark, d)
    folds = M.stratified_folds(s.where("is_train = 1"), "new_score", "sale_id", k=10, seed=42)
    return rounded(folds.select(*si.SALE_KEY, "new_score", F.col("fold").cast("bigint").alias("fold")))


def _member(s: DataFrame, p) -> DataFrame:
    """A fixed rule as a member's table of class-1 probabilities."""
    return s.select(*si.SALE_KEY, "sale_id", "new_score", p.cast("double").alias("proba_1"))


def _member_rows(spark, d) -> DataFrame:
    """What the members read of every sale, written once for all of them."""
    return stored(_sale_id(si.sales(spark, d)).select(
        *si.SALE_KEY, "sale_id", "new_score", "margem_percentagem", "stock_days"))


def _members(s: DataFrame) -> dict[str, DataFrame]:
    return {"margin": _member(s, F.least(F.lit(1.0), F.col("margem_percentagem") / 10)),
            "days": _member(s, F.greatest(F.lit(0.0), 1 - F.col("stock_days") / 1000)),
            "price": _member(s, F.when(F.col("l_extendedprice") > 30000, 0.75).otherwise(0.25))}


@query
def soft_vote(spark: SparkSession, d: str) -> DataFrame:
    """Soft vote (mean class-1 probability) over three fixed members."""
    m = _members(_member_rows(spark, d))
    vote = M.average_probability(list(m.values()), "sale_id")
    return rounded(vote.join(m["days"].select("sale_id", *si.SALE_KEY), "sale_id").select(
        *si.SALE_KEY, "proba_0", "proba_1", "score_class_pred"))


@query
def run_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Tagged metric rows of three runs, gathered into one table."""
    rows = None
    for name, t in _members(_member_rows(spark, d)).items():
        pred = t.select(F.col("new_score").cast("double").alias("score_class_gt"),
                        (F.col("proba_1") > 0.5).cast("double").alias("score_class_pred"))
        r = ML.metrics_rows(spark, ML.run_tag("classification", name, "new_score", "recall"), ML.evaluate(pred))
        rows = r if rows is None else rows.unionByName(r)
    wide = report.metrics_pivot(rows, ["approach", "model", "target", "scoring"], "metric", "value",
                                ["accuracy", "macro_f1", "micro_f1", "specificity"])
    return rounded(wide)


@query
def regression_coefficients(spark: SparkSession, d: str) -> DataFrame:
    """Coefficient table of margin % on stock days and price (in thousands)."""
    s = si.sales(spark, d).select("margem_percentagem", F.col("stock_days").cast("double").alias("stock_days"),
                                  (F.col("l_extendedprice") / 1000).alias("price_k"))
    feats = ["stock_days", "price_k"]
    model = M.linear_regression(M.assemble(s, feats), "margem_percentagem")
    return M.coefficient_table(spark, model, feats).withColumn("coefficient", F.round("coefficient", 5))


# ---------------------------------------------------------------- modelling (rows-only checks)

_FOLDS = 10
_TARGET = "new_score"


def _model_rows(spark, d):
    lines = si.raw_option_lines(spark, d)
    v = stock.vehicle_table(spark, lines, si.orders_meta(spark, d), "l_orderkey", si.LINE_ORDER,
                            "l_shipdate", _FEATURE_KW)
    v = v.drop(*[c for c in v.columns if c.endswith("_norm") or c == "score"])
    return ML.modelling_rows(spark, si.with_places(v, spark, d), "l_orderkey", si.GROUPS, si.EXCLUDED_MODELS,
                             new_score_days=si.NEW_SCORE_DAYS)


def _model_data(spark, d):
    data = ML.prepared(_model_rows(spark, d), "l_orderkey", _TARGET, folds=_FOLDS)
    return data.train, data.test, data.model.features


@query
def prepared_features(spark: SparkSession, d: str) -> DataFrame:
    """K1: cleanup, groups, history, split, scales and category lists of training rows, the 12 best
    features by ANOVA F, oversampling: every non-zero feature of every prepared row."""
    data = ML.prepared(_model_rows(spark, d), "l_orderkey", _TARGET, k_features=12, criterion="anova_f", oversample=True)
    names = F.array(*[F.lit(f) for f in data.model.features])
    rows = data.train.select("l_orderkey", F.lit("train").alias("part"), "copy_index", "features").unionByName(
        data.test.select("l_orderkey", F.lit("test").alias("part"), F.lit(0).cast("bigint").alias("copy_index"), "features"))
    long = rows.select("l_orderkey", "part", "copy_index",
                       F.explode(F.arrays_zip(names.alias("feature"), vector_to_array_col("features").alias("value"))).alias("f"))
    return rounded(long.select("l_orderkey", "part", "copy_index", "f.feature", "f.value").where("value <> 0"))


@query
def run_report(spark: SparkSession, d: str) -> DataFrame:
    """Three runs of fixed rules written to a run store, one of them twice; class
    report, metric and rank rows as they are read back."""
    store = runs.RunStore(spark, f"{ensure_checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}")
    rows = _member_rows(spark, d)
    scores = select.anova_f_scores(rows, ["stock_days", "margem_percentagem", "l_extendedprice"], _TARGET)
    ranks = cut_lineage(select.rank_scores(scores.withColumn("score", F.round("score", 6))))
    members = _members(rows)
    for name in [*members, "margin"]:
        pred = members[name].select(F.col("new_score").cast("string").alias("score_class_gt"),
                                    (F.col("proba_1") > 0.5).cast("int").cast("string").alias("score_class_pred"))
        tag = ML.run_tag("classification", name, _TARGET, "recall")
        tables = runs.evaluation_tables(pred)
        tables["performance"] = ML.evaluate(pred.select(*[F.col(c).cast("double") for c in pred.columns]))
        store.write(tag, {**tables, "importances": ranks})
    report = store.read("class_report").selectExpr(
        "model", "'class' AS kind", "class AS name",
        "stack(4, 'precision', precision, 'recall', recall, 'f1_score', f1_score, 'support', CAST(support AS DOUBLE)) AS (metric, value)")
    perf = store.read("performance").selectExpr(
        "model", "'run' AS kind", "'all' AS name",
        "stack(4, 'micro_f1', micro_f1, 'macro_f1', macro_f1, 'accuracy', accuracy, 'specificity', specificity) AS (metric, value)")
    rank = store.read("importances").selectExpr("model", "'feature' AS kind", "feature AS name", "'rank' AS metric",
                                                "CAST(rank AS DOUBLE) AS value")
    return rounded(report.unionByName(perf).unionByName(rank))


@query
def run_flow(spark: SparkSession, d: str) -> DataFrame:
    """Prepare with oversampling, fit the tree, evaluate, write the run; its predictions of
    training and test rows as read back."""
    store = runs.RunStore(spark, f"{ensure_checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}")
    data = ML.prepared(_model_rows(spark, d), "l_orderkey", _TARGET, oversample=True, folds=_FOLDS)
    runs.run_classification(store, data, "dt")
    return store.read("predictions").drop("run")


def _classifier(spark, d, name):
    train, test, feats = _model_data(spark, d)
    return T.fit(name, train, _TARGET, "l_orderkey", len(feats)), test, feats


_KEPT = ["l_orderkey", "score", "stock_days", "margem_percentagem"]


def _register_classifier(name, key=None):
    def q(spark: SparkSession, d: str) -> DataFrame:
        found, test, _ = _classifier(spark, d, key or name)
        return T.predictions(found.model, test, _TARGET, keep=_KEPT)
    q.__name__ = f"classifier_{name}"
    q.__doc__ = f"K9–K18/K20: {name}, the whole grid on ten stratified folds, test predictions."
    return query(q)


for _n in ["dt", "rf", "lr", "svm", "gc", "bayes", "neural", "bagging"]:
    _register_classifier(_n)
_register_classifier("adaboost", "ab")


@query
def classifier_voting(spark: SparkSession, d: str) -> DataFrame:
    """Soft vote (mean class-1 probability) of the best model of seven families."""
    train, test, feats = _model_data(spark, d)
    return T.predictions(T.vote(train, _TARGET, "l_orderkey", len(feats)).model, test, _TARGET, keep=["l_orderkey"])


@query
def feature_importance_dt(spark: SparkSession, d: str) -> DataFrame:
    """Ranked feature importances of the best decision tree."""
    found, _, feats = _classifier(spark, d, "dt")
    rows = [(f, float(v)) for f, v in zip(feats, found.model.importance)]
    return select.rank_scores(spark.createDataFrame(rows, "feature string, importance double"), "importance", "feature")


@query
def performance_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Performance row of the decision tree as tagged metric rows."""
    found, test, _ = _classifier(spark, d, "dt")
    pred = T.predictions(found.model, test, _TARGET)
    return ML.metrics_rows(spark, ML.run_tag("classification", "dt", _TARGET, "recall"), ML.evaluate(pred))


@query
def kmeans_clusters(spark: SparkSession, d: str) -> DataFrame:
    """K-means (k=10, best of 50 starts) on the training rows, test rows assigned,
    cluster sizes and mean silhouette per cluster."""
    train, test, _ = _model_data(spark, d)
    km = lloyd.kmeans(train, k=10, n_init=50)
    assigned = km.transform(test).select("l_orderkey", "cluster", vector_to_array_col("features").alias("v"))
    sil = clustering.silhouette_samples(assigned, "v", "cluster", "l_orderkey")
    return sil.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.avg("silhouette").alias("silhouette_avg"))


def vector_to_array_col(c):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(c)


@query
def gap_statistic(spark: SparkSession, d: str) -> DataFrame:
    """Gap statistic for k = 1..29 on z-scored price, days and margin, with the k it names."""
    s = score.zscore_population(si.sales(spark, d), ["stock_days", "margem_percentagem", "l_extendedprice"])
    return lloyd.gap_statistic(s, ["stock_days", "margem_percentagem", "l_extendedprice"], range(1, 30))


@query
def linear_regression(spark: SparkSession, d: str) -> DataFrame:
    """Linear regression of margin % on the features; train/test MSE and R²."""
    lines = si.raw_option_lines(spark, d)
    v = stock.vehicle_table(spark, lines, si.orders_meta(spark, d), "l_orderkey", si.LINE_ORDER,
                            "l_shipdate", _FEATURE_KW)
    ft = ML.feature_table(v, "l_orderkey", new_score_days=si.NEW_SCORE_DAYS)
    feats = [f for f in ML.numeric_features(ft, ["l_orderkey", "n_lines", "margem", *ML.TARGETS, "buy_day",
                                                 "buy_year", "sell_day", "sell_month", "sell_year"])]
    s = sampling.stratified_split(ft, "new_score", "l_orderkey", 0.25, seed=2)
    s = cut_lineage(M.assemble(s, feats))
    model = M.linear_regression(s.filter("is_train = 1"), "margem_percentagem")
    out = []
    for part, flag in [("train", 1), ("test", 0)]:
        pred = model.transform(s.filter(f"is_train = {flag}"))
        out.append(metrics.mse_r2(pred, "margem_percentagem", "prediction").withColumn("part", F.lit(part)))
    return out[0].unionByName(out[1]).withColumn("n_coefficients", F.lit(len(model.coefficients)))


@query
def per_group_models(spark: SparkSession, d: str) -> DataFrame:
    """One decision tree per sales place, split and searched within the place; its best
    parameters and its performance on the place's test rows."""
    fitted, pred = _place_models(spark, d)
    perf = grouped.grouped_performance(pred)
    return rounded(fitted.select("group", "n_train", "parameters", "score").join(perf, "group"))


def _place_rows(spark, d) -> DataFrame:
    """Prepared rows with their place; split and folds are dealt within (place, class)."""
    rows = _model_rows(spark, d).withColumn("_stratum", F.concat_ws("|", "local_da_venda_new", _TARGET))
    return sampling.stratified_split(rows.where("local_da_venda_new is not null"), "_stratum", "l_orderkey", 0.25, seed=2)


def _place_models(spark, d):
    s = cut_lineage(_place_rows(spark, d))
    train, test = s.where("is_train = 1"), s.where("is_train = 0")
    numeric = ["navegacao", "sensores", "caixa_auto", *[c for c in history.HISTORY_COLUMNS if c not in ML.SCALED]]
    encoded = [c for c in ML.ENCODED if c != "local_da_venda_new"]
    prep = Preparation(encoded, ML.SCALED, numeric).fit(train, _TARGET)
    train = M.stratified_folds(prep.transform(train), "_stratum", "l_orderkey", k=_FOLDS, seed=42)
    fitted = cut_lineage(grouped.grouped_trees(train, "local_da_venda_new", _TARGET, folds=_FOLDS,
                                               min_rows=T.PLACE_LEAVES, depths=T.PLACE_DEPTHS))
    return fitted, grouped.grouped_predictions(prep.transform(test), fitted, "local_da_venda_new", "l_orderkey", _TARGET)


# ---------------------------------------------------------------- nearest neighbours


@query
def knn_vote(spark: SparkSession, d: str) -> DataFrame:
    """5-nearest-neighbour vote for the held-out quarter of the vectors
    (stratified by label), neighbours from the other three quarters."""
    from ..sources.tables import table
    e = table(spark, d, "embeddings")
    # the split is written once (reliable checkpoint); train and test then
    # meet again in one plan without re-deriving the split twice
    s = cut_lineage(sampling.stratified_split(e, "label", "vec_id", 0.25, seed=2))
    train, test = s.filter("is_train = 1"), s.filter("is_train = 0")
    vote = neighbors.knn_vote(train, test, "embedding", "vec_id", "label", k=5)
    return vote.join(test.select("vec_id", "label"), "vec_id")


@query
def knn_grid(spark: SparkSession, d: str) -> DataFrame:
    """Cross-validated accuracy of the nearest-neighbour vote for k = 1..49 from one search
    of a pivot index over the training vectors."""
    from ..sources.tables import table
    e = table(spark, d, "embeddings")
    train = sampling.stratified_split(e, "label", "vec_id", 0.25, seed=2).where("is_train = 1")
    train = cut_lineage(M.stratified_folds(train, "label", "vec_id", k=10, seed=42))
    return rounded(pivots.knn_grid(train, "embedding", "vec_id", "label"))


@query
def mutual_info_continuous(spark: SparkSession, d: str) -> DataFrame:
    """K8: mutual information of continuous features and new_score by the nearest-neighbour estimator."""
    return rounded(neighbour_info.mutual_info_continuous(
        si.sales(spark, d), ["stock_days", "margem_percentagem", "l_extendedprice"], "new_score"))


@query
def group_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact quartiles and decile of price per class, without a value map per group."""
    s = si.sales(spark, d).select("new_score", "l_extendedprice")
    return rounded(quantiles.exact_quantiles(s, ["new_score"], "l_extendedprice", [0.25, 0.5, 0.75, 0.9]))


@query
def sparse_encoding(spark: SparkSession, d: str) -> DataFrame:
    """Every part number one-hot encoded as a sparse block (no bound on the categories),
    reversed through its metadata and counted."""
    from ..sources.tables import table
    li = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("part"))
    back = encode.reverse_sparse(encode.sparse_one_hot(li, ["part"]).transform(li), ["part"])
    return back.groupBy("part", "part_value").agg(F.count(F.lit(1)).alias("n"))


@query
def category_groups(spark: SparkSession, d: str) -> DataFrame:
    """Colour, wheel and model groups of every vehicle with the
    dealer group lists; raw columns dropped."""
    lines = si.raw_option_lines(spark, d)
    v = stock.vehicle_table(spark, lines, si.orders_meta(spark, d), "l_orderkey", si.LINE_ORDER,
                            "l_shipdate", _FEATURE_KW)
    v = v.select("l_orderkey", "cor_exterior", "cor_interior", "jantes", "modelo")
    return options.category_groups(spark, v)


@query
def last7_key(spark: SparkSession, d: str) -> DataFrame:
    """H1: last 7 characters of the chassis number (short and null pass)."""
    v = si.visits(spark, d)
    return v.select("o_orderkey", "chassis_number", last_n("chassis_number", 7).alias("chassis_7"))


@query
def coalesce_update(spark: SparkSession, d: str) -> DataFrame:
    """The removal date overrides the contract end date."""
    c = si.contracts(spark, d)
    return joins.coalesce_update(c, "cm_date_end", "cm_date_removal").select("registration_number", "cm_date_end")


@query
def regular_pct_vhe(spark: SparkSession, d: str) -> DataFrame:
    """D23, second variant: regular-visit percentage from the vhe date."""
    v = si.visits(spark, d)
    return rounded(V.regular_percentage(v, ["customer", "registration_number"], si.AS_OF,
                                        "registration_date_vhe", tie_break=["o_orderkey"]))


@query
def undo_oversample(spark: SparkSession, d: str) -> DataFrame:
    """Original rows recovered after over-sampling (copy_index = 0),
    counted per class."""
    s = si.sales(spark, d).withColumn("sale_id", F.concat_ws(":", *si.SALE_KEY))
    out = sampling.oversample(s, "new_score", "sale_id", seed=42).filter("copy_index = 0")
    return out.groupBy("new_score").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sale_id").alias("n_ids"))

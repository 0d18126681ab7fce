"""Modelling flow (entry 3 of the original): vehicle table → cleanup →
targets → category groups → classes → history → zero fill → stratified split →
preparation learned from training rows → oversampling → model → evaluation
tables (K1, K2, K21)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classes import binary_target
from ..operators import clean, encode, history, metrics, models, options, sampling, score
from ..operators.prepare import Preparation, PreparationModel
from ..session import cut_lineage, stored

CONFIG7 = ["navegacao", "sensores", "caixa_auto", "cor_exterior", "cor_interior", "jantes", "modelo"]
TARGETS = ["margem_percentagem", "stock_days", "score", "stock_class1", "stock_class2", "margem_class1",
           "score_class", "new_score"]

# What the original leaves out before modelling, and its columns.
EXCLUDED_MODELS = ["Série", "Z4", "MINI"]
EXCLUDED_PROVENANCE = ["Demonstração", "Em utilização"]
CONFIG_NEW = ["navegacao", "sensores", "caixa_auto", "cor_exterior_new", "cor_interior_new", "jantes_new", "modelo_new"]
ENCODED = ["jantes_new", "cor_interior_new", "cor_exterior_new", "local_da_venda_new", "modelo_new", "prov_new",
           "buy_day", "buy_month", "buy_year"]
SCALED = ["price_total", "number_prev_sales", "last_margin", "last_stock_days"]


def database_cleanup(vehicles: DataFrame, excluded_models: Sequence[str] = EXCLUDED_MODELS) -> DataFrame:
    """No vehicles whose model contains a listed word, no demonstration or
    used-in-house cars (a null provenance stays)."""
    return clean.exclude_substrings(vehicles, "modelo", excluded_models, "prov", EXCLUDED_PROVENANCE)


def modelling_rows(spark: SparkSession, vehicles: DataFrame, id_col: str, groups: Mapping[str, Sequence] | None = None,
                   excluded_models: Sequence[str] = EXCLUDED_MODELS, new_score_days: float = 45,
                   min_margin: float = 3.5) -> DataFrame:
    """K1 as far as nothing is learned: cleanup, score and targets over what is
    left, category groups, classes, history per configuration, nulls to zero."""
    v = database_cleanup(vehicles, excluded_models)
    v = score.score_targets(stored(v), max_days=new_score_days, min_margin=min_margin)
    v = options.category_groups(spark, v, groups, provenance="prov")
    v = score.bucket_classes(v)
    v = history.config_history(v, CONFIG_NEW, ["sell_date", id_col], chunk=F.to_date("sell_date"))
    return stored(clean.fill_numeric_zero(v))


@dataclass
class Prepared:
    """Training rows (oversampled on request, with folds and weights) and test
    rows, both with features, and the preparation they went through."""
    train: DataFrame
    test: DataFrame
    model: PreparationModel
    key: str
    target: str
    attributes: list[str]
    configuration: list[str]
    oversampled: bool = False
    k_features: int | None = None
    criterion: str | None = None


def prepared(rows: DataFrame, id_col: str, target: str = "new_score", k_features: int | None = None,
             criterion: str = "mutual_info", oversample: bool = False, folds: int = 10) -> Prepared:
    """K1: split, learn the preparation from the training rows, apply it to both
    parts; then, in the training part alone, oversampling, weights and folds.

    Copies of a row share its fold (folds are dealt to rows before they are
    repeated), so a held-out fold has no copy of a training row. Rows are written
    after each step that shuffles them, so that no later count repeats it; folds and
    copies share one rank, and the features come last, so that no shuffle carries them."""
    s = stored(sampling.stratified_split(rows, target, id_col, 0.25, seed=2))
    train, test = s.filter("is_train = 1"), s.filter("is_train = 0")
    numeric = ["navegacao", "sensores", "caixa_auto", *[c for c in history.HISTORY_COLUMNS if c not in SCALED]]
    model = Preparation([c for c in ENCODED if c in rows.columns], SCALED, numeric, k_features, criterion).fit(train, target)
    train, test = [part.withColumn(target, F.col(target).cast("double")) for part in (train, test)]
    ranked = stored(models.stratified_folds(train, target, id_col, k=folds, seed=42, rank="_rank"))
    train = sampling.oversample(ranked, target, id_col, seed=42, rank="_rank") if oversample else ranked.drop("_rank")
    train = model.transform(models.balanced_weights(train, target))
    order = [*s.columns, models.FEATURES, *[c for c in train.columns if c not in s.columns and c != models.FEATURES]]
    return Prepared(stored(train.select(*order)), model.transform(test), model, id_col, target, rows.columns, CONFIG_NEW, oversample, k_features,
                    criterion if k_features else None)


def feature_table(vehicles: DataFrame, id_col: str, new_score_days: float = 45, min_margin: float = 3.5,
                  ohe_cols=("jantes", "cor_interior", "cor_exterior", "buy_month"),
                  zscore_cols=("price_total", "number_prev_sales", "last_margin", "last_stock_days")) -> DataFrame:
    """One numeric row per vehicle: targets, history features per
    configuration (E2–E8), z-scored columns (H23) and one-hot blocks (H27).
    The vehicle table and the history result are written to the checkpoint
    folder (the original hands over CSV files at these points), which keeps
    the plans of the later global statistics small."""
    v = cut_lineage(vehicles).withColumn("new_score", binary_target("stock_days", "margem_percentagem", new_score_days,
                                                       min_margin))
    v = score.bucket_classes(v)
    v = cut_lineage(history.config_history(v, CONFIG7, ["sell_date", id_col], chunk=F.to_date("sell_date")))
    v = score.zscore_population(v, list(zscore_cols))
    v = v.withColumn("buy_month", F.col("buy_month").cast("string"))
    v = encode.one_hot(v, list(ohe_cols))
    return v


def numeric_features(df: DataFrame, exclude) -> list[str]:
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [c for c, t in df.dtypes if t in numeric and c not in set(exclude)]


def split_assemble(df: DataFrame, id_col: str, target: str, features, folds: int = 10):
    """Stratified 75/25 split (K3); then, from the training rows alone,
    balanced weights and CV folds; vectors. Test rows carry neither."""
    s = sampling.stratified_split(df, target, id_col, 0.25, seed=2)
    s = cut_lineage(models.assemble(s.withColumn(target, F.col(target).cast("double")), features))
    train = models.balanced_weights(s.filter("is_train = 1"), target)
    train = models.stratified_folds(train, target, id_col, k=folds, seed=42)
    return train, s.filter("is_train = 0")


def evaluate(pred: DataFrame, gt: str = "score_class_gt", p: str = "score_class_pred") -> DataFrame:
    """Performance row (A10): micro F1, macro F1, accuracy, specificity. Predictions
    are made and counted once; all four come from the written counts."""
    counts = cut_lineage(metrics.confusion_counts(pred, gt, p))
    return metrics.f1_of_counts(counts).withColumn("specificity", metrics.specificity_of_counts(counts, positive=1.0))


def run_tag(approach: str, model: str, target: str, scoring: str, oversample: bool = False,
            k_features: int | None = None, criterion: str | None = None) -> dict:
    """Run identity (A11) as columns instead of a file name."""
    return {"approach": approach, "model": model, "target": target, "scoring": scoring,
            "oversample": int(bool(oversample)), "k_features": k_features, "criterion": criterion}


def metrics_rows(spark: SparkSession, tag: dict, perf: DataFrame) -> DataFrame:
    """Long metrics rows ``tag columns + metric, value`` to append to one
    metrics table partitioned by run (A10, A11)."""
    long = perf.selectExpr("stack(4, 'micro_f1', micro_f1, 'macro_f1', macro_f1, 'accuracy', accuracy, "
                           "'specificity', specificity) AS (metric, value)")
    for k, v in tag.items():
        long = long.withColumn(k, F.lit(v).cast("string" if not isinstance(v, int) or isinstance(v, bool) else "int"))
    return long

"""Model training and evaluation on MLlib.

The reference fits scikit-learn estimators in one process; here every
estimator is a ``pyspark.ml`` Estimator trained on a DataFrame, with the
grid search as ``CrossValidator`` over a stratified fold column, balanced
class weights as a ``weightCol``, and evaluation as the metric tables of
:mod:`.metrics`. Iterative ensembles that MLlib lacks (AdaBoost, bagging,
soft voting) are driver loops over distributed fits; their per-round state
is a DataFrame column whose lineage is cut with a reliable checkpoint.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .sampling import class_rank
from .select import rank_scores

FEATURES = "features"


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """sklearn's ``class_weight='balanced'``: N / (C · n_c) per row."""
    counts = cut_lineage(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc")))  # read twice below
    tot = counts.agg(F.struct(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("c"))).scalar()
    w = counts.select(label, (tot["n"] / (tot["c"] * F.col("_nc"))).alias(out))
    from .joins import attach_per_group
    return attach_per_group(df, w, [label], 32)


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 10, seed: int = 2,
                     out: str = "fold", rank: str | None = None) -> DataFrame:
    """Fold index 0..k-1 dealt round-robin inside each class in hash order,
    so every fold has the class proportions (StratifiedKFold). On request the
    place in that order stays as ``rank``."""
    r = class_rank(df, label, id_col, seed)
    r = r.withColumn(out, ((F.col("_hrank") - 1) % k).cast("int"))
    return r.withColumnRenamed("_hrank", rank) if rank else r.drop("_hrank")


def evaluator(scoring: str, label: str, positive: float = 1.0):
    """GridSearchCV scoring names → MLlib evaluators."""
    if scoring == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                             metricName="areaUnderROC")
    metric = {"accuracy": "accuracy", "recall": "recallByLabel", "f1_weighted": "f1",
              "precision": "precisionByLabel"}[scoring]
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    if metric.endswith("ByLabel"):
        ev.setMetricLabel(positive)
    return ev


def _logspace(lo: float, hi: float, n: int) -> list[float]:
    return [float(x) for x in np.logspace(lo, hi, n)]


def classifier_grid(name: str, label: str, n_rows: int, n_features: int, weighted: bool = True):
    """Estimator and parameter grid of each model family of the original
    (grids as there; C → regParam = 1/(C·n))."""
    w = {"weightCol": "weight"} if weighted else {}
    if name == "dt":
        est = DecisionTreeClassifier(labelCol=label, featuresCol=FEATURES, seed=2, **w)
        grid = (ParamGridBuilder().addGrid(est.minInstancesPerNode, [3, 5, 7, 9, 10, 15, 20, 30])
                .addGrid(est.maxDepth, [3, 5, 6]).build())
    elif name == "rf":
        est = RandomForestClassifier(labelCol=label, featuresCol=FEATURES, seed=2, **w)
        grid = (ParamGridBuilder().addGrid(est.numTrees, [10, 25, 50, 100])
                .addGrid(est.maxDepth, [5, 10, 20]).build())
    elif name == "lr":
        est = LogisticRegression(labelCol=label, featuresCol=FEATURES, standardization=False)
        grid = ParamGridBuilder().addGrid(est.regParam, [1.0 / (c * n_rows) for c in _logspace(-2, 2, 20)]).build()
    elif name == "svm":
        est = LinearSVC(labelCol=label, featuresCol=FEATURES, standardization=False)
        grid = ParamGridBuilder().addGrid(est.regParam, [1.0 / (c * n_rows) for c in _logspace(-2, 2, 10)]).build()
    elif name == "gc":
        est = GBTClassifier(labelCol=label, featuresCol=FEATURES, seed=2)
        grid = ParamGridBuilder().addGrid(est.maxIter, list(range(10, 101, 10))).build()
    elif name == "bayes":
        est = NaiveBayes(labelCol=label, featuresCol=FEATURES, modelType="gaussian")
        grid = ParamGridBuilder().build()
    elif name == "neural":
        est = MultilayerPerceptronClassifier(labelCol=label, featuresCol=FEATURES, layers=[n_features, 100, 2],
                                             solver="gd", seed=2, maxIter=200)
        grid = ParamGridBuilder().build()
    else:
        raise ValueError(f"unknown model {name}")
    return est, grid


def grid_search(train: DataFrame, est: Estimator, grid, scoring: str, label: str, fold_col: str = "fold",
                parallelism: int = 8, folds: int = 10):
    """Grid search on a precomputed column of ``folds`` folds; refits the best
    parameters on all training rows (``bestModel``)."""
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid or [{}], evaluator=evaluator(scoring, label),
                        foldCol=fold_col, numFolds=folds, parallelism=parallelism, seed=2)
    return cv.fit(train)


def predictions(model: Model, df: DataFrame, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prediction table (K20): ground truth, prediction, class probabilities
    (or the decision value for margin classifiers) and kept attributes."""
    out = model.transform(df)
    cols = [*keep, F.col(label).alias("score_class_gt"), F.col("prediction").alias("score_class_pred")]
    if "probability" in out.columns:
        p = vector_to_array("probability")
        cols += [p[0].alias("proba_0"), p[1].alias("proba_1")]
    else:
        cols += [vector_to_array("rawPrediction")[1].alias("decision_function")]
    return out.select(*cols)


def feature_importance(spark: SparkSession, model: Model, features: Sequence[str], k: int | None = None) -> DataFrame:
    """Ranked feature importances (K27, F4/F5); one row per feature."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return rank_scores(df, "importance", "feature", k)


# ---------------------------------------------------------------- ensembles MLlib lacks
def adaboost_samme(train: DataFrame, label: str, n_estimators: int = 50, max_depth: int = 1,
                   checkpoint_every: int = 5):
    """AdaBoost (SAMME, two classes) with decision stumps. Each round fits a
    weighted tree, one aggregate gives the weighted error, and the weights
    column is updated; the lineage is cut every ``checkpoint_every`` rounds
    with a reliable checkpoint. Returns ``[(alpha, model), …]``."""
    k = 2
    cur = train.withColumn("_w", F.lit(1.0) / train.count())
    members = []
    for m in range(n_estimators):
        tree = DecisionTreeClassifier(labelCol=label, featuresCol=FEATURES, weightCol="_w", maxDepth=max_depth,
                                      seed=m).fit(cur)
        scored = tree.transform(cur).withColumn("_miss", (F.col("prediction") != F.col(label)).cast("double"))
        err_row = scored.agg((F.sum(F.col("_w") * F.col("_miss")) / F.sum("_w")).alias("e")).first()
        err = float(err_row["e"] or 0.0)
        if err >= 1 - 1.0 / k:
            break
        alpha = math.log((1 - err) / max(err, 1e-12)) + math.log(k - 1)
        members.append((alpha, tree))
        if err <= 0:
            break
        cur = scored.select(*train.columns, (F.col("_w") * F.exp(F.lit(alpha) * F.col("_miss"))).alias("_w"))
        if (m + 1) % checkpoint_every == 0:
            cur = cut_lineage(cur)
    return members


def adaboost_predict(members, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Weighted vote of the stumps; ``proba_1`` = softmax of the normalised
    class scores (the SAMME probability)."""
    total = sum(a for a, _ in members) or 1.0
    out = df.select(*keep, FEATURES).withColumn("_s1", F.lit(0.0))
    for alpha, tree in members:
        out = tree.transform(out).withColumn("_s1", F.col("_s1") + F.lit(alpha / total) * F.col("prediction")) \
                  .drop("prediction", "rawPrediction", "probability")
    s1 = F.col("_s1")
    s0 = F.lit(1.0) - s1
    return out.select(*keep, (F.exp(s1) / (F.exp(s0) + F.exp(s1))).alias("proba_1"),
                      (s1 > s0).cast("double").alias("prediction"))


def bagging(train: DataFrame, features: Sequence[str], label: str, make_estimator, id_col: str,
            n_members: int = 100, max_features: float = 0.5, seed: int = 0):
    """Bagging (K17): each member sees a Poisson(1) bootstrap weight per row
    (from a hash of the row id, so it is reproducible after a task retry and
    needs no resampled copy) and a random half of the features. Returns
    ``[(feature_names, model), …]``."""
    rng = np.random.default_rng(seed)
    members = []
    for m in range(n_members):
        cols = sorted(rng.choice(list(features), size=max(1, int(len(features) * max_features)),
                                 replace=False).tolist())
        u = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed * 7919 + m)), F.lit(1 << 53)) / F.lit(float(1 << 53))
        # Poisson(1) by inversion of the CDF at u; beyond 18 the CDF is 1 in doubles
        cdf = [sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)) for i in range(18)]
        w = F.when(u < cdf[0], 0)
        for i in range(1, 18):
            w = w.when(u < cdf[i], i)
        w = w.otherwise(18).cast("double")
        part = assemble(train.withColumn("_bw", w).filter(F.col("_bw") > 0), cols, "_fx")
        est = make_estimator().setFeaturesCol("_fx").setLabelCol(label)
        if est.hasParam("weightCol"):
            est = est.setWeightCol("_bw")
        members.append((cols, est.fit(part)))
    return members


def bagging_predict(members, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Mean class-1 probability of the bagged members."""
    out = df.withColumn("_sum", F.lit(0.0))
    for cols, model in members:
        scored = model.transform(assemble(out, cols, "_fx"))
        out = scored.withColumn("_sum", F.col("_sum") + vector_to_array("probability")[1]) \
                    .drop("_fx", "prediction", "rawPrediction", "probability")
    p1 = F.col("_sum") / len(members)
    return out.select(*keep, p1.alias("proba_1"), (p1 > 0.5).cast("double").alias("prediction"))


def average_probability(member_tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Soft voting (K19): mean ``proba_1`` of the members per row, joined on
    the row key; prediction = class with the larger mean probability."""
    tagged = [t.select(key, F.col("proba_1").alias("_p")) for t in member_tables]
    allp = tagged[0]
    for t in tagged[1:]:
        allp = allp.unionByName(t)
    avg = allp.groupBy(key).agg(F.avg("_p").alias("proba_1"))
    return avg.select(key, (F.lit(1.0) - F.col("proba_1")).alias("proba_0"), "proba_1",
                      (F.col("proba_1") > 0.5).cast("double").alias("score_class_pred"))


# ---------------------------------------------------------------- clustering, regression
def kmeans(df: DataFrame, k: int = 10, seed: int = 2, max_iter: int = 50, n_init: int = 1):
    """The fit of least training cost from ``n_init`` seeds on; the first of equals."""
    fits = (KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol=FEATURES).fit(df) for i in range(n_init))
    return min(fits, key=lambda m: m.summary.trainingCost)


def gap_statistic(df: DataFrame, features: Sequence[str], k_values: Sequence[int], n_refs: int = 3,
                  seed: int = 0) -> DataFrame:
    """Gap statistic (K25): for each k, log of the k-means cost on uniform
    reference data over the bounding box minus log of the cost on the data.
    The reference sets are generated by Spark (``rand``) with the data's row
    count, never collected. Returns ``(k, gap, sk)``; the chosen k is the one
    with the largest gap."""
    spark = df.sparkSession
    df = cut_lineage(df.select(*features))  # every k reads it
    bounds = df.agg(F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c)
                               for c in features]).alias("b")).scalar()
    data = assemble(df, features)
    refs = []
    for b in range(n_refs):
        r = df.select(*[(bounds[c]["lo"] + F.rand(seed * 1000 + b * 100 + i) * (bounds[c]["hi"] - bounds[c]["lo"]))
                        .alias(c) for i, c in enumerate(features)])
        refs.append(cut_lineage(assemble(r, features)))
    def cost(frame: DataFrame, k: int) -> float:
        if k == 1:  # MLlib needs k >= 2; one cluster costs the total sum of squares
            arr = vector_to_array(FEATURES)
            sq = frame.select(F.posexplode(arr).alias("i", "x")).groupBy("i").agg(
                (F.sum(F.col("x") * F.col("x")) - F.pow(F.sum("x"), 2) / F.count(F.lit(1))).alias("ss"))
            return float(sq.agg(F.sum("ss")).first()[0])
        return KMeans(k=k, seed=seed, featuresCol=FEATURES).fit(frame).summary.trainingCost

    rows = []
    for k in k_values:
        wk = cost(data, k)
        ref_logs = [math.log(cost(r, k)) for r in refs]
        gap = float(np.mean(ref_logs) - math.log(wk))
        sk = float(np.std(ref_logs) * math.sqrt(1 + 1.0 / n_refs))
        rows.append((int(k), gap, sk))
    return spark.createDataFrame(rows, "k int, gap double, sk double")


def linear_regression(train: DataFrame, label: str):
    return LinearRegression(labelCol=label, featuresCol=FEATURES, fitIntercept=True, regParam=0.0,
                            standardization=False).fit(train)


def coefficient_table(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(feature, coefficient) of a linear model, the intercept included."""
    rows = [*zip(features, map(float, model.coefficients)), ("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


# ---------------------------------------------------------------- persistence
def save_models(models: Mapping[str, Model], folder: str) -> None:
    """Persist models (A9) as MLlib pipeline folders, overwriting; a model
    that is no pipeline is saved as a pipeline of one stage."""
    for name, m in models.items():
        pipe = m if isinstance(m, PipelineModel) else PipelineModel(stages=[m])
        pipe.write().overwrite().save(f"{folder.rstrip('/')}/{name}")


def load_model(folder: str, name: str) -> Model:
    """A model as it was given to :func:`save_models`."""
    pipe = PipelineModel.load(f"{folder.rstrip('/')}/{name}")
    return pipe.stages[0] if len(pipe.stages) == 1 else pipe

"""Fitting any of the original's classifiers by name.

Every search runs the original's whole grid on stratified folds and returns the
best parameters, their mean score, all scores, and a model fitted with them on
all training rows. Models have one interface: ``transform`` adds ``prediction``
and either ``proba_1`` or ``decision_function``, ``save`` writes a folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import descent, forest, models, trees

# The grids of the original.
TREE_LEAVES = (3, 5, 7, 9, 10, 15, 20, 30)
TREE_DEPTHS = (3, 5, 6)
PLACE_LEAVES = (3, 5, 7, 9, 10, 15, 20, 50)
PLACE_DEPTHS = (3, 5)
LOGISTIC_CS = tuple(np.logspace(-2, 2, 20).tolist())
SVM_CS = tuple(np.logspace(-2, 2, 10).tolist())
BAGS = 100
FINAL_BAGS = 10
VOTERS = ("dt", "rf", "lr", "gc", "bayes", "ab", "neural")
FITS = 4  # searches of a vote at a time
BOOSTED = {"ab": "samme", "gc": "boost"}


@dataclass
class Fitted:
    best: dict
    score: float | None
    scores: list
    model: Any


class MllibModel:
    """An MLlib classifier with the interface of this module."""

    def __init__(self, model):
        self.model = model

    @property
    def importance(self):
        return self.model.featureImportances.toArray() if hasattr(self.model, "featureImportances") else None

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        return out.withColumn("proba_1", vector_to_array("probability")[1]).drop("rawPrediction", "probability")

    def save(self, spark: SparkSession, path: str) -> None:
        models.save_models({"mllib": self.model}, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> MllibModel:
        return cls(models.load_model(path, "mllib"))


class VotingModel:
    """The mean of its members' class-1 probabilities; the members are applied
    one after another to the same rows, so nothing is joined."""

    def __init__(self, members: dict[str, Any]):
        self.members = members

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for name, m in self.members.items():
            own = m.transform(out).drop("decision_function", "prediction")
            out = own.withColumnRenamed("proba_1", f"_proba_{name}")
        votes = [F.col(f"_proba_{n}") for n in self.members]
        total = votes[0]
        for v in votes[1:]:
            total = total + v
        out = out.withColumn("proba_1", total / len(votes)).drop(*[f"_proba_{n}" for n in self.members])
        return out.withColumn("prediction", (F.col("proba_1") > 0.5).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        for name, m in self.members.items():
            save(spark, m, f"{path}/{name}")
        _note(spark, {"members": list(self.members)}, f"{path}/members")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> VotingModel:
        names = json.loads(spark.read.text(f"{path}/members").first()[0])["members"]
        return cls({n: load(spark, f"{path}/{n}") for n in names})


MODELS = {c.__name__: c for c in (MllibModel, VotingModel, trees.StagedModel, forest.ForestModel, descent.LinearModel, descent.NetworkModel)}


def _note(spark: SparkSession, what: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(what),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save(spark: SparkSession, model, path: str) -> None:
    """Any model of this module, overwriting ``path``."""
    model.save(spark, f"{path}/model")
    _note(spark, {"class": type(model).__name__}, f"{path}/kind")


def load(spark: SparkSession, path: str):
    """A model as it was given to ``save``."""
    kind = json.loads(spark.read.text(f"{path}/kind").first()[0])["class"]
    return MODELS[kind].load(spark, f"{path}/model")


def fit(name: str, train: DataFrame, label: str, key: str, n_features: int, scoring: str = "recall", folds: int = 10,
        bags: int = BAGS) -> Fitted:
    """The search of model ``name`` on rows with ``features``, ``fold`` and, for
    the forest, ``weight``."""
    if name == "dt":
        found = trees.tree_search(train, label, folds=folds, scoring=scoring, min_rows=TREE_LEAVES, depths=TREE_DEPTHS)
    elif name in BOOSTED:
        found = trees.staged_search(train, label, BOOSTED[name], folds=folds, scoring=scoring)
    elif name == "bagging":
        found = trees.staged_search(train, label, "samme", folds=folds, scoring=scoring, bags=bags,
                                    final_bags=FINAL_BAGS, key=key)
    elif name == "lr":
        found = descent.linear_search(train, label, "logistic", LOGISTIC_CS, folds=folds, scoring=scoring)
    elif name == "svm":
        found = descent.linear_search(train, label, "hinge", SVM_CS, folds=folds, scoring=scoring)
    elif name == "neural":
        found = descent.network_search(train, label, folds=folds, scoring=scoring)
    elif name == "rf" and forest.fits(train.count(), n_features):
        found = forest.forest_search(train, label, folds=folds, scoring=scoring, key=key)
    elif name in ("rf", "bayes"):
        est, grid = models.classifier_grid(name, label, train.count(), n_features, weighted=name == "rf")
        if not any(grid):  # one point: nothing to choose, as in the original's last fit
            return Fitted({}, None, [], MllibModel(est.fit(train)))
        cv = models.grid_search(train, est, grid, scoring, label, folds=folds)
        points = [{p.name: v for p, v in g.items()} for g in grid]
        at = int(np.argmax(cv.avgMetrics))
        return Fitted(points[at], float(cv.avgMetrics[at]), list(zip(points, cv.avgMetrics)), MllibModel(cv.bestModel))
    else:
        raise ValueError(f"unknown model {name}")
    return Fitted(found.best, found.score, found.scores, found.model)


def vote(train: DataFrame, label: str, key: str, n_features: int, scoring: str = "recall", folds: int = 10,
         voters: Sequence[str] = VOTERS) -> Fitted:
    """The soft vote of the best model of every family. ``FITS`` searches run at a
    time: most passes of one leave cores idle."""
    one = inheritable_thread_target(train.sparkSession)(
        lambda n: fit(n, train, label, key, n_features, scoring, folds))
    with ThreadPool(min(FITS, len(voters))) as pool:
        found = dict(zip(voters, pool.map(one, voters, chunksize=1)))
    return Fitted({n: f.best for n, f in found.items()}, None, [], VotingModel({n: f.model for n, f in found.items()}))


def predictions(model, rows: DataFrame, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Truth, prediction, class probabilities (or, for the margin classifier,
    the decision value) and the columns to keep. Rows keep their own attributes,
    so nothing is joined back by position."""
    out = model.transform(rows)
    if "proba_1" in out.columns:
        told = [(1 - F.col("proba_1")).alias("proba_0"), F.col("proba_1")]
    else:
        told = [F.col("decision_function")]
    return out.select(*keep, F.col(label).cast("double").alias("score_class_gt"),
                      F.col("prediction").alias("score_class_pred"), *told)

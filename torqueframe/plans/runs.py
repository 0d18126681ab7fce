"""A store of training runs.

A run is its model, its preparation and its tables. Everything is written under a
new folder of the run first; only then a one-line manifest names that folder.
Readers go by the newest manifest of every run, so a run is seen with all its parts
or not at all, a run written again replaces itself alone, and a failed attempt
leaves the last good one in place. Folders that no newest manifest names can be
deleted by whoever owns the store; ``stale`` lists them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics, score, select
from . import modelling, training
from .training import predictions

MANIFEST = "run string, attempt string, committed_at long, tag string, tables array<string>"


def run_name(tag: Mapping) -> str:
    """The identity of a run as one name, from the tag of ``modelling.run_tag``."""
    parts = [tag["approach"], tag["model"], "target", tag["target"], "scoring", tag["scoring"]]
    if tag.get("place"):
        parts.append(tag["place"])
    if tag.get("oversample"):
        parts.append("oversample")
    if tag.get("k_features"):
        parts += [tag["k_features"], "features", tag["criterion"]]
    return "_".join(str(p) for p in parts)


class RunStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, run: str, attempt: str) -> str:
        return f"{self.path}/data/{run}/{attempt}"

    def write(self, tag: Mapping, tables: Mapping[str, DataFrame], model=None, preparation=None) -> str:
        """Write all parts of a run, then its manifest; returns the run's name."""
        run, attempt = run_name(tag), uuid.uuid4().hex
        folder = self._folder(run, attempt)
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}")
        if model is not None:
            training.save(self.spark, model, f"{folder}/model")
        if preparation is not None:
            preparation.save(self.spark, f"{folder}/preparation")
        row = (run, attempt, time.time_ns(), json.dumps(dict(tag)), list(tables))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.json(f"{self.path}/manifest/{attempt}")
        return run

    def manifests(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/*")

    def current(self) -> dict[str, dict]:
        """The newest manifest of every run (runs are few: one per model and setting)."""
        newest = self.manifests().groupBy("run").agg(F.max_by(F.struct("attempt", "tag", "tables"), "committed_at").alias("m"))
        return {r["run"]: {"attempt": r["m"]["attempt"], "tag": json.loads(r["m"]["tag"]), "tables": r["m"]["tables"]}
                for r in newest.collect()}

    def stale(self) -> list[str]:
        kept = {m["attempt"] for m in self.current().values()}
        rows = self.manifests().select("run", "attempt").collect()
        return sorted(self._folder(r["run"], r["attempt"]) for r in rows if r["attempt"] not in kept)

    def read(self, table: str) -> DataFrame:
        """``table`` of every run, with the run's name and tag as columns."""
        out = None
        for run, m in sorted(self.current().items()):
            if table not in m["tables"]:
                continue
            df = self.spark.read.parquet(f"{self._folder(run, m['attempt'])}/{table}")
            df = df.select(F.lit(run).alias("run"), *[F.lit(v).alias(k) for k, v in m["tag"].items() if v is not None], "*")
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        if out is None:
            raise ValueError(f"no run has a table {table}")
        return out

    def model(self, run: str):
        return training.load(self.spark, f"{self._folder(run, self.current()[run]['attempt'])}/model")

    def preparation(self, run: str):
        from ..operators.prepare import PreparationModel
        return PreparationModel.load(self.spark, f"{self._folder(run, self.current()[run]['attempt'])}/preparation")


def evaluation_tables(pred: DataFrame, gt: str = "score_class_gt", p: str = "score_class_pred") -> dict[str, DataFrame]:
    """The performance row, the class report and the confusion counts."""
    return {"performance": modelling.evaluate(pred, gt, p), "class_report": metrics.class_report(pred, gt, p),
            "confusion": metrics.confusion_counts(pred, gt, p, normalize=True)}


def importance_table(spark: SparkSession, features, values) -> DataFrame:
    """Rank, feature, importance."""
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return select.rank_scores(spark.createDataFrame(rows, "feature string, importance double"), "importance", "feature")


def run_classification(store: RunStore, data: modelling.Prepared, name: str, scoring: str = "recall", folds: int = 10,
                       **fit_options) -> str:
    """Fit, predict, evaluate and write one run.

    Predictions cover training rows (each once, however often it was drawn again)
    and test rows, with every attribute of the row: categories are columns of
    their own throughout, so no one-hot block has to be reversed. They carry the
    sales of their configuration, their mean margin and days (D3)."""
    spark = store.spark
    found = training.fit(name, data.train, data.target, data.key, len(data.model.features), scoring, folds, **fit_options) \
        if name != "voting" else training.vote(data.train, data.target, data.key, len(data.model.features), scoring, folds)
    once = data.train.where("copy_index = 0") if "copy_index" in data.train.columns else data.train
    keep = [c for c in data.attributes if c != data.target]
    pred = predictions(found.model, once, data.target, keep).withColumn("part", F.lit("train")).unionByName(
        predictions(found.model, data.test, data.target, keep).withColumn("part", F.lit("test")))
    pred = modelling.cut_lineage(score.group_summary(pred, data.configuration))
    tables = {"predictions": pred, **evaluation_tables(pred.where("part = 'test'"))}
    if found.scores:
        grid = [(json.dumps(p), float(s)) for p, s in found.scores]
        tables["grid"] = spark.createDataFrame(grid, "parameters string, score double")
    importance = getattr(found.model, "importance", None)
    if importance is not None:
        tables["importances"] = importance_table(spark, data.model.features, importance)
    tag = modelling.run_tag("classification", name, data.target, scoring, data.oversampled, data.k_features, data.criterion)
    return store.write(tag, tables, found.model, data.model)

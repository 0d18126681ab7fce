"""Feature preparation as something fitted (K1).

What depends on data (category lists, means and deviations, the chosen columns)
is learned from training rows alone, kept as a small state that can be saved, and
applied to any rows by projections: no row of a test set can change it, and new
rows are prepared as the training rows were.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import short_methods
from . import encode, models, select

CRITERIA = {"chi2": select.chi2_scores, "anova_f": select.anova_f_scores, "mutual_info": select.mutual_info_scores}


@dataclass(frozen=True)
class Preparation:
    """What to learn: columns to encode, to scale and to pass; ``k`` features kept
    by ``criterion`` (all, if None)."""
    categorical: Sequence[str]
    scaled: Sequence[str]
    numeric: Sequence[str] = ()
    k: int | None = None
    criterion: str = "mutual_info"

    def fit(self, train: DataFrame, target: str) -> PreparationModel:
        """Learn from ``train``: one job for the scales, one per category list, one
        for the feature scores."""
        lists = {c: encode.category_values(train, c) for c in self.categorical}
        aggs = [F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in self.scaled]
        row = train.agg(*aggs).first() if aggs else {}
        scales = {c: (row[c]["m"], row[c]["s"]) for c in self.scaled}
        model = PreparationModel(lists, scales, list(self.numeric), [])
        every = model.every_feature()
        chosen, scores = every, {}
        if self.k is not None:
            table = CRITERIA[self.criterion](model.encoded(train, [target]), every, target)
            # equal scores go by name: rounded, so that the order of a sum does not decide
            ranked = select.rank_scores(table.withColumn("score", F.round("score", 9)), k=self.k)
            with short_methods(train.sparkSession):
                scores = {r["feature"]: r["score"] for r in ranked.orderBy("rank").collect()}
            chosen = list(scores)
        return PreparationModel(lists, scales, list(self.numeric), chosen, scores)


@dataclass(frozen=True)
class PreparationModel:
    lists: Mapping[str, Sequence[str]]
    scales: Mapping[str, tuple]
    numeric: Sequence[str]
    features: Sequence[str]
    scores: Mapping[str, float] = field(default_factory=dict)

    def every_feature(self) -> list[str]:
        blocks = [f"{c}_{v}" for c, values in self.lists.items() for v in values]
        return [*self.numeric, *self.scales, *blocks]

    def encoded(self, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """All features as columns, and the columns to keep. A value that training
        did not see, or a null, is zero in its block; a constant or null number is 0."""
        out = rows
        for c, (mean, deviation) in self.scales.items():
            scaled = ratio(F.col(c) - F.lit(mean), F.lit(deviation))
            out = out.withColumn(c if c not in keep else f"_scaled_{c}", F.coalesce(scaled, F.lit(0.0)))
        blocks = [F.when(F.col(c).cast("string") == v, 1).otherwise(0).cast("bigint").alias(f"{c}_{v}")
                  for c, values in self.lists.items() for v in values]
        numbers = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in self.numeric if c not in keep]
        scaled = [F.col(c if c not in keep else f"_scaled_{c}").alias(c) for c in self.scales if c not in keep]
        return out.select(*keep, *numbers, *scaled, *blocks)

    def transform(self, rows: DataFrame, out: str = models.FEATURES) -> DataFrame:
        """``rows`` with the vector of the chosen features; their own columns stay."""
        parts = []
        for name in self.features:
            if name in self.scales:
                mean, deviation = self.scales[name]
                parts.append(F.coalesce(ratio(F.col(name) - F.lit(mean), F.lit(deviation)), F.lit(0.0)))
            elif name in self.numeric:
                parts.append(F.coalesce(F.col(name).cast("double"), F.lit(0.0)))
            else:
                col, value = self.source(name)
                parts.append(F.when(F.col(col).cast("string") == value, 1.0).otherwise(0.0))
        return rows.withColumn(out, models.array_to_vector(F.array(*[p.cast("double") for p in parts])))

    def source(self, feature: str) -> tuple[str, str]:
        """The column and value of an encoded feature."""
        for c, values in self.lists.items():
            for v in values:
                if feature == f"{c}_{v}":
                    return c, v
        raise KeyError(feature)

    def save(self, spark: SparkSession, path: str) -> None:
        state = {"lists": {c: list(v) for c, v in self.lists.items()}, "scales": {c: list(v) for c, v in self.scales.items()},
                 "numeric": list(self.numeric), "features": list(self.features), "scores": dict(self.scores)}
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PreparationModel:
        s = json.loads(spark.read.text(path).first()[0])
        return cls(s["lists"], {c: tuple(v) for c, v in s["scales"].items()}, s["numeric"], s["features"], s["scores"])

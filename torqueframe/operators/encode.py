"""One-hot encoding and its reverse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import argmax_label


MAX_CATEGORIES = 1000


def category_values(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct non-null values of a categorical column. The output
    width of a one-hot encoding depends on them, so they are fixed on the
    driver, like a fitted ``StringIndexer``. At most ``max_categories + 1``
    values are read; more is an error (one column per value would not be a
    sensible encoding), so the driver never receives an unbounded list."""
    rows = (df.select(F.col(col).cast("string").alias("v")).filter(F.col("v").isNotNull())
              .distinct().orderBy("v").limit(max_categories + 1).collect())
    if len(rows) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories; one-hot encoding refused")
    return [r["v"] for r in rows]


def one_hot(df: DataFrame, cols: Sequence[str],
            vocabularies: Mapping[str, Sequence[str]] | None = None,
            drop_original: bool = True) -> DataFrame:
    """``{col}_{value}`` = 1 when the value (compared as string on both
    sides) equals, else 0 — also for nulls (H27). Pure projection: no
    shuffle, unlike ``groupBy().pivot()``."""
    vocabularies = dict(vocabularies or {})
    out = df
    for c in cols:
        values = vocabularies.get(c) or category_values(df, c)
        s = F.col(c).cast("string")
        out = out.select("*", *[F.when(s == F.lit(v), 1).otherwise(0).cast("bigint").alias(f"{c}_{v}")
                                for v in values])
        if drop_original:
            out = out.drop(c)
    return out


def reverse_one_hot(df: DataFrame, prefixes: Sequence[str], strip: str = "_new") -> DataFrame:
    """Rebuild each categorical column from its one-hot block (H28): the
    value of the column holding the maximum (first column on ties, so an
    all-zero row takes the first category). Columns are picked by exact
    prefix ``{prefix}_``; the rebuilt column is named ``prefix`` without
    ``strip``."""
    out = df
    for p in prefixes:
        block = [c for c in df.columns if c.startswith(p + "_")]
        if not block:
            continue
        name = p.replace(strip, "") if strip else p
        out = out.withColumn(name, argmax_label(block, [c[len(p) + 1:] for c in block])).drop(*block)
    return out


def sparse_one_hot(train: DataFrame, cols: Sequence[str], suffix: str = "_ohe") -> PipelineModel:
    """One-hot blocks of any width, learned from ``train`` (H27 beyond
    :data:`MAX_CATEGORIES`): ``transform`` adds one sparse vector ``{col}{suffix}`` a
    column, whose metadata names the category of every place. Categories are in
    alphabetical order; an unseen or null value has an empty vector."""
    cols = list(cols)
    index = StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols], stringOrderType="alphabetAsc",
                          handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}{suffix}" for c in cols], dropLast=True,
                        handleInvalid="error")
    return Pipeline(stages=[index, hot]).fit(train)


def reverse_sparse(df: DataFrame, cols: Sequence[str], suffix: str = "_ohe") -> DataFrame:
    """H28 for the vectors of :func:`sparse_one_hot`: ``{col}_value`` is the category
    that the metadata names at the vector's place, null for an empty vector. The
    place is read from the vector as it is stored, and the names are a table that is
    joined, so a row costs the same however many categories there are."""
    out = df
    for c in cols:
        meta = df.schema[f"{c}{suffix}"].metadata["ml_attr"]["attrs"]
        names = [a["name"] for kind in sorted(meta) for a in sorted(meta[kind], key=lambda a: a["idx"])]
        table = df.sparkSession.createDataFrame(
            pa.table({"_place": pa.array(range(len(names)), pa.int32()), f"{c}_value": pa.array(names, pa.string())}))
        raw = F.unwrap_udt(f"{c}{suffix}")
        at = F.array_position(raw["values"], 1.0).cast("int")
        # a sparse vector lists the places of its values, a dense one has a value for each
        place = F.when(at > 0, F.when(raw["type"] == 0, F.get(raw["indices"], at - 1)).otherwise(at - 1))
        out = out.drop(f"{c}_value").withColumn("_place", place).join(table, "_place", "left").drop("_place")
    return out

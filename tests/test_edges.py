"""Edge inputs, sinks and round trips: nothing is lost, corrupted or crashes."""

import os
import tempfile

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from torqueframe.functions.text import shorten_model, tokenize
from torqueframe.operators import clean, metrics, models, neighbors, ordered, profile, report, sampling, select
from torqueframe.plans import modelling, standins, stock
from torqueframe.sources import csv, sinks
from torqueframe.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_decimal_numbers_keep_their_value(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="tf-edge-"), "o.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("Custo;Margem\n1234.50;1234,50\n1,5;x\n;7\n")
    raw = csv.read_delimited(spark, p)
    rows = csv.read_delimited(spark, p, decimal_comma_cols=["Custo", "Margem"]).collect()
    assert [(r.Custo, r.Margem) for r in rows] == [(1234.5, 1234.5), (1.5, None), (None, 7.0)]
    assert csv.unparsable_counts(raw, ["Custo", "Margem"]).first().asDict() == {"Custo": 0, "Margem": 1}


def test_metrics_of_runs_that_differ_in_any_tag_are_kept(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tf-edge-"), "metrics")
    perf = spark.createDataFrame([(0.5, 0.4, 0.6, 0.7)], "micro_f1 double, macro_f1 double, accuracy double, specificity double")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for scoring, oversample in (("recall", False), ("roc_auc", False), ("recall", True), ("recall", False)):
        tag = modelling.run_tag("classification", "dt", "new_score", scoring, oversample)
        sinks.append_metrics(modelling.metrics_rows(spark, tag, perf), path)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    back = spark.read.parquet(path)
    assert back.count() == 12  # three runs of four metrics; the repeated one replaced itself
    wide = report.metrics_pivot(back, ["model", "scoring", "oversample"], "metric", "value")
    assert wide.count() == 3 and set(wide.columns) >= {"micro_f1", "accuracy"}


def test_a_pivot_that_mixes_runs_is_an_error(spark):
    import pytest
    rows = spark.createDataFrame([("dt", "acc", 0.5), ("dt", "acc", 0.6)], "model string, metric string, value double")
    with pytest.raises(Exception, match="several values"):
        report.metrics_pivot(rows, "model", "metric", "value").collect()


def test_saved_models_predict_alike(spark):
    rng = np.random.default_rng(0)
    df = models.assemble(spark.createDataFrame([(float(a), float(b), float(a > b)) for a, b in rng.normal(size=(60, 2))],
                                               "a double, b double, y double"), ["a", "b"])
    tree = DecisionTreeClassifier(labelCol="y", seed=1).fit(df)
    folder = tempfile.mkdtemp(prefix="tf-edge-")
    models.save_models({"tree": tree}, folder)
    back = models.load_model(folder, "tree")
    assert [r.prediction for r in back.transform(df).collect()] == [r.prediction for r in tree.transform(df).collect()]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "a int, s string, y int, p double")
    assert {tuple(r) for r in profile.null_profile(empty).select("column_name", "n_null").collect()} == {
        ("a", 0), ("s", 0), ("y", 0), ("p", 0)}
    assert all(r.n_zero == 0 and r.pct_n_zero is None for r in profile.zero_profile(empty).collect())
    assert clean.constant_columns(empty) == []
    assert metrics.roc_points(empty, "y", "p").count() == 0
    assert ordered.sorted_positions(empty, [F.asc("a")]).count() == 0


def test_blank_model_text(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), ("Série 1 a b c",), ("x y z w",)], "m string")
    assert [r[0] for r in df.select(shorten_model(tokenize("m"))).collect()] == ["", "", None, "Série 1", "x"]


def test_one_class_and_null_feature_values(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (None, 0)], "x double, y int")
    assert select.anova_f_scores(df, ["x"], "y").first().score is None
    two = spark.createDataFrame([(1.0, 0), (2.0, 0), (5.0, 1), (6.0, 1), (None, 1)], "x double, y int")
    assert abs(select.anova_f_scores(two, ["x"], "y").first().score - 32.0) < 1e-9
    assert abs(select.mutual_info_scores(df, ["x"], "y").first().score) < 1e-12


def test_rows_of_a_null_target_are_kept(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(30)], "id int, y int")
    split = sampling.stratified_split(df, "y", "id")
    assert split.count() == 30 and split.where("y is null").count() == 10
    assert sampling.undersample(df, "y", "id").where("y is null").count() == 10
    assert sampling.oversample(df, "y", "id").where("y is null").count() == 10


def test_null_scores_are_no_point(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, 1e9)], "y int, p double")
    assert metrics.roc_points(df, "y", "p").count() == 3
    assert metrics.unscored(df, "p").first().unscored == 1
    assert metrics.auc(df, "y", "p").first().auc == 0.5


def test_quantile_chunks_keep_order_and_spread(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).alias("x"))
    got = df.select("x", ordered.quantile_chunk(df, "x", 8).alias("c")).orderBy("x").collect()
    chunks = [r.c for r in got]
    assert chunks == sorted(chunks) and set(chunks) == set(range(8))
    assert max(chunks.count(c) for c in range(8)) < 200


def test_neighbours_vote_with_text_labels(spark):
    train = spark.createDataFrame([(i, [float(i), 0.0], "b" if i < 3 else "a") for i in range(6)],
                                  "id int, v array<float>, y string")
    query = spark.createDataFrame([(100, [0.4, 0.0]), (101, [2.5, 0.0])], "id int, v array<float>")
    got = {r.id: r.predicted_label for r in neighbors.knn_vote(train, query, "v", "id", "y", k=2).collect()}
    assert got == {100: "b", 101: "a"}


def test_every_line_is_a_sale_and_raw_lines_are_cleaned(spark):
    assert standins.sales(spark, SF).count() == table(spark, SF, "lineitem").count()
    raw = standins.raw_option_lines(spark, SF)
    lines = stock.clean_lines(raw)
    assert raw.where("lower(opcional) = 'preço de venda'").count() and raw.where("cor is null").count()
    assert lines.where("opcional = 'preço de venda' or cor is null or cor like '%|%' or modelo like '%utilizar%'").isEmpty()
    assert "cdint" not in lines.columns and lines.where("interior like '%ind.%' or interior like '%.%'").isEmpty()


def test_fill_crosses_chunks(spark):
    v = standins.visits(spark, "/root/testdata/sf0.01").select("o_orderkey", "registration_number")
    n = v.withColumn("c", ordered.quantile_chunk(v, "o_orderkey", 64)).groupBy("registration_number").agg(
        F.count_distinct("c").alias("n")).agg(F.max("n")).first()[0]
    assert n > 3

"""Operators that no registered query uses, each on a small table."""

import os
import tempfile

from pyspark.sql import functions as F

from torqueframe.operators import clean, lloyd, models, score
from torqueframe.plans import catalog
from torqueframe.sources import csv, sinks


def _file(text, encoding="utf-8"):
    p = os.path.join(tempfile.mkdtemp(prefix="tf-small-"), "f.csv")
    with open(p, "w", encoding=encoding) as f:
        f.write(text)
    return p


def test_numeric_nulls_become_zero(spark):
    df = spark.createDataFrame([(None, None, None), (1, 2.5, "x")], "a int, b double, s string")
    assert [tuple(r) for r in clean.fill_numeric_zero(df).collect()] == [(0, 0.0, None), (1, 2.5, "x")]


def test_constant_columns_are_dropped(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None)], "a int, s string, n int")
    assert clean.drop_constant_columns(df).columns == ["a", "n"]


def test_score_targets(spark):
    df = spark.createDataFrame([(10, 2.0), (40, 4.0), (90, 9.0)], "stock_days int, margem_percentagem double")
    out = {r.stock_days: r for r in score.score_targets(df).collect()}
    assert [out[d].new_score for d in (10, 40, 90)] == [0, 1, 0]
    assert "stock_days_norm" not in score.score_targets(df).columns and out[90].score == 0.0


def test_plate_contracts(spark):
    p = _file("MATRICULA;ANOS;KILOMETROS;DATA_INICIO;DATA_FIM;DATA_REMOCAO;VIA_MAR_DES\n"
              "00AA11;3;60000;2015-01-02;2018-01-02;;BMW\n")
    df = csv.read_contracts_ca(spark, p)
    assert df.columns == ["registration_number", "cm_years", "cm_km", "cm_date_start", "cm_date_end", "cm_date_removal"]
    r = df.first()
    assert (r.registration_number, r.cm_years, r.cm_km, r.cm_date_removal) == ("00AA11", 3.0, 60000.0, None)
    assert str(r.cm_date_end) == "2018-01-02 00:00:00"


def test_preview_and_selected_sink(spark):
    p = _file("1;a\n2;b\n3;c\n")
    assert [r[0] for r in csv.preview_headerless(spark, p, 2).collect()] == ["1", "2"]
    out = os.path.join(tempfile.mkdtemp(prefix="tf-small-"), "t")
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    sinks.write_selected(df.withColumn("w", F.lit(1)), ["x", "z"], out)
    assert spark.read.parquet(out).columns == ["x", "z"]


def test_kmeans_takes_the_best_of_its_starts(spark):
    rows = [(float(x), float(y)) for x in range(0, 60, 10) for y in (0, 1, 50, 53)]
    df = models.assemble(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    costs = [models.kmeans(df, k=5, seed=s).summary.trainingCost for s in range(2, 8)]
    assert models.kmeans(df, k=5, seed=2, n_init=6).summary.trainingCost == min(costs)


def test_cluster_queries_search_as_widely_as_the_reference(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(lloyd, "gap_statistic", lambda df, cols, k_values, **kw: asked.update(k=list(k_values), **kw))
    catalog.gap_statistic(spark, "/root/testdata/sf0.001")
    assert asked == {"k": list(range(1, 30))}  # and the default of 3 reference sets

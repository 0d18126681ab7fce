"""Hand-derived edge rows per operator (FIXTURES.md §2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from torqueframe.functions.classes import (binary_target, keep_or_other, right_closed_bucket,
                                           threshold_class)
from torqueframe.functions.text import last_n, tokenize
from torqueframe.operators import clean, encode, history, joins, metrics, options, sampling, score, visits


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_last7(spark):
    df = spark.createDataFrame([("WBA1234567",), ("ABC",), (None,)], "c string")
    assert [r[0] for r in df.select(last_n("c", 7)).collect()] == ["1234567", "ABC", None]


def test_exclude_keeps_nulls(spark):
    df = spark.createDataFrame([(4,), (5,), (6,), (None,)], "a int")
    assert sorted(r[0] for r in clean.exclude_values(df, "a", [4, 6]).collect()
                  if r[0] is not None) == [5]
    assert clean.exclude_values(df, "a", [4, 6]).count() == 2


def test_registration_flag(spark):
    df = spark.createDataFrame([(p,) for p in ["98IQ85", "12345", "000000", "000001", "++++++", None]],
                               "registration_number string")
    out = {r[0]: r[1] for r in clean.registration_flag(df).collect()}
    assert out == {"98IQ85": 0, "12345": 1, "000000": 1, "000001": 1, "++++++": 1}


@pytest.mark.parametrize("chunked", [False, True])
def test_fill_forward_backward(spark, chunked):
    rows = [("p", 1, None), ("p", 2, "a"), ("p", 3, None), ("p", 4, "b"), ("p", 5, None),
            ("q", 1, None), ("q", 2, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    chunk = F.col("o") if chunked else None
    out = visits.fill_within(df, "k", ["o"], ["v"], chunk=chunk)
    got = {(r.k, r.o): r.v for r in out.collect()}
    assert [got[("p", i)] for i in range(1, 6)] == ["a", "a", "a", "b", "b"]
    assert got[("q", 1)] is None and got[("q", 2)] is None


def test_null_key_join(spark):
    left = spark.createDataFrame([(None, 1)], "k string, a int")
    right = spark.createDataFrame([(None, 2)], "k string, b int")
    assert joins.left_join_null_keys(left, right, "k", null_keys_match=True).collect()[0].b == 2
    assert joins.left_join_null_keys(left, right, "k").collect()[0].b is None


def test_coalesce_update(spark):
    df = spark.createDataFrame([(1, None, ts("2020-01-01")), (2, ts("2019-01-01"), ts("2020-01-01"))],
                               "id int, removal timestamp_ntz, end timestamp_ntz")
    out = {r.id: r.end for r in joins.coalesce_update(df, "end", "removal").collect()}
    assert out == {1: ts("2020-01-01"), 2: ts("2019-01-01")}


def test_warranty_flag(spark):
    reg = ts("2010-01-01")
    rows = [(1, 101, reg, reg + dt.timedelta(days=1824)), (2, 101, reg, reg + dt.timedelta(days=1825)),
            (3, 101, None, reg)]
    df = spark.createDataFrame(rows, "id int, nlr_code bigint, r timestamp_ntz, vehicle_in_date timestamp_ntz")
    out = visits.warranty_flags(df, visits.warranty_table(spark), reg_dates=["r"], outs=["w"])
    assert {r.id: r.w for r in out.collect()} == {1: 1, 2: 0, 3: None}


def test_contract_flag(spark):
    e = ts("2015-01-01")
    df = spark.createDataFrame([(1, e, e, 3.0, 3.0, 100, 100.0), (2, e, None, 3.0, 3.0, 100, 100.0)],
                               "id int, vehicle_in_date timestamp_ntz, cm_date_end timestamp_ntz, "
                               "anos_viatura double, cm_years double, kms int, cm_km double")
    assert {r.id: r.contract_visit for r in visits.contract_flag(df).collect()} == {1: 1, 2: None}


def test_abandoned(spark):
    as_of = ts("2020-01-01")
    rows = [("a", "1", as_of - dt.timedelta(days=730)), ("b", "1", as_of - dt.timedelta(days=731)),
            ("c", "1", as_of), ("c", "1", None)]
    df = spark.createDataFrame(rows, "customer string, reg string, vehicle_in_date timestamp_ntz")
    out = visits.abandoned_per_group(df, ["customer", "reg"], "2020-01-01")
    assert {r.customer: r.abandoned for r in out.collect()} == {"a": 0, "b": 1, "c": None}


def test_regular_percentage(spark):
    as_of = ts("2020-01-01")
    rows = [("a", as_of - dt.timedelta(days=3 * 365 + 1), as_of)]
    rows += [("b", as_of - dt.timedelta(days=365), as_of)]
    rows += [("c", as_of - dt.timedelta(days=3 * 365 + 1), as_of)] * 10
    rows += [("d", None, as_of)]
    df = spark.createDataFrame(rows, "customer string, reg timestamp_ntz, vehicle_in_date timestamp_ntz")
    out = {r.customer: (r.regular_status, r.regular_pct)
           for r in visits.regular_percentage(df, ["customer"], "2020-01-01", "reg").collect()}
    assert out["a"][0] == "pct" and out["a"][1] == pytest.approx(100 / (1096 / 365.25 - 1), rel=1e-9)
    assert out["b"] == ("<2years", None)
    assert out["c"] == ("pct", 100.0)
    assert out["d"] == ("NULL", None)


def _one(spark, text_col, expr):
    df = spark.createDataFrame([(t,) for t in text_col], "t string")
    return [r[0] for r in df.select(expr).collect()]


def test_token_flags_as_coded(spark):
    lines = spark.createDataFrame([(1, 1, "sensor"), (2, 1, "dianteiros")], "v int, n int, t string")
    lines = lines.select("*", F.lit("x").alias("c"), F.lit("x").alias("i"), F.lit("m a b c").alias("m"),
                         F.lit(1.0).alias("cost"))
    out = options.vehicle_features(lines, "v", ["n"], "t", "c", "i", "m", "cost")
    assert {r.v: r.sensores for r in out.collect()} == {1: 0, 2: 1}


def test_first_vocab_match(spark):
    from torqueframe.operators import vocab
    got = _one(spark, ["white silver", "azul preto", "xyz"],
               options.first_vocab_match(tokenize("t"), vocab.COLOURS_PT, vocab.COLOURS_EN))
    assert got == ["white", "preto", None]


def test_interior_rules(spark):
    got = _one(spark, ["azul", "azul preto", "truffle", "banco standard"], options.interior_colour(tokenize("t")))
    assert got == ["azul", "vernasca", "truffle", "preto"]
    intended = _one(spark, ["bege preto"], options.interior_colour(tokenize("t"), ruleset="intended"))
    assert intended == ["bege"]


def test_wheels_and_model(spark):
    rows = [(1, 1, "jante 17"), (1, 2, "jantes 18 19"), (1, 3, "nada"), (2, 1, "nada")]
    lines = spark.createDataFrame(rows, "v int, n int, t string")
    models = {1: "Série R 1200 GS", 2: "X1 a"}
    lines = lines.select("*", F.lit("preto").alias("c"), F.lit("preto").alias("i"),
                         F.when(F.col("v") == 1, models[1]).otherwise(models[2]).alias("m"),
                         F.lit(1.0).alias("cost"))
    out = {r.v: r for r in options.vehicle_features(lines, "v", ["n"], "t", "c", "i", "m", "cost").collect()}
    assert out[1].jantes == "19" and out[2].jantes == "standard"
    assert out[1].modelo == "Série R" and out[2].modelo == ""
    from torqueframe.functions.text import shorten_model
    assert _one(spark, ["S3 Touring a b c"], shorten_model(tokenize("t"))) == ["S3 Touring"]


def test_group_map_later_wins(spark):
    from torqueframe.operators import vocab
    df = spark.createDataFrame([("S2 Gran Tourer",), ("Nope",)], "m string")
    out = options.group_map(df, "m", options.group_table(spark, vocab.MODEL_GROUPS))
    assert {r.m: r.m_new for r in out.collect()} == {"S2 Gran Tourer": "Outros", "Nope": None}


def test_keep_or_other(spark):
    assert _one(spark, ["a", "b", None], keep_or_other("t", ["a"])) == ["a", "outros", None]


def test_buckets_and_target(spark):
    df = spark.createDataFrame([(d,) for d in [16, 17, 60, 61, 100, 101, 200, 201, None]], "d int")
    got = [r[0] for r in df.select(right_closed_bucket("d", [16, 60, 100, 200])).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 3, 4, None]
    t = spark.createDataFrame([(45, 3.5), (46, 3.5), (45, 3.4)], "d int, m double")
    assert [r[0] for r in t.select(binary_target("d", "m")).collect()] == [1, 0, 0]
    s = spark.createDataFrame([(0.69,), (0.7,), (-0.1,)], "s double")
    assert [r[0] for r in s.select(threshold_class("s")).collect()] == [0, 1, None]


def test_minmax_constant_is_null(spark):
    df = spark.createDataFrame([(5, 1.0), (5, 2.0)], "stock_days int, margem_percentagem double")
    assert all(r.score is None for r in score.minmax_score(df).collect())


def test_history_fixture(spark):
    rows = [("c", 1, 1), ("c", 2, 0), ("c", 3, 1), ("solo", 1, 1)]
    df = spark.createDataFrame(rows, "k string, t int, new_score int") \
              .withColumn("margem_percentagem", F.col("t") * 1.0).withColumn("stock_days", F.col("t") * 10)
    out = {(r.k, r.t): r for r in history.config_history(df, ["k"], ["t"], chunk=F.col("t")).collect()}
    c = [out[("c", i)] for i in (1, 2, 3)]
    assert [r.number_prev_sales for r in c] == [0, 1, 2]
    assert [r.prev_sales_check for r in c] == [0, 1, 1]
    assert [r.last_score for r in c] == [0, 1, 0]
    assert [round(r.average_score_dynamic, 4) for r in c] == [0, 0.5, 0.6667]
    assert round(c[0].average_score_global, 4) == 0.6667
    solo = out[("solo", 1)]
    assert all(solo[h] == 0 for h in history.HISTORY_COLUMNS)


def test_f1_excludes_unpredicted_labels(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "gt int, pred int")
    r = metrics.f1_summary(df, "gt", "pred").collect()[0]
    assert r.macro_f1 == pytest.approx(0.5)   # only label 0: p=1/3, r=1 → f1=0.5
    assert r.accuracy == pytest.approx(1 / 3)


def test_reverse_one_hot_all_zero(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 1)], "id int, c_new_a int, c_new_b int")
    out = {r.id: r.c for r in encode.reverse_one_hot(df, ["c_new"]).collect()}
    assert out == {1: "a", 2: "b"}


def test_oversample_counts(spark):
    df = spark.createDataFrame([(i, 0) for i in range(5)] + [(10 + i, 1) for i in range(2)], "id int, y int")
    out = sampling.oversample(df, "y", "id")
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 5, 1: 5}
    assert out.filter("copy_index = 0").count() == 7


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_attach_per_group_both_ways(spark, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
        per = rows.groupBy("k").agg(F.sum("v").alias("s"))
        out = {r.v: r.s for r in joins.attach_per_group(rows, per, ["k"]).collect()}
        assert out == {1: 3, 2: 3, 3: 3, 4: 4}  # a null group is a group: no row is lost
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_values_not_in_and_exclusions(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",), (None,), ("z",)], "k string")
    b = spark.createDataFrame([("y",), (None,)], "k string")
    assert sorted(r.k for r in joins.values_not_in(a, b, ["k"]).collect()) == ["x", "z"]
    v = spark.createDataFrame([("M3 Série", 1), ("X1", None), ("X5", 2), ("Z4 roadster", 3)], "name string, prov int")
    kept = clean.exclude_substrings(v, "name", ["Série", "Z4"], null_safe_col="prov", excluded=[2])
    assert sorted(r.name for r in kept.collect()) == ["X1"]


def test_cast_like_and_keep_one_target(spark):
    orig = spark.createDataFrame([(1, 2.5, 0)], "a bigint, b double, t1 int")
    back = spark.createDataFrame([(1.0, "2.5", "0")], "a double, b string, t1 string")
    out = clean.cast_like(back, orig)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "int"]
    assert out.first() == (1, 2.5, 0)
    wide = spark.createDataFrame([(1, 0, 1, 9)], "t1 int, t2 int, t3 int, x int")
    assert clean.keep_one_target(wide, "t2", ["t1", "t2", "t3"]).columns == ["t2", "x"]


def test_category_values_bounded(spark):
    df = spark.createDataFrame([(str(i),) for i in range(12)], "c string")
    assert len(encode.category_values(df, "c", max_categories=12)) == 12
    with pytest.raises(ValueError):
        encode.category_values(df, "c", max_categories=11)

"""Fitted preparation, the run store, grouped trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from torqueframe.operators import grouped, metrics, models, sampling, trees
from torqueframe.operators.prepare import Preparation, PreparationModel
from torqueframe.plans import modelling as ML
from torqueframe.plans import runs, training


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, ["a", "b", None][i % 3], float(i), float(i % 4), int(i % 3 == 0)) for i in range(60)]
    return spark.createDataFrame(data, "id long, kind string, price double, n double, y int")


def test_preparation_learns_from_training_rows_only(spark, rows, tmp_path):
    train = rows.where("id < 40")
    model = Preparation(["kind"], ["price"], ["n"]).fit(train, "y")
    assert model.features == ["n", "price", "kind_a", "kind_b"] and model.scales["price"][0] == pytest.approx(19.5)
    new = spark.createDataFrame([(99, "unseen", 19.5, None, 0), (98, "b", None, 2.0, 1)], rows.schema)
    got = {r["id"]: r["features"].toArray().tolist() for r in model.transform(new).collect()}
    assert got == {99: [0.0, 0.0, 0.0, 0.0], 98: [2.0, 0.0, 0.0, 1.0]}
    model.save(spark, str(tmp_path / "p"))
    again = PreparationModel.load(spark, str(tmp_path / "p"))
    assert again.features == model.features and again.scales == model.scales
    assert again.transform(new).collect() == model.transform(new).collect()


def test_preparation_keeps_the_best(spark, rows):
    model = Preparation(["kind"], ["price"], ["n"], k=2, criterion="anova_f").fit(rows, "y")
    assert set(model.features) == {"kind_a", "kind_b"} and len(model.scores) == 2


def test_run_store(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    a, b = (ML.run_tag("classification", m, "y", "recall") for m in ("dt", "lr"))
    one = spark.createDataFrame([(1.0,)], "v double")
    store.write(a, {"t": one})
    store.write(b, {"t": one, "u": one})
    store.write(a, {"t": one.withColumn("v", F.lit(2.0))})
    got = {(r["model"], r["v"]) for r in store.read("t").collect()}
    assert got == {("dt", 2.0), ("lr", 1.0)} and store.read("u").count() == 1 and len(store.stale()) == 1
    # an attempt that fails before its manifest leaves the last run in place
    with pytest.raises(Exception):
        store.write(a, {"t": one, "w": one.select(F.raise_error(F.lit("stop")).alias("v"))})
    assert {(r["model"], r["v"]) for r in store.read("t").collect()} == got
    with pytest.raises(ValueError):
        store.read("missing")


def test_run_classification_and_voting(spark, tmp_path):
    rng = np.random.default_rng(0)
    data = [(i, float(rng.random()), float(rng.random()), ["x", "y"][i % 2]) for i in range(160)]
    v = spark.createDataFrame(data, "id long, price_total double, last_margin double, modelo_new string")
    v = v.withColumn("new_score", ((F.col("price_total") + F.col("last_margin")) > 1.2).cast("int"))
    for c in ["number_prev_sales", "last_stock_days", "navegacao", "sensores", "caixa_auto", "stock_days", "margem_percentagem",
              *[c for c in ML.history.HISTORY_COLUMNS if c not in ML.SCALED]]:
        v = v.withColumn(c, F.lit(1.0))
    for c in ("cor_exterior_new", "cor_interior_new", "jantes_new"):
        v = v.withColumn(c, F.lit("z"))
    data = ML.prepared(v, "id", oversample=True, folds=3)
    copies = data.train.groupBy("id").agg(F.count_distinct("fold").alias("f"), F.count("*").alias("n")).agg(F.max("f"), F.max("n"))
    assert copies.first()[0] == 1 and copies.first()[1] > 1
    store = runs.RunStore(spark, str(tmp_path))
    run = runs.run_classification(store, data, "dt", "accuracy", folds=3)
    assert run == "classification_dt_target_new_score_scoring_accuracy_oversample"
    pred = store.read("predictions").toPandas()
    assert len(pred) == 160 and set(pred["part"]) == {"train", "test"} and pred["id"].is_unique
    assert (pred["score_class_gt"] == pred["score_class_pred"]).mean() > 0.8 and pred["nr_cars_sold"].sum() == 80 * 160
    assert store.read("importances").count() == len(data.model.features) and store.read("grid").count() == 24
    assert set(store.read("class_report").toPandas()["class"]) == {"0.0", "1.0", "avg/total"}
    model, prep = store.model(run), store.preparation(run)
    again = training.predictions(model, prep.transform(v), "new_score", ["id"]).toPandas().set_index("id")
    first = pred.set_index("id")
    assert np.allclose(again["proba_1"].sort_index(), first["proba_1"].sort_index())
    found = training.vote(data.train, "new_score", "id", 3, "accuracy", 3, voters=("dt", "lr", "bayes"))
    training.save(spark, found.model, str(tmp_path / "vote"))
    out = training.predictions(training.load(spark, str(tmp_path / "vote")), data.test, "new_score", ["id"]).toPandas()
    each = [training.predictions(m, data.test, "new_score", ["id"]).toPandas().set_index("id")["proba_1"]
            for m in found.model.members.values()]
    assert np.allclose(out.set_index("id")["proba_1"], sum(each) / 3)


def test_folds_and_copies_share_one_rank(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 7 == 0)) for i in range(60)], "id long, y double")
    dealt = models.stratified_folds(df, "y", "id", k=3, seed=42)
    ranked = models.stratified_folds(df, "y", "id", k=3, seed=42, rank="r").cache()
    shared = sampling.oversample(ranked, "y", "id", seed=42, rank="r")
    again = sampling.oversample(dealt, "y", "id", seed=42)
    assert shared.columns == again.columns
    assert sorted(map(tuple, shared.collect())) == sorted(map(tuple, again.collect()))
    plan = shared._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("InMemoryRelation")[0]  # rows keep their place

    rng = np.random.default_rng(2)
    v = spark.createDataFrame([(i, *[float(a) for a in rng.random(4)], int(i % 5 == 0)) for i in range(80)],
                              "id long, price_total double, number_prev_sales double, last_margin double, "
                              "last_stock_days double, new_score int")
    for c in ["navegacao", "sensores", "caixa_auto", *[c for c in ML.history.HISTORY_COLUMNS if c not in ML.SCALED]]:
        v = v.withColumn(c, F.lit(1.0))
    ranks, rank = [], sampling.class_rank

    def counted(*args, **kw):
        ranks.append(args)
        return rank(*args, **kw)

    monkeypatch.setattr(sampling, "class_rank", counted)
    monkeypatch.setattr(models, "class_rank", counted)
    data = ML.prepared(v, "id", oversample=True, folds=3)
    assert len(ranks) == 2  # the split and the folds
    assert data.train.columns == [*v.columns, "is_train", "features", "fold", "copy_index", "weight"]
    sizes = data.train.groupBy("new_score").agg(F.count("*").alias("n"), F.min("weight"), F.max("weight")).collect()
    assert {tuple(r)[1:] for r in sizes} == {(48, 1.0, 1.0)}


def test_grouped_trees(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.random((900, 2))
    group = np.arange(900) % 3
    y = np.where(group == 0, x[:, 0] > 0.5, x[:, 1] > 0.3).astype(float)
    data = [(int(i), f"g{group[i]}" if i % 50 else None, [float(v) for v in x[i]], float(y[i]), int(i // 3 % 4)) for i in range(900)]
    df = spark.createDataFrame(data, "id long, place string, features array<double>, y double, fold int").cache()
    fitted = grouped.grouped_trees(df, "place", "y", folds=4, min_rows=(3, 10), depths=(1, 2)).cache()
    monkeypatch.setattr(grouped, "SMALL", 100)  # all groups are large ones now
    wide = {r["group"]: r for r in grouped.grouped_trees(df, "place", "y", folds=4, min_rows=(3, 10), depths=(1, 2)).collect()}
    rows = {r["group"]: r for r in fitted.collect()}
    assert set(rows) == {"g0", "g1", "g2"} == set(wide)
    for g, r in rows.items():
        own = trees.StagedModel.unpacked(r["settings"], bytes(r["arrays"]))
        assert r["score"] > 0.9 and wide[g]["score"] > 0.9 and r["n_train"] == wide[g]["n_train"]
        assert own.importance.argmax() == (0 if g == "g0" else 1)
    monkeypatch.setattr(grouped, "ROWS", 50)
    pred = grouped.grouped_predictions(df, fitted, "place", "id", "y").cache()
    assert pred.count() == df.where("place is not null").count()
    perf = {r["group"]: r for r in grouped.grouped_performance(pred).collect()}
    for g, own in pred.toPandas().groupby("group"):
        assert perf[g]["accuracy"] == pytest.approx((own["gt"] == own["pred"]).mean())
        neg = own[own["gt"] == 0]
        assert perf[g]["specificity"] == pytest.approx((neg["pred"] == 0).mean()) and perf[g]["n_test"] == len(own)


def test_evaluation_makes_predictions_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, None), (None, 0.0)] * 3
    pred = spark.createDataFrame(rows, "score_class_gt double, score_class_pred double")
    got = ML.evaluate(pred.mapInArrow(counted, pred.schema)).first().asDict()
    assert made.value == len(rows)
    f1 = metrics.f1_summary(pred, "score_class_gt", "score_class_pred").first().asDict()
    assert {k: got[k] for k in f1} == pytest.approx(f1)
    assert got["accuracy"] == pytest.approx(3 / 5)
    spec = metrics.binary_confusion(pred, "score_class_gt", "score_class_pred", positive=1.0).first()["specificity"]
    assert got["specificity"] == pytest.approx(spec) == pytest.approx(2 / 3)

"""Models and streams."""

import pytest
from pyspark.sql import functions as F

from textgrove.functions import vectors as V
from textgrove.operators import model as L
from textgrove.operators.scale import new_path
from textgrove.operators.terms import term_weights
from textgrove.plans.workflow import examine, explore, train_and_evaluate
from textgrove.streaming import scoring


def texts(spark, n=120):
    word = F.when(F.col("id") % 2 == 0, "good fine").otherwise("bad poor")
    text = F.concat(word, F.lit(" film number "), (F.col("id") % 5).cast("string"))
    return spark.range(n).select("id", text.alias("text"), (F.col("id") % 2).cast("int").alias("label"))


@pytest.fixture(scope="module")
def model(spark):
    return L.train(texts(spark), features=256, max_iter=5)


def test_train_and_evaluate(spark):
    out = train_and_evaluate(texts(spark), features=256, max_iter=5)
    assert out.results.first()["evaluation"]["accuracy"] == 1.0
    assert out.scored.groupBy("split").count().count() == 3
    assert examine(out.scored)["roc_auc"].first()[0] == 1.0
    assert explore(out.scored)["analysis"].count() == 3


def test_save_and_load(spark, model):
    path = new_path(spark, "model")
    L.save_model(model, path)
    a, b = L.predict(model, texts(spark)), L.predict(L.load_model(path), texts(spark))
    assert a.exceptAll(b).count() == 0
    with pytest.raises(Exception):
        L.load_model(path + "-absent")


def test_model_info(spark, model):
    r = L.model_info(model, texts(spark)).first()
    assert (r["num_labels"], r["num_parameters"]) == (2, 257)


def test_three_classes(spark):
    df = texts(spark).withColumn("label", (F.col("id") % 3).cast("int")).withColumn("text", F.concat(F.lit("c"), "label"))
    m = L.train(df, features=64, max_iter=5)
    assert L.predict(m, df).filter("y_pred <> label").count() == 0
    assert len(L.predict(m, df).first()["probabilities"]) == 3
    assert term_weights(df, 1).select("term").orderBy("class").collect()[2][0] == "c2"


def test_softmax_and_argmax(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 0.0],), ([-5.0, 3.0, 3.0],)], "x array<double>")
    rows = df.select(V.softmax(F.col("x")).alias("p"), V.argmax(F.col("x")).alias("i")).collect()
    assert rows[0]["p"] == pytest.approx([0.5, 0.5, 0.0]) and [r["i"] for r in rows] == [0, 1]
    names = df.select(V.prediction(V.softmax(F.col("x")), V.default_names(F.col("x"))).alias("r")).select("r.*")
    assert names.first()["predicted_class"] == "LABEL_0" and names.first()["class_names"][2] == "LABEL_2"


def test_tuning_counts_failures_as_zero(spark):
    space = {"regParam": (1e-4, 1e-1), "numFeatures": [64], "maxIter": (-2, -1)}
    trials = L.tune(texts(spark), texts(spark), trials=2, space=space)
    assert [r["value"] for r in trials.collect()] == [0.0, 0.0]


def test_params_repeat(spark):
    a, b = L.draw_params(20, 1), L.draw_params(20, 1)
    assert a == b != L.draw_params(20, 2)
    low, high = L.SEARCH["regParam"]
    assert all(low <= p["regParam"] <= high and p["numFeatures"] in L.SEARCH["numFeatures"] for p in a)


def test_best_trial(spark):
    trials = spark.createDataFrame([(0, None), (1, 0.7), (2, 0.7)], "trial_number int, value double")
    assert tuple(L.best_trial(trials).first()) == (1, 0.7)


@pytest.mark.parametrize("values, best, stop", [
    ([0.1, 0.2, 0.3], 3, None),
    ([0.5, 0.4, 0.3, 0.2, 0.9], 1, 4),
    ([0.5, 0.5, 0.6, 0.1, 0.6, 0.2, 0.9], 3, 6),
])
def test_early_stop(spark, values, best, stop):
    log = spark.createDataFrame([("a", i + 1, v) for i, v in enumerate(values)], "run string, step int, eval_f1 double")
    r = L.best_checkpoints(log).first()
    assert (r["best_step"], r["stop_step"]) == (best, stop)


def test_stream_counts_each_file_once(spark, model, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    first, second = texts(spark).filter("id < 70"), texts(spark).filter("id >= 70")

    def run():
        rows = scoring.watch(spark, source, first.schema, files_per_batch=1)
        scoring.write_stream(scoring.score_stream(rows, model), out, out + "-checkpoint").awaitTermination()
        return spark.read.parquet(out)

    first.write.mode("append").parquet(source)
    assert run().count() == 70
    second.write.mode("append").parquet(source)
    got = run()
    assert got.count() == 120 and got.select("id").distinct().count() == 120
    batch = L.predict(model, scoring.clean_stream(texts(spark)))
    assert got.select("id", "y_pred").exceptAll(batch.select("id", "y_pred")).count() == 0


def test_trials_of_one_size_share_their_features(spark, monkeypatch):
    """Words are weighted once for each size of the features; a size that fails is told by its trials alone."""
    asked, terms = [], L.weighted_terms
    monkeypatch.setattr(L, "weighted_terms", lambda features: asked.append(features) or terms(features))
    space = {"regParam": (1e-4, 1e-1), "numFeatures": [1 << 8, 1 << 9, -1], "maxIter": (1, 3)}
    drawn = [p["numFeatures"] for p in L.draw_params(8, space=space)]
    found = L.tune(texts(spark), texts(spark), trials=8, space=space, parallelism=2).orderBy("trial_number").collect()
    assert sorted(asked) == sorted(set(drawn)) and -1 in drawn and len(asked) < len(drawn)
    assert [r["error"] is not None for r in found] == [n < 0 for n in drawn]
    assert all(r["value"] == 0 if r["error"] else r["value"] > 0 for r in found)

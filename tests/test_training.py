"""Training in rounds, outside models, successive halving, bootstrap and term weights."""

import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from textgrove.operators import bootstrap, external, halving, rounds, terms
from textgrove.operators import model as L
from textgrove.operators.scale import new_path


def numbers(spark, n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        x, y = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, x, y if i % 50 else None, int(x + 0.5 * (y if i % 50 else 0) + rng.gauss(0, 0.3) > 0)))
    return spark.createDataFrame(rows, "id long, x double, y double, label int").repartition(5, "id")


def plain_descent(rows, steps, rate, reg):
    """Weights of the positive class after each step; the other class has the opposite ones."""
    x = np.array([(r["x"], r["y"] or 0.0, 1.0) for r in rows])
    y = np.array([r["label"] for r in rows])
    w, out = np.zeros(3), []
    for _ in range(steps):
        p = 1 / (1 + np.exp(-2 * x @ w))
        w = w - rate * ((p - y) @ x / len(y) + reg * w * [1, 1, 0])
        out.append(w)
    return out


def test_rounds_descend_and_resume(spark, tmp_path):
    table = numbers(spark)
    features = rounds.plain_features(["x", "y"])
    learn, check = table.filter("id % 4 > 0"), table.filter("id % 4 = 0")
    run = lambda folder, n: rounds.train_rounds(learn, check, str(tmp_path / folder), features, 2, rounds=n, rate=0.8, reg=0.01, patience=99)
    whole = run("whole", 7)
    plain = plain_descent(learn.collect(), 7, 0.8, 0.01)
    assert [r["step"] for r in whole.log.orderBy("step").collect()] == list(range(8))
    assert whole.weights[1] == pytest.approx(plain[whole.best_round - 1], abs=1e-12) and whole.weights[0] == pytest.approx(-whole.weights[1])
    run("ended", 3)
    # a round that was being written when the job was killed does not count
    os.remove(tmp_path / "ended" / "log" / "step=3" / "_SUCCESS")
    again = run("ended", 7)
    assert again.best_round == whole.best_round and again.weights == pytest.approx(whole.weights, abs=1e-12)
    assert again.log.exceptAll(whole.log).count() == 0 or again.log.count() == 8
    losses = [r["train_loss"] for r in whole.log.orderBy("step").collect()]
    assert losses[0] is None and losses[1] == pytest.approx(math.log(2)) and losses[1:] == sorted(losses[1:], reverse=True)
    with pytest.raises(ValueError, match="classes"):
        rounds.train_rounds(learn, check, str(tmp_path / "ended"), features, 3)
    assert rounds.load_rounds(spark, str(tmp_path / "ended")).log.count() == 8
    with pytest.raises(FileNotFoundError):
        rounds.load_rounds(spark, str(tmp_path / "none"))


def test_rounds_stop_when_nothing_gets_better(spark, tmp_path):
    table = numbers(spark).withColumn("label", F.when(F.col("id") % 9 == 0, F.lit(7)).otherwise(F.col("label")))
    found = rounds.train_rounds(table, table, str(tmp_path / "r"), rounds.plain_features(["x", "y"]), 2, rounds=60, rate=1.0, patience=3)
    steps = found.log.count() - 1
    assert found.stopped and steps == found.best_round + 3
    assert {r["n"] for r in found.log.collect()} == {table.filter("label < 2").count()}  # other labels are left out


def test_rounds_of_texts(spark, tmp_path):
    text = F.concat(F.lit("the "), F.element_at(F.array(*map(F.lit, ("good", "bad", "odd"))), (F.col("id") % 3 + 1).cast("int")), F.lit(" film"))
    table = spark.range(90).select("id", F.when(F.col("id") != 3, text).alias("text"), (F.col("id") % 3).cast("int").alias("label"))
    features = rounds.hashed_terms("text", 1 << 10)
    found = rounds.train_rounds(table, table, str(tmp_path / "t"), features, 1 << 10, classes=3, rounds=8, rate=0.5, adaptive=True)
    rows = rounds.predict_rounds(found, table, features, ["good", "bad", "odd"]).collect()
    assert all(r["prediction"]["predicted_class"] in r["text"] for r in rows if r["text"])
    assert all(sum(r["prediction"]["all_probabilities"]) == pytest.approx(1) and r["prediction"]["class_names"] == ["good", "bad", "odd"] for r in rows)
    assert rounds.predict_rounds(found, table.limit(0), features, ["good", "bad", "odd"]).count() == 0


def test_outside_model(spark, tmp_path):
    """Even batches, one load for each worker, probabilities as the model gives them."""
    (tmp_path / "factors").write_text("2 -2")
    loads = tmp_path / "loads"
    loads.mkdir()

    def load(path):
        with open(path) as f:
            factors = np.array(f.read().split(), float)
        (loads / f"{os.getpid()}-{random.random()}").touch()

        def score(batch):
            assert batch.num_rows <= 7 and batch.schema.names == ["x"]
            (loads.parent / f"rows-{os.getpid()}-{random.random()}").write_text(str(batch.num_rows))
            return np.outer([0.0 if v is None else v for v in batch.column("x").to_pylist()], factors)

        return score

    table = spark.range(0, 100, 1, 3).select("id", F.when(F.col("id") != 50, F.col("id") / 100 - 0.5).alias("x"), F.lit("kept").alias("other"))
    found = external.predict_external(table, str(tmp_path / "factors"), load, ["up", "down"], ["x"], 7, logits=True)
    rows = found.collect()
    assert found.columns == ["id", "x", "other", "prediction"] and len(rows) == 100
    for r in rows:
        p = 1 / (1 + math.exp(-4 * (r["x"] or 0)))
        assert r["prediction"]["all_probabilities"] == pytest.approx([p, 1 - p])
        assert r["prediction"]["confidence"] == pytest.approx(max(p, 1 - p))
        assert r["prediction"]["predicted_class"] == ("up" if p >= 0.5 else "down")
    sizes = sorted(int(p.read_text()) for p in tmp_path.glob("rows-*"))
    assert sum(sizes) == 100 and sizes.count(7) == len(sizes) - sum(s < 7 for s in sizes) and sum(s < 7 for s in sizes) <= 3
    per_worker = [name.split("-")[0] for name in os.listdir(loads)]
    assert len(set(per_worker)) == len(per_worker)
    assert external.predict_external(table.limit(0), str(tmp_path / "factors"), load, ["up", "down"], ["x"]).count() == 0
    with pytest.raises(Exception, match="3 classes"):
        external.predict_external(table, str(tmp_path / "factors"), load, ["a", "b", "c"], ["x"], 7).collect()
    with pytest.raises(FileNotFoundError):
        external.predict_external(table, str(tmp_path / "absent"), load, ["up", "down"], ["x"])


ON_A_CLUSTER = """
import sys
import numpy as np
from pyspark.sql import SparkSession
from textgrove.operators import external

spark = (
    SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false")
    .config("spark.driver.host", "127.0.0.1").config("spark.executorEnv.PYTHONPATH", sys.argv[1]).getOrCreate()
)

def load(path):
    with open(f"{path}/inner/factor") as f:
        factor = float(f.read())
    return lambda batch: np.outer(batch.column("x").to_numpy(), [factor, -factor])

found = external.predict_external(spark.range(4).selectExpr("id - 1.5D AS x"), sys.argv[2], load, ["up", "down"], ["x"], logits=True)
print("found", [r["prediction"]["predicted_class"] for r in found.orderBy("x").collect()])
spark.stop()
"""


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_outside_model_in_a_folder_on_a_cluster(tmp_path, scheme):
    """A bundle that is a folder of a mounted file system reaches executors that are not the driver."""
    inner = tmp_path / "my bundle" / "inner"
    inner.mkdir(parents=True)
    (inner / "factor").write_text("2")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run(
        [sys.executable, "-c", ON_A_CLUSTER, root, f"{scheme}{tmp_path}/my bundle"],
        env=os.environ | {"PYTHONPATH": root, "SPARK_LOCAL_IP": "127.0.0.1"}, capture_output=True, text=True, timeout=300, check=False,
    )
    assert "found ['down', 'down', 'up', 'up']" in run.stdout, run.stderr[-2000:]


def test_halving_goes_on_where_it_ended(spark, tmp_path):
    table = numbers(spark).select("id", "label")
    asked = []

    def evaluate(sample, params):
        asked.append((sample.count(), params["value"]))
        if params["value"] == 3:
            raise ArithmeticError("no fit")
        return params["value"] / 10

    trials = [{"value": v} for v in (1, 2, 3, 4, 4)]
    run = lambda: halving.successive_halving(table, trials, evaluate, str(tmp_path / "h"), rungs=3, eta=2, by=["label"])
    rows = {(r["rung"], r["trial_number"]): r for r in run().collect()}
    assert {k for k in rows if k[0] == 0} == {(0, t) for t in range(5)}
    assert {k[1] for k in rows if k[0] == 1} == {1, 3, 4} and {k[1] for k in rows if k[0] == 2} == {3, 4}
    assert "no fit" in rows[0, 2]["error"] and rows[0, 2]["value"] == 0 and not rows[0, 2]["kept"]
    assert [k for k, r in rows.items() if k[0] == 2 and r["kept"]] == [(2, 3)] and rows[2, 3]["n"] == table.count()
    before = len(asked)
    os.remove(tmp_path / "h" / "ledger" / "r1" / "t4" / "_SUCCESS")
    again = run()
    assert len(asked) == before + 1 and asked[-1] == (rows[1, 4]["n"], 4)
    assert halving.best_params(again) == {"value": 4}


def test_nested_samples(spark):
    table = numbers(spark).select("id", "label")
    for by in ([], ["label"]):
        parts = [{(r["id"], r["label"]) for r in s.collect()} for s in halving.nested_samples(table, [0.1, 0.5, 1.0], by=by)]
        assert parts[0] < parts[1] < parts[2] and len(parts[2]) == 400
        sizes = table.groupBy(*by).count().collect()
        for part, share in zip(parts, (0.1, 0.5, 1.0), strict=True):
            assert len(part) == sum(math.ceil(r["count"] * share) for r in sizes)


def test_bootstrap(spark):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        y = i % 3 == 0
        good, poor = rng.random() * 0.5 + 0.4 * y, rng.random()
        rows.append((i, int(y), int(good > 0.5), good, None if i == 7 else int(poor > 0.5), poor))
    table = spark.createDataFrame(rows, "id long, y_true int, a int, sa double, b int, sb double").repartition(4)
    first = table.select("id", "y_true", F.col("a").alias("y_pred"), F.col("sa").alias("score"))
    second = table.select("id", "y_true", F.col("b").alias("y_pred"), F.col("sb").alias("score"))
    found = {r["metric"]: r for r in bootstrap.bootstrap_difference(first, second, 60).collect()}
    assert found["auc"]["significant"] and found["auc"]["high"] < 0 and found["accuracy"]["replicates"] == 60
    drawn = spark.range(5000).withColumn("block", F.lit(3)).select(*[w.alias(f"w{k}") for k, w in enumerate(bootstrap.weights("id"))])
    for k in range(bootstrap.SHARED):  # Poisson numbers: mean and variance 1
        mean, variance = drawn.agg(F.avg(f"w{k}"), F.variance(f"w{k}")).first()
        assert abs(mean - 1) < 0.06 and abs(variance - 1) < 0.1
    # a replicate restated: its weights in a plain sum
    chosen = table.withColumn("block", F.lit(2)).select("y_true", "a", "b", bootstrap.weights("id")[1].alias("w")).collect()
    right = lambda c: sum(r["w"] for r in chosen if r["y_true"] == r[c]) / sum(r["w"] for r in chosen)
    values = {r["model"]: r["accuracy"] for r in bootstrap.replicate_metrics(first, second, 60).filter("replicate = 9").collect()}
    assert values == {"first": pytest.approx(right("a")), "second": pytest.approx(right("b"))}
    same = {r["metric"]: r for r in bootstrap.bootstrap_difference(first, first, 20).collect()}
    assert all(r["low"] == r["high"] == 0 and not r["significant"] for r in same.values())


def test_term_weights(spark):
    rows = [("good good film", 1), ("bad film", 0), (None, 1), ("", None), ("odd film", None)]
    table = spark.createDataFrame(rows, "text string, label int")
    found = terms.term_weights(table, 2)
    best = {(r["class"], r["rank"]): r["term"] for r in found.collect()}
    assert best[1, 1] == "good" and best[0, 1] == "bad" and best[None, 1] == "odd"
    assert terms.term_weights(table, 5, min_count=2).filter("term = 'odd'").count() == 0
    assert terms.term_weights(table.limit(0)).count() == 0
    # each task drops what cannot be among the first before rows are exchanged
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_model_terms(spark):
    text = F.when(F.col("id") % 2 == 0, "good fine film").otherwise("bad poor film")
    table = spark.range(60).select("id", text.alias("text"), (F.col("id") % 2).cast("int").alias("label"))
    found = terms.model_terms(L.train(table, features=512, max_iter=5), table, 2)
    best = {c: {r["term"] for r in found.collect() if r["class"] == c} for c in (0, 1)}
    assert best == {0: {"good", "fine"}, 1: {"bad", "poor"}}


def test_queries_write_below_the_shared_folder(spark):
    assert new_path(spark, "x").startswith(new_path(spark, "y").rsplit("/", 1)[0])

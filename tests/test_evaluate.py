"""Metrics: a published confusion matrix, Spark ML as a second opinion, properties."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from textgrove.operators import evaluate as E
from textgrove.queries.common import multiclass, scored

GOLDEN = [(0, 0, 11375), (0, 1, 1125), (1, 0, 925), (1, 1, 11575)]


@pytest.fixture(scope="module")
def golden(spark):
    cells = spark.createDataFrame(GOLDEN, "y_true int, y_pred int, n int")
    return cells.withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).select("y_true", "y_pred")


def test_golden_matrix(golden):
    m = E.metrics(golden).first()
    assert [round(m[k], 6) for k in ("accuracy", "precision", "recall", "f1")] == [0.918, 0.918107, 0.918, 0.917995]
    per = {r["class"]: r for r in E.per_class(golden).collect()}
    assert [round(per[0][k], 6) for k in ("precision", "recall", "f1")] == [0.924797, 0.91, 0.917339]
    assert [round(per[1][k], 6) for k in ("precision", "recall", "f1")] == [0.911417, 0.926, 0.918651]
    assert [tuple(r) for r in E.error_patterns(golden).collect()] == [("0 -> 1", 1125), ("1 -> 0", 925)]
    assert E.error_rate(golden).first()["error_rate"] == 0.082


def test_languages_in_percent_of_the_base(spark):
    table = spark.createDataFrame(
        [("en", 91.7), ("fr", 88.3), ("de", 87.0), ("es", 88.6), ("zh", 81.8)], "lang string, f1 double"
    )
    got = {r["lang"]: round(r["f1_pct_of_base"], 1) for r in E.relative_to(table, "en", ["f1"], "lang").collect()}
    assert got == {"en": 100.0, "fr": 96.3, "de": 94.9, "es": 96.6, "zh": 89.2}


def test_agrees_with_spark_ml(spark, sf_dir):
    rows = multiclass(spark, sf_dir).select(F.col("y_true").cast("double").alias("label"), F.col("y_pred").cast("double").alias("prediction"), "y_true", "y_pred")
    ours = E.metrics(rows).first()
    for name, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(rows))
    binary = scored(spark, sf_dir).select(F.col("y_true").cast("double").alias("label"), "y_true", "score")
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(binary)
    assert E.roc_auc(binary).first()[0] == pytest.approx(auc)


def test_auc_of_reversed_scores(spark, sf_dir):
    rows = scored(spark, sf_dir)
    reverse = rows.withColumn("score", -F.col("score"))
    assert E.roc_auc(rows).first()[0] + E.roc_auc(reverse).first()[0] == pytest.approx(1.0)


def test_auc_needs_two_classes(spark, sf_dir):
    assert E.roc_auc(scored(spark, sf_dir).filter("y_true = 1")).first()[0] is None
    three = spark.createDataFrame([(0, 0.1), (1, 0.5), (2, 0.7)], "y_true int, score double")
    assert E.roc_auc(three).first()[0] is None


def test_half_of_the_rows_share_a_score(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 2).cast("int").alias("y_true"),
        F.when(F.col("id") < 500, 0.5).otherwise(F.col("id") / 1000.0).alias("score"),
    )
    points = E.roc_points(rows).orderBy("fpr", "tpr").collect()
    assert (points[0]["fpr"], points[0]["tpr"], points[-1]["fpr"], points[-1]["tpr"]) == (0, 0, 1, 1)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(points, points[1:]))
    assert E.roc_auc(rows).first()[0] == pytest.approx(area)


def test_confusion_has_all_cells(spark):
    rows = spark.createDataFrame([(0, 0), (0, 2), (1, 0)], "y_true int, y_pred int")
    cells = {(r["y_true"], r["y_pred"]): (r["n"], r["share"]) for r in E.confusion(rows).collect()}
    assert len(cells) == 9 and cells[(0, 2)] == (1, 0.5) and cells[(1, 1)] == (0, 0.0) and cells[(2, 2)] == (0, None)
    assert E.metrics(rows).first()["recall"] == pytest.approx(1 / 3)


def test_unknown_split_means_test(spark):
    rows = spark.createDataFrame([(1, 1, "test"), (0, 1, "train")], "y_true int, y_pred int, split string")
    r = E.evaluate_split(rows, "nonsense").first()
    assert (r["dataset"], r["num_samples"], r["accuracy"]) == ("test", 1, 1.0)


def test_mcnemar_without_difference(spark):
    rows = spark.createDataFrame([(1, 1, 1), (2, 0, 1)], "id int, y_true int, y_pred int")
    r = E.mcnemar(rows, rows).first()
    assert r["statistic"] is None and r["significant"] is False

"""Text classifiers on Spark ML: training, scoring, tuning, comparison."""

from __future__ import annotations

import math
import random
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, OneVsRest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.functions.vectors import argmax
from textgrove.operators.evaluate import metrics
from textgrove.operators.scale import settle

FEATURES = 1 << 16

# Search space of the tuning: ranges, and choices for the size of the features.
SEARCH = {"regParam": (1e-6, 1e-1), "numFeatures": [1 << 14, 1 << 15, 1 << 16], "maxIter": (5, 20)}


def tokenizer(text: str = "text") -> RegexTokenizer:
    return RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\S+", gaps=False)


def weighted_terms(features: int = FEATURES) -> list:
    """Stages from words to TF-IDF vectors."""
    return [
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features"),
    ]


def train(
    df: DataFrame,
    text: str = "text",
    label: str = "label",
    features: int = FEATURES,
    max_iter: int = 20,
    reg: float = 1e-3,
) -> PipelineModel:
    """Fit a logistic regression on TF-IDF terms (MDL-1); several classes work as well."""
    classifier = LogisticRegression(
        labelCol=label, featuresCol="features", maxIter=max_iter, regParam=reg, family="auto"
    )
    return Pipeline(stages=[tokenizer(text), *weighted_terms(features), classifier]).fit(df)


def predict(model: PipelineModel, df: DataFrame, positive: int = 1) -> DataFrame:
    """Score a table (MDL-2): adds ``y_pred``, ``probabilities``, ``confidence`` and ``score``.

    ``score`` is the probability of the positive class.
    """
    probabilities = vector_to_array("probability")
    return (
        model.transform(df)
        .withColumn("probabilities", probabilities)
        .select(
            *df.columns,
            argmax(F.col("probabilities")).alias("y_pred"),
            "probabilities",
            F.array_max("probabilities").alias("confidence"),
            F.get("probabilities", F.lit(positive)).alias("score"),
        )
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A saved model; a path without one is an error (MDL-4)."""
    return PipelineModel.load(path)


def model_info(model: PipelineModel, df: DataFrame, name: str = "model") -> DataFrame:
    """Classes, parameters and size in MB of the classifier, one row (MDL-5)."""
    stage = model.stages[-1]
    if hasattr(stage, "coefficientMatrix"):
        matrix = stage.coefficientMatrix
        parameters = matrix.numRows * matrix.numCols + len(stage.interceptVector)
    elif hasattr(stage, "theta"):
        parameters = stage.theta.numRows * stage.theta.numCols + len(stage.pi)
    else:
        parameters = len(stage.coefficients) + 1
    row = (name, stage.numClasses, parameters, parameters * 8 / 2**20)
    return df.sparkSession.createDataFrame(
        [row], "model string, num_labels int, num_parameters long, model_size_mb double"
    )


def draw_params(trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded random parameters: a log-uniform rate, a choice, a whole number (MDL-6)."""
    space, rng, drawn = space or SEARCH, random.Random(seed), []
    low, high = (math.log(x) for x in space["regParam"])
    for _ in range(trials):
        drawn.append(
            {
                "regParam": math.exp(rng.uniform(low, high)),
                "numFeatures": rng.choice(space["numFeatures"]),
                "maxIter": rng.randint(*space["maxIter"]),
            }
        )
    return drawn


def tune(
    training: DataFrame,
    validation: DataFrame,
    trials: int = 20,
    seed: int = 42,
    text: str = "text",
    label: str = "label",
    space: dict | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Random search for the best weighted F1 on the validation rows (MDL-6).

    Texts are cut into words once for all trials, and words are weighted once for each size of the
    features. A trial that fails counts 0 and tells its ``error``. Returns
    ``(trial_number, value, params, error)``.
    """
    words = lambda df: settle(tokenizer(text).transform(df).select("words", F.col(label).alias("label")), "words")
    fit_rows, check_rows = words(training), words(validation)
    spark = training.sparkSession

    told = lambda failure: f"{type(failure).__name__}: {failure}"

    def weigh(features: int) -> tuple[list[DataFrame], str | None]:
        try:
            terms = Pipeline(stages=weighted_terms(features)).fit(fit_rows)
            return [settle(terms.transform(df).select("features", "label"), "features") for df in (fit_rows, check_rows)], None
        except Exception as failure:
            return [], told(failure)

    def run(params: dict) -> tuple[float, str | None]:
        weighted, error = weighted_by[params["numFeatures"]]
        if error is not None:
            return 0.0, error
        try:
            fit, check = weighted
            model = LogisticRegression(maxIter=params["maxIter"], regParam=params["regParam"]).fit(fit)
            scored = model.transform(check).select(
                F.col("label").alias("y_true"), F.col("prediction").cast("int").alias("y_pred")
            )
            return metrics(scored).first()["f1"] or 0.0, None
        except Exception as failure:
            return 0.0, told(failure)

    drawn = draw_params(trials, seed, space)
    sizes = sorted({p["numFeatures"] for p in drawn})
    with ThreadPool(parallelism) as pool:
        weighted_by = dict(zip(sizes, pool.map(weigh, sizes)))
        values = pool.map(run, drawn)
    rows = [(i, v, p["regParam"], p["numFeatures"], p["maxIter"], e) for i, ((v, e), p) in enumerate(zip(values, drawn))]
    flat = spark.createDataFrame(
        rows, "trial_number int, value double, regParam double, numFeatures int, maxIter int, error string"
    )
    params = F.struct("regParam", "numFeatures", "maxIter").alias("params")
    return flat.select("trial_number", "value", params, "error")


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest value, the earlier one of equals (MDL-7)."""
    value = F.coalesce("value", F.lit(0.0))
    return trials.withColumn("value", value).orderBy(F.col("value").desc(), "trial_number").limit(1)


def compare(
    training: DataFrame, test: DataFrame, text: str = "text", label: str = "label", features: int = FEATURES
) -> DataFrame:
    """Train several kinds of model on the same features and score the same rows (MDL-8).

    Returns scored rows with a column ``model``, ready for ``compare_models``.
    The support vector machine separates two classes, or each of several from the rest.
    """
    prepared = Pipeline(stages=[tokenizer(text), *weighted_terms(features)]).fit(training)
    fields = lambda df: settle(prepared.transform(df).select(*df.columns, "features"), "features")
    fit_rows, test_rows = fields(training), fields(test)
    kinds = {
        "logistic": LogisticRegression(labelCol=label, maxIter=20, regParam=1e-3),
        "bayes": NaiveBayes(labelCol=label),
    }
    classes = fit_rows.select(label).distinct().count()
    if classes < 2:
        raise ValueError(f"{label} has {classes} classes; a comparison needs two")
    svm = LinearSVC(labelCol=label, maxIter=20, regParam=1e-3)
    kinds["svm"] = svm if classes == 2 else OneVsRest(labelCol=label, classifier=svm)
    parts = []
    for name, kind in kinds.items():
        rows = kind.fit(fit_rows).transform(test_rows)
        parts.append(
            rows.select(
                *test.columns,
                F.lit(name).alias("model"),
                F.col(label).alias("y_true"),
                F.col("prediction").cast("int").alias("y_pred"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cross_lingual(
    df: DataFrame, target: list[str], lang: str = "lang", text: str = "text", label: str = "label"
) -> DataFrame:
    """Train on the target languages and score all others (MDL-9)."""
    is_target = F.coalesce(F.col(lang).isin(target), F.lit(False))
    model = train(df.filter(is_target), text, label)
    return predict(model, df.filter(~is_target)).withColumn("y_true", F.col(label))


def best_checkpoints(
    log: DataFrame, patience: int = 3, run: str = "run", step: str = "step", metric: str = "eval_f1"
) -> DataFrame:
    """Best checkpoint of each run and the step at which it stops early (MDL-11).

    A run stops at the first step with ``patience`` evaluations in a row that
    do not exceed the best before them; later steps do not count.
    """
    order = Window.partitionBy(run).orderBy(step)
    before = F.max(metric).over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = log.withColumn("_no", F.row_number().over(order)).withColumn(
        "_better", before.isNull() | (F.col(metric) > before)
    )
    latest = F.max(F.when(F.col("_better"), F.col("_no"))).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stale = numbered.withColumn("_stale", F.col("_no") - latest)
    stop = F.min(F.when(F.col("_stale") >= patience, F.col(step))).over(Window.partitionBy(run))
    counted = stale.withColumn("_stop", stop).filter(F.col("_stop").isNull() | (F.col(step) <= F.col("_stop")))
    best = F.when(F.col("_better"), F.struct(F.col(metric), (-F.col("_no")).alias("_o"), F.col(step)))
    return counted.groupBy(run).agg(
        F.max(best)[step].alias("best_step"),
        F.max(metric).alias("best_value"),
        F.first("_stop").alias("stop_step"),
        F.count("*").alias("evaluations"),
    )


def cluster_errors(errors: DataFrame, k: int = 5, text: str = "text", features: int = FEATURES, seed: int = 42) -> DataFrame:
    """Put misclassified texts with similar terms into groups (EVL-23)."""
    clusters = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed)
    model = Pipeline(stages=[tokenizer(text), *weighted_terms(features), clusters]).fit(errors)
    return model.transform(errors).select(*errors.columns, "cluster")

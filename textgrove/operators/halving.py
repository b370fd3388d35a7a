"""Search for parameters that spends little on bad ones: successive halving with a ledger."""

from __future__ import annotations

import json
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.operators.evaluate import metrics
from textgrove.operators.model import draw_params, tokenizer, train, weighted_terms
from textgrove.operators.scale import match, seeded_cuts, settle, within

LEDGER = "rung int, trial_number int, params string, n long, value double, error string"


def nested_samples(rows: DataFrame, fractions: list[float], id_col: str = "id", by: list[str] | None = None, seed: int | str = 42) -> list[DataFrame]:
    """Samples of growing size, each one holding those before it, with the same share of each stratum.

    Of a stratum of n rows the sample has the first ``ceil(n * fraction)`` in a seeded order of the ids.
    """
    placed, by = (rows, by) if by else (rows.withColumn("_all", F.lit(0)), ["_all"])
    names = [f"cut_{k}" for k in range(len(fractions))]
    wanted = F.array(*[F.struct(F.lit(n).alias("cut"), F.ceil(F.col("_n") * f).alias("k")) for n, f in zip(names, fractions, strict=True)])
    sizes = settle(placed.groupBy(*by).agg(F.count("*").alias("_n")), "sizes").select(*by, F.inline(wanted))
    placed = match(placed, seeded_cuts(placed, sizes, names, id_col, by, seed), by)
    return [placed.filter(within(id_col, seed, n)).select(rows.columns) for n in names]


def ledger(spark: SparkSession, folder: str, eta: int = 2) -> DataFrame:
    """The written trials: ``(rung, trial_number, params, n, value, error, kept)``.

    ``kept`` are those that went on to the next rung: one in ``eta`` of each, the best ones first, the
    earlier of equals.
    """
    order = Window.partitionBy("rung").orderBy(F.round(F.coalesce("value", F.lit(0.0)), 9).desc(), "trial_number")
    size = F.count("*").over(Window.partitionBy("rung"))
    rows = spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{folder}/ledger")
    return rows.withColumn("kept", F.row_number().over(order) <= F.ceil(size / eta))


def successive_halving(
    rows: DataFrame,
    trials: list[dict],
    evaluate: Callable[[DataFrame, dict], float],
    folder: str,
    rungs: int = 3,
    eta: int = 2,
    id_col: str = "id",
    by: list[str] | None = None,
    seed: int | str = 42,
    parallelism: int = 4,
) -> DataFrame:
    """The ledger of a search that tries all parameters on few rows and the best of them on more (MDL-6).

    On the first of ``rungs`` rungs all trials are evaluated on a sample; one in ``eta`` goes on to the
    next, on ``eta`` times the rows, the former ones among them; the last rung has all rows. A trial that
    fails counts 0 and tells its ``error``. Each result is a file of its own below ``folder``: a job that
    is started again with the same arguments evaluates only what is not there.
    """
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    samples = nested_samples(rows, [eta ** -(rungs - 1 - r) for r in range(rungs)], id_col, by, seed)
    left = list(range(len(trials)))
    for rung, sample in enumerate(samples):
        place = lambda t, r=rung: f"{folder}/ledger/r{r}/t{t}"
        missing = [t for t in left if not store.exists(path(f"{place(t)}/_SUCCESS"))]
        if missing:
            sample = settle(sample, "sample")
            n = sample.count()

            def run(t: int, sample=sample, n=n, rung=rung, place=place) -> None:
                try:
                    value, error = evaluate(sample, trials[t]), None
                except Exception as failure:
                    value, error = 0.0, f"{type(failure).__name__}: {failure}"[:1000]
                one = [(rung, t, json.dumps(trials[t]), n, value, error)]
                spark.createDataFrame(one, LEDGER).coalesce(1).write.mode("overwrite").parquet(place(t))

            with ThreadPool(parallelism) as pool:
                pool.map(run, missing)
        kept = ledger(spark, folder, eta).filter((F.col("rung") == rung) & F.col("kept"))
        left = sorted(r["trial_number"] for r in kept.select("trial_number").collect())  # trials of the caller
    return ledger(spark, folder, eta)


def best_params(found: DataFrame) -> dict:
    """Parameters of the best trial of the last rung of a ledger."""
    order = [F.col("rung").desc(), F.round(F.coalesce("value", F.lit(0.0)), 9).desc(), F.col("trial_number")]
    return json.loads(found.orderBy(*order).first()["params"])


def tune_by_halving(
    training: DataFrame,
    validation: DataFrame,
    folder: str,
    trials: int = 8,
    rungs: int = 3,
    eta: int = 2,
    seed: int = 42,
    id_col: str = "id",
    text: str = "text",
    label: str = "label",
    space: dict | None = None,
) -> tuple[DataFrame, PipelineModel]:
    """The ledger of a search for a text classifier and the classifier of the best parameters.

    Trials are seeded random draws (``draw_params``), judged by the weighted F1 on the validation rows;
    the final classifier is fitted on all training rows.
    """
    words = lambda df: tokenizer(text).transform(df)
    rows = settle(words(training).select(id_col, label, "words"), "words")
    check = settle(words(validation).select(F.col(label).alias("y_true"), "words"), "words")

    def evaluate(sample: DataFrame, params: dict) -> float:
        classifier = LogisticRegression(labelCol=label, maxIter=params["maxIter"], regParam=params["regParam"])
        model = Pipeline(stages=[*weighted_terms(params["numFeatures"]), classifier]).fit(sample)
        scored = model.transform(check).select("y_true", F.col("prediction").cast("int").alias("y_pred"))
        return metrics(scored).first()["f1"] or 0.0

    found = successive_halving(rows, draw_params(trials, seed, space), evaluate, folder, rungs, eta, id_col, [label], seed)
    best = best_params(found)
    return found, train(training, text, label, best["numFeatures"], best["maxIter"], best["regParam"])

"""Linear classifiers trained in rounds that are written down as they end.

Each round is one pass over the rows: every task sums the gradient of its own rows, sums of several
tasks are added up in between, and the driver holds one array of the size of the model. After each
round the weights and the metrics on the validation rows are written; training stops when they no
longer get better, goes back to the best round, and can be taken up again where it was ended.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrove.operators.evaluate import metrics
from textgrove.operators.external import add_records, softmax
from textgrove.operators.model import best_checkpoints
from textgrove.operators.scale import settle
from textgrove.operators.terms import words_of

#: Partial sums that are added up at a time.
FAN = 16
STATE = "round long, weights binary, squares binary, classes int, features int"
LOG = "run string, step long, train_loss double, accuracy double, precision double, recall double, eval_f1 double, n long"


def plain_features(columns: list[str]) -> tuple[Column, Column]:
    """Indices and values of numeric columns; a null is 0."""
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return F.sequence(F.lit(0), F.lit(len(columns) - 1)), values


def hashed_terms(text: str = "text", size: int = 1 << 16) -> tuple[Column, Column]:
    """Indices and values of the words of a text: hashed, one of each, the rows of length one."""
    found = F.array_distinct(F.transform(words_of(text), lambda w: F.pmod(F.hash(w), F.lit(size)).cast("int")))
    length = F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))
    return found, F.transform(found, lambda _: 1 / length)


@dataclass(frozen=True)
class Rounds:
    """Weights (classes x features and a constant) of the best round, and the log of all rounds."""

    weights: np.ndarray
    best_round: int
    stopped: bool
    log: DataFrame


def _margins(weights: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Margins of the rows of a batch by class; index, value and row of each of their features."""
    indices, values = batch.column("indices"), batch.column("values")
    sizes = indices.value_lengths().to_numpy(zero_copy_only=False)
    index, value = indices.flatten().to_numpy(), values.flatten().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    margins = np.stack([np.bincount(row, w[index] * value, len(sizes)) + w[-1] for w in weights], 1)
    return margins, index, value, row


def _gradient(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Summed gradient of the logistic loss, loss, and number of rows; the order of sums is fixed."""
    shape = weights.shape
    schema = "task long, gradient binary, loss double, n long"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total, loss, n = np.zeros(shape), 0.0, 0
        for batch in batches:
            margins, index, value, row = _margins(weights, batch)
            p, y = softmax(margins), batch.column("y").to_numpy()
            mine = np.arange(len(y))
            loss -= float(np.log(np.maximum(p[mine, y], 1e-300)).sum())
            p[mine, y] -= 1
            for c in range(shape[0]):
                total[c, :-1] += np.bincount(index, p[row, c] * value, shape[1] - 1)
                total[c, -1] += p[:, c].sum()
            n += len(y)
        if n:
            one = {"task": TaskContext.get().partitionId(), "gradient": total.tobytes(), "loss": loss, "n": n}
            yield pa.RecordBatch.from_pylist([one], pa.schema([("task", pa.int64()), ("gradient", pa.binary()), ("loss", pa.float64()), ("n", pa.int64())]))

    def added(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("task")
        total = np.sum([np.frombuffer(g) for g in part["gradient"]], 0)
        return pd.DataFrame({"task": part["task"].iloc[:1] // FAN, "gradient": [total.tobytes()], "loss": [part["loss"].sum()], "n": [part["n"].sum()]})

    partial = rows.mapInArrow(summed, schema)
    some = partial.groupBy(F.floor(F.col("task") / FAN)).applyInPandas(added, schema).collect()
    some.sort(key=lambda r: r["task"])
    total = np.sum([np.frombuffer(r["gradient"]) for r in some], 0) if some else np.zeros(weights.size)
    return total.reshape(shape), sum(r["loss"] for r in some), sum(r["n"] for r in some)


def _scored(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(y_true, y_pred)`` of prepared rows."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = _margins(weights, batch)[0].argmax(1)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(best.astype(np.int32))], ["y_true", "y_pred"])

    return rows.mapInArrow(scored, "y_true int, y_pred int")


def _prepared(df: DataFrame, features: tuple[Column, Column], label: str) -> DataFrame:
    return settle(df.select(features[0].cast("array<int>").alias("indices"), features[1].cast("array<double>").alias("values"), F.col(label).cast("int").alias("y")), "features")


def _written(spark: SparkSession, folder: str) -> int:
    """The last round whose state is complete below ``folder``; -1 if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    done = -1
    while store.exists(path(f"{folder}/log/step={done + 1}/_SUCCESS")):
        done += 1
    return done


def training_log(spark: SparkSession, folder: str) -> DataFrame:
    """``(run, step, train_loss, accuracy, precision, recall, eval_f1, n)`` of the complete rounds."""
    done = _written(spark, folder)
    paths = [f"{folder}/log/step={k}" for k in range(done + 1)]
    return spark.read.schema(LOG).parquet(*paths) if paths else spark.createDataFrame([], LOG)


def load_rounds(spark: SparkSession, folder: str, patience: int = 3) -> Rounds:
    """The best of the rounds that are written below ``folder``."""
    log = training_log(spark, folder)
    found = best_checkpoints(log, patience).first()
    if found is None:
        raise FileNotFoundError(f"no round of training is complete in {folder}")
    best = spark.read.schema(STATE).parquet(f"{folder}/state/step={found['best_step']}").first()
    weights = np.frombuffer(best["weights"]).reshape(best["classes"], best["features"] + 1)
    return Rounds(weights, found["best_step"], found["stop_step"] is not None, log)


def train_rounds(
    training: DataFrame,
    validation: DataFrame,
    folder: str,
    features: tuple[Column, Column],
    size: int,
    label: str = "label",
    classes: int = 2,
    rounds: int = 50,
    rate: float = 0.5,
    reg: float = 1e-4,
    adaptive: bool = False,
    patience: int = 3,
    run: str = "run",
) -> Rounds:
    """Fit a linear classifier of several classes in rounds (MDL-1, MDL-11).

    ``features`` are indices below ``size`` and values, as by ``plain_features`` or ``hashed_terms``;
    labels are 0 .. ``classes`` - 1, rows with others or none are left out. A round moves the weights,
    zero at first, by ``rate`` times the mean gradient of the logistic loss and ``reg`` times the weights
    but for the constant; ``adaptive`` divides the step of each weight by the root of the squares of
    its gradients so far. Then its row of the log is written to ``folder``: the loss before the step and
    the metrics of the validation rows after it. Round 0 is the beginning, without a loss.

    Training ends after ``rounds`` rounds or when ``eval_f1`` was not above its best in ``patience`` rounds in
    a row (``best_checkpoints``); the weights returned are those of the best round, the earliest of
    several. Called again with the same folder, it goes on behind the last round that is complete
    there, with the same results: the sums of a round have a fixed order.
    """
    spark, shape = training.sparkSession, (classes, size + 1)
    known = F.col("y").between(0, classes - 1)
    rows, check = (_prepared(df, features, label).filter(known) for df in (training, validation))
    done = _written(spark, folder)
    if done >= 0:
        state = spark.read.schema(STATE).parquet(f"{folder}/state/step={done}").first()
        if (state["classes"], state["features"]) != (classes, size):
            raise ValueError(f"{folder} holds a model of {state['classes']} classes and {state['features']} features")
        weights, squares = (np.frombuffer(state[k]).reshape(shape).copy() for k in ("weights", "squares"))
    else:
        weights, squares = np.zeros(shape), np.zeros(shape)

    def write(step: int, loss: float | None) -> None:
        one = [(step, weights.tobytes(), squares.tobytes(), classes, size)]
        spark.createDataFrame(one, STATE).coalesce(1).write.mode("overwrite").parquet(f"{folder}/state/step={step}")
        found = metrics(_scored(check, weights)).withColumnRenamed("f1", "eval_f1")
        line = found.select(
            F.lit(run).alias("run"), F.lit(step).cast("long").alias("step"), F.lit(loss).cast("double").alias("train_loss"),
            "accuracy", "precision", "recall", "eval_f1", "n",
        )
        line.coalesce(1).write.mode("overwrite").parquet(f"{folder}/log/step={step}")  # complete with this

    if done < 0:
        write(0, None)
        done = 0
    stop = best_checkpoints(training_log(spark, folder), patience).first()
    while done < rounds and stop["stop_step"] is None:
        total, loss, n = _gradient(rows, weights)
        slope = total / max(n, 1)
        slope[:, :-1] += reg * weights[:, :-1]
        squares += slope**2
        weights = weights - rate * (slope / np.sqrt(squares + 1e-12) if adaptive else slope)
        done += 1
        write(done, loss / max(n, 1))
        stop = best_checkpoints(training_log(spark, folder), patience).first()
    return load_rounds(spark, folder, patience)


def predict_rounds(model: Rounds, df: DataFrame, features: tuple[Column, Column], names: list[str], record: str = "prediction") -> DataFrame:
    """``df`` with the prediction record of each row."""
    weights = model.weights
    score = lambda _, batch: _margins(weights, batch)[0]
    kinds = {"indices": features[0].cast("array<int>"), "values": features[1].cast("array<double>")}
    return add_records(df, object, score, names, 1024, True, record, **kinds)

"""Workflows: explore a data set, train and evaluate a classifier, examine predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrove.operators import evaluate as E
from textgrove.operators import profile as P
from textgrove.operators.language import preprocess
from textgrove.operators.model import model_info, predict, train
from textgrove.operators.scale import settle
from textgrove.operators.split import prepare_splits
from textgrove.sources.sinks import final_results


def explore(df: DataFrame, text: str = "text", label: str = "label", split: str = "split") -> dict[str, DataFrame]:
    """Statistics, balance, histograms and advice for a table with splits."""
    training = df.filter(F.col(split) == "train")
    measured = P.measure(training.select(text, label), text)
    analysis = P.analyze(df, text, label, split)
    return {
        "analysis": analysis,
        "chars": P.describe(measured, "chars"),
        "words": P.describe(measured, "words"),
        "labels": P.label_shares(training, label),
        "imbalance": P.imbalance(training, label),
        "chars_histogram": P.histogram(measured, "chars", 50),
        "words_histogram": P.histogram(measured, "words", 50),
        "chars_by_label": P.histogram(measured, "chars", 30, [label]),
        "advice": P.advice(analysis),
    }


@dataclass(frozen=True)
class Outcome:
    """A fitted model, the scored rows of all splits and the results as one nested row."""

    model: PipelineModel
    scored: DataFrame
    results: DataFrame


def train_and_evaluate(
    df: DataFrame,
    id_col: str = "id",
    text: str = "text",
    label: str = "label",
    validation: float = 0.2,
    test: float = 0.1,
    seed: int = 42,
    **options,
) -> Outcome:
    """Split, clean, train on the training rows, score and evaluate the test rows.

    The cleaned rows are written once; fitting and scoring read them back.
    """
    parts = prepare_splits(df, id_col, label, validation, test, seed)
    rows = settle(preprocess(parts, text), "clean")
    model = train(rows.filter(F.col("split") == "train"), text, label, **options)
    scored = settle(predict(model, rows).withColumn("y_true", F.col(label)), "scored")
    results = final_results(
        training=E.evaluate_split(scored, "train"),
        evaluation=E.evaluate_split(scored, "test"),
        model_info=model_info(model, df),
        settings={"validation": validation, "test": test, "seed": seed},
    )
    return Outcome(model, scored, results)


def examine(scored: DataFrame, name: str = "test", examples: int = 10, id_col: str = "id") -> dict[str, DataFrame]:
    """All evaluations of a table of scored rows, each as its own small query."""
    return {
        "metrics": E.metrics(scored),
        "per_class": E.per_class(scored),
        "confusion": E.confusion(scored),
        "roc_points": E.roc_points(scored),
        "roc_auc": E.roc_auc(scored),
        "error_rate": E.error_rate(scored),
        "error_patterns": E.error_patterns(scored),
        "error_examples": E.error_examples(scored, examples, id_col),
        "scores": E.score_histogram(scored),
        "reliability": E.reliability(scored),
        "report": E.report(scored, name),
    }

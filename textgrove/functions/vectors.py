"""Class scores: softmax, argmax and the prediction record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgrove.functions.binding import once


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the maximum for stability."""
    powers = once(
        F.array_max(logits),
        lambda top: F.transform(logits, lambda x: F.exp(x.cast("double") - top.cast("double"))),
    )
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return once(powers, lambda p: once(total(p), lambda t: F.transform(p, lambda x: x / t)))


def argmax(values: Column) -> Column:
    """Index of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def prediction(probabilities: Column, names: Column) -> Column:
    """Prediction struct of an array of probabilities and an array of class names."""
    return F.struct(
        F.get(names, argmax(probabilities)).alias("predicted_class"),
        F.array_max(probabilities).alias("confidence"),
        probabilities.alias("all_probabilities"),
        names.alias("class_names"),
    )


def default_names(probabilities: Column) -> Column:
    """``LABEL_0``, ``LABEL_1``, ... for as many classes as there are probabilities."""
    return F.transform(
        F.sequence(F.lit(0), F.size(probabilities) - 1),
        lambda i: F.concat(F.lit("LABEL_"), i.cast("string")),
    )

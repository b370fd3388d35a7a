"""Intervals of metrics and of their differences by a Poisson bootstrap in one pass."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.operators.evaluate import metrics_of
from textgrove.operators.scale import settle

#: Replicates that one hash serves: eight hexadecimal digits each.
SHARED = 4
#: Distribution function of a Poisson number of mean 1, for 0 to 11.
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(12)]


def weights(id_col: str = "id", seed: int | str = 42, block: str = "block") -> list[Column]:
    """How often a row counts in each replicate of a block: Poisson numbers from a hash of seed, block and id."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(block).cast("string"), F.col(id_col).cast("string")))
    out = []
    for k in range(SHARED):
        even = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("double") / 2**32
        out.append(reduce(lambda a, b: a + b, [(even >= p).cast("long") for p in POISSON]))
    return out


def _replicated(rows: DataFrame, by: list[str], replicates: int, id_col: str, seed: int | str) -> DataFrame:
    """``(by..., replicate, n)``: the weighted rows of each group in each replicate."""
    blocks = F.sequence(F.lit(0), F.lit(math.ceil(replicates / SHARED) - 1))
    drawn = rows.select("*", F.explode(blocks).alias("block"))
    weighted = drawn.select(*by, "block", *[w.alias(f"w{k}") for k, w in enumerate(weights(id_col, seed))])
    summed = weighted.groupBy(*by, "block").agg(*[F.sum(f"w{k}").alias(f"w{k}") for k in range(SHARED)])
    cells = F.array(*[F.struct((F.col("block") * SHARED + k).alias("replicate"), F.col(f"w{k}").alias("n")) for k in range(SHARED)])
    return summed.select(*by, F.inline(cells)).filter((F.col("replicate") < replicates) & (F.col("n") > 0))


def _areas(counts: DataFrame, by: list[str], positive: int) -> DataFrame:
    """Area under the ROC curve per ``by`` from ``n`` rows of each score and class; null with one class only."""
    sides = counts.groupBy(*by, "bin").agg(
        F.sum(F.when(F.col("y_true") == positive, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("y_true") != positive, F.col("n")).otherwise(0)).alias("neg"),
    )
    below = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("pos") * (F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg") / 2)
    summed = sides.withColumn("won", won).groupBy(*by).agg(F.sum("won").alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    return summed.select(*by, F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("won") / (F.col("p") * F.col("q"))).alias("auc"))


def _both(first: DataFrame, second: DataFrame, id_col: str) -> DataFrame:
    """One row for each id that both models have scored."""
    other = second.select(id_col, F.col("y_pred").alias("_pred"), F.col("score").alias("_score"))
    return first.select(id_col, "y_true", "y_pred", "score").join(other, id_col)


def replicate_metrics(
    first: DataFrame, second: DataFrame, replicates: int = 200, seed: int | str = 42, bins: int = 1000, id_col: str = "id", positive: int = 1
) -> DataFrame:
    """``(replicate, model, accuracy, precision, recall, f1, auc)``; replicate -1 is the table as it is.

    Both models are drawn the same rows. What is exchanged and kept are counts: of true and predicted
    classes, and of classes in ``bins`` equal steps of the score between 0 and 1, on which the area is
    computed; it is exact for scores of as many steps.
    """
    rows = _both(first, second, id_col)
    grid = lambda c: F.least(F.floor(F.col(c) * bins), F.lit(bins - 1)).cast("int")
    models = lambda a, b, name: F.inline(F.array(*[F.struct(F.lit(m).alias("model"), c.alias(name)) for m, c in (("first", a), ("second", b))]))
    plain = lambda by: rows.groupBy(*by).agg(F.count("*").alias("n")).withColumn("replicate", F.lit(-1))
    drawn = lambda by: _replicated(rows, by, replicates, id_col, seed)
    pairs = ["y_true", "y_pred", "_pred"]
    cells = settle(drawn(pairs).unionByName(plain(pairs)), "cells")
    by = ["replicate", "model"]
    cells = cells.select("replicate", "y_true", "n", models(F.col("y_pred"), F.col("_pred"), "y_pred"))
    classes = metrics_of(cells.groupBy(*by, "y_true", "y_pred").agg(F.sum("n").alias("n")), by)
    rows = rows.filter("y_true is not null and score is not null and _score is not null").select(
        id_col, "y_true", models(grid("score"), grid("_score"), "bin")
    )
    places = ["model", "y_true", "bin"]
    curves = settle(drawn(places).unionByName(plain(places)), "curves")
    areas = _areas(curves, by, positive)
    return classes.join(areas, by, "left").select(*by, "accuracy", "precision", "recall", "f1", "auc")


def bootstrap_difference(
    first: DataFrame,
    second: DataFrame,
    replicates: int = 200,
    level: float = 0.95,
    seed: int | str = 42,
    bins: int = 1000,
    id_col: str = "id",
    positive: int = 1,
) -> DataFrame:
    """Whether two models differ in accuracy, F1 and area under the curve (EVL-22).

    One row per metric: ``first``, ``second``, their ``difference``, the interval ``low`` to ``high`` of the
    differences of ``replicates`` bootstrap replicates at ``level``, and ``significant`` if 0 is outside it.
    Rows that only one model has are left out; a null prediction is an error. A row counts in each
    replicate by a hash of its id, so that reruns agree and rows are read where they lie.
    """
    found = settle(replicate_metrics(first, second, replicates, seed, bins, id_col, positive), "replicates")
    named = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "f1", "auc")]))
    long = found.select("replicate", "model", named)
    wide = long.groupBy("replicate", "metric").pivot("model", ["first", "second"]).agg(F.first("value"))
    wide = wide.withColumn("gap", F.col("second") - F.col("first"))
    drawn, whole = F.col("replicate") >= 0, F.col("replicate") < 0
    at = lambda c: F.max(F.when(whole, F.col(c)))
    tail = (1 - level) / 2
    gap = F.when(drawn, F.col("gap"))
    out = wide.groupBy("metric").agg(
        at("first").alias("first"), at("second").alias("second"), at("gap").alias("difference"),
        F.percentile(gap, tail).alias("low"), F.percentile(gap, 1 - tail).alias("high"), F.count(gap).alias("replicates"),
    )
    return out.withColumn("significant", F.coalesce((F.col("low") > 0) | (F.col("high") < 0), F.lit(False)))

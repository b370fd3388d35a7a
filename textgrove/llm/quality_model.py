"""Quality as a regularised quadratic discriminant over transformed statistics of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.llm.quality_rules import statistics
from textgrove.llm.words import column
from textgrove.operators.scale import settle

#: Logarithms of counts and of shares, which are nearer to normal than the shares.
FEATURES = {
    "length": "log1p(n_words)",
    "word_length": "log1p(word_chars / greatest(n_words, 1))",
    "symbols": "log1p(50 * n_symbols / greatest(n_words, 1))",
    "marks": "log1p(50 * n_marks / greatest(n_words, 1))",
    "capitals": "log1p(50 * n_capitals / greatest(word_chars, 1))",
    "letters": "log1p(50 * (1 - n_letters / greatest(word_chars, 1)))",
    "plain": "log1p(50 * (1 - least(1, n_plain / greatest(n_words, 1))))",
    "lines": "log1p(n_words / greatest(n_lines, 1))",
    "repeated_lines": "log1p(50 * n_dup_lines / greatest(n_lines, 1))",
    "repeated_words": "log1p(50 * n_repeat_words / greatest(n_words, 1))",
    "variety": "log1p(50 * n_distinct / greatest(n_words, 1))",
}
CLASSES = (0, 1)


@dataclass
class Discriminant:
    """Means, Cholesky factors of the covariances, their log-determinants and log-priors, by class."""

    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    priors: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the log-densities."""
        logs = []
        for mean, factor, logdet, prior in zip(self.means, self.factors, self.logdets, self.priors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(prior - 0.5 * (logdet + (z * z).sum(0)))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def discriminant(counts, sums, products, shared: float, ridge: float) -> Discriminant | None:
    """From counts, sums and sums of products of each class; None unless both classes have rows.

    A covariance is its own with a share ``shared`` of the one common to both classes, and then a
    share ``ridge`` of the common variances alone, which also keep it positive.
    """
    n = np.asarray(counts, float)
    if (n < 1).any():
        return None
    means = np.asarray(sums) / n[:, None]
    scatter = np.asarray(products) - n[:, None, None] * means[:, :, None] * means[:, None, :]
    common = scatter.sum(0) / n.sum()
    spread = np.diag(np.diag(common) + 1e-3)
    covariances = [(1 - ridge) * ((1 - shared) * s / m + shared * common) + ridge * spread for s, m in zip(scatter, n, strict=True)]
    factors = np.array([np.linalg.cholesky(c) for c in covariances])
    logdets = 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(1)
    return Discriminant(means, factors, logdets, np.log(n / n.sum()))


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Rows whose hash of the id falls into the fold kept for testing; null ids are none."""
    return F.coalesce(F.crc32(column(id_col).cast("string")) % folds == fold, F.lit(False))


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, x)``: the transformed statistics of each text as an array."""
    plain = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    return statistics(plain, "text").select("id", F.array(*[F.expr(f).cast("double") for f in FEATURES.values()]).alias("x"))


def fit(labelled: DataFrame, shared: float = 0.3, ridge: float = 0.1) -> Discriminant | None:
    """Discriminant of rows ``(x, label)``: one aggregate with a row for each class."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = [F.col("x")[i] for i in range(d)]
    aggs = [F.count("*").alias("n"), *[F.sum(c) for c in x], *[F.sum(x[i] * x[j]) for i, j in pairs]]
    rows = {r[0]: r[1:] for r in labelled.filter(F.col("label").isin(*CLASSES)).groupBy("label").agg(*aggs).collect()}
    counts = [rows[c][0] if c in rows else 0 for c in CLASSES]
    sums, products = np.zeros((2, d)), np.zeros((2, d, d))
    for k, c in enumerate(CLASSES):
        if c in rows:
            sums[k] = rows[c][1 : d + 1]
            for (i, j), v in zip(pairs, rows[c][d + 1 :], strict=True):
                products[k, i, j] = products[k, j, i] = v
    return discriminant(counts, sums, products, shared, ridge)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
    fold: int = 0,
    threshold: float = 0.3,
    shared: float = 0.3,
    ridge: float = 0.1,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row; ``score`` is the probability of label 1.

    All rows of ``labels`` outside the test fold with a label of 0 or 1 are learned from; others,
    null labels and ids without a document are left out, and a repeated label counts each time.
    Null and empty texts have statistics of zero and are scored like any other. Without labels of
    both classes every score is the share of label 1, 0.5 if there is none. Null ids and repeated
    rows are scored each; an empty table gives no rows. Statistics are computed once, in the JVM,
    and written without the texts; the sums of each class are all that comes to the driver.
    """
    rated = settle(features(docs, id_col, text_col), "features")
    known = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label"))
    learned = rated.join(known.filter(~held_out("id", folds, fold)), "id").filter("label is not null")
    model = fit(learned, shared, ridge)
    if model is None:
        share = learned.agg(F.avg(F.col("label").cast("double"))).first()[0]
        score: Column = F.lit(0.5 if share is None else share)
    else:

        @F.pandas_udf("double")
        def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield pd.Series(model.probability(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

        score = probability(F.col("x"))
    return rated.select(F.col("id").alias(id_col), held_out("id", folds, fold).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )

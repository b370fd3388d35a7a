"""Terms that speak for a class: by their counts, or by the weights of a fitted classifier."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, IDFModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.operators.scale import match, settle


def words_of(text: str = "text") -> Column:
    """Lower-cased words between white space, in order; a null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"(\S+)"), F.lit(1))


def term_counts(df: DataFrame, text: str = "text", by: list[str] | None = None) -> DataFrame:
    """``(by..., term, n)``: occurrences, counted in the tasks first."""
    return df.select(*(by or []), F.explode(words_of(text)).alias("term")).groupBy(*(by or []), "term").agg(F.count("*").alias("n"))


def top_rows(df: DataFrame, by: str, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each group with their ``rank``.

    Each task drops all but its own first rows of a group before anything is exchanged.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= top)


def term_weights(
    df: DataFrame,
    top: int = 20,
    text: str = "text",
    label: str = "label",
    min_count: int = 1,
    smoothing: float = 0.5,
) -> DataFrame:
    """Terms that speak most for each class: ``(class, rank, term, n, weight, z)`` (EVL-24).

    ``weight`` is the log-odds ratio of the term in the class against all others, every term being
    counted ``smoothing`` times more; ``z`` is the weight over its standard error and ranks the terms,
    so that rare ones do not come first by chance; equal ones go by term. Listed are terms that the
    class has; ``min_count`` leaves out terms that are rarer in all classes together. A null class is
    one, a null text has no terms.

    Nothing but counts is exchanged: of (class, term), then of each term; the totals of the classes
    are one small table. The driver holds no term.
    """
    counts = settle(term_counts(df, text, [label]), "counts")
    everywhere = F.sum("n").over(Window.partitionBy("term"))
    counts = settle(counts.withColumn("all", everywhere).filter(F.col("all") >= min_count), "kept")
    tokens, terms = (counts.agg(a).scalar() for a in (F.sum("n"), F.count_distinct("term")))
    sizes = counts.groupBy(label).agg(F.sum("n").alias("size"))
    totals = settle(sizes.select("*", tokens.alias("tokens"), terms.alias("terms")), "totals")  # a row for each class
    inside, outside = F.col("n") + smoothing, F.col("all") - F.col("n") + smoothing
    extra = F.col("terms") * smoothing
    weight = F.log(inside / (F.col("size") + extra)) - F.log(outside / (F.col("tokens") - F.col("size") + extra))
    weighted = match(counts, totals, [label]).select(
        F.col(label).alias("class"), "term", "n", weight.alias("weight"), (weight / F.sqrt(1 / inside + 1 / outside)).alias("z")
    )
    found = top_rows(weighted, "class", [F.round("z", 9).desc(), F.col("term")], top)
    return found.select("class", "rank", "term", "n", "weight", "z")


def model_terms(model: PipelineModel, df: DataFrame, top: int = 20, text: str = "text", min_count: int = 1) -> DataFrame:
    """Terms of ``df`` with the largest weights in a model of ``train``: ``(class, rank, term, n, weight)`` (EVL-24).

    The weight of a term is that of its hashed feature, times the feature's inverse document
    frequency; terms that share a feature share its weight, the more frequent first. The coefficients
    come from the model, their number is that of its features, and are joined to the terms as a table.
    """
    spark = df.sparkSession
    hashing = next(s for s in model.stages if isinstance(s, HashingTF))
    idf = next((s.idf.toArray() for s in model.stages if isinstance(s, IDFModel)), 1.0)
    classifier = model.stages[-1]
    if hasattr(classifier, "coefficientMatrix"):
        rows = classifier.coefficientMatrix.toArray()
        rows = [-rows[0], rows[0]] if len(rows) == 1 else rows
    else:
        rows = [-classifier.coefficients.toArray(), classifier.coefficients.toArray()]
    table = pd.concat([pd.DataFrame({"class": c, "feature": range(len(r)), "weight": r * idf}) for c, r in enumerate(rows)])
    weights = settle(spark.createDataFrame(table[table["weight"] != 0], "class int, feature int, weight double"), "weights")
    terms = term_counts(df, text).filter(F.col("n") >= min_count).withColumn("_one", F.array("term"))
    single = HashingTF(inputCol="_one", outputCol="_vector", numFeatures=hashing.getNumFeatures()).transform(terms)
    # a vector of one term reads (size,[feature],[1.0])
    feature = F.regexp_extract(F.col("_vector").cast("string"), r"\[(\d+)\]", 1).cast("int")
    named = single.select("term", "n", feature.alias("feature")).join(weights, "feature")
    found = top_rows(named, "class", [F.col("weight").desc(), F.col("n").desc(), F.col("term")], top)
    return found.select("class", "rank", "term", "n", "weight")

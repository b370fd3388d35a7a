"""Registry and shared inputs of the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrove.operators.scale import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the SQL that must agree."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spread over the cores for work on the texts."""
    return spread(table(spark, sf_dir, "documents"))


def labelled(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Labelled texts ``(id, text, lang, label)``: documents with a quality label.

    ``heavy`` spreads the texts over the cores, for work beyond moving them.
    """
    docs = documents(spark, sf_dir) if heavy else table(spark, sf_dir, "documents")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("doc_id").alias("id"), "text", "lang", F.col("quality").alias("label")
    )


LABELLED = """
labelled AS (
  SELECT d.doc_id AS id, d.text, d.lang, l.quality AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def score_of(multiplier) -> F.Column:
    """Made-up score of a row that both engines can compute from id and label."""
    return ((F.col("id") * multiplier) % 61 + 40 * F.col("y_true")) / F.lit(100.0)


def scored(spark: SparkSession, sf_dir: str, multiplier: int = 7919) -> DataFrame:
    """Scored rows ``(id, text, lang, y_true, y_pred, score)`` of the labelled texts."""
    return (
        labelled(spark, sf_dir)
        .withColumnRenamed("label", "y_true")
        .withColumn("score", score_of(F.lit(multiplier)))
        .withColumn("y_pred", (F.col("score") >= 0.5).cast("int"))
    )


def scored_sql(multiplier: int = 7919, name: str = "scored") -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS y_pred FROM (
    SELECT d.doc_id AS id, d.text, d.lang, l.quality AS y_true,
           CAST((d.doc_id * {multiplier}) % 61 + 40 * l.quality AS DOUBLE) / 100.0 AS score
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id))"""


MODELS = {"first": 7919, "second": 104729, "third": 1299709}


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows of three made-up models in one pass over the labels."""
    models = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(m).alias("m")) for n, m in MODELS.items()])
    rows = labelled(spark, sf_dir).withColumnRenamed("label", "y_true")
    return (
        rows.select("*", F.inline(models))
        .withColumn("score", score_of(F.col("m")))
        .withColumn("y_pred", (F.col("score") >= 0.5).cast("int"))
        .drop("m")
    )


def scored_models_sql() -> str:
    parts = [scored_sql(m, n) for n, m in MODELS.items()]
    union = " UNION ALL ".join(f"SELECT *, '{n}' AS model FROM {n}" for n in MODELS)
    return ",".join(parts) + f",\nmodels AS ({union})"


def multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-class predictions on the embeddings table."""
    shift = F.when(F.col("vec_id") % 4 == 0, 1).otherwise(0)
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("label").alias("y_true"),
        ((F.col("label") + shift) % 10).alias("y_pred"),
    )


MULTICLASS = """
multiclass AS (
  SELECT vec_id AS id, label AS y_true,
         (label + CASE WHEN vec_id % 4 = 0 THEN 1 ELSE 0 END) % 10 AS y_pred
  FROM embeddings)"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the doubles, whose last digits depend on the order of summation."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )

"""Cleaning and scoring of text files as they arrive.

The jobs are stateless: a row is cleaned and scored on its own, so nothing can
be late and no watermark is needed. A checkpoint folder makes each file count
exactly once, also after a restart.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textgrove.functions.text import clean_text
from textgrove.operators.model import predict


def watch(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the files in a folder; ``glob`` picks file names."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def clean_stream(rows: DataFrame, text: str = "text", **switches) -> DataFrame:
    """Clean the text column of a stream."""
    return rows.withColumn(text, clean_text(F.col(text), **switches))


def score_stream(rows: DataFrame, model: PipelineModel, text: str = "text") -> DataFrame:
    """Clean and score a stream with a fitted model (MDL-10)."""
    return predict(model, clean_stream(rows, text))


def write_stream(
    rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = True
) -> StreamingQuery:
    """Append a stream to a folder: all that is there now, or for good."""
    writer = rows.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)

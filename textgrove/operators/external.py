"""Batch scoring with models of any kind, by a function of Arrow batches.

A model is a bundle, a file or folder that any library reads, and a loader. The bundle goes to each
executor once, as a file or archive of the application; each Python worker loads it once and keeps it. Rows
reach the model in batches of one size, whatever the size of Spark's own.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

#: A loader gets the path of the bundle and returns the model: a function from a batch to an array
#: of rows x classes.
Model = Callable[[pa.RecordBatch], np.ndarray]
LOADED: dict[str, Model] = {}  # models of this worker process, by name of the bundle
RECORD = (
    StructType()
    .add("predicted_class", "string")
    .add("confidence", "double")
    .add("all_probabilities", ArrayType(DoubleType()))
    .add("class_names", ArrayType(StringType()))
)


def ship(spark: SparkSession, path: str) -> str:
    """Make a bundle known to all executors; returns the name by which they find it.

    ``path`` may be of any file system that Spark reads; a folder is sent with all that is in it. Spark
    adds no folders of a mounted file system on a cluster, so these go as an archive, which each executor
    unpacks. The name is that of the file or folder: an application ships a name once.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        raise FileNotFoundError(f"there is no model at {path}")
    name, directory = os.path.basename(path.rstrip("/")), store.getFileStatus(folder).isDirectory()
    if directory and store.getUri().getScheme() == "file":
        packed = shutil.make_archive(f"{tempfile.mkdtemp()}/bundle", "zip", store.makeQualified(folder).toUri().getPath())
        spark.sparkContext.addArchive(f"{Path(packed).as_uri()}#{quote(name)}")
    else:
        spark.sparkContext.addFile(path, recursive=directory)
    return name


def loaded(name: str, load: Callable[[str], Model], key: str) -> Model:
    """The model of a bundle in this worker; loaded at its first use."""
    if key not in LOADED:
        LOADED.clear()  # workers are used again: one model at a time
        LOADED[key] = load(SparkFiles.get(name))
    return LOADED[key]


def even_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``size``; the last one may have fewer."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while rows + batch.num_rows >= size:
            held.append(batch.slice(0, size - rows))
            batch = batch.slice(size - rows)
            yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=size)[0]
            held, rows = [], 0
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=size)[0]


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


def records(values: np.ndarray, names: list[str]) -> pa.StructArray:
    """Prediction records of rows of probabilities; of equal ones the first class is predicted."""
    best = values.argmax(1)
    even = pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(names))
    return pa.StructArray.from_arrays(
        [
            pa.array([names[b] for b in best], pa.string()),
            pa.array(values[np.arange(len(values)), best]),
            pa.ListArray.from_arrays(even, pa.array(values.ravel())),
            pa.ListArray.from_arrays(even, pa.array(names * len(values), pa.string())),
        ],
        ["predicted_class", "confidence", "all_probabilities", "class_names"],
    )


def predict_external(
    df: DataFrame,
    bundle: str,
    load: Callable[[str], Model],
    names: list[str],
    inputs: list[str],
    batch_size: int = 32,
    logits: bool = False,
    record: str = "prediction",
) -> DataFrame:
    """``df`` with a prediction record of each row (MDL-2).

    The record holds ``predicted_class, confidence, all_probabilities, class_names``. ``load`` turns
    the path of the bundle into a model, which gets batches of the columns ``inputs`` of up to
    ``batch_size`` rows and returns an array of rows x ``names``: probabilities, or ``logits``, of
    which the softmax is taken. Nulls reach the model as they are. An array of another shape and
    probabilities that are not numbers are errors. An empty table gives no rows.
    """
    name, key = ship(df.sparkSession, bundle), uuid.uuid4().hex
    score = lambda model, batch: model(batch.select(inputs))
    return add_records(df, lambda: loaded(name, load, key), score, names, batch_size, logits, record)


def add_records(
    df: DataFrame,
    begin: Callable[[], object],
    score: Callable[[object, pa.RecordBatch], np.ndarray],
    names: list[str],
    batch_size: int = 1024,
    logits: bool = False,
    record: str = "prediction",
    **features: Column,
) -> DataFrame:
    """``df`` with prediction records of what ``score`` gives for a batch; ``begin`` is called once a task.

    ``features`` are further columns for ``score`` that the result does not have.
    """
    schema = StructType([*df.schema.fields]).add(record, RECORD)
    arrow = to_arrow_schema(df.schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in even_batches(batches, batch_size):
            model = begin() if model is None else model
            values = np.asarray(score(model, batch), np.float64)
            if values.shape != (batch.num_rows, len(names)):
                raise ValueError(f"the model gave {values.shape} for {batch.num_rows} rows and {len(names)} classes")
            values = softmax(values) if logits else values
            if np.isnan(values).any():
                raise ValueError("the model gave probabilities that are not numbers")
            columns = [column.cast(field.type) for column, field in zip(batch.columns, arrow, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, records(values, names)], names=[*arrow.names, record])

    return df.select("*", *[c.alias(n) for n, c in features.items()]).mapInArrow(scored, schema)

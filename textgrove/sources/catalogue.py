"""Known data sets: columns, class names and how to bring them to ``text, label``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    task: str
    num_labels: int
    class_names: list[str] = field(default_factory=list)
    text_column: str = "text"
    label_column: str = "label"


# Public data sets with their columns and class names.
DATASETS = {
    spec.name: spec
    for spec in (
        DatasetSpec("imdb", "sentiment", 2, ["NEGATIVE", "POSITIVE"]),
        DatasetSpec("ag_news", "topic", 4, ["World", "Sports", "Business", "Technology"]),
        DatasetSpec("yelp_polarity", "sentiment", 2),
        DatasetSpec("amazon_polarity", "sentiment", 2, text_column="content"),
        DatasetSpec("yelp_review_full", "sentiment", 5, ["1", "2", "3", "4", "5"]),
        DatasetSpec("emotion", "emotion", 6, ["sadness", "joy", "love", "anger", "fear", "surprise"]),
    )
}


def dataset_spec(name: str) -> DatasetSpec:
    """Entry of the catalogue; an unknown name is an error (SRC-7)."""
    if name not in DATASETS:
        raise ValueError(f"unknown data set {name}; known: {', '.join(DATASETS)}")
    return DATASETS[name]


def unify(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rename the text and label columns of a data set to ``text`` and ``label``."""
    return df.withColumnsRenamed({spec.text_column: "text", spec.label_column: "label"})


def load_dataset(spark: SparkSession, root: str, name: str, split: str | None = None) -> DataFrame:
    """A catalogued data set, all splits or one (SRC-1).

    ``root/name`` holds Parquet files below ``split=<name>`` folders, so that
    asking for one split reads only its folder.
    """
    spec = dataset_spec(name)
    df = unify(spark.read.parquet(f"{root}/{name}"), spec)
    return df if split is None else df.filter(F.col("split") == split)


def catalogue(spark: SparkSession) -> DataFrame:
    """The catalogue as a table."""
    rows = [
        (s.name, s.task, s.text_column, s.label_column, s.num_labels, ",".join(s.class_names))
        for s in DATASETS.values()
    ]
    return spark.createDataFrame(
        rows,
        "name string, task string, text_column string, label_column string, num_labels int, class_names string",
    )

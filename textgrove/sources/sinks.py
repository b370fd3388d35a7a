"""Writers of results: JSON for small results, partitioned Parquet for rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_json(df: DataFrame, path: str) -> None:
    """Write a result as JSON lines, replacing an earlier one (SNK-1, SNK-2)."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read back a result; with its schema all types survive (SNK-2)."""
    return (spark.read if schema is None else spark.read.schema(schema)).json(path)


def final_results(**sections: DataFrame | dict[str, Column | object]) -> DataFrame:
    """One nested row out of one-row tables and plain values, a struct each (SNK-4)."""
    tables = {k: v for k, v in sections.items() if isinstance(v, DataFrame)}
    spark = next(iter(tables.values())).sparkSession
    columns = []
    for name, part in sections.items():
        if isinstance(part, DataFrame):
            columns.append(part.select(F.struct("*").alias("s")).scalar().alias(name))
        else:
            values = [F.lit(v).alias(k) for k, v in part.items()]
            columns.append(F.struct(*values).alias(name))
    return spark.range(1).select(*columns)


def trial_results(trials: DataFrame) -> DataFrame:
    """Best value, its parameters and the list of all trials in one row (SNK-5)."""
    entry = F.struct("trial_number", "value", "params")
    order = F.struct(F.coalesce("value", F.lit(0.0)), -F.col("trial_number"))
    return trials.agg(
        F.max_by("params", order).alias("best_params"),
        F.max(F.coalesce("value", F.lit(0.0))).alias("best_value"),
        F.count("*").alias("n_trials"),
        F.array_sort(F.collect_list(entry)).alias("trials"),
    )


def save_predictions(scored: DataFrame, path: str, by: str = "split") -> None:
    """Write scored rows, one folder per split (SNK-6)."""
    scored.write.mode("overwrite").partitionBy(by).parquet(path)

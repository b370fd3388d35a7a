"""User functions on batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """Apply a function to Arrow batches of a table (UDF-1).

    The batches are as large as ``spark.sql.execution.arrow.maxRecordsPerBatch``
    says; the function must not depend on how the rows are batched.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)

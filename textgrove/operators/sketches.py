"""Profiles in parts that can be put together later, without the rows behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch (rank error about 0.5 %), and of a sketch of distinct values (about 0.8 %).
QUANTILES, DISTINCT = 800, 14
PARTS = "value string, rows long, count long, mean double, squares double, min double, max double, quantiles binary, distinct binary"


def profile_parts(df: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """One row per part of the table and column: ``(by..., value, rows, count, mean, squares, min, max, quantiles, distinct)`` (AGG-1, AGG-6).

    A part is a split, a day or a file. ``squares`` are the summed squares around the mean; ``quantiles`` and
    ``distinct`` are sketches of a bounded size, empty ones being null. One pass, aggregated in the tasks first.
    """
    number = lambda c: F.col(c).cast("double")
    columns = []
    for k, c in enumerate(values):
        columns += [
            F.count(c).alias(f"_count{k}"), F.avg(number(c)).alias(f"_mean{k}"), (F.var_pop(number(c)) * F.count(c)).alias(f"_squares{k}"),
            F.min(number(c)).alias(f"_min{k}"), F.max(number(c)).alias(f"_max{k}"),
            F.kll_sketch_agg_double(number(c), QUANTILES).alias(f"_quantiles{k}"), F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT).alias(f"_distinct{k}"),
        ]
    names = ("count", "mean", "squares", "min", "max", "quantiles", "distinct")
    rows = df.groupBy(*by).agg(F.count("*").alias("_rows"), *columns)
    lines = [F.struct(F.lit(c).alias("value"), F.col("_rows").alias("rows"), *[F.col(f"_{n}{k}").alias(n) for n in names]) for k, c in enumerate(values)]
    return rows.select(*by, F.inline(F.array(*lines)))


def merged_profile(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(by..., value, rows, count, mean, std, min, max, q25, q50, q75, distinct)`` from the parts of a table.

    Counts, means, deviations and extremes are exact; quartiles and distinct values are estimates
    whose error does not grow with the number of parts. Parts of several tables may be put together.
    """
    by = [*(by or []), "value"]
    weight, filled = F.col("count"), F.col("count") > 0
    mean = F.sum(F.col("mean") * weight) / F.sum(weight)
    spread = F.sum("squares") + F.sum(F.col("mean") * F.col("mean") * weight) - mean * mean * F.sum(weight)
    whole = parts.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.sum(weight).alias("count"),
        mean.alias("mean"),
        F.when(F.sum(weight) > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.sum(weight) - 1))).alias("std"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double(F.when(filled, F.col("quantiles")), QUANTILES).alias("_quantiles"),
        F.hll_union_agg(F.when(filled, F.col("distinct"))).alias("_distinct"),
    )
    known = F.col("count") > 0
    quartile = lambda p: F.when(known, F.kll_sketch_get_quantile_double("_quantiles", F.lit(p)))
    return whole.select(
        *by, "rows", "count", "mean", "std", "min", "max",
        *[quartile(p).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))],
        F.when(known, F.hll_sketch_estimate("_distinct")).otherwise(F.lit(0)).cast("long").alias("distinct"),
    )

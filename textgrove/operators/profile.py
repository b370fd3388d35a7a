"""Profiles of labelled-text tables: statistics, balance, histograms, advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.functions.text import char_count, word_count
from textgrove.operators.scale import match, running_totals, settle

ADVICE_COLUMNS = ["rule", "finding", "value"]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by its length in characters and words."""
    return df.withColumns(
        {"chars": char_count(F.col(text)), "words": word_count(F.col(text))}
    ).drop(text)


def analyze(
    df: DataFrame, text: str = "text", label: str = "label", by: str | None = "split"
) -> DataFrame:
    """All statistics of a data set, one row per split (AGG-1 to AGG-5).

    One pass: rows are first reduced to one row per split and label, which
    serves the label counts, the distinct labels and, summed up, the rest.
    """
    split = F.col(by) if by else F.lit("dataset")
    lengths = measure(df.select(split.alias("split"), F.col(label).alias("label"), F.col(text).alias("text")))
    per_label = lengths.groupBy("split", "label").agg(
        F.count("*").alias("n"),
        *[
            agg(c).alias(f"{c}_{name}")
            for c in ("chars", "words")
            for name, agg in (("sum", F.sum), ("n", F.count), ("max", F.max), ("min", F.min))
        ],
    )
    entry = F.when(F.col("label").isNotNull(), F.struct("label", "n"))
    return per_label.groupBy("split").agg(
        F.sum("n").alias("num_samples"),
        F.count("label").alias("num_labels"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("label_distribution"),
        (F.sum("chars_sum") / F.sum("chars_n")).alias("avg_text_length"),
        F.max("chars_max").alias("max_text_length"),
        F.min("chars_min").alias("min_text_length"),
        (F.sum("words_sum") / F.sum("words_n")).alias("avg_word_count"),
        F.max("words_max").alias("max_word_count"),
        F.min("words_min").alias("min_word_count"),
    )


def label_counts(df: DataFrame, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Rows per label (AGG-2)."""
    return df.groupBy(*(by or []), label).agg(F.count("*").alias("n"))


def approximate_sizes(df: DataFrame, key: str, by: list[str] | None = None, error: float = 0.02) -> DataFrame:
    """Rows and an estimate of the distinct keys, for keys too many to count exactly."""
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("num_samples"), F.approx_count_distinct(key, error).alias("num_keys")
    )


def label_shares(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share in percent per label (AGG-7)."""
    counts = label_counts(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 2))


def imbalance(df: DataFrame, label: str = "label", limit: float = 2.0) -> DataFrame:
    """Largest class over smallest class, flagged beyond ``limit`` (AGG-8)."""
    sizes = label_counts(df, label).agg(F.max("n").alias("max_class"), F.min("n").alias("min_class"))
    ratio = F.col("max_class") / F.col("min_class")
    return sizes.withColumns({"imbalance_ratio": ratio, "imbalanced": ratio > limit})


def quantiles(
    df: DataFrame, value: str, points: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per point.

    Equal values are counted together first, nulls as zero; the rank of each
    distinct value comes from ``running_totals``, so no group has to fit into
    one task.
    """
    by = by or []
    counted = df.groupBy(*by, value).agg(F.count(value).alias("_n"))
    placed = running_totals(counted, [value], ["_n"], by)
    first, last = F.col("_n_before"), F.col("_n_before") + F.col("_n") - 1

    def at(index: Column) -> Column:
        return F.max(F.when((first <= index) & (index <= last), F.col(value))).cast("double")

    def between(p: float) -> Column:
        position = (F.col("_n_total") - 1) * F.lit(float(p))
        low, high = at(F.floor(position)), at(F.ceil(position))
        return low + (high - low) * F.max(position - F.floor(position))

    return placed.groupBy(*by).agg(*[between(p).alias(name) for name, p in points.items()])


def describe(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of a column (AGG-6).

    The numbers are written first, so that texts behind them are measured once.
    """
    by = by or []
    df = settle(df.select(*by, value), "values")
    plain = df.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = quantiles(df, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by)
    if by:
        return match(plain, quartiles, by, "left")
    whole = quartiles.select(F.struct("*").alias("q")).scalar()
    return plain.withColumn("q", whole).select("*", "q.*").drop("q")


def describe_fast(df: DataFrame, value: str, by: list[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """``describe`` in one pass, with approximate quartiles."""
    parts = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    return (
        df.groupBy(*(by or []))
        .agg(
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            parts.alias("_parts"),
        )
        .select(
            "*", *[F.col("_parts")[i].cast("double").alias(q) for i, q in enumerate(("q25", "q50", "q75"))]
        )
        .drop("_parts")
    )


def histogram(df: DataFrame, value: str, bins: int = 50, by: list[str] | None = None) -> DataFrame:
    """Equal-width histogram over the range of each group (AGG-9, AGG-10).

    Whole numbers are counted per value first; fractions, which seldom repeat,
    go straight into their bins.

    Both the edges and the bins are taken from these numbers, which are written once.
    Empty bins are kept, the last bin includes the maximum, and a group with a
    single value gets the range one half around it.
    """
    by = by or []
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    values = df.select(*by, number.alias("_v"))
    if dict(df.dtypes)[value] in ("double", "float"):
        counted = values.withColumn("_n", F.col("_v").isNotNull().cast("long"))
    else:
        counted = values.groupBy(*by, "_v").agg(F.count("_v").alias("_n"))
    counted = settle(counted, "counted")
    ranges = counted.groupBy(*by).agg(
        F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.sum("_n").alias("_size")
    )
    half = F.when(F.col("_min") == F.col("_max"), 0.5).otherwise(0.0)
    ranges = ranges.filter((F.col("_size") > 0) & F.col("_min").isNotNull()).select(
        *by, (F.col("_min") - half).alias("_lo"), (F.col("_max") + half).alias("_hi")
    )
    if by:
        ranges = settle(ranges, "ranges")
        placed = match(counted, ranges, by)
    else:
        edges = ranges.select(F.struct("_lo", "_hi").alias("r")).scalar()
        placed = counted.withColumn("r", edges).select("*", "r.*").drop("r")
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_no = F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    filled = placed.groupBy(*by, bin_no.alias("bin")).agg(F.sum("_n").alias("_n"))
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return match(grid, filled, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("_lo") + width * F.col("bin")).alias("lower"),
        (F.col("_lo") + width * (F.col("bin") + 1)).alias("upper"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def totals(df: DataFrame, by: str = "split") -> DataFrame:
    """Rows per split and, with a null split, of all splits (AGG-11)."""
    return df.rollup(by).agg(F.count("*").alias("n"))


def advice(analysis: DataFrame, train: str = "train") -> DataFrame:
    """Findings on size, text length, balance and classes of an analysis (AGG-12).

    The size counts all splits; the other rules look at the training split.
    """
    on_train = lambda c: F.max(F.when(F.col("split") == train, c))
    sizes = F.map_values("label_distribution")
    facts = analysis.agg(
        F.sum("num_samples").alias("rows"),
        on_train(F.col("avg_text_length")).alias("length"),
        on_train(F.array_max(sizes) / F.array_min(sizes)).alias("ratio"),
        on_train(F.col("num_labels")).alias("classes"),
    )
    rows, length, ratio, classes = (F.col(c) for c in ("rows", "length", "ratio", "classes"))
    long_text = length > 1000

    def rule(name: str, finding: Column, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), finding.alias("finding"), value.cast("double").alias("value")
        )

    rules = F.array(
        rule(
            "size",
            F.when(rows >= 10000, "sufficient for deep models")
            .when(rows >= 1000, "medium: augment or transfer")
            .otherwise("small: regularise and transfer"),
            rows,
        ),
        rule("length", F.when(long_text, "long texts").otherwise("manageable texts"), length),
        rule(
            "max_length",
            F.lit("suggested number of tokens"),
            F.when(long_text, F.least(F.lit(512), F.floor(length * 1.5))).otherwise(F.lit(512)),
        ),
        rule(
            "balance",
            F.when(ratio > 2, "imbalanced: weight or resample").otherwise("balanced"),
            ratio,
        ),
        rule(
            "classes",
            F.when(classes == 2, "binary: sigmoid").otherwise("multi-class: softmax"),
            classes,
        ),
    )
    return facts.select(F.explode(rules).alias("r")).select("r.*")

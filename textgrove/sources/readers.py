"""Files of labelled texts: CSV, TSV, JSON, JSON lines, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.window import Window

from textgrove.operators.scale import running_totals, settle

# Cells that data frame readers take as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

FORMATS = ("csv", "tsv", "json", "jsonl", "parquet")


def read_file(
    spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | str | None = None,
    multiline: bool = True, mode: str = "FAILFAST",
) -> DataFrame:
    """A file or folder in one of the formats (SRC-2 to SRC-4).

    Rows that do not fit, such as surplus cells, an unclosed quote, broken JSON
    or a word under a number, are an error; other Spark modes are "PERMISSIVE"
    and "DROPMALFORMED".

    Without a schema the types are inferred, at the price of a pass over the
    file. Quoted cells may hold line breaks, which keeps a CSV file in one
    piece; pass ``multiline=False`` for large files without such cells, or give
    the data as many files, JSON lines or Parquet.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt}; known: {', '.join(FORMATS)}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt in ("csv", "tsv"):
        return reader.csv(
            path,
            sep="\t" if fmt == "tsv" else ",",
            header=True,
            quote='"',
            escape='"',
            multiLine=multiline,
            inferSchema=schema is None,
            mode=mode,
        )
    if fmt == "parquet":
        return reader.parquet(path)
    return reader.json(path, multiLine=fmt == "json", mode=mode)


def missing_to_null(df: DataFrame) -> DataFrame:
    """Replace the markers of missing cells by null in all text columns."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING), F.col(c)) for c in texts})


def require(df: DataFrame, *columns: str) -> DataFrame:
    """The table itself, if it has the columns (SRC-5)."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing column {', '.join(absent)}; the table has {', '.join(df.columns)}")
    return df


def read_labelled(
    spark: SparkSession,
    path: str,
    text: str = "text",
    label: str = "label",
    fmt: str = "csv",
    schema: StructType | str | None = None,
    multiline: bool = True,
    keep: list[str] | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Text and label columns of a file, all others dropped but for ``keep`` (SRC-6)."""
    df = require(read_file(spark, path, fmt, schema, multiline, mode), text, label, *(keep or []))
    df = df.select(text, label, *(keep or []))
    return missing_to_null(df) if fmt in ("csv", "tsv") else df


def with_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Number the rows of a table that has no id, copies of a row included.

    The number is the place in the order of a 128-bit hash of the content, so
    that it does not depend on files or partitions; copies take places in a row.
    Copies are counted where they lie, so that many of them are no large group.
    """
    values = [F.col(f"`{c}`").cast("string") for c in df.columns]
    content = F.to_json(F.array(*values), {"ignoreNullFields": "false"})
    keyed = settle(
        df.select(
            F.struct("*").alias("row"),
            F.xxhash64(content).alias("h1"),
            F.xxhash64(F.lit(1), content).alias("h2"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("seen"),
        ),
        "keyed",
    )
    copies = keyed.groupBy("h1", "h2", "part").agg(F.count("*").alias("n"))
    placed = running_totals(copies, ["h1", "h2", "part"], ["n"]).select("h1", "h2", "part", "n_before")
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "part").orderBy("seen"))
    numbered = keyed.join(placed, ["h1", "h2", "part"]).withColumn(name, F.col("n_before") + nth - 1)
    return settle(numbered.select("row.*", F.col(name).cast("long").alias(name)), "numbered")

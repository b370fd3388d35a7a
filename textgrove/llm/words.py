"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word of the contracts that cut at white space, and the white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"


def column(name: str) -> Column:
    """Column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``docs`` as one, ``_doc``, beside computed ones: no names can clash."""
    return docs.select(F.struct("*").alias("_doc"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    """The rows that ``packed`` put away, with their own columns only."""
    return df.select("_doc.*")


def row_hash(docs: DataFrame) -> Column:
    """Hash of all columns of a row; nulls count, so that their place matters."""
    values = [column(c).cast("string") for c in docs.columns]
    return F.xxhash64(*[v for c in values for v in (c, c.isNull())])


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and empty texts have none."""
    flat = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACE, " " * len(SPACE)))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " +"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)

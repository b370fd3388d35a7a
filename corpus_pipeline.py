"""From documents to packed token ids: quality, near-duplicates, benchmark, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textgrove.llm import decontaminate, mixing, packing, quality_rules, simhash
from textgrove.operators.scale import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voting rules keep.

    Null, empty and very short texts fail the base rule and go; equal texts are judged equally and
    all stay or go; very long texts are judged whole. An empty table gives an empty one.
    """
    return quality_rules.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, fingerprints at 2 bits or fewer.

    Null and empty texts have fingerprint zero and are one group, like any other; a text below three
    words is one shingle. Of a group the row with the smallest id stays, of equal rows one.
    """
    return simhash.one_of_each(docs, shingle=3, bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have no words and stay; repeated rows stay or go together; whole texts are
    searched. An empty benchmark or an empty table removes nothing.
    """
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, at most three times.

    A null source is one of its own, the last in order; null and empty texts have no words and count
    nothing; repeated rows share their copies. An empty table gives an empty one.
    """
    return mixing.mix(docs)


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids.

    Null and empty texts have no ids; texts longer than a row go on in further rows without loss;
    repeated rows are packed each; an empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing", mixture),
    ("token ids", token_rows),
]
#: Voting, components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

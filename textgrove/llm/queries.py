"""The registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from textgrove.llm import brown, chat, decontaminate, exact, line_dedup, mixing, packing, quality_model, quality_rules, repair, simhash, spelling, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the SQL that must agree."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_decontaminate",
    f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item, least(10, len(w)) AS m, unnest(list_transform(
    range(1, greatest(len(w) - 10, 0) + 2), lambda i: array_to_string(w[i : i + least(10, len(w)) - 1], ' '))) AS s
  FROM b WHERE len(w) > 0),
m AS (SELECT DISTINCT m FROM p),
places AS (
  SELECT r, m.m, unnest(range(1, len(w) - m.m + 2)) AS i, w FROM d, m WHERE len(w) >= m.m),
hits AS (
  SELECT a.r, a.i, a.m, p.item FROM places a JOIN p
  ON p.m = a.m AND p.s = array_to_string(a.w[a.i : a.i + a.m - 1], ' ')),
n AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + m)) AS j FROM hits) GROUP BY r),
k AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(k.n, 0)::BIGINT AS n_items,
       sha256(coalesce(k.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)""",
)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside occurrences of ten-word windows of the benchmark."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op2_chat_format",
    """
WITH c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id),
b AS (SELECT DISTINCT turns[1 : k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM c)),
w AS (SELECT min(conv_id) AS conv_id, turns FROM c GROUP BY turns)
SELECT conv_id, 0::BIGINT AS part, len(turns)::BIGINT AS n_turns, list_aggregate(list_transform(turns, lambda t:
       '<|im_start|>' || replace(coalesce(t.role, 'unknown'), '<|', '< |') || chr(10)
       || replace(coalesce(t.text, ''), '<|', '< |') || '<|im_end|>' || chr(10)), 'string_agg', '') AS text
FROM w ANTI JOIN b USING (turns)""",
)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered conversations without the snapshots that longer ones begin with."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of each document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_mix")
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources at weights 5, 2, 1 takes from each document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each document and whether the voting rules keep it."""
    rated = quality_rules.rate(table(spark, sf_dir, "documents"))
    return rated.drop("votes")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is toxic, by compression distance."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_line_dedup")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that are equal or similar to earlier ones."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query("op8_brown_lm")
def op8_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of each document under a class-based bigram model."""
    return brown.score(table(spark, sf_dir, "documents"))


@query("op9_pack")
def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of 2,048 token ids of all documents, best-fit-decreasing."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op10_quality_model")
def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is of good quality, by a quadratic discriminant."""
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op11_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW w AS (PARTITION BY t)""",
)
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    return exact.duplicates(table(spark, sf_dir, "documents"))


@query("op12_repair")
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of each conversation after a damage by hash."""
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.report(rows, copies=F.col("copies"))


@query("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent word at one edit that they are a variant of."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

"""Queries on splits and samples (SPL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgrove.functions.text import preview
from textgrove.operators import split as S
from textgrove.operators.profile import label_counts
from textgrove.operators.scale import seeded_rank
from textgrove.queries.common import LABELLED, labelled, query, table

HASH = "md5('42:' || id)"


def share_sql(source: str, size: str, share: str, name: str) -> str:
    """Largest-remainder counts per class: relation ``source(label, <size>)`` plus ``name``."""
    return f"""
{name}_q AS (
  SELECT *, CAST(sum({size}) OVER () AS DOUBLE) AS {name}_total,
         ceil({share} * CAST(sum({size}) OVER () AS DOUBLE)) AS {name}_take FROM {source}),
{name}_f AS (
  SELECT *, floor({name}_take * {size} / {name}_total) AS {name}_whole,
         {name}_take * {size} / {name}_total - floor({name}_take * {size} / {name}_total) AS {name}_part
  FROM {name}_q),
{name} AS (
  SELECT *, CAST({name}_whole + CASE
           WHEN row_number() OVER (ORDER BY {name}_part DESC, label) <= {name}_take - sum({name}_whole) OVER ()
           THEN 1 ELSE 0 END AS BIGINT) AS k_{name}
  FROM {name}_f)"""


THREE_WAY = f"""{LABELLED},
sizes AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
{share_sql('sizes', 'n', '0.1::DOUBLE', 'tst')},
rest AS (SELECT label, k_tst, n - k_tst AS r FROM tst),
{share_sql('rest', 'r', '(0.2::DOUBLE / (1 - 0.1::DOUBLE))', 'val')},
ordered AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {HASH}, id) AS pos FROM labelled),
three_way AS (
  SELECT o.id, o.text, o.lang, o.label,
         CASE WHEN pos <= k_tst THEN 'test' WHEN pos <= k_tst + k_val THEN 'validation' ELSE 'train' END AS split
  FROM ordered o JOIN val v ON o.label = v.label)"""


def by_source(spark, sf_dir):
    """Labelled texts whose split is given by the label table: toxic rows are the test part."""
    labels = table(spark, sf_dir, "labels")
    given = F.when(F.col("toxic") == 1, "test").otherwise("train")
    return table(spark, sf_dir, "documents").join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label"), given.alias("split")
    )


BY_SOURCE = """
given AS (
  SELECT d.doc_id AS id, l.quality AS label, CASE WHEN l.toxic = 1 THEN 'test' ELSE 'train' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@query("spl_01_keep_given_splits", """
SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'test' WHEN quality = 0 THEN 'validation' ELSE 'train' END AS split
FROM labels""")
def keep_given(spark, sf_dir):
    given = F.when(F.col("toxic") == 1, "test").when(F.col("quality") == 0, "validation").otherwise("train")
    rows = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label"), given.alias("split")
    )
    return S.prepare_splits(rows, "id", "label").select("id", "split")


@query("spl_02_carve_validation", f"""
WITH {BY_SOURCE},
t AS (SELECT id, row_number() OVER (ORDER BY {HASH}, id) AS pos, count(*) OVER () AS n FROM given WHERE split = 'train')
SELECT id, CASE WHEN pos <= ceil(0.2::DOUBLE * n) THEN 'validation' ELSE 'train' END AS split FROM t
UNION ALL SELECT id, split FROM given WHERE split = 'test'""")
def carve_validation(spark, sf_dir):
    return S.prepare_splits(by_source(spark, sf_dir), "id", "label").select("id", "split")


@query("spl_03_stratified_split", f"""
WITH {LABELLED}, sizes AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
{share_sql('sizes', 'n', '0.1::DOUBLE', 'tst')},
o AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {HASH}, id) AS pos FROM labelled)
SELECT o.id, o.label, CASE WHEN pos <= k_tst THEN 'test' ELSE 'train' END AS split
FROM o JOIN tst ON o.label = tst.label""")
def stratified_split(spark, sf_dir):
    return S.stratified_split(labelled(spark, sf_dir).select("id", "label"), "id", "label")


@query("spl_03_stratified_events", f"""
WITH labelled AS (SELECT event_id AS id, event_type AS label FROM events),
sizes AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
{share_sql('sizes', 'n', '0.15::DOUBLE', 'tst')},
o AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {HASH}, id) AS pos FROM labelled)
SELECT o.id, o.label, CASE WHEN pos <= k_tst THEN 'test' ELSE 'train' END AS split
FROM o JOIN tst ON o.label = tst.label""")
def stratified_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("label")
    )
    return S.stratified_split(rows, "id", "label", 0.15)


@query("spl_04_three_way_split", f"WITH {THREE_WAY} SELECT id, label, split FROM three_way")
def three_way_split(spark, sf_dir):
    return S.three_way_split(labelled(spark, sf_dir).select("id", "label"), "id", "label")


@query("spl_05_split_column", f"""
WITH {THREE_WAY} SELECT split, label, count(*) AS n, sum(length(text))::BIGINT AS chars
FROM three_way GROUP BY split, label""")
def split_column(spark, sf_dir):
    parts = S.prepare_splits(labelled(spark, sf_dir), "id", "label")
    return parts.groupBy("split", "label").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")
    )


@query("spl_06_sample", f"""
WITH {BY_SOURCE},
o AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {HASH}, id) AS pos FROM given)
SELECT id, split FROM o WHERE pos <= CASE WHEN split = 'train' THEN 60 ELSE 15 END""")
def sample(spark, sf_dir):
    return S.sample_splits(by_source(spark, sf_dir), "id", 60).select("id", "split")


@query("spl_06_sample_rows", """
SELECT event_id AS id, event_type FROM events ORDER BY md5('7:' || event_id), event_id LIMIT 500""")
def sample_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type")
    return S.take_seeded(rows, "id", 500, 7)


@query("spl_06_shuffled_rank", f"""
SELECT id, row_number() OVER (ORDER BY {HASH}, id) AS rank FROM (SELECT event_id AS id FROM events)""")
def shuffled_rank(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return seeded_rank(rows, "id")


@query("spl_07_first_rows", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS sample, lang
FROM documents ORDER BY doc_id LIMIT 3""")
def first_rows(spark, sf_dir):
    rows = S.first_rows(table(spark, sf_dir, "documents"), "doc_id", 3)
    return rows.select("doc_id", preview(F.col("text")).alias("sample"), "lang")


@query("spl_08_first_per_label", f"""
WITH {LABELLED}, o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY id) AS pos FROM labelled)
SELECT label, id, left(text, 100) || '...' AS sample FROM o WHERE pos = 1""")
def first_per_label(spark, sf_dir):
    rows = labelled(spark, sf_dir).withColumn("sample", preview(F.col("text"), 100, always=True))
    return S.first_per_label(rows, "id", "label", ["sample"])


@query("spl_09_cap_splits", f"""
WITH {BY_SOURCE},
o AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {HASH}, id) AS pos FROM given)
SELECT id, split FROM o WHERE split <> 'train' OR pos <= 50""")
def cap_splits(spark, sf_dir):
    return S.cap_splits(by_source(spark, sf_dir), "id", {"train": 50, "test": None}).select("id", "split")


@query("spl_10_sorted_labels", """
SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY lang""")
def sorted_labels(spark, sf_dir):
    return label_counts(table(spark, sf_dir, "documents"), "lang").orderBy("lang")

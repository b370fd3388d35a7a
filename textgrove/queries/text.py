"""Queries on text cleaning and text measures (TXT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgrove.functions import text as T
from textgrove.queries.common import documents, query, table

N = r"[^\s]"


def _contractions_sql(expr: str) -> str:
    for short, long in T.CONTRACTIONS:
        quoted = short.replace("'", "''")
        expr = f"regexp_replace({expr}, '(?i){quoted}', '{long}', 'g')"
    return expr


def clean_sql(expr: str, numbers: bool = False, punctuation: bool = False) -> str:
    """The cleaning chain in DuckDB, with the patterns in their plain form."""
    expr = f"coalesce({expr}, '')"
    expr = rf"regexp_replace({expr}, '<[^>]+>', '', 'g')"
    expr = rf"regexp_replace({expr}, 'http\S+|www\S+|https\S+', '', 'g')"
    expr = rf"regexp_replace({expr}, '\S+@\S+', '', 'g')"
    expr = f"lower({_contractions_sql(expr)})"
    if numbers:
        expr = rf"regexp_replace({expr}, '\d+', '', 'g')"
    if punctuation:
        marks = T.PUNCTUATION.replace("'", "''")
        expr = f"translate({expr}, '{marks}', '')"
    return rf"trim(regexp_replace({expr}, '\s+', ' ', 'g'))"


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query("txt_01_missing_text", """
SELECT d.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN NULL ELSE d.text END, '') AS text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def missing_text(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    hidden = F.when(~F.coalesce(F.col("toxic") == 1, F.lit(False)), F.col("text"))
    return rows.select("doc_id", T.fill_missing(hidden).alias("text"))


@query("txt_02_strip_html", """
SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages""")
def strip_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.strip_html(F.col("html")).alias("text"))


@query("txt_03_strip_urls", r"""
SELECT page_id, regexp_replace(html || ' ' || url, 'http\S+|www\S+|https\S+', '', 'g') AS text
FROM pages""")
def strip_urls(spark, sf_dir):
    return pages(spark, sf_dir).select(
        "page_id", T.strip_urls(F.concat_ws(" ", "html", "url")).alias("text")
    )


@query("txt_04_strip_emails", r"""
SELECT doc_id, regexp_replace(text, '\S+@\S+', '', 'g') AS text FROM documents""")
def strip_emails(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.strip_emails(F.col("text")).alias("text"))


# The given texts hold no contractions, so both engines put some in: the words
# "the", "is" and "and" become "don't", "It's" and "we've".
APOSTROPHES = [(r"\bthe\b", "don't"), (r"\bis\b", "It's"), (r"\band\b", "we've")]


@query("txt_05_contractions", "SELECT doc_id, " + _contractions_sql(
    r"regexp_replace(regexp_replace(regexp_replace(text, '\bthe\b', 'don''t', 'g'),"
    r" '\bis\b', 'It''s', 'g'), '\band\b', 'we''ve', 'g')") + " AS text FROM documents")
def contractions(spark, sf_dir):
    source = F.col("text")
    for pattern, word in APOSTROPHES:
        source = F.regexp_replace(source, pattern, word)
    return (
        documents(spark, sf_dir)
        .select("doc_id", source.alias("text"))
        .select("doc_id", T.expand_contractions(F.col("text")).alias("text"))
    )


@query("txt_06_lower", "SELECT doc_id, lower(text) AS text FROM documents")
def lower(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.lower("text").alias("text"))


@query("txt_07_strip_digits", r"SELECT doc_id, regexp_replace(text, '\d+', '', 'g') AS text FROM documents")
def strip_digits(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.strip_digits(F.col("text")).alias("text"))


@query("txt_08_strip_punctuation",
       "SELECT doc_id, translate(text, '" + T.PUNCTUATION.replace("'", "''") + "', '') AS text FROM documents")
def strip_punctuation(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.strip_punctuation(F.col("text")).alias("text"))


@query("txt_09_collapse_spaces",
       r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def collapse_spaces(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.collapse_spaces(F.col("text")).alias("text"))


@query("txt_10_clean_text", f"SELECT doc_id, {clean_sql('text')} AS text FROM documents")
def clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("text"))


@query("txt_10_clean_text_all_steps",
       f"SELECT doc_id, {clean_sql('text', True, True)} AS text FROM documents")
def clean_text_all_steps(spark, sf_dir):
    cleaned = T.clean_text(F.col("text"), remove_numbers=True, remove_punctuation=True)
    return documents(spark, sf_dir).select("doc_id", cleaned.alias("text"))


INSERTED = r"regexp_replace(regexp_replace(regexp_replace(text, '\bthe\b', 'DON''t', 'g'), '\bis\b', 'It''s', 'g'), '\band\b', 'we''ve', 'g')"


@query("txt_10_clean_contractions", f"SELECT doc_id, {clean_sql(INSERTED)} AS text FROM documents")
def clean_contractions(spark, sf_dir):
    source = F.regexp_replace("text", r"\bthe\b", "DON't")
    source = F.regexp_replace(F.regexp_replace(source, r"\bis\b", "It's"), r"\band\b", "we've")
    rows = documents(spark, sf_dir).select("doc_id", source.alias("text"))
    return rows.select("doc_id", T.clean_text(F.col("text")).alias("text"))


@query("txt_10_clean_pages", f"SELECT page_id, {clean_sql('html')} AS text FROM pages")
def clean_pages(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.clean_text(F.col("html")).alias("text"))


@query("txt_11_clean_splits", f"""
SELECT conv_id, turn, role AS split, {clean_sql('text')} AS text FROM conversations""")
def clean_splits(spark, sf_dir):
    from textgrove.operators.language import preprocess

    turns = table(spark, sf_dir, "conversations").withColumnRenamed("role", "split")
    return preprocess(turns, "text").select("conv_id", "turn", "split", "text")


@query("txt_12_chars", "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents")
def chars(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", T.char_count(F.col("text")).cast("long").alias("chars")
    )


@query("txt_13_words",
       r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS words FROM documents")
def words(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", T.word_count(F.col("text")).cast("long").alias("words")
    )


@query("txt_14_preview", """
SELECT doc_id,
       CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS sample,
       left(text, 200) || '...' AS error_sample,
       left(text, 100) || '...' AS label_sample
FROM documents""")
def preview(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        T.preview(t).alias("sample"),
        T.preview(t, always=True).alias("error_sample"),
        T.preview(t, 100, always=True).alias("label_sample"),
    )


@query("txt_15_label_names", """
SELECT vec_id, label,
       CASE label WHEN 0 THEN 'World' WHEN 1 THEN 'Sports' WHEN 2 THEN 'Business'
                  WHEN 3 THEN 'Technology' ELSE 'LABEL_' || label END AS name,
       CASE WHEN label < 4 THEN CAST(label AS INTEGER) ELSE -1 END AS back
FROM embeddings""")
def label_names(spark, sf_dir):
    from textgrove.sources.catalogue import DATASETS

    names = DATASETS["ag_news"].class_names
    named = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", T.label_name(F.col("label"), names).alias("name")
    )
    return named.withColumn("back", F.coalesce(T.label_id(F.col("name"), names), F.lit(-1)))

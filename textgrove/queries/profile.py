"""Queries on profiling aggregates (AGG)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgrove.operators import profile as P
from textgrove.operators import sketches as K
from textgrove.operators.scale import new_path, settle
from textgrove.operators.split import three_way_split
from textgrove.queries.common import LABELLED, documents, labelled, query, rounded, table
from textgrove.queries.split import THREE_WAY

WORDS = r"len(regexp_extract_all(text, '\S+'))"


@query("agg_01_rows_and_labels", f"""
WITH {LABELLED}
SELECT lang AS split, count(*) AS num_samples, count(DISTINCT label) AS num_labels
FROM labelled GROUP BY lang""")
def rows_and_labels(spark, sf_dir):
    return P.analyze(labelled(spark, sf_dir), by="lang").select("split", "num_samples", "num_labels")


@query("agg_01_approximate_sizes", """
SELECT l_returnflag, count(*) AS num_samples, count(DISTINCT l_orderkey) AS exact, true AS near FROM lineitem GROUP BY l_returnflag""")
def approximate_sizes(spark, sf_dir):
    """Estimates beside exact numbers: within four times the error asked for."""
    rows = table(spark, sf_dir, "lineitem")
    exact = rows.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("exact"))
    found = P.approximate_sizes(rows, "l_orderkey", ["l_returnflag"]).join(exact, "l_returnflag")
    near = F.abs(F.col("num_keys") / F.col("exact") - 1) <= 0.08
    return found.select("l_returnflag", "num_samples", "exact", near.alias("near"))


@query("agg_02_label_distribution", f"""
WITH {LABELLED}
SELECT lang AS split, label, count(*) AS n FROM labelled GROUP BY lang, label""")
def label_distribution(spark, sf_dir):
    found = P.analyze(labelled(spark, sf_dir), by="lang")
    return found.select("split", F.explode("label_distribution").alias("label", "n"))


def _lengths(column: str, what: str) -> str:
    return f"""
WITH {LABELLED}, m AS (SELECT lang AS split, {column} AS v FROM labelled)
SELECT split, round(avg(v), 6) AS avg_{what}, CAST(max(v) AS BIGINT) AS max_{what},
       CAST(min(v) AS BIGINT) AS min_{what}
FROM m GROUP BY split"""


@query("agg_03_text_lengths", _lengths("length(text)", "text_length"))
def text_lengths(spark, sf_dir):
    found = P.analyze(labelled(spark, sf_dir, heavy=True), by="lang")
    return rounded(found).select(
        "split",
        "avg_text_length",
        *[F.col(f"{m}_text_length").cast("long").alias(f"{m}_text_length") for m in ("max", "min")],
    )


@query("agg_04_word_counts", _lengths(WORDS, "word_count"))
def word_counts(spark, sf_dir):
    found = P.analyze(labelled(spark, sf_dir, heavy=True), by="lang")
    return rounded(found).select(
        "split",
        "avg_word_count",
        *[F.col(f"{m}_word_count").cast("long").alias(f"{m}_word_count") for m in ("max", "min")],
    )


@query("agg_05_analyze_splits", f"""
WITH {THREE_WAY},
c AS (SELECT split, label, count(*) AS n FROM three_way GROUP BY split, label),
d AS (SELECT split, string_agg(label || ':' || n, ',' ORDER BY label) AS labels FROM c GROUP BY split),
m AS (SELECT split, label, length(text) AS chars, {WORDS} AS words FROM three_way)
SELECT m.split, count(*) AS num_samples, count(DISTINCT label) AS num_labels,
       max(d.labels) AS label_distribution,
       round(avg(chars), 6) AS avg_text_length, CAST(max(chars) AS BIGINT) AS max_text_length,
       CAST(min(chars) AS BIGINT) AS min_text_length,
       round(avg(words), 6) AS avg_word_count, CAST(max(words) AS BIGINT) AS max_word_count,
       CAST(min(words) AS BIGINT) AS min_word_count
FROM m JOIN d ON m.split = d.split GROUP BY m.split""")
def analyze_splits(spark, sf_dir):
    found = P.analyze(three_way_split(labelled(spark, sf_dir, heavy=True), "id", "label"))
    pairs = F.transform(
        F.map_entries("label_distribution"),
        lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string")),
    )
    limits = [f"{m}_{c}" for m in ("max", "min") for c in ("text_length", "word_count")]
    return rounded(
        found.withColumn("label_distribution", F.array_join(pairs, ",")).withColumns(
            {c: F.col(c).cast("long") for c in limits}
        )
    )


@query("agg_05_analyze_documents", f"""
SELECT 'dataset' AS split, count(*) AS num_samples, count(DISTINCT lang) AS num_labels,
       round(avg(length(text)), 6) AS avg_text_length, round(avg({WORDS}), 6) AS avg_word_count
FROM documents""")
def analyze_documents(spark, sf_dir):
    found = P.analyze(documents(spark, sf_dir), label="lang", by=None)
    return rounded(
        found.select("split", "num_samples", "num_labels", "avg_text_length", "avg_word_count")
    )


DESCRIBE = """count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
       CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max,
       round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
       round(quantile_cont(v, 0.75), 6) AS q75"""


def _doubles(df):
    return rounded(df.withColumns({c: F.col(c).cast("double") for c in ("min", "max")}))


@query("agg_06_describe_lengths", f"""
WITH m AS (SELECT CAST(length(text) AS DOUBLE) AS v FROM documents) SELECT {DESCRIBE} FROM m""")
def describe_lengths(spark, sf_dir):
    return _doubles(P.describe(P.measure(documents(spark, sf_dir)), "chars"))


@query("agg_06_describe_words_by_lang", f"""
WITH m AS (SELECT lang, CAST({WORDS} AS DOUBLE) AS v FROM documents)
SELECT lang, {DESCRIBE} FROM m GROUP BY lang""")
def describe_words(spark, sf_dir):
    return _doubles(P.describe(P.measure(documents(spark, sf_dir)), "words", ["lang"]))


@query("agg_06_describe_prices", f"""
WITH m AS (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem)
SELECT l_returnflag, {DESCRIBE} FROM m GROUP BY l_returnflag""")
def describe_prices(spark, sf_dir):
    prices = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").cast("double").alias("price")
    )
    return _doubles(P.describe(prices, "price", ["l_returnflag"]))


@query("agg_06_describe_fast", f"""
WITH m AS (SELECT lang, length(text)::DOUBLE AS v FROM documents)
SELECT lang, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, max(v) AS max,
       true AS q25_near, true AS q50_near, true AS q75_near FROM m GROUP BY lang""")
def describe_fast(spark, sf_dir):
    """One pass; each approximate quartile has a share of the rows below it and up to it that allows for the quartile."""
    measured = settle(P.measure(documents(spark, sf_dir)).select("lang", "chars"), "chars")
    found = settle(P.describe_fast(measured, "chars", ["lang"]), "described")
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    ranks = measured.join(found.select("lang", *quartiles), "lang").groupBy("lang").agg(
        *[(F.avg((F.col("chars") < F.col(q)).cast("int")) <= p + 0.001).alias(f"{q}_low") for q, p in quartiles.items()],
        *[(F.avg((F.col("chars") <= F.col(q)).cast("int")) >= p - 0.001).alias(f"{q}_high") for q, p in quartiles.items()],
    )
    near = [(F.col(f"{q}_low") & F.col(f"{q}_high")).alias(f"{q}_near") for q in quartiles]
    return _doubles(found.join(ranks, "lang").select("lang", "count", "mean", "std", "min", "max", *near))


@query("agg_06_merged_profile", f"""
WITH m AS (SELECT 'chars' AS value, length(text)::DOUBLE AS v FROM documents UNION ALL SELECT 'words', {WORDS}::DOUBLE FROM documents)
SELECT value, count(*) AS rows, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, max(v) AS max,
       true AS q25_near, true AS q50_near, true AS q75_near, true AS distinct_near FROM m GROUP BY value""")
def merged_profile(spark, sf_dir):
    """Sketches of each language, written one after the other and put together; errors within 1.5 % of the ranks, 4 % of the values."""
    path, measured = new_path(spark, "parts"), settle(P.measure(documents(spark, sf_dir)).select("lang", "chars", "words"), "lengths")
    for english in (True, False):
        part = measured.filter((F.col("lang") == "en") == english)
        K.profile_parts(part, ["lang"], ["chars", "words"]).write.mode("append").parquet(path)
    found = settle(K.merged_profile(spark.read.schema(f"lang string, {K.PARTS}").parquet(path)), "merged")
    lengths = measured.select(F.inline(F.array(*[F.struct(F.lit(c).alias("value"), F.col(c).cast("double").alias("v")) for c in ("chars", "words")])))
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    below = lengths.join(found.select("value", *quartiles), "value").groupBy("value").agg(
        *[(F.avg((F.col("v") < F.col(q)).cast("int")) <= p + 0.015).alias(f"{q}_low") for q, p in quartiles.items()],
        *[(F.avg((F.col("v") <= F.col(q)).cast("int")) >= p - 0.015).alias(f"{q}_high") for q, p in quartiles.items()],
        F.count_distinct("v").alias("exact"),
    )
    near = [(F.col(f"{q}_low") & F.col(f"{q}_high")).alias(f"{q}_near") for q in quartiles]
    distinct = (F.abs(F.col("distinct") / F.col("exact") - 1) < 0.04).alias("distinct_near")
    return rounded(found.join(below, "value").select("value", "rows", "count", "mean", "std", "min", "max", *near, distinct))


@query("agg_07_label_shares", f"""
WITH {LABELLED}
SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent
FROM labelled GROUP BY label""")
def label_shares(spark, sf_dir):
    return P.label_shares(labelled(spark, sf_dir))


@query("agg_08_imbalance", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT max(n) AS max_class, min(n) AS min_class,
       round(CAST(max(n) AS DOUBLE) / min(n), 6) AS imbalance_ratio,
       CAST(max(n) AS DOUBLE) / min(n) > 2 AS imbalanced FROM c""")
def imbalance(spark, sf_dir):
    return rounded(P.imbalance(table(spark, sf_dir, "documents"), "lang"))


def histogram_sql(source: str, bins: int, by: str | None = None) -> str:
    """Histogram of column ``v`` of a DuckDB relation, empty bins included."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    on = f"a.{by} = b.{by}" if by else "true"
    return f"""
WITH s AS ({source}),
r AS (SELECT {keys}min(v) AS mn, max(v) AS mx FROM s {group}),
e AS (SELECT {keys}CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
             CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM r),
g AS (SELECT e.*, (hi - lo) / {bins} AS w, CAST(bin AS INTEGER) AS bin
      FROM e, range({bins}) AS x(bin)),
f AS (SELECT {'a.' + by + ', ' if by else ''}CAST(least(floor((a.v - b.lo) / ((b.hi - b.lo) / {bins})), {bins - 1}) AS INTEGER) AS bin,
             count(*) AS n FROM s a JOIN e b ON {on} GROUP BY ALL)
SELECT {'g.' + by + ', ' if by else ''}g.bin, round(g.lo + g.w * g.bin, 6) AS lower,
       round(g.lo + g.w * (g.bin + 1), 6) AS upper, coalesce(f.n, 0) AS n
FROM g LEFT JOIN f ON g.bin = f.bin {f'AND g.{by} = f.{by}' if by else ''}"""


@query("agg_09_histogram_chars", histogram_sql(
    "SELECT CAST(length(text) AS DOUBLE) AS v FROM documents", 50))
def histogram_chars(spark, sf_dir):
    return rounded(P.histogram(P.measure(documents(spark, sf_dir)), "chars", 50))


@query("agg_09_histogram_words", histogram_sql(
    f"SELECT CAST({WORDS} AS DOUBLE) AS v FROM documents", 50))
def histogram_words(spark, sf_dir):
    return rounded(P.histogram(P.measure(documents(spark, sf_dir)), "words", 50))


@query("agg_10_histogram_by_label", histogram_sql(
    "SELECT l.quality AS label, CAST(length(d.text) AS DOUBLE) AS v"
    " FROM documents d JOIN labels l ON d.doc_id = l.doc_id", 30, "label"))
def histogram_by_label(spark, sf_dir):
    return rounded(P.histogram(P.measure(labelled(spark, sf_dir, heavy=True)), "chars", 30, ["label"]))


@query("agg_10_histogram_events", histogram_sql(
    "SELECT event_type, CAST(value AS DOUBLE) AS v FROM events", 30, "event_type"))
def histogram_events(spark, sf_dir):
    return rounded(P.histogram(table(spark, sf_dir, "events"), "value", 30, ["event_type"]))


@query("agg_11_totals", f"""
WITH {THREE_WAY} SELECT split, count(*) AS n FROM three_way GROUP BY ROLLUP (split)""")
def totals(spark, sf_dir):
    return P.totals(three_way_split(labelled(spark, sf_dir), "id", "label"))


@query("agg_12_advice", f"""
WITH {THREE_WAY},
c AS (SELECT count(*) AS n FROM three_way WHERE split = 'train' GROUP BY label),
f AS (SELECT (SELECT count(*) FROM three_way) AS rows_, (SELECT avg(length(text)) FROM three_way WHERE split = 'train') AS len,
             (SELECT CAST(max(n) AS DOUBLE) / min(n) FROM c) AS ratio, (SELECT count(*) FROM c) AS classes)
SELECT 'size' AS rule, CASE WHEN rows_ >= 10000 THEN 'sufficient for deep models'
       WHEN rows_ >= 1000 THEN 'medium: augment or transfer' ELSE 'small: regularise and transfer' END AS finding,
       CAST(rows_ AS DOUBLE) AS value FROM f
UNION ALL SELECT 'length', CASE WHEN len > 1000 THEN 'long texts' ELSE 'manageable texts' END, round(len, 6) FROM f
UNION ALL SELECT 'max_length', 'suggested number of tokens',
       CAST(CASE WHEN len > 1000 THEN least(512, floor(len * 1.5)) ELSE 512 END AS DOUBLE) FROM f
UNION ALL SELECT 'balance', CASE WHEN ratio > 2 THEN 'imbalanced: weight or resample' ELSE 'balanced' END, round(ratio, 6) FROM f
UNION ALL SELECT 'classes', CASE WHEN classes = 2 THEN 'binary: sigmoid' ELSE 'multi-class: softmax' END,
       CAST(classes AS DOUBLE) FROM f""")
def advice(spark, sf_dir):
    found = P.analyze(three_way_split(labelled(spark, sf_dir, heavy=True), "id", "label"))
    return rounded(P.advice(found))

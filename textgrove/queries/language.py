"""Queries on languages (LNG)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgrove.operators import language as L
from textgrove.operators import segment as G
from textgrove.operators.scale import settle
from textgrove.queries.common import LABELLED, SQL, documents, labelled, query, table
from textgrove.queries.text import clean_sql

LANGS = ["de", "en", "es", "fr"]  # languages of the documents

PROFILES = rf"""
w AS (SELECT lang, word, count(*) AS n FROM (
        SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}]+')) AS word FROM documents)
      GROUP BY lang, word),
t AS (SELECT lang, n, substr(m, i, 3) AS gram FROM (
        SELECT lang, n, '_' || word || '_' AS m, unnest(range(1, length(word) + 1)) AS i FROM w)),
g AS (SELECT gram, {', '.join(f"coalesce(sum(n) FILTER (lang = '{x}'), 0) AS {x}" for x in LANGS)} FROM t GROUP BY gram),
tot AS (SELECT count(*) AS v, {', '.join(f'sum({x}) AS t_{x}' for x in LANGS)} FROM g),
profile AS (SELECT gram, {', '.join(f'CAST(round(ln((CAST({x} AS DOUBLE) + 1) / (t_{x} + v)) * 1e6) AS BIGINT) AS {x}' for x in LANGS)}
            FROM g, tot)"""

BEST = "greatest(" + ", ".join(LANGS) + ")"


@query("lng_01_profiles", f"WITH {PROFILES} SELECT * FROM profile")
def profiles(spark, sf_dir):
    found = L.build_profiles(documents(spark, sf_dir))
    return found.grams.select("gram", *[F.col("scores")[i].alias(x) for i, x in enumerate(found.languages)])


@query("lng_02_detect", rf"""
WITH {PROFILES},
dw AS (SELECT doc_id, word, count(*) AS n FROM (
         SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}]+')) AS word FROM documents)
       GROUP BY doc_id, word),
ws AS (SELECT word, {', '.join(f'sum({x}) AS {x}' for x in LANGS)} FROM (
         SELECT word, substr('_' || word || '_', i, 3) AS gram FROM (
           SELECT word, unnest(range(1, length(word) + 1)) AS i FROM (SELECT DISTINCT word FROM dw))) x
       JOIN profile p ON x.gram = p.gram GROUP BY word),
s AS (SELECT doc_id, {', '.join(f'sum(n * {x}) AS {x}' for x in LANGS)} FROM dw JOIN ws ON dw.word = ws.word GROUP BY doc_id)
SELECT d.doc_id, coalesce(CASE {' '.join(f"WHEN {x} = {BEST} THEN '{x}'" for x in LANGS)} END, 'en') AS detected
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id""")
def detect(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    found = L.detect(docs, L.build_profiles(docs), "doc_id")
    return found.select("doc_id", "detected")


# Codes that are also names of columns or no plain names.
CODES = {"de": "id", "en": "a.b", "es": "word", "fr": "gram"}


@query("lng_02_detect_odd_codes", SQL["lng_02_detect"].replace("coalesce(CASE", "coalesce(CASE CASE").replace(
    "END, 'en') AS detected", "END " + " ".join(f"WHEN '{x}' THEN '{y}'" for x, y in CODES.items()) + " END, 'en') AS detected"
))
def detect_odd_codes(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("lang_code"), "text")
    code = F.create_map(*[F.lit(v) for pair in CODES.items() for v in pair])[F.col("lang_code")]
    found = L.detect(docs, L.build_profiles(docs.withColumn("lang", code)), "doc_id")
    return found.select("doc_id", "detected")


# A given language for some of the sources: one without a model, one unknown.
def given():
    return F.when(F.col("source") == "src0", "ja").when(F.col("source") == "src1", "xx")


GIVEN = "CASE source WHEN 'src0' THEN 'ja' WHEN 'src1' THEN 'xx' END"


@query("lng_03_route", f"""
WITH r AS (SELECT doc_id, coalesce({GIVEN}, lang, 'en') AS lang FROM documents)
SELECT doc_id, lang,
       CASE WHEN lang IN ('en', 'es', 'fr', 'de', 'it', 'pt', 'ru', 'zh') THEN 'model' ELSE 'fallback' END AS route,
       lang IN ('en', 'es', 'fr', 'de', 'it', 'pt', 'ru', 'zh', 'ja', 'ar') AS supported FROM r""")
def route(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", L.route(given(), F.col("lang")).alias("r")).select("doc_id", "r.*")


# Short stop word lists that both engines can hold.
STOP = {
    "en": ["the", "of", "and", "to", "in", "is"],
    "fr": ["le", "la", "de", "que", "et"],
    "de": ["der", "die", "und", "in"],
    "es": ["el", "la", "de", "que"],
}
STOP_SQL = "stop(lang, word) AS (VALUES " + ", ".join(
    f"('{lang}', '{w}')" for lang, words in STOP.items() for w in words
) + ")"

TOKENS = rf"""
tokens AS (SELECT doc_id, lang, unnest(list) AS word, generate_subscripts(list, 1) AS pos FROM (
             SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}_]+') AS list FROM documents)),
{STOP_SQL},
kept AS (SELECT t.* FROM tokens t ANTI JOIN stop s ON t.lang = s.lang AND t.word = s.word)"""


@query("lng_04_stop_words", f"""
WITH {TOKENS}, j AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(j.text, '') AS text FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id""")
def stop_words(spark, sf_dir):
    kept = L.content_words(F.col("text"), F.col("lang"), STOP)
    return documents(spark, sf_dir).select("doc_id", F.array_join(kept, " ").alias("text"))


# Words that every list of the language holds, and words that none does.
SURE = {"en": ["the", "of", "and", "in", "is"], "fr": ["le", "la", "de", "que", "et"], "de": ["der", "die", "und", "in"], "es": ["el", "la", "de", "que"]}
LISTED = "sure(lang, word) AS (VALUES " + ", ".join(f"('{lang}', '{w}')" for lang, words in SURE.items() for w in words) + ")"


@query("lng_03_segments", """
SELECT p_partkey, lower(replace(p_name, ' ', '') || p_type) AS text, true AS cut FROM part""")
def segments(spark, sf_dir):
    """Names and types of parts without spaces, cut into words that a model learned from them; put together they are the text again."""
    text = F.lower(F.concat(F.replace("p_name", F.lit(" "), F.lit("")), "p_type"))
    parts = settle(table(spark, sf_dir, "part").select("p_partkey", text.alias("text")), "unspaced")
    model = G.learn_segments(parts, letters="a-z", longest=7)
    rows = settle(parts.select("p_partkey", G.segmented(F.col("text"), model).alias("words")), "words")
    return rows.select("p_partkey", F.array_join("words", "").alias("text"), F.size("words").between(2, 5).alias("cut"))


@query("lng_04_default_stop_words", rf"""
WITH t AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}_]+')) AS word FROM documents),
{LISTED},
n AS (SELECT doc_id, count(*) AS words, sum((length(word) > 14)::INTEGER)::BIGINT AS long FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(words, 0) AS words, coalesce(long, 0) AS long, true AS fewer, 0::BIGINT AS sure_left
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id""")
def default_stop_words(spark, sf_dir):
    """Spark's lists: words that surely are stop words go, long ones, which never are, all stay."""
    kept = L.content_words(F.col("text"), F.col("lang"), L.default_stop_words())
    every = L.content_words(F.col("text"), F.lit(None).cast("string"), {})
    sure = F.create_map(*[x for lang, words in SURE.items() for x in (F.lit(lang), F.array(*map(F.lit, words)))])
    left = F.coalesce(F.size(F.array_intersect("kept", sure[F.col("lang")])), F.lit(0))
    rows = documents(spark, sf_dir).select("doc_id", "lang", kept.alias("kept"), every.alias("every"))
    return rows.select(
        "doc_id",
        F.size("every").cast("long").alias("words"),
        F.size(F.filter("kept", lambda w: F.length(w) > 14)).cast("long").alias("long"),
        (F.size("kept") <= F.size("every")).alias("fewer"),
        left.cast("long").alias("sure_left"),
    )


def lemma_table(docs):
    """Words of the documents that end in ``s`` or ``en``, with the stem as lemma."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(L.TOKENS), F.lit(0))
    words = docs.select("lang", F.explode(found).alias("word")).distinct()
    stem = F.regexp_replace("word", "(s|en)$", "")
    return words.filter(F.length("word") > 4).select("lang", "word", stem.alias("lemma")).filter("word <> lemma")


LEMMAS = """
lemmas AS (SELECT DISTINCT lang, word, regexp_replace(word, '(s|en)$', '') AS lemma FROM tokens
           WHERE length(word) > 4 AND regexp_matches(word, '(s|en)$')),
j AS (SELECT doc_id, string_agg(coalesce(l.lemma, k.word), ' ' ORDER BY pos) AS text
      FROM kept k LEFT JOIN lemmas l ON k.lang = l.lang AND k.word = l.word GROUP BY doc_id)"""


@query("lng_05_lemmas", f"""
WITH {TOKENS}, {LEMMAS}
SELECT d.doc_id, coalesce(j.text, '') AS text FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id""")
def lemmas(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    tokens = docs.select("doc_id", "lang", L.content_words(F.col("text"), F.col("lang"), STOP).alias("tokens"))
    out = L.lemmatize(tokens, lemma_table(docs), "doc_id")
    return out.select("doc_id", F.array_join("tokens", " ").alias("text"))


@query("lng_06_multilingual", f"""
WITH {TOKENS}, {LEMMAS}
SELECT d.doc_id, CASE WHEN {GIVEN} IS NULL THEN coalesce(j.text, '') ELSE {clean_sql('d.text')} END AS text
FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id""")
def multilingual(spark, sf_dir):
    docs = documents(spark, sf_dir)
    used = docs.select("doc_id", "text", F.coalesce(given(), "lang").alias("lang"))
    return L.preprocess(
        used, multilingual=True, id_col="doc_id", lang="lang", stop_words=STOP, lemmas=lemma_table(docs)
    ).select("doc_id", "text")


@query("lng_06_detect_and_clean", f"""
WITH {TOKENS}, j AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(j.text, '') AS text FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id""")
def detect_and_clean(spark, sf_dir):
    """Languages are detected first; those of the documents are told apart without an error."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return L.preprocess(
        docs.drop("lang"), multilingual=True, id_col="doc_id", profiles=L.build_profiles(docs), stop_words=STOP
    )


@query("lng_07_target_languages", f"""
WITH {LABELLED} SELECT id, lang, label FROM labelled WHERE lang IN ('en', 'es', 'fr', 'de', 'zh')""")
def target_languages(spark, sf_dir):
    return L.by_language(labelled(spark, sf_dir), L.TARGET).select("id", "lang", "label")


@query("lng_07_roles", f"""
WITH {LABELLED}
SELECT CASE WHEN lang = 'en' THEN 'target' ELSE 'zero_shot' END AS role, lang, count(*) AS n
FROM labelled GROUP BY ALL""")
def roles(spark, sf_dir):
    tagged = L.tag_target(labelled(spark, sf_dir), ["en"])
    return tagged.groupBy("role", "lang").agg(F.count("*").alias("n"))

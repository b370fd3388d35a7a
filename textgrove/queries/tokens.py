"""Queries on tokenization (TOK)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrove.functions.tokens import frame, pretokenize
from textgrove.operators import tokens as K
from textgrove.operators.scale import new_path, settle, spread
from textgrove.queries.common import documents, labelled, query, rounded, table

SIZE = 3000
PATTERN = r"[\p{P}$+<=>^~`|]|[^\s\p{P}$+<=>^~`|]+"

WORDS = f"""
listed AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '{PATTERN}') AS list FROM documents),
tokens AS MATERIALIZED (SELECT doc_id, unnest(list) AS word, generate_subscripts(list, 1) AS pos FROM listed),
counts AS MATERIALIZED (SELECT word, count(*) AS n FROM tokens GROUP BY word)"""

VOCABULARY = f"""
starts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM counts),
pieces AS (
  SELECT token, sum(n) AS n, min(len) AS len FROM (
    SELECT CASE WHEN i > 1 THEN '##' ELSE '' END || substr(word, i, 1) AS token, n, 1 AS len FROM starts
    UNION ALL
    SELECT CASE WHEN i > 1 THEN '##' ELSE '' END || substr(word, i), n, length(word) - i + 1
    FROM starts WHERE length(word) - i + 1 > 1)
  GROUP BY token),
special(token, id) AS (VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3), ('[MASK]', 4)),
vocabulary AS MATERIALIZED (
  SELECT token, CAST(id AS INTEGER) AS id FROM special UNION ALL
  SELECT token, CAST(4 + row_number() OVER (ORDER BY CASE WHEN len = 1 THEN 0 ELSE 1 END, n DESC, token) AS INTEGER)
  FROM pieces QUALIFY row_number() OVER (ORDER BY CASE WHEN len = 1 THEN 0 ELSE 1 END, n DESC, token) <= {SIZE - 5})"""

PIECES = """
parts AS (SELECT word, i, unnest(range(1, length(word) - i + 2)) AS len FROM starts),
hits AS MATERIALIZED (
  SELECT p.word, p.i, max(p.len) AS len, arg_max(v.id, p.len) AS id
  FROM parts p JOIN vocabulary v
    ON v.token = CASE WHEN p.i > 1 THEN '##' ELSE '' END || substr(p.word, p.i, p.len)
  GROUP BY p.word, p.i),
walk(word, place, ids) AS (
  SELECT word, CAST(1 AS BIGINT), CAST([] AS INTEGER[]) FROM counts
  UNION ALL
  SELECT w.word, w.place + h.len, list_append(w.ids, h.id) FROM walk w JOIN hits h ON w.word = h.word AND w.place = h.i),
ids AS MATERIALIZED (
  SELECT c.word, coalesce(w.ids, [1]) AS ids
  FROM counts c LEFT JOIN walk w ON c.word = w.word AND w.place = length(c.word) + 1)"""

ENCODED = f"""{WORDS}, {VOCABULARY}, {PIECES},
encoded AS MATERIALIZED (
  SELECT d.doc_id, coalesce(flatten(e.ids), []) AS ids FROM documents d LEFT JOIN (
    SELECT t.doc_id, list(i.ids ORDER BY t.pos) AS ids FROM tokens t JOIN ids i ON t.word = i.word GROUP BY t.doc_id) e
  ON d.doc_id = e.doc_id)"""


def counted(docs):
    """Word counts, written once: building and using a vocabulary both read them."""
    return spread(settle(K.token_counts(docs), "counts"))


def vocabulary(docs):
    return K.build_vocabulary(counted(docs), SIZE)


def joined(column):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), " ")


@query("tok_01_pretokenize", f"""
WITH {WORDS} SELECT doc_id, array_to_string(list, ' ') AS tokens, len(list) AS n FROM listed""")
def pretokens(spark, sf_dir):
    found = documents(spark, sf_dir).select("doc_id", pretokenize(F.col("text")).alias("t"))
    return found.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("long").alias("n"))


@query("tok_02_load_vocabulary", f"WITH {WORDS}, {VOCABULARY} SELECT token, id FROM vocabulary")
def load_vocabulary(spark, sf_dir):
    path = new_path(spark, "vocabulary-file")
    K.save_vocabulary(vocabulary(documents(spark, sf_dir)), path)
    return K.load_vocabulary(spark, path)


@query("tok_03_build_vocabulary", f"WITH {WORDS}, {VOCABULARY} SELECT token, id FROM vocabulary")
def build_vocabulary(spark, sf_dir):
    return vocabulary(documents(spark, sf_dir))


# Words far above 100 characters: the letters of each address, four times in a row.
ADDRESSES = "documents AS (SELECT page_id AS doc_id, repeat(regexp_replace(url, '[^A-Za-z0-9]', '', 'g'), 4) || ' ' || url AS text FROM pages)"


@query("tok_03_long_words", f"""
WITH {ADDRESSES}, {WORDS}, {VOCABULARY}
SELECT token, id, length(token) > 100 AS long FROM vocabulary""")
def long_words(spark, sf_dir):
    """A vocabulary of words of any length."""
    letters = F.repeat(F.regexp_replace("url", "[^A-Za-z0-9]", ""), 4)
    texts = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.concat_ws(" ", letters, "url").alias("text"))
    return vocabulary(texts).select("token", "id", (F.length("token") > 100).alias("long"))


@query("tok_04_word_pieces", f"""
WITH RECURSIVE {WORDS}, {VOCABULARY}, {PIECES} SELECT word, array_to_string(ids, ' ') AS ids FROM ids""")
def word_pieces(spark, sf_dir):
    counts = counted(documents(spark, sf_dir))
    ids = K.vocabulary_ids(K.build_vocabulary(counts, SIZE))
    return K.word_pieces(counts, ids).select("word", joined("ids").alias("ids"))


@query("tok_04_encode", f"""
WITH RECURSIVE {ENCODED} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM encoded""")
def encode(spark, sf_dir):
    docs = documents(spark, sf_dir)
    ids = K.vocabulary_ids(vocabulary(docs))
    return K.encode(docs.select("doc_id", "text"), ids).select("doc_id", joined("ids").alias("ids"))


@query("tok_05_frame", f"""
WITH RECURSIVE {ENCODED}
SELECT doc_id, array_to_string(list_concat(list_concat([2], ids[1:510]), [3]), ' ') AS input_ids FROM encoded""")
def framed(spark, sf_dir):
    docs = documents(spark, sf_dir)
    ids = K.vocabulary_ids(vocabulary(docs))
    rows = K.encode(docs.select("doc_id", "text"), ids)
    return rows.select("doc_id", joined(frame(F.col("ids"), 2, 3)).alias("input_ids"))


PADDED = """
framed AS (SELECT e.doc_id, l.quality AS labels, list_concat(list_concat([2], ids[1:510]), [3]) AS ids
           FROM encoded e JOIN labels l ON e.doc_id = l.doc_id),
ranked AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1) / 32.0) AS BIGINT) AS batch_id FROM framed),
sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM ranked)"""

PADDED_SELECT = """
SELECT doc_id AS id, batch_id, labels,
       array_to_string(ids, ' ') || repeat(' 0', longest - len(ids)) AS input_ids,
       trim(repeat('1 ', len(ids)) || repeat('0 ', longest - len(ids))) AS attention_mask FROM sized"""


@query("tok_06_pad_batches", f"WITH RECURSIVE {ENCODED}, {PADDED} {PADDED_SELECT}")
def pad_batches(spark, sf_dir):
    vocab = vocabulary(documents(spark, sf_dir))
    rows = K.tokenize(labelled(spark, sf_dir, heavy=True), vocab, max_length=512, batch_size=32)
    return rows.select(
        "id", "batch_id", "labels",
        joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask"),
    )


BY_LENGTH = """
framed AS (SELECT e.doc_id, l.quality AS labels, list_concat(list_concat([2], ids[1:510]), [3]) AS ids
           FROM encoded e JOIN labels l ON e.doc_id = l.doc_id),
placed AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY len(ids), md5('42:' || doc_id), doc_id) - 1) / 32.0) AS BIGINT) AS batch FROM framed),
turns AS (SELECT batch, max(len(ids)) AS longest, row_number() OVER (ORDER BY md5('42:' || batch), batch) - 1 AS batch_id FROM placed GROUP BY batch),
sized AS (SELECT p.*, t.batch_id, t.longest FROM placed p JOIN turns t ON p.batch = t.batch)"""


def unpadded(spark, sf_dir):
    """Framed ids of the labelled texts, written once."""
    vocab = K.vocabulary_ids(vocabulary(documents(spark, sf_dir)))
    rows = K.encode(labelled(spark, sf_dir, heavy=True), vocab)
    return settle(rows.select("id", frame(F.col("ids"), 2, 3).alias("input_ids"), F.col("label").alias("labels")), "tokens")


@query("tok_06_length_batches", f"WITH RECURSIVE {ENCODED}, {BY_LENGTH} {PADDED_SELECT}")
def length_batches(spark, sf_dir):
    rows = K.length_batches(unpadded(spark, sf_dir), batch_size=32)
    return rows.select(
        "id", "batch_id", "labels",
        joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask"),
    )


SHARE_SQL = "SELECT '{}' AS batches, sum(longest)::BIGINT AS places, sum(len(ids))::BIGINT AS tokens, round(1 - sum(len(ids)) / sum(longest), 6) AS padding"


@query("tok_06_padding_share", f"""
WITH RECURSIVE {ENCODED}, {PADDED},
by_length AS (WITH {BY_LENGTH} SELECT * FROM sized)
{SHARE_SQL.format('shuffled')} FROM sized UNION ALL {SHARE_SQL.format('by_length')} FROM by_length""")
def padding_share(spark, sf_dir):
    """What is padded in shuffled batches and in batches by length."""
    rows, size = unpadded(spark, sf_dir), 32
    kinds = {"shuffled": K.pad_batches(rows, batch_size=size), "by_length": K.length_batches(rows, batch_size=size)}
    shares = [K.padding_share(b).withColumn("batches", F.lit(name)) for name, b in kinds.items()]
    return rounded(reduce(DataFrame.union, shares))


@query("tok_07_tokenize", f"""
WITH RECURSIVE {ENCODED}, {PADDED},
fixed AS (SELECT * REPLACE (512 AS longest), NULL AS nothing FROM sized)
{PADDED_SELECT.replace('batch_id, ', '').replace('FROM sized', 'FROM fixed')}""")
def tokenize(spark, sf_dir):
    vocab = vocabulary(documents(spark, sf_dir))
    rows = K.tokenize(labelled(spark, sf_dir, heavy=True), vocab, max_length=512, batch_size=None)
    return rows.select(
        "id", "labels", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )

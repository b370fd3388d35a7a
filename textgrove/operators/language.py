"""Languages: profiles, detection, routing and language-aware preprocessing.

A profile is a table of character trigrams with one score per language. Scores
are whole millionths of a log-probability, so that sums do not depend on the
order of addition and are the same for any partitioning.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.functions.text import clean_text
from textgrove.operators.scale import settle

# Supported languages, those with a model, and the default.
SUPPORTED = ["en", "es", "fr", "de", "it", "pt", "ru", "zh", "ja", "ar"]
WITH_MODEL = ["en", "es", "fr", "de", "it", "pt", "ru", "zh"]
TARGET = ["en", "es", "fr", "de", "zh"]
ZERO_SHOT = ["it", "pt", "ru"]
DEFAULT = "en"

# Names under which Spark ships its stop word lists.
STOP_WORD_LISTS = {
    "en": "english",
    "es": "spanish",
    "fr": "french",
    "de": "german",
    "it": "italian",
    "pt": "portuguese",
    "ru": "russian",
}

MAX_BYTES = 128 << 20  # of a profile in the memory of an executor
MEMO = 200_000  # words whose scores a task remembers
CHUNK = 1 << 18  # words of a batch whose lemmas are looked up at a time
LETTERS = r"[\p{L}\p{M}]+"
TOKENS = r"[\p{L}\p{M}\p{N}_]+"


def words(text: Column) -> Column:
    """Lower-case words of letters and marks."""
    return F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))


def trigrams(word: Column) -> Column:
    """Overlapping trigrams of ``_word_``, found in one pass by an empty match at each position.

    The middle of a surrogate pair is no position.
    """
    marked = F.concat(F.lit("_"), word, F.lit("_"))
    return F.regexp_extract_all(marked, F.lit(r"(?s)(?!\p{Cs})(?=(.{3}))"), F.lit(1))


@dataclass(frozen=True)
class Profiles:
    """Language profiles: ``(gram, scores)``, one score for each language in their order."""

    languages: list[str]
    grams: DataFrame


def word_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Occurrences of each word per language."""
    exploded = df.select(F.col(lang).alias("lang"), F.explode(words(F.col(text))).alias("word"))
    return exploded.groupBy("lang", "word").agg(F.count("*").alias("n"))


def gram_counts(counts: DataFrame) -> DataFrame:
    """Occurrences of each trigram and language."""
    grams = counts.select("lang", "n", F.explode(trigrams(F.col("word"))).alias("gram"))
    return grams.groupBy("gram", "lang").agg(F.sum("n").alias("n"))


def build_profiles(df: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of all languages in a table of texts with known language (LNG-1).

    Texts are read once; everything after that works on distinct words. Scores
    are logarithms of add-one smoothed trigram shares. Languages are rows and
    places in an array, never column names, so that any code will do.
    """
    known = df.filter(F.col(lang).isNotNull())
    counts = settle(gram_counts(word_counts(known, text, lang)), "grams")
    sums = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(sums)
    n_grams = counts.select("gram").distinct().count()
    by_lang = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    score = lambda m, x: F.round(
        F.log((F.coalesce(F.try_element_at(m, F.lit(x)), F.lit(0)) + 1) / F.lit(float(sums[x] + n_grams))) * 1e6
    ).cast("long")
    wide = counts.groupBy("gram").agg(by_lang.alias("m"))
    scores = F.array(*[score(F.col("m"), x) for x in languages]).cast("array<long>")
    return Profiles(languages, settle(wide.select("gram", scores.alias("scores")), "profile"))


def _total(scores: Column, n_languages: int) -> list[Column]:
    return [F.sum(scores[i]) for i in range(n_languages)]


def _detect_by_join(df: DataFrame, profiles: Profiles, id_col: str, text: str, name: str) -> DataFrame:
    """Detection with a profile of any size: distinct words are scored, then summed up per text."""
    size, spots = len(profiles.languages), F.col("scores")
    used = df.select(F.col(id_col).alias("_id"), F.explode(words(F.col(text))).alias("word")).groupBy("_id", "word").agg(
        F.count("*").alias("n")
    )
    grams = used.select("word").distinct().select("word", F.explode(trigrams(F.col("word"))).alias("gram"))
    scored = grams.join(profiles.grams, "gram").groupBy("word").agg(F.array(*_total(spots, size)).alias("scores"))
    sums = used.join(scored, "word").groupBy("_id").agg(F.array(*[F.sum(F.col("n") * spots[i]) for i in range(size)]).alias("s"))
    places = F.array(*[F.lit(x) for x in profiles.languages])
    best = sums.select("_id", F.get(places, (F.array_position("s", F.array_max("s")) - 1).cast("int")).alias("_found"))
    return (
        df.drop(name)
        .join(best, F.col(id_col) == F.col("_id"), "left")
        .withColumn(name, F.coalesce("_found", F.lit(DEFAULT)))
        .drop("_id", "_found")
    )


def detect(
    df: DataFrame,
    profiles: Profiles,
    id_col: str = "id",
    text: str = "text",
    name: str = "detected",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Add the language of every text (LNG-2); without evidence it is the default.

    The profile is sent to the executors and words are looked up in a narrow
    Arrow step that remembers their scores: no text moves. A profile that takes
    more than ``max_bytes`` there is joined with the distinct words instead.
    Ties go to the language that comes first in the alphabet.
    """
    langs = profiles.languages
    if not langs:
        return df.withColumn(name, F.lit(DEFAULT))
    size = profiles.grams.agg(F.sum(F.octet_length("gram") + 100 + 32 * len(langs))).first()[0] or 0
    if size > max_bytes:
        return _detect_by_join(df, profiles, id_col, text, name)
    table = {r["gram"]: tuple(r["scores"]) for r in profiles.grams.collect()}
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("string")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams, memo = shared.value, {}

        def score(word: str):
            marked = f"_{word}_"
            found = [g for g in (grams.get(marked[i : i + 3]) for i in range(len(marked) - 2)) if g]
            return tuple(map(sum, zip(*found, strict=True))) if found else None

        for batch in batches:
            out = []
            for row in batch:
                counted = Counter(() if row is None else row)
                if len(memo) > MEMO:
                    memo.clear()
                known = []
                for word, n in counted.items():
                    if word not in memo:
                        memo[word] = score(word)
                    if memo[word] is not None:
                        known.append((n, memo[word]))
                if not known:
                    out.append(DEFAULT)
                    continue
                sums = np.array([n for n, _ in known], np.int64) @ np.array([v for _, v in known], np.int64)
                out.append(langs[int(sums.argmax())])
            yield pd.Series(out, dtype="object")

    return df.withColumn(name, language(words(F.col(text))))


def route(given: Column | None, detected: Column, models: list[str] | None = None) -> Column:
    """Struct of the language to use and whether a model handles it (LNG-3).

    A given language wins over the detected one. Chinese is routed to "model", but
    is cut into words by ``segment`` and has no stop words here.
    """
    lang = F.coalesce(*([] if given is None else [given]), detected, F.lit(DEFAULT))
    has_model = lang.isin(WITH_MODEL if models is None else models)
    return F.struct(
        lang.alias("lang"),
        F.when(has_model, "model").otherwise("fallback").alias("route"),
        lang.isin(SUPPORTED).alias("supported"),
    )


def default_stop_words() -> dict[str, list[str]]:
    """Spark's stop word lists by language, cut into words as texts are; there is none for Chinese."""
    return {
        lang: sorted({w for line in StopWordsRemover.loadDefaultStopWords(name) for w in re.findall(r"\w+", line.lower())})
        for lang, name in STOP_WORD_LISTS.items()
    }


def content_words(text: Column, lang: Column, stop_words: dict[str, list[str]]) -> Column:
    """Lower-case words of a text without punctuation and stop words, in order (LNG-4)."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKENS), F.lit(0))
    kept = lambda stop: F.filter(found, lambda w: ~w.isin(stop))
    by_lang = [(lang == code, kept(stop)) for code, stop in stop_words.items() if stop]
    if not by_lang:
        return found
    return reduce(lambda acc, x: acc.when(*x), by_lang[1:], F.when(*by_lang[0])).otherwise(found)


def _lemmatize_by_join(df: DataFrame, table: DataFrame, id_col: str, tokens: str, lang: str) -> DataFrame:
    """Lemmas from a table of any size: all words are joined with it and put back in order."""
    rows = df.repartition(id_col)
    exploded = rows.select(
        F.col(id_col).alias("_id"), F.col(lang).alias("_lang"), F.posexplode(tokens).alias("_pos", "word")
    )
    looked_up = exploded.join(table, ["_lang", "word"], "left").select(
        "_id", F.struct("_pos", F.coalesce("lemma", "word").alias("w")).alias("_w")
    )
    ordered = looked_up.groupBy("_id").agg(F.array_sort(F.collect_list("_w"))["w"].alias("_tokens"))
    empty = F.array().cast("array<string>")
    return (
        rows.join(ordered, rows[id_col] == ordered["_id"], "left")
        .withColumn(tokens, F.coalesce("_tokens", empty))
        .select(*df.columns)
    )


def _bytes(table: DataFrame) -> int:
    """Memory that a table of strings takes in a Python worker, about."""
    return table.agg(F.sum(150 + sum(F.octet_length(c) for c in table.columns))).first()[0] or 0


def lemmatize(
    df: DataFrame, lemmas: DataFrame, id_col: str, tokens: str = "tokens", lang: str = "lang", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Replace each word by its lemma of ``(lang, word, lemma)``; others stay (LNG-5).

    Of several lemmas of a word the least counts. Words whose lemma they are themselves need no
    entry. The table is sent to the executors and words are looked up where they lie: no text moves.
    Of a table that takes more than ``max_bytes`` there, only the words that occur in ``df`` are sent;
    if these are too many as well, all words are joined with the table.
    """
    table = settle(
        lemmas.filter("lemma <> word")
        .groupBy("lang", "word")
        .agg(F.min("lemma").alias("lemma"))
        .withColumnRenamed("lang", "_lang"),
        "lemmas",
    )
    if _bytes(table) > max_bytes:
        used = df.select(F.col(lang).alias("_lang"), F.explode(tokens).alias("word")).distinct()
        table = settle(table.join(used, ["_lang", "word"], "left_semi"), "lemmas")
        if _bytes(table) > max_bytes:
            return _lemmatize_by_join(df, table, id_col, tokens, lang)
    entries: dict[str, dict[str, str]] = {}
    for r in table.collect():
        entries.setdefault(r["_lang"], {})[r["word"]] = r["lemma"]
    shared = df.sparkSession.sparkContext.broadcast(entries)

    @F.arrow_udf("array<string>")
    def looked_up(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for rows, langs in batches:
            rows_of, sizes = langs.dictionary_encode(null_encoding="encode"), rows.value_lengths().fill_null(0).to_numpy()
            codes = rows_of.dictionary.to_pylist()
            code_of = np.repeat(rows_of.indices.to_numpy(), sizes)  # of each word
            words, parts = rows.flatten(), []
            for at in range(0, len(words), CHUNK):
                coded = words.slice(at, CHUNK).dictionary_encode(null_encoding="encode")
                distinct, index, spots = coded.dictionary.to_pylist(), coded.indices.to_numpy(), code_of[at : at + CHUNK]
                forms, form_of = list(distinct), np.tile(np.arange(len(distinct)), (len(codes), 1))
                for k, code in enumerate(codes):
                    known = shared.value.get(code, {})
                    for i in np.unique(index[spots == k]) if known else ():
                        if distinct[i] in known:
                            form_of[k, i] = len(forms)
                            forms.append(known[distinct[i]])
                parts.append(pa.array(forms, words.type).take(pa.array(form_of[spots, index])))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(parts) if parts else words)

    return df.withColumn(tokens, looked_up(tokens, lang))


def preprocess_multilingual(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    stop_words: dict[str, list[str]] | None = None,
    lemmas: DataFrame | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Content words for languages with a model, plain cleaning for the rest (LNG-6)."""
    stop_words = default_stop_words() if stop_words is None else stop_words
    has_model = F.col(lang).isin(WITH_MODEL)
    tokens = F.when(has_model, content_words(F.col(text), F.col(lang), stop_words))
    out = df.withColumn("_tokens_", tokens)
    if lemmas is not None:
        known = lemmatize(out.withColumn("_tokens_", F.coalesce("_tokens_", F.array().cast("array<string>"))),
                          lemmas, id_col, "_tokens_", lang)
        out = known
    cleaned = F.when(has_model, F.array_join("_tokens_", " ")).otherwise(clean_text(F.col(text)))
    return out.withColumn(text, cleaned).drop("_tokens_")


def preprocess(
    df: DataFrame,
    text: str = "text",
    multilingual: bool = False,
    id_col: str = "id",
    lang: str | None = None,
    profiles: Profiles | None = None,
    **options,
) -> DataFrame:
    """Clean the text column of a table with all its splits (TXT-11).

    With ``multilingual`` the language is read from ``lang``, or detected.
    """
    if not multilingual:
        return df.withColumn(text, clean_text(F.col(text)))
    if lang is None:
        if profiles is None:
            raise ValueError("multilingual cleaning needs a language column or profiles")
        df, lang = detect(df, profiles, id_col, text, "_lang_"), "_lang_"
    return preprocess_multilingual(df, text, lang, id_col=id_col, **options).drop("_lang_")


def by_language(df: DataFrame, languages: list[str], lang: str = "lang") -> DataFrame:
    """Rows in one of the languages (LNG-7); the filter reaches the scan."""
    return df.filter(F.col(lang).isin(languages))


def tag_target(df: DataFrame, target: list[str], lang: str = "lang") -> DataFrame:
    """Split by language: target languages are for training, all others for zero-shot tests."""
    return df.withColumn("role", F.when(F.col(lang).isin(target), "target").otherwise("zero_shot"))

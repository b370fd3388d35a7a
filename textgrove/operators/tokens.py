"""Vocabularies, word pieces and padded batches of token ids."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.functions.tokens import attention_mask, frame, pad, pretokenize
from textgrove.operators.scale import match, running_totals, seeded_hash, seeded_rank, settle

# Special tokens, by role.
SPECIALS = {"pad": "[PAD]", "unk": "[UNK]", "cls": "[CLS]", "sep": "[SEP]", "mask": "[MASK]"}
CONTINUED = "##"  # mark of a piece that does not start a word
SHORT = 100  # longer ends of words are counted only where their last characters are frequent enough
MAX_BYTES = 256 << 20  # of a vocabulary, which is sent to every executor
MEMO = 200_000  # words whose pieces a task remembers
CHUNK = 1 << 18  # words of a batch that are looked up at a time


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary of a file with one token per line (TOK-2).

    The id is the line number from 0; of a repeated token the last line counts.
    One file holds the vocabulary; more files with tokens are an error.
    """
    names = spark.read.text(path).filter("value <> ''").select(F.input_file_name().alias("f")).distinct().limit(2)
    if len(names.collect()) > 1:
        raise ValueError(f"{path} holds more than one vocabulary file")
    lines = F.split(F.regexp_replace("value", "\n$", ""), "\n")
    numbered = spark.read.text(path, wholetext=True).select(F.posexplode(lines).alias("id", "token"))
    return numbered.groupBy("token").agg(F.max("id").alias("id"))


def save_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """Write a vocabulary without gaps as one file in the order of the ids."""
    vocabulary.orderBy("id").coalesce(1).select("token").write.mode("overwrite").text(path)


def token_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of each pre-token."""
    return (
        df.select(F.explode(pretokenize(F.col(text))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def build_vocabulary(counts: DataFrame, size: int, max_word: int | None = None) -> DataFrame:
    """Vocabulary of a corpus from its word counts (TOK-3).

    Special tokens come first, then the characters in both forms, then the
    most frequent words and word ends; ties go by the text of the piece. Words
    of any length count, unless ``max_word`` leaves longer ones out.
    """
    usable = counts if max_word is None else counts.filter(F.length("word") <= max_word)
    word = F.col("word")
    mark = lambda i: F.when(i > 1, CONTINUED).otherwise("")
    characters = F.transform(
        F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(mark(i), F.substring(word, i, F.lit(1)))
    )
    ends_from = lambda first: F.transform(
        first, lambda i: F.concat(mark(i), F.substring(word, i, F.length(word)))
    )
    first_short = F.greatest(F.lit(1), F.length(word) - SHORT + 1)
    ends = F.filter(ends_from(F.sequence(first_short, F.length(word))), lambda p: ~_single(p))
    pieces = (
        usable.select("n", F.explode(F.concat(characters, ends)).alias("token"))
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )
    room = size - len(SPECIALS)
    long_ones = usable.filter(F.length(word) > SHORT)
    if not long_ones.isEmpty():
        pieces = settle(pieces, "pieces")
        pieces = pieces.unionByName(_long_ends(long_ones, pieces, room))
    top = (
        pieces.withColumn("rank_class", F.when(_single(F.col("token")), 0).otherwise(1))
        .orderBy("rank_class", F.col("n").desc(), "token")
        .limit(room)
    )
    order = Window.orderBy("rank_class", F.col("n").desc(), "token")
    numbered = top.select("token", (F.row_number().over(order) + len(SPECIALS) - 1).alias("id"))
    special = F.array(*[F.struct(F.lit(t).alias("token"), F.lit(i).alias("id")) for i, t in enumerate(SPECIALS.values())])
    return counts.sparkSession.range(1).select(F.inline(special)).unionByName(numbered)


def _single(piece: Column) -> Column:
    """Whether a piece is one character, the mark aside."""
    return F.length(F.regexp_replace(piece, "^" + CONTINUED + "(?=.)", "")) == 1


def _long_ends(words: DataFrame, pieces: DataFrame, room: int) -> DataFrame:
    """Counts of the ends of more than ``SHORT`` characters that may be among the ``room`` first.

    An end is not more frequent than its own last characters. So ends are built
    only of words whose last ``SHORT`` characters reach the count of the last
    piece that has room.
    """
    least = pieces.orderBy(F.col("n").desc()).limit(room).agg(F.min("n")).first()[0] or 0
    last = F.concat(F.lit(CONTINUED), F.substring("word", -SHORT, SHORT))
    frequent = pieces.filter(F.col("n") >= least).select(F.col("token").alias("_last"))
    built = words.withColumn("_last", last).join(frequent, "_last", "left_semi")
    places = built.select("n", "word", F.explode(F.sequence(F.lit(1), F.length("word") - SHORT)).alias("i"))
    end = F.concat(F.when(F.col("i") > 1, CONTINUED).otherwise(""), F.expr("substring(word, i)"))
    return places.groupBy(end.alias("token")).agg(F.sum("n").alias("n"))


def vocabulary_ids(vocabulary: DataFrame, max_bytes: int = MAX_BYTES) -> dict[str, int]:
    """The vocabulary as a dictionary, after a check of its size in memory and of its ids.

    It is written first: counting and sending it do not build it twice.
    """
    vocabulary = settle(vocabulary.select("token", "id"), "vocabulary")
    facts = vocabulary.agg(
        F.sum(F.octet_length("token") + 100).alias("bytes"), F.count("*").alias("n"), F.count_distinct("id").alias("ids")
    ).first()
    if (facts["bytes"] or 0) > max_bytes:
        raise ValueError(f"the vocabulary takes about {facts['bytes']} bytes of each executor; {max_bytes} are allowed")
    if facts["ids"] != facts["n"]:
        raise ValueError("tokens of the vocabulary share an id")
    return {r["token"]: r["id"] for r in vocabulary.collect()}


def _greedy(word: str, ids: dict[str, int], unknown: int, longest: int, max_word: int | None) -> list[int]:
    found, at = [], 0
    while at < len(word) and (max_word is None or len(word) <= max_word):
        mark = CONTINUED if at else ""
        for end in range(min(len(word), at + longest), at, -1):
            piece = ids.get(mark + word[at:end])
            if piece is not None:
                break
        else:
            return [unknown]
        found.append(piece)
        at = end
    return found or [unknown]


def _look_up(spark: SparkSession, ids: dict[str, int], max_word: int | None):
    """Arrow function from words to piece ids; a task cuts each word once.

    Words stay in Arrow: of ``CHUNK`` of them at a time, only the distinct ones become Python strings,
    and the ids of all are put together as flat arrays.
    """
    shared = spark.sparkContext.broadcast(ids)
    unknown = ids[SPECIALS["unk"]]

    @F.arrow_udf("array<int>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        longest = max(map(len, table))
        memo: dict[str, list[int]] = {}

        def cut(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """How many ids each word has, and all ids."""
            coded = words.dictionary_encode()
            if len(memo) > MEMO:
                memo.clear()
            found = []
            for word in coded.dictionary.to_pylist():
                pieces = memo.get(word)
                if pieces is None:
                    pieces = memo[word] = _greedy(word, table, unknown, longest, max_word)
                found.append(pieces)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, sizes.sum())
            index = coded.indices.to_numpy()
            n = sizes[index]
            first = (np.cumsum(sizes) - sizes)[index] - (np.cumsum(n) - n)
            return n, flat[np.arange(n.sum()) + np.repeat(first, n)]

        for batch in batches:
            words, places = batch.flatten(), np.zeros(len(batch) + 1, np.int64)
            np.cumsum(batch.value_lengths().to_numpy(), out=places[1:])
            parts = [cut(words.slice(at, CHUNK)) for at in range(0, len(words), CHUNK)]
            ends = np.zeros(len(words) + 1, np.int32)
            np.cumsum(np.concatenate([n for n, _ in parts] or [ends[:0]]), out=ends[1:])
            every = np.concatenate([found for _, found in parts] or [ends[:0]])
            yield pa.ListArray.from_arrays(pa.array(ends[places]), pa.array(every))

    return look_up


def word_pieces(words: DataFrame, ids: dict[str, int], max_word: int | None = None) -> DataFrame:
    """Piece ids of each distinct word by greedy longest match (TOK-4).

    A word that cannot be covered becomes the unknown token, and so does one of
    more than ``max_word`` characters, where that is given.
    """
    look_up = _look_up(words.sparkSession, ids, max_word)
    return words.select("word").distinct().withColumn("ids", look_up(F.array("word")))


def encode(
    df: DataFrame, ids: dict[str, int], text: str = "text", name: str = "ids", max_word: int | None = None
) -> DataFrame:
    """Add the piece ids of every text, in order and in full (TOK-4).

    Words are cut out in the JVM; looking them up is a narrow Arrow step, so
    that no text is taken apart and shuffled back together.
    """
    look_up = _look_up(df.sparkSession, ids, max_word)
    return df.withColumn(name, look_up(pretokenize(F.col(text))))


def pad_batches(
    df: DataFrame,
    id_col: str = "id",
    ids: str = "input_ids",
    batch_size: int = 1000,
    pad_id: int = 0,
    seed: int | str = 42,
    by: list[str] | None = None,
) -> DataFrame:
    """Pad each row to the longest of its batch and add the mask (TOK-6).

    Batches of ``batch_size`` rows follow the shuffled order of the ids, within
    each group of ``by``.
    """
    by = by or []
    ranked = seeded_rank(df, id_col, seed, by, "_rank")
    batched = ranked.withColumn("batch_id", F.floor((F.col("_rank") - 1) / batch_size)).drop("_rank")
    longest = F.max(F.size(ids)).over(Window.partitionBy(*by, "batch_id"))
    filled = batched.withColumn("_length", longest)
    return filled.withColumns(
        {
            "attention_mask": attention_mask(F.col(ids), F.col("_length")),
            ids: pad(F.col(ids), F.col("_length"), pad_id),
        }
    ).drop("_length")


def length_batches(
    df: DataFrame,
    id_col: str = "id",
    ids: str = "input_ids",
    batch_size: int = 1000,
    pad_id: int = 0,
    seed: int | str = 42,
    by: list[str] | None = None,
) -> DataFrame:
    """``pad_batches`` with batches of rows of about one length, so that little is padded (TOK-6).

    Rows are ranked by length, equal lengths in a seeded order, and cut into batches of ``batch_size``;
    the batches have a seeded order of their own, so that lengths do not rise through an epoch. Another
    seed gives other batches of the same lengths. Only ids and lengths are ranked, by ranges; of the rows
    nothing moves but for the one join that gives them their batch. ``id_col`` is unique.
    """
    by = by or []
    sizes = df.select(*by, F.col(id_col).alias("_id"), F.size(ids).alias("_size"), seeded_hash(id_col, seed).alias("_hash"))
    ranked = running_totals(sizes.withColumn("_one", F.lit(1)), ["_size", "_hash", "_id"], ["_one"], by)
    placed = settle(ranked.select(*by, "_id", "_size", F.floor(F.col("_one_before") / batch_size).alias("_batch")), "placed")
    longest = settle(placed.groupBy(*by, "_batch").agg(F.max("_size").alias("_length")), "longest")
    ordered = seeded_rank(longest, "_batch", seed, by, "_rank")
    batches = ordered.select(*by, "_batch", "_length", (F.col("_rank") - 1).cast("long").alias("batch_id"))
    known = match(placed.drop("_size"), settle(batches, "batches"), [*by, "_batch"]).select("_id", "_length", "batch_id")
    filled = df.join(known, F.col(id_col) == F.col("_id")).drop("_id")
    return filled.withColumns(
        {
            "attention_mask": attention_mask(F.col(ids), F.col("_length")),
            ids: pad(F.col(ids), F.col("_length"), pad_id),
        }
    ).drop("_length")


def padding_share(batched: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Places of padded rows, those that hold tokens, and the share of padding (TOK-6)."""
    tokens = F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = batched.groupBy(*(by or [])).agg(F.sum(F.size("attention_mask")).alias("places"), F.sum(tokens).alias("tokens"))
    return sums.withColumn("padding", 1 - F.col("tokens") / F.col("places"))


def pad_fixed(df: DataFrame, length: int, ids: str = "input_ids", pad_id: int = 0) -> DataFrame:
    """Pad each row to a fixed length and add the mask (TOK-6)."""
    return df.withColumns(
        {
            "attention_mask": attention_mask(F.col(ids), F.lit(length)),
            ids: pad(F.col(ids), F.lit(length), pad_id),
        }
    )


def tokenize(
    df: DataFrame,
    vocabulary: DataFrame,
    id_col: str = "id",
    text: str = "text",
    label: str = "label",
    max_length: int = 512,
    batch_size: int | None = 1000,
    keep: list[str] | None = None,
    seed: int | str = 42,
) -> DataFrame:
    """Token ids, mask and ``labels`` of a labelled table (TOK-7).

    The text and other source columns are dropped, but for the id and ``keep``.
    Batches stay within the groups of ``keep``, such as splits. Without a batch
    size all rows get ``max_length`` places.
    """
    keep = keep or []
    ids = vocabulary_ids(vocabulary)
    pad_token = SPECIALS["pad"] if SPECIALS["pad"] in ids else SPECIALS["sep"]
    framed = frame(F.col("ids"), ids[SPECIALS["cls"]], ids[SPECIALS["sep"]], max_length)
    rows = encode(df, ids, text).select(
        id_col, *keep, framed.alias("input_ids"), F.col(label).alias("labels")
    )
    if batch_size is None:
        return pad_fixed(rows, max_length, pad_id=ids[pad_token])
    rows = settle(rows, "tokens")  # ranking reads the ids a second time
    return pad_batches(rows, id_col, batch_size=batch_size, pad_id=ids[pad_token], seed=seed, by=keep)

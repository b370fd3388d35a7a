"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

The words of a line are a set, ordered by rarity in the corpus. Two lines of a Jaccard similarity
of at least the threshold share a word among the rarest of both (the prefixes); length, position
and a bitmap rule most of the others out, and what is left is verified. Of two similar lines the
later one goes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.llm.words import SPACE, ascii_lower, column
from textgrove.operators.scale import discard, running_totals, settle_by, settle_last as settle, shuffles_dropped

SIMILARITY = 0.8
#: Cells of the table of frequencies; a cell's level is a byte. Only the order of words depends on it.
CELLS = 1 << 19
#: Levels for each doubling of a frequency, and the bits of a word's hash below its level.
STEPS = 5
HASH_BITS = 55
SLACK = 1e-9
#: What may have a lower case besides A-Z: all but ASCII, Latin-1 from sharp s on, punctuation and CJK.
OTHER_LETTERS = "[^\\x00-\\x7F\\xA0-\\xBF\\xDF-\\xFF\\u2010-\\u205E\\u3001-\\u9FFF]"
#: Lines of a word that one task compares at most; the lines of more frequent words are dealt over a grid.
HOT = 1 << 12
#: Numbers of 64 bits in the sketch of a line that is verified, a power of 2.
SKETCH = 4
#: Rows of a word from which lines that are known to go are always taken out before they are joined.
CROWD = 1 << 10


def _plain(line: Column) -> Column:
    """A line in lower case whose only white space are plain spaces."""
    other = reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in SPACE[1:]])
    flat = F.when(other, F.translate(line, SPACE, " " * len(SPACE))).otherwise(line)
    only_a_to_z = (F.octet_length(line) == F.char_length(line)) | ~line.rlike(OTHER_LETTERS)
    return F.when(only_a_to_z, F.lower(flat)).otherwise(ascii_lower(flat))


def _split(line: Column) -> Column:
    """The words of a plain line, repeats included, and empty strings between spaces.

    Cut at a single character, which builds no pattern for each line.
    """
    return F.split(line, " ")


def line_words(line: Column) -> Column:
    """The set of words of a plain line, as 64-bit hashes."""
    return F.array_distinct(F.transform(F.array_remove(_split(line), ""), lambda w: F.xxhash64(w)))


def _numbered(docs: DataFrame, id_col: str, text_col: str, **more: Column) -> tuple[DataFrame, int]:
    """``(num, id, text, ...)`` and the bits of a line's place: ``num`` orders the rows by id.

    Unique ids that leave room for the place are their own numbers. Else rows are ranked by id,
    nulls last, by ranges.
    """
    plain = docs.select(column(id_col).alias("id"), column(text_col).alias("text"), *[c.alias(n) for n, c in more.items()])
    facts = plain.agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("ids"),
        F.coalesce(F.max(F.octet_length("text")), F.lit(0)).alias("bytes"),
        *([F.min("id").alias("low"), F.max("id").alias("high")] if dict(plain.dtypes)["id"] in ("bigint", "int") else []),
    ).first()
    bits = int(facts["bytes"]).bit_length() + 1
    if "high" in facts and facts["ids"] == facts["n"] and (facts["n"] == 0 or (facts["low"] >= 0 and facts["high"] < 1 << (62 - bits))):
        return plain.withColumn("num", F.col("id").cast("long")), bits
    rows = settle(plain.withColumn("row", F.monotonically_increasing_id()), "rows")
    numeric = dict(plain.dtypes)["id"] in ("bigint", "int", "smallint", "tinyint")
    name = F.col("id") if numeric else F.col("id").cast("string")
    order = rows.select("row", F.col("id").isNull().alias("none"), name.alias("name"), F.lit(1).alias("one"))
    ranked = running_totals(order, ["none", "name", "row"], ["one"])
    return rows.join(ranked.select("row", F.col("one_before").cast("long").alias("num")), "row").drop("row"), bits


def _lines(numbered: DataFrame, bits: int) -> DataFrame:
    """``(num, pos, line, order)`` of every line that has a word."""
    each = numbered.select("num", F.posexplode_outer(F.split("text", "\n")).alias("pos", "line"))
    return each.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn(
        "order", F.call_function("shiftleft", "num", F.lit(bits)) + F.col("pos")
    )


def _level(n: Column) -> Column:
    """Frequency level of a count, 0 to 127: ``STEPS`` for each doubling."""
    return F.least(F.lit(127), F.floor(STEPS * F.log2(1 + n))).cast("int")


def rarity(lines: DataFrame) -> Callable[[Column], Column]:
    """A function of a word's hash: its place in the order of words, level before hash, as one number.

    Words are counted by cell of their hash, over all words of all ``lines``; the table has a byte for
    each cell, whatever the corpus. Words that share a cell look as frequent as all of them together,
    which moves words in the order, the same in all lines, and loses no pair. A place holds 55 bits of
    the hash; words of one place are taken for one here, which adds pairs to verify and loses none.
    """
    spark = lines.sparkSession
    cell = lambda w: w.bitwiseAND(F.lit(CELLS - 1))
    few = lines.coalesce(spark.sparkContext.defaultParallelism)  # each task sends a count for nearly every cell
    counts = few.select(F.explode_outer(_split(F.col("line"))).alias("w")).groupBy(cell(F.xxhash64("w")).alias("cell")).agg(F.count("*").alias("n"))
    every = spark.range(CELLS).select(F.col("id").alias("cell")).join(counts, "cell", "left")
    every = every.select("cell", _level(F.coalesce("n", F.lit(0))).alias("level"))
    by_cell = F.sort_array(F.collect_list(F.struct("cell", "level")))
    text = F.array_join(F.transform(by_cell, lambda c: c["level"].cast("string")), ",")
    with shuffles_dropped(spark):
        levels = every.agg(text.alias("levels")).first()["levels"]
    table = F.from_json(F.lit(f"[{levels}]"), "array<tinyint>")  # made once, by the planner
    level = lambda w: F.get(table, cell(w).cast("int"))
    return lambda w: F.shiftleft(level(w).cast("long"), HASH_BITS).bitwiseOR(F.shiftrightunsigned(w, 64 - HASH_BITS))


def _needed(a: Column, b: Column, t: float) -> Column:
    """Common words that two sets of these sizes need."""
    return F.ceil((a + b) * (t / (1 + t)) - SLACK)


def _possible(a: str, b: str, t: float) -> Column:
    """Length, positional and bitmap filter for two entries of the index, given as column prefixes."""
    n, m, i, j = (F.col(f"{p}{c}") for c, p in (("n", a), ("n", b), ("i", a), ("i", b)))
    need = _needed(n, m, t)
    return (
        (F.least(n, m) >= F.greatest(n, m) * t - SLACK)
        & (F.least(n - i, m - j) >= need)
        & (F.bit_count(F.col(f"{a}bits").bitwiseXOR(F.col(f"{b}bits"))) <= n + m - 2 * need)
    )


def _parity(words: str | Column) -> Column:
    """64 bits, each whether an odd number of the words fall on it: a word more or less turns one over."""
    one = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(words, F.lit(0).cast("long"), lambda b, w: b.bitwiseXOR(one(w)))


def _verified(pairs: DataFrame, distinct: DataFrame, t: float) -> DataFrame:
    """``order`` of the later lines of the pairs ``(earlier, later)`` whose sets of words are similar.

    Words are sent only for pairs whose sketches, ``SKETCH`` numbers a line, leave it open.
    """
    pairs = settle(pairs.distinct(), "pairs")
    ids = pairs.select(F.explode(F.array("earlier", "later")).alias("order")).distinct()
    words = distinct.join(ids.hint("shuffle_hash"), "order", "left_semi").select("order", line_words(F.col("line")).alias("words"))
    part = lambda k: F.filter("words", lambda w: F.shiftright(w, 6).bitwiseAND(F.lit(SKETCH - 1)) == k)
    bits = [f"b{k}" for k in range(SKETCH)]
    sets = settle(words.select("*", F.size("words").alias("n"), *[_parity(part(k)).alias(b) for k, b in enumerate(bits)]), "sets")
    sketches = sets.drop("words")
    n, m = F.col("n"), F.col("m")
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.col(b).bitwiseXOR(F.col(f"e_{b}"))) for b in bits])
    open_ = (
        pairs.join(sketches.toDF("earlier", "m", *[f"e_{b}" for b in bits]), "earlier")
        .join(sketches.withColumnRenamed("order", "later"), "later")
        .filter(apart <= n + m - 2 * _needed(n, m, t))
        .select("earlier", "later")
    )
    left, right = sets.select(F.col("order").alias("earlier"), F.col("words").alias("w")), sets.select(F.col("order").alias("later"), F.col("words").alias("v"))
    common = F.size(F.array_intersect("w", "v"))
    similar = open_.join(left, "earlier").join(right, "later").filter(common >= _needed(F.size("w"), F.size("v"), t))
    later = settle(similar.select(F.col("later").alias("order")).distinct(), "later")
    discard(pairs, sets)
    return later


ENTRY = ("order", "n", "i", "bits")


def _index(distinct: DataFrame, t: float) -> DataFrame:
    """``(key, w, order, n, i, bits, hot, f_order, crowded)``: the words of the prefixes of the lines of ``distinct``.

    Rows of a word have one ``key`` and are dealt by it. A row is left out if no other line of its
    word has a length at which their places allow the words that are needed. ``f_order`` is the
    earliest line of the word if the two may be similar. Hot words, which the table of frequencies
    shows to have ``HOT`` lines or more, have several keys by line, and all of their rows stay; only
    they are named in ``w``.
    """
    words = distinct.select("order", line_words(F.col("line")).alias("words"))
    place = rarity(distinct)
    n = F.size("words")
    prefix = F.slice(F.sort_array(F.transform("words", place)), F.lit(1), (n - F.ceil(n * t - SLACK) + 1).cast("int"))
    rows = words.select("order", n.alias("n"), _parity("words").alias("bits"), prefix.alias("prefix"))
    rows = rows.select("order", "n", "bits", F.posexplode_outer("prefix").alias("i", "w"))
    level = F.shiftright("w", HASH_BITS)
    hot = level >= F.lit(math.floor(STEPS * math.log2(1 + HOT)))
    most = F.ceil(F.pow(F.lit(2.0), (level + 1) / STEPS) / HOT)
    key = F.when(hot, F.xxhash64("w", F.pmod(F.xxhash64("order"), most))).otherwise(F.col("w"))
    rows = rows.select(key.alias("key"), F.when(hot, F.col("w")).alias("w"), *ENTRY)
    rows = rows.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    one = Window.partitionBy("key")
    by_length = one.orderBy("n")
    before = by_length.rowsBetween(Window.unboundedPreceding, -1)
    n, left = F.col("n"), F.col("n") - F.col("i")  # words from the place of this one on
    rows = rows.withColumns(
        {
            "shorter": F.last(F.when(left >= _needed(n, n, t), n), ignorenulls=True).over(before),  # fit for a line as long or longer
            "longer": F.lead("n").over(by_length),
        }
    )
    rows = rows.withColumns({"f": F.min(F.struct(*ENTRY)).over(one), "crowded": F.count("*").over(one) > CROWD})
    rows = rows.select("*", *[F.col("f")[c].alias(f"f_{c}") for c in ENTRY])
    partner = (F.col("shorter") >= n * t - SLACK) | (left >= _needed(n, F.col("longer"), t))
    hot = F.col("w").isNotNull()
    tried = F.when((F.col("f_order") < F.col("order")) & _possible("f_", "", t), F.col("f_order"))
    return rows.filter(hot | F.coalesce(partner, F.lit(False))).select("key", "w", *ENTRY, hot.alias("hot"), tried.alias("f_order"), "crowded")


def _earlier(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*more, *[F.col(c).alias(f"e_{c}") for c in ENTRY])


def _paired(rows: DataFrame, t: float) -> DataFrame:
    """The pairs ``(earlier, later)`` of joined rows that may be similar."""
    return (
        rows.filter(F.col("e_order") < F.col("order"))
        .filter(_possible("e_", "", t))
        .select(F.col("e_order").alias("earlier"), F.col("order").alias("later"))
    )


def _rest_of_hot(left: DataFrame, others: DataFrame, facts: DataFrame, t: float) -> DataFrame:
    """Pairs of the lines of ``left`` and earlier ones of ``others`` that share a hot word.

    Lines meet only those of a similar length, and in cells of a grid, so that a task holds ``HOT``
    lines of a side: each line is sent to one row or column of the grid of its word.
    """
    step = lambda n: F.floor(F.log(n) / math.log(1.001 / t)).cast("int")  # noqa: E731  similar lengths are one step apart at most
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    place = lambda order: F.pmod(F.xxhash64(order), F.col("parts"))
    near = F.explode(F.array(*[step(F.col("e_n")) + d for d in (-1, 0, 1)]))
    later = left.join(facts, "w").select("w", *ENTRY, step(F.col("n")).alias("step"), place("order").alias("row"), F.explode(every).alias("column"))
    earlier = _earlier(others.join(facts, "w"), "w", "parts").withColumn("step", near)
    earlier = earlier.withColumn("column", place("e_order")).withColumn("row", F.explode(every)).drop("parts")
    return _paired(
        later.withColumn("column", F.col("column").cast("long")).join(earlier.withColumn("row", F.col("row").cast("long")), ["w", "step", "row", "column"]), t
    )


def similar_later(distinct: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """``order`` of the lines of ``distinct`` (line, order), plain ones, that are similar to an earlier one.

    Each line is indexed under the words of its prefix. A line is held against the earliest line of
    each of its words first; most near-copies of one line go there, however many there are. Only
    the lines that are left are joined with all earlier ones of their words. The index is written as
    it was dealt, so this join moves no row of it but those that may belong to lines that went, of
    crowded words and with an earliest line that may be similar; these lose what went before. What
    the other rows add is taken out of the pairs.
    """
    index = settle_by(_index(distinct, t), "key", "index")
    tried = index.filter(F.col("f_order").isNotNull()).select(F.col("f_order").alias("earlier"), F.col("order").alias("later"))
    gone = _verified(tried, distinct, t)
    cold, hot = index.filter("not hot"), index.filter("hot")
    known = F.col("crowded") | F.col("f_order").isNotNull()
    without = lambda df: df.join(gone, "order", "left_anti")
    entries = lambda df: df.select("key", *ENTRY)
    others = _earlier(cold, "key")
    rest = _paired(entries(cold.filter(~known)).join(others, "key"), t).union(_paired(without(entries(cold.filter(known))).join(others, "key"), t))
    parts = F.ceil(F.col("many") / HOT).cast("int")
    facts = settle(hot.groupBy("w").agg(F.count("*").alias("many")).filter("many > 1").select("w", parts.alias("parts")), "facts")
    rest = rest.union(_rest_of_hot(without(hot), hot, facts, t))
    rest = settle(rest, "rest")  # else the planner takes lines out of the index, not of the pairs, and deals it once more
    discard(index, facts)
    late = _verified(rest.join(gone.toDF("later"), "later", "left_anti"), distinct, t)
    discard(rest)
    both = settle(gone.union(late), "gone")
    discard(gone, late)
    return both


def _removed(numbered: DataFrame, bits: int, t: float) -> DataFrame:
    """``(num, removed)``: the places of the lines that go, for rows that lose some."""
    lines = _lines(numbered, bits)
    key = [F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2")]
    firsts = settle(lines.select("order", *key).groupBy("k1", "k2").agg(F.min("order").alias("order"), F.count("*").alias("n")), "firsts")
    dealt = lines.select(_plain(F.col("line")).alias("line"), "order").repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "order")
    distinct = settle_by(dealt.join(firsts, "order", "left_semi"), "order", "distinct", compression="zstd")
    gone = similar_later(distinct, t)
    discard(distinct)
    affected = settle(
        firsts.join(gone.withColumn("similar", F.lit(True)), "order", "left")
        .filter("n > 1 or similar")
        .select("k1", "k2", F.col("order").alias("first"), F.coalesce("similar", F.lit(False)).alias("similar")),
        "affected",
    )
    discard(firsts, gone)
    places = lines.select("num", "pos", "order", *key).join(affected, ["k1", "k2"]).filter(F.col("similar") | (F.col("order") > F.col("first")))
    return places.groupBy("num").agg(F.sort_array(F.collect_list("pos")).alias("removed"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``(id, n_lines, n_removed, removed)`` of every row; ``removed`` are places of lines from 0.

    Lines end at a line feed; ``n_lines`` counts those with a word, the others never go. A line goes
    if an earlier one, by id and then by place, has the same or a similar set of lower-cased words,
    whether that one goes or stays. Rows of null id come last; rows of equal ids are ordered as they
    are read. Null and empty texts have no lines; an empty table gives no rows.
    """
    numbered, bits = _numbered(docs, id_col, text_col)
    removed = _removed(numbered, bits, similarity)
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return (
        numbered.select("num", "id", n.cast("long").alias("n_lines"))
        .join(removed, "num", "left")
        .select(
            F.col("id").alias(id_col),
            "n_lines",
            F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        )
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the lines taken out that ``report`` removes; other columns and rows stay."""
    numbered, bits = _numbered(docs, id_col, text_col, doc=F.struct("*"))
    removed = _removed(numbered.select("num", "text"), bits, similarity)
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("removed", i))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    joined = numbered.join(removed, "num", "left")
    return joined.select(*[(text if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns])

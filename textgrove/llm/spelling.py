"""Spelling variants: words at one edit from each other, found in dense tiles of code points.

Two words differ by one inserted, deleted or replaced code point if, and only if, their common prefix
and their common suffix together reach the length of the longer one less one. Of such a pair the
common prefix ends in one of ``SEGMENTS`` segments of the longer word; what is before and behind the
segment is common to both. So words are dealt into groups by the code points around a segment, and
inside a group, cut into tiles of bounded size, all words are laid out as padded matrices of code
points, aligned left and right, and compared with each other.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.llm.words import column
from textgrove.operators.scale import settle

#: Letters of a word, and the least length and number of words.
LETTERS = "A-Za-zÀ-ÿ"
LENGTH, OFTEN = 7, 2
SEGMENTS = 4
#: Words of one block of a group, and code points of the matrices that are compared at a time.
BLOCK, POINTS = 512, 1 << 21
#: Distinct words that a task holds before it gives them out.
HELD = 1 << 18


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LENGTH, often: int = OFTEN) -> DataFrame:
    """``(word, n)`` of the words of ``least`` or more code points and ``often`` or more occurrences.

    Words are whole runs of letters, A-Z lower-cased. Where the CRC-32 of ``id:run`` is a multiple of
    31, the run loses the code point at that number modulo its length, a misprint that is planted. A
    null text has no words, a null id is an empty one. Occurrences are counted in the tasks first.
    """
    pattern = re.compile(f"[{LETTERS}]{{{least},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(pattern.findall((text.as_py() or b"").lower().decode())).items():
                    mark = zlib.crc32(run.encode(), start)
                    if mark % 31 == 0:
                        at = mark % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least:
                            continue
                    held[run] += n
                if len(held) >= HELD:
                    yield given()
        yield given()

    key = F.coalesce(column(id_col).cast("string"), F.lit(""))
    parts = docs.select(key.alias("id"), F.encode(column(text_col).cast("string"), "utf-8").alias("text"))
    parts = parts.mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


def _keyed(words: DataFrame, segments: int) -> DataFrame:
    """Words under the code points around each segment, as the longer word of a pair or the shorter.

    ``longest`` is the length of the longer word of the pairs to be found, ``segment`` that of the edit.
    """
    size = F.length("word")

    def around(i: Column) -> Column:
        longest, segment = size + F.floor(i / segments).cast("int"), (i % segments).cast("int")
        start = F.floor(segment * longest / segments).cast("int")
        stop = F.floor((segment + 1) * longest / segments).cast("int")
        rest = longest - stop
        key = F.xxhash64(F.substring("word", F.lit(1), start), F.substring("word", size - rest + 1, rest))
        return F.struct(longest.alias("longest"), segment.alias("segment"), key.alias("key"), (stop > start).alias("some"))

    places = F.transform(F.sequence(F.lit(0), F.lit(2 * segments - 1)), around)
    return words.select("word", "n", F.inline(F.filter(places, lambda p: p["some"]))).drop("some")


GROUP = ["longest", "segment", "key"]


def _tiled(keyed: DataFrame, block: int) -> DataFrame:
    """Rows with the pair of blocks, ``low`` and ``high``, that they are compared in.

    A group of more words than a block is dealt into blocks by a hash of the word, and each pair of
    blocks is a tile of its own, so that no task holds more than two blocks of a group.
    """
    most = F.greatest(F.lit(2), F.least(F.lit(block), F.floor(F.lit(POINTS) / F.col("longest")).cast("int")))
    large = settle(
        keyed.groupBy(GROUP).agg(F.count("*").alias("many")).filter(F.col("many") > most).withColumn("blocks", F.ceil(F.col("many") / most).cast("int")),
        "large",
    )
    whole = [F.lit(0).alias(c) for c in ("own", "low", "high")]
    if large.isEmpty():
        return keyed.select("*", *whole)
    own = keyed.join(large.drop("many"), GROUP, "left").withColumn("own", F.pmod(F.xxhash64("word", F.lit(7)), F.coalesce("blocks", F.lit(1))).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    return other.select("word", "n", *GROUP, "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words, padded on the right, the same padded on the left, and lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = max(1, int(sizes.max(initial=1)))
    left = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
    if left.max(initial=0) < 256:
        left = left.astype(np.uint8)
    place = np.arange(width) - (width - sizes)[:, None]
    right = np.where(place < 0, 0, np.take_along_axis(left, np.maximum(place, 0), 1))
    return left, right, sizes


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal places at the beginning of the rows; padding differs from letters, so it ends there."""
    differ = a != b
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def near_pairs(words: list[str], group: np.ndarray, own: np.ndarray, apart: np.ndarray, longest: np.ndarray, segment: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(i, k)`` of words of one group at one edit that belongs to the group's segment.

    ``group`` numbers the tiles, whose rows are neighbours. Rows of the same block are not compared
    in a tile of two blocks (``apart``). Every pair is found in one group only: that of the longer
    length and of the segment in which the common prefix ends.
    """
    left, right, sizes = matrices(words)
    mirrored = right[:, ::-1]
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for step in range(1, len(words)):
        i = np.flatnonzero(group[step:] == group[:-step])
        if not len(i):
            break
        k = i + step
        most = np.maximum(sizes[i], sizes[k])
        i, k, most = (x[(most == longest[i]) & ~(apart[i] & (own[i] == own[k]))] for x in (i, k, most))
        least = np.minimum(sizes[i], sizes[k])
        prefix = np.minimum(_common(left[i], left[k]), least)
        suffix = np.minimum(_common(mirrored[i], mirrored[k]), least)
        here = (prefix >= segment[i] * most // segments) & (prefix < (segment[i] + 1) * most // segments)
        found = here & (prefix + suffix >= most - 1) & ((sizes[i] != sizes[k]) | (prefix < most))
        pairs.append((i[found], k[found]))
    first, second = zip(*pairs, strict=True)
    return np.concatenate(first), np.concatenate(second)


def _nearest(words: list[str], counts: np.ndarray, i: np.ndarray, k: np.ndarray) -> pa.RecordBatch:
    """Of each word with a pair the number of its near words and the most frequent, the least of equals."""
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    own, other = np.concatenate([i, k]), np.concatenate([k, i])
    order = np.lexsort((rank[other], -counts[other], own))
    own, other = own[order], other[order]
    rows, first, n = np.unique(own, return_index=True, return_counts=True)
    best = other[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[r] for r in rows], pa.string()),
            pa.array(n.astype(np.int64)),
            pa.array([words[b] for b in best], pa.string()),
            pa.array(counts[best]),
        ],
        ["word", "n_near", "best", "best_n"],
    )


def _compared(tiles: DataFrame, segments: int) -> DataFrame:
    """``(word, n_near, best, best_n)`` of the words of each task's tiles that have a near one."""
    by = [*GROUP, "low", "high"]
    dealt = tiles.repartition(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches, len(by)):
            keys = [table.column(c).to_numpy() for c in by]
            new = np.concatenate([[True], np.logical_or.reduce([key[1:] != key[:-1] for key in keys])])
            group = np.cumsum(new)
            alone = new & np.append(new[1:], True)
            table, group, keys = table.filter(pa.array(~alone)), group[~alone], [key[~alone] for key in keys]
            if not len(table):
                continue
            words, counts = table.column("word").to_pylist(), table.column("n").to_numpy()
            i, k = near_pairs(words, group, table.column("own").to_numpy(), keys[3] != keys[4], keys[0], keys[1], segments)
            if len(i):
                yield _nearest(words, counts, i, k)

    return dealt.select(*by, "own", "n", "word").mapInArrow(compare, "word string, n_near long, best string, best_n long")


def _tables(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The sorted rows in tables that end with a tile; larger tables only where one tile is larger."""
    held: list[pa.RecordBatch] = []

    def ends(batch: pa.RecordBatch) -> np.ndarray:
        columns = [batch.column(c).to_numpy() for c in range(keys)]
        return np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1

    for batch in batches:
        while batch.num_rows:
            if held and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in range(keys)):
                cuts = ends(batch)
                stop = int(cuts[0]) if len(cuts) else batch.num_rows
                held.append(batch.slice(0, stop))
                batch = batch.slice(stop)
                continue
            if held and sum(b.num_rows for b in held) * held[-1].column(0)[-1].as_py() >= POINTS // 16:
                yield pa.Table.from_batches(held)
                held = []
            width = max(1, batch.column(0)[-1].as_py())
            wanted, cuts = max(1, POINTS // 16 // width), ends(batch)
            at = np.searchsorted(cuts, wanted)
            stop = int(cuts[at]) if at < len(cuts) else batch.num_rows
            held.append(batch.slice(0, stop))
            batch = batch.slice(stop)
    if held:
        yield pa.Table.from_batches(held)


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form: forms are followed twice as far in each round.

    A form is more frequent than its word, so the ways end, and soon.
    """
    ways = settle(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        further = ways.join(ways.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        further = settle(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        ways = further.select("word", "root")
        if further.filter("moved").isEmpty():
            return ways


def variants(words: DataFrame, times: int = 10, block: int = BLOCK, segments: int = SEGMENTS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of a table of distinct words and their numbers.

    ``form`` is the most frequent word at one edit, the least in code-point order of several, if it is
    ``times`` as frequent, else null; ``root`` is where forms lead to from a word, at least itself;
    ``n_near`` is the number of words at one edit. Null words are left out; an empty table gives no rows.
    """
    words = settle(words.filter("word is not null").select("word", "n"), "words")
    partial = settle(_compared(_tiled(_keyed(words, segments), block), segments), "near")
    near = partial.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    )
    frequent = -F.col("first.less") >= F.col("n") * times
    found = settle(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("first.best")).alias("form"), F.when(frequent, -F.col("first.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of all texts, counted as in ``word_counts``."""
    return variants(word_counts(docs, id_col, text_col))

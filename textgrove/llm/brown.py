"""A class-based bigram language model in the manner of Brown et al.

Exchange clustering puts words into classes so that the classes of neighbouring words tell most
about each other. The probability of a word is that of its class after the class before it, times
that of the word in its class, mixed with its probability in the whole corpus.

Every word with ``EVIDENCE`` training occurrences is exchanged as a row of its own. The frequent ones
begin: they move one after the other, on counts that the driver can hold. Then all words move in
sweeps: the classes of each word's neighbours are counted, words are dealt over the tasks with their
counts, and each goes to the class in which the corpus is most likely, until that settles.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.llm.quality_model import held_out
from textgrove.llm.words import column
from textgrove.operators.scale import settle

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
END = b"\n"  # no word can be a line break
ADD = 0.1
#: Words with at least one of ``NEAR`` shares of the training tokens, and ``EVIDENCE`` occurrences, are
#: looked up in the executors' memory and have a class of their own; so there are a million at most.
#: Those of the second share begin. Rarer words have the class of others that end like them.
NEAR, OWN, EVIDENCE = 1 << 20, 1 << 11, 5
#: Units of words by their last bytes. Longer words than ``LONG`` bytes are known by a digest.
BINS, LONG = 512, 64
CLASSES, ROUNDS, PARTS, TRUST = 64, 12, 4, 0.9
#: Sweeps over all words at most; they end when one makes a token likelier by less than ``SETTLED`` nats.
SWEEPS, SETTLED = 4, 0.002
#: Distinct words, and tokens, that a task holds before it counts them together.
HELD, TOKENS = 1 << 19, 1 << 20


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words of a text and the end."""
    words = WORD.findall((text or "").encode().lower())
    words.append(END)
    return words


def short(word: bytes) -> bytes:
    """A word as the lookup knows it: a long one by a digest, after a byte that no shorter one begins with."""
    return word if len(word) <= LONG else b"\n" + hashlib.md5(word).digest()


def bin_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % BINS


@dataclass
class Lookup:
    """Near words: place, and logarithm of the training count. Places behind them are those of the bins."""

    places: dict[bytes, int]
    logs: np.ndarray
    owned: int

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Places of words or of their bins; and the words that have none."""
        find, rare, first = self.places.get, [], len(self.places)
        out = [find(w) for w in words]
        for i, place in enumerate(out):
            if place is None:
                word = words[i]
                place = find(short(word)) if len(word) > LONG else None
                if place is None:
                    rare.append(word)
                    place = first + bin_of(word)
                out[i] = place
        return np.array(out, np.int32), rare

    def units(self, bins: np.ndarray) -> np.ndarray:
        """Units of the places in the first rounds: frequent words for themselves, the others by their bins."""
        own = np.arange(len(self.places))
        return np.concatenate([np.where(own < self.owned, own, self.owned + bins), self.owned + np.arange(BINS)])


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, n_train)`` of the training texts; ``docs`` has ``text`` and ``train``. Counted in the tasks first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def given() -> pa.RecordBatch:
            rows = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(rows, ["word", "n_train"])

        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
                if len(held) >= HELD:
                    yield given()
        yield given()

    counts = docs.filter("train").select("text").mapInArrow(counted, "word binary, n_train long")
    return counts.groupBy("word").agg(F.sum("n_train").alias("n_train"))


def is_near(total: int) -> Column:
    """Whether a word of a counted vocabulary with ``total`` training tokens is in the lookup."""
    frequent = (F.col("n_train") * NEAR >= total) & (F.col("n_train") >= EVIDENCE)
    return frequent | (F.col("word") == F.lit(bytearray(END)))


def lookup(vocabulary: DataFrame, total: int) -> tuple[Lookup, np.ndarray]:
    """The near words of a counted vocabulary, the end first, then by training count; and their bins."""
    key = F.when(F.octet_length("word") > LONG, F.concat(F.lit(bytearray(b"\n")), F.unhex(F.md5("word")))).otherwise(F.col("word"))
    near = vocabulary.filter(is_near(total)).select(key.alias("key"), F.substring("word", -3, 3).alias("last"), "n_train")
    rows = sorted(((-r["n_train"], bytes(r["key"]), bytes(r["last"])) for r in near.collect()))
    rows.sort(key=lambda r: r[1] != END)
    if not rows or rows[0][1] != END:
        rows.insert(0, (0, END, END))
    owned = max(1, sum(-n * OWN >= total for n, _, _ in rows))
    places = {key: i for i, (_, key, _) in enumerate(rows)}
    logs = np.log10(np.array([-n for n, _, _ in rows]) + ADD)
    return Lookup(places, logs, owned), np.array([bin_of(last) for _, _, last in rows])


def _encoded(rows: DataFrame, shared) -> DataFrame:
    """``(id, row, train, n_tokens, ids, rare)``: the places of a text's tokens, packed, and its words without one."""
    kind = rows.schema["id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, pack = shared.value, zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            ids, rare, n = [], [], []
            for text in batch.column("text"):
                places, words = table.encode(tokens(text.as_py()))
                ids.append(pack(places.tobytes()))
                rare.append(words)
                n.append(len(places))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), batch.column("train"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(rare, pa.list_(pa.binary()))],
                ["id", "row", "train", "n_tokens", "ids", "rare"],
            )

    numbered = rows.select("id", F.monotonically_increasing_id().alias("row"), "train", "text")
    return numbered.mapInArrow(encode, f"id {kind.simpleString()}, row long, train boolean, n_tokens long, ids binary, rare array<binary>")


def _places(ids: pa.Array) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(unpack(x.as_py()), np.int32) for x in ids]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The places of whole texts one after the other, about ``TOKENS`` at a time; each text ends with the end."""
    held, n = [], 0
    for batch in batches:
        for places in _places(batch.column("ids")):
            held.append(places)
            n += len(places)
            if n >= TOKENS:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _before(places: np.ndarray) -> np.ndarray:
    """The place before each; a text begins after an end, which is place 0 and the last of each text."""
    return np.concatenate([[0], places[:-1]])


def count_pairs(rows: DataFrame, units: np.ndarray) -> DataFrame:
    """``(a, b, n)`` of neighbouring units in the training texts."""
    size = int(units.max()) + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for places in _pieces(batches):
            keys = units[_before(places)].astype(np.int64) * size + units[places]
            pairs, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs // size), pa.array(pairs % size), pa.array(n)], ["a", "b", "n"])

    counts = rows.filter("train").select("ids").mapInArrow(counted, "a long, b long, n long")
    return counts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Log-likelihood of a class assignment but for what does not depend on it."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def gains(matrix: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, itself: float) -> tuple[np.ndarray, np.ndarray]:
    """How likely the corpus is with a unit of class ``own`` in each class; and the matrix without the unit.

    ``after`` and ``before`` count its neighbours by class, but for its ``itself`` pairs with itself.
    """
    rest = matrix.copy()
    rest[own, :] -= after
    rest[:, own] -= before
    rest[own, own] -= itself
    old = _xlogx(rest)
    rows = _xlogx(rest + after[None, :]) - old
    columns = _xlogx(rest + before[:, None]) - old
    corner = np.diag(rest)
    gain = rows.sum(1) - np.diag(rows) + columns.sum(0) - np.diag(columns)
    gain += _xlogx(corner + after + before + itself) - np.diag(old)
    left, right = rest.sum(1) + before, rest.sum(0) + after  # wherever the unit goes
    gain -= _xlogx(left + after.sum() + itself) - _xlogx(left)
    gain -= _xlogx(right + before.sum() + itself) - _xlogx(right)
    return gain, rest


def moved(matrix: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, itself: float) -> int:
    """The class in which a unit of class ``own`` makes the corpus most likely; ``matrix`` follows.

    ``after`` and ``before`` count its neighbours by class, ``itself`` its pairs with itself.
    """
    after, before = after.copy(), before.copy()
    after[own] -= itself
    before[own] -= itself
    gain, rest = gains(matrix, own, after, before, itself)
    best = int(gain.argmax())
    to = best if gain[best] > gain[own] + 1e-6 else own
    if to != own:
        rest[to, :] += after
        rest[:, to] += before
        rest[to, to] += itself
        matrix[:] = rest
    return to


def exchange(pairs: DataFrame, units: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit and the matrix of class pairs after ``rounds`` of exchanges.

    Spark counts the neighbours of each unit by class and all pairs of classes. Each round takes the
    units of one of ``PARTS`` parts, frequent ones first, and sends them to their best classes one
    after the other, with the class matrix kept up to date; the counts of the neighbours are those
    of the start of the round. The assignment of the highest likelihood is returned. What comes to
    the driver is as large as the units of a part times the classes, which constants bound.
    """
    spark = pairs.sparkSession
    assigned = np.arange(units) % classes
    best: tuple = (-np.inf, assigned, np.zeros((classes, classes)))
    for turn in range(rounds + 1):
        named = spark.createDataFrame(pd.DataFrame({"u": np.arange(units, dtype=np.int32), "c": assigned.astype(np.int32)}))
        left, right = named.toDF("a", "ca"), named.toDF("b", "cb")
        both = pairs.join(F.broadcast(left), "a").join(F.broadcast(right), "b")
        matrix = np.zeros((classes, classes))
        for r in both.groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
            matrix[r["ca"], r["cb"]] = r["n"]
        value = likelihood(matrix)
        if value > best[0]:
            best = (value, assigned, matrix)
        if turn == rounds:
            break
        neighbours = both.select(
            F.inline(
                F.array(
                    F.struct(F.col("a").alias("u"), F.lit(0).alias("side"), F.col("cb").alias("c"), "n"),
                    F.struct(F.col("b").alias("u"), F.lit(1).alias("side"), F.col("ca").alias("c"), "n"),
                    F.struct(F.col("a").alias("u"), F.lit(2).alias("side"), F.lit(0).alias("c"), F.when(F.col("a") == F.col("b"), F.col("n")).alias("n")),
                )
            )
        )
        counts = (
            neighbours.filter((F.col("u") % PARTS == turn % PARTS) & F.col("n").isNotNull())
            .groupBy("u", "side", "c")
            .agg(F.sum("n").alias("n"))
            .groupBy("u")
            .agg(F.collect_list(F.struct("side", "c", "n")).alias("counts"))
        )
        assigned, table = assigned.copy(), matrix.copy()
        for r in sorted(counts.collect(), key=lambda r: r["u"]):
            sides = np.zeros((3, classes))
            for row in r["counts"]:
                sides[row["side"], row["c"]] = row["n"]
            assigned[r["u"]] = moved(table, int(assigned[r["u"]]), sides[0], sides[1], sides[2, 0])
    return best[1], best[2]


def neighbours(rows: DataFrame, kinds: np.ndarray, classes: int) -> DataFrame:
    """``(place, counts)``: of each place the classes after it, before it, and its pairs with itself.

    ``kinds`` are the classes of the places. Tasks count their texts together before rows are
    exchanged, and send of a place the classes that occur.
    """
    wide = 2 * classes + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> None:
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            keys, inverse = np.unique(keys, return_inverse=True)
            held[:] = [(keys, np.bincount(inverse, n).astype(np.int64))]

        for places in _pieces(batches):
            before = _before(places).astype(np.int64)
            kind, kind_before = kinds[places], kinds[before]
            equal = before[before == places]
            keys = np.concatenate([before * wide + kind, places * np.int64(wide) + classes + kind_before, equal * wide + 2 * classes])
            held.append(np.unique(keys, return_counts=True))
            if len(held) > 4:
                merge()
        if not held:
            return
        merge()
        (keys, n), = held
        place, first = np.unique(keys // wide, return_index=True)
        for at in range(0, len(place), 1 << 14):
            ends = np.append(first, len(keys))[at : at + (1 << 14) + 1]
            part = slice(ends[0], ends[-1])
            offsets = pa.array((ends - ends[0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place[at : at + (1 << 14)]),
                    pa.ListArray.from_arrays(offsets, pa.array((keys[part] % wide).astype(np.int16))),
                    pa.ListArray.from_arrays(offsets, pa.array(n[part])),
                ],
                ["place", "slot", "n"],
            )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, slots, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if place not in rows:
                    rows[place] = np.zeros(wide, np.int64)
                rows[place][slots.values.to_numpy()] += n.values.to_numpy()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array([r.tobytes() for r in rows.values()], pa.binary())], ["place", "counts"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = rows.filter("train").select("ids").mapInArrow(counted, "place long, slot array<short>, n array<long>")
    return sent.repartition(parts, "place").mapInArrow(summed, "place long, counts binary")


def _matrix(counts: DataFrame, kinds: np.ndarray, classes: int) -> np.ndarray:
    """Pairs of classes, from the classes after each place."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, classes), np.int64)
        for batch in batches:
            for place, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[kinds[place]] += np.frombuffer(row.as_py(), np.int64)[:classes]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["part"])

    parts = counts.select("place", "counts").mapInArrow(summed, "part binary").collect()
    return sum((np.frombuffer(r["part"], np.int64) for r in parts), np.zeros(classes**2, np.int64)).reshape(classes, classes).astype(float)


def sweeps(rows: DataFrame, kinds: np.ndarray, near: int, owned: int, classes: int = CLASSES, most: int = SWEEPS) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Classes of all places after sweeps over the ``near`` ones; the class matrix; log-likelihoods a token.

    In a sweep each word goes to the class in which it makes the corpus most likely, the others being
    where they are; the words are dealt over the tasks with the counts of their neighbours, and only
    their classes come back. As words move at the same time, a sweep takes one half of them by a hash,
    the first one all but the ``owned`` ones. A sweep that makes the corpus less likely is undone, and
    is the last, as is one that gains less than ``SETTLED`` a token.
    """
    best: tuple = (-np.inf, kinds, np.zeros((classes, classes)))
    history: list[float] = []
    for turn in range(most + 1):
        counts = settle(neighbours(rows, kinds, classes), "neighbours")
        matrix = _matrix(counts, kinds, classes)
        value = likelihood(matrix) / max(matrix.sum(), 1)
        history.append(value)
        gained = value - best[0]
        if gained > 0:
            best = (value, kinds, matrix)
        if gained < SETTLED or turn == most:
            break

        def move(batches: Iterator[pa.RecordBatch], kinds=kinds, matrix=matrix, turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for place, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if place >= near or (place < owned if turn == 0 else zlib.crc32(b"%d" % place) % 2 == turn % 2):
                        continue
                    own, n = int(kinds[place]), np.frombuffer(row.as_py(), np.int64).astype(float)
                    after, before, itself = n[:classes].copy(), n[classes : 2 * classes].copy(), n[-1]
                    after[own] -= itself
                    before[own] -= itself
                    gain, _ = gains(matrix, own, after, before, itself)
                    to = int(gain.argmax())
                    if to != own and gain[to] > gain[own] + 1e-6:
                        out.append((place, to))
                places, to = zip(*out, strict=True) if out else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(to, pa.int32())], ["place", "kind"])

        kinds = kinds.copy()
        for r in counts.mapInArrow(move, "place long, kind int").toLocalIterator():  # near words: a million at most
            kinds[r["place"]] = r["kind"]
    return best[1], best[2], history


def transitions(matrix: np.ndarray, tokens_in: np.ndarray, words_in: np.ndarray, total: float, trust: float = TRUST) -> np.ndarray:
    """log10 of what a token's count is multiplied with, by the class before it and its own.

    A word of count c has (c + ADD) / (tokens + ADD * (words + 1)) of its class; ``total`` is that
    denominator for the whole corpus.
    """
    follow = (matrix + ADD) / (matrix.sum(1, keepdims=True) + ADD * len(matrix))
    return np.log10(trust * follow / (tokens_in + ADD * (words_in + 1))[None, :] + (1 - trust) / total)


@dataclass
class Model:
    """A fitted model: the lookup, the class of each place, what a token's count is multiplied with, totals."""

    table: Lookup
    kinds: np.ndarray
    step: np.ndarray
    train: int
    words: int
    history: list[float]

    @property
    def total(self) -> float:
        """Denominator of a word's probability in the whole corpus."""
        return self.train + ADD * (self.words + 1)


def fit(vocabulary: DataFrame, rows: DataFrame, table: Lookup, bins: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> Model:
    """Classes and probabilities from a counted vocabulary and encoded rows, of which the training rows count."""
    sums = vocabulary.agg(F.sum("n_train").alias("train"), F.count_if(F.col("n_train") > 0).alias("words")).first()
    train, words = sums["train"] or 0, sums["words"]
    units = table.units(bins)
    assigned, _ = exchange(settle(count_pairs(rows, units), "pairs"), table.owned + BINS, classes, rounds)
    near = len(table.places)
    kinds, matrix, history = sweeps(rows, assigned[units], near, table.owned, classes)
    sizes = np.zeros((2, classes))
    for place, log in enumerate(table.logs):
        n = round(10**log - ADD)
        sizes[:, kinds[place]] += (n, n > 0)
    far = vocabulary.filter(~is_near(train) & (F.col("n_train") > 0))
    last = (F.crc32(F.substring("word", -3, 3)) % BINS).cast("int")
    for r in far.groupBy(last.alias("bin")).agg(F.sum("n_train").alias("n"), F.count("*").alias("v")).collect():
        sizes[:, kinds[near + r["bin"]]] += (r["n"], r["v"])
    return Model(table, kinds, transitions(matrix, sizes[0], sizes[1], train + ADD * (words + 1)), train, words, history)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    fold: int = 0,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Learned from all whole texts outside the test fold; scored are all. Null and empty texts are
    their end alone; null ids count as training rows and repeated rows each time; an empty table
    gives no rows. A word never seen in training has the count 0 in its class and in the corpus.

    The vocabulary grows with the corpus and stays in a table. Texts are read twice, to count words
    and to encode them; what follows reads the encoded rows. Near words are looked up in place; the
    others are joined by the word, which none of them makes hot, and summed up by row.
    """
    return scored(docs, id_col, text_col, folds, fold, classes, rounds)[0]


def scored(docs: DataFrame, id_col: str, text_col: str, folds: int = 10, fold: int = 0, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[DataFrame, Model]:
    """``score`` and the model that it comes from."""
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text")).withColumn(
        "train", ~held_out("id", folds, fold)
    )
    vocabulary = settle(count_words(rows), "vocabulary")
    table, bins = lookup(vocabulary, vocabulary.agg(F.sum("n_train")).first()[0] or 0)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    packed_rows = settle(_encoded(rows, shared), "encoded")
    model = fit(vocabulary, packed_rows, table, bins, classes, rounds)
    kinds, step, logs, near = model.kinds, model.step, table.logs, len(table.places)

    @F.pandas_udf("near_log double, near_known long, steps double")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for places in _places(pa.array(part, pa.binary())):
                kind = kinds[places]
                before = np.concatenate([[kinds[0]], kind[:-1]])
                found = places[places < near]
                out.append((logs[found].sum(), (logs[found] > known).sum(), step[before, kind].sum()))
            yield pd.DataFrame(out, columns=["near_log", "near_known", "steps"])

    known = float(np.log10(ADD)) + 1e-6
    near_rows = packed_rows.select("id", "row", "n_tokens", measured("ids").alias("m"))
    far = (
        packed_rows.select("row", F.explode("rare").alias("word"))
        .join(vocabulary.select("word", "n_train"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10(F.coalesce("n_train", F.lit(0)) + ADD)).alias("far_log"),
            F.count_if(F.col("n_train") > 0).alias("far_known"),
        )
    )
    sums = F.col("m.near_log") + F.coalesce("far_log", F.lit(0.0))
    found = near_rows.join(far, "row", "left").select(
        F.col("id").alias(id_col),
        held_out("id", folds, fold).alias("held_out"),
        "n_tokens",
        (F.col("m.near_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(model.train).cast("long").alias("train_tokens"),
        (sums - F.col("n_tokens") * F.lit(float(np.log10(model.total)))).alias("base_score"),
        (sums + F.col("m.steps")).alias("score"),
    )
    return found, model

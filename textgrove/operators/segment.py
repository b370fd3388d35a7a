"""Words of text that is written without spaces, by the likeliest cut under a unigram model.

The model is learned from the corpus: substrings of runs of such script are counted, and in a few
rounds all distinct runs are cut in the likeliest way and the pieces counted anew. Scores are whole
numbers, so that cuts do not depend on the order of additions.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.operators.scale import settle

#: Scripts without spaces between words: Han, kana, Thai, Lao, Khmer and Burmese letters.
UNSPACED = "฀-๿຀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿"
#: Letters of a word at most, rounds of learning, bytes of a model in an executor, counts a task holds.
LONGEST, ROUNDS, MAX_BYTES, HELD = 4, 3, 64 << 20, 1 << 18
UNIT = 1000  # a score is this many times the negative logarithm of a probability


@dataclass(frozen=True)
class Segmenter:
    """Pieces with their scores, of the letters ``letters`` (a character class of a pattern)."""

    pieces: DataFrame
    unknown: int
    letters: str
    longest: int


def best_cut(run: str, scores: dict[str, int], unknown: int, longest: int) -> list[str]:
    """The cut of least total score; of equal ones that of fewest pieces, then of the longest first piece.

    A single letter without a score has ``unknown``; longer pieces without one do not exist.
    """
    n = len(run)
    cost, pieces, step = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(n - 1, -1, -1):  # from the end, so that of equal cuts the first piece decides
        best = None
        for size in range(min(longest, n - i), 0, -1):
            score = scores.get(run[i : i + size], unknown if size == 1 else None)
            if score is not None:
                found = (score + cost[i + size], 1 + pieces[i + size])
                if best is None or found < best:
                    best, step[i] = found, size
        cost[i], pieces[i] = best
    out, at = [], 0
    while at < n:
        out.append(run[at : at + step[at]])
        at += step[at]
    return out


def _runs(df: DataFrame, text: str, letters: str) -> DataFrame:
    """``(run, n)``: the distinct runs of letters, counted in the tasks first."""
    pattern = re.compile(f"[{letters}]+")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                held.update(pattern.findall(t.as_py() or ""))
                if len(held) >= HELD:
                    yield _given(held, "run")
        yield _given(held, "run")

    parts = df.select(F.col(text).alias("text")).mapInArrow(counted, "run string, n long")
    return parts.groupBy("run").agg(F.sum("n").alias("n"))


def _given(held: Counter, name: str) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], [name, "n"])
    held.clear()
    return batch


def _pieces(runs: DataFrame, cut) -> DataFrame:
    """``(piece, n)`` of what ``cut``, made once a task, gives for each run, times the number of the run."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pieces = Counter(), cut()
        for batch in batches:
            for run, n in zip(batch.column("run").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for piece in pieces(run):
                    held[piece] += n
                if len(held) >= HELD:
                    yield _given(held, "piece")
        yield _given(held, "piece")

    return runs.select("run", "n").mapInArrow(counted, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def _scored(pieces: DataFrame, max_bytes: int) -> tuple[DataFrame, int]:
    """Scores of the most frequent pieces that fit into ``max_bytes``, and that of a letter never seen."""
    sized = pieces.withColumn("bytes", F.octet_length("piece") + 150)
    whole = sized.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    if (whole["bytes"] or 0) > max_bytes:  # by powers of two of the count, rare ones go first; letters stay
        levels = sized.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.sum("bytes").alias("bytes")).collect()
        kept, least = 0, 0
        for r in sorted(levels, key=lambda r: -r["level"]):  # 63 levels at most
            kept += r["bytes"]
            if kept > max_bytes:
                least = r["level"] + 1
                break
        pieces = pieces.filter((F.floor(F.log2("n")) >= least) | (F.length("piece") == 1))
    total = float(whole["n"] or 1)
    score = F.round((F.lit(math.log(total)) - F.log("n")) * UNIT).cast("long")
    return settle(pieces.select("piece", score.alias("score")), "pieces"), round(math.log(total + 1) * UNIT) + UNIT


def learn_segments(
    df: DataFrame, text: str = "text", letters: str = UNSPACED, longest: int = LONGEST, least: int = 2, rounds: int = ROUNDS, max_bytes: int = MAX_BYTES
) -> Segmenter:
    """A unigram model of the words in runs of ``letters`` (LNG-3, LNG-4).

    Begins with all substrings of up to ``longest`` letters that occur ``least`` times; in each round the
    runs are cut by the model and the pieces counted, of which those below ``least`` go, but for single letters.
    Texts are read once, for their distinct runs. A null text has none; without runs the model is empty.
    """
    runs = settle(_runs(df, text, letters), "runs")

    def substrings():
        return lambda run: (run[i : i + size] for i in range(len(run)) for size in range(1, min(longest, len(run) - i) + 1))

    often = (F.col("n") >= least) | (F.length("piece") == 1)
    pieces, unknown = _scored(_pieces(runs, substrings).filter(often), max_bytes)
    for _ in range(rounds):
        shared = _shared(pieces)
        pieces, unknown = _scored(_pieces(runs, lambda shared=shared, unknown=unknown: lambda run: best_cut(run, shared.value, unknown, longest)).filter(often), max_bytes)
    return Segmenter(pieces, unknown, letters, longest)


def _shared(pieces: DataFrame):
    """Scores in the executors; ``_scored`` has bounded their bytes."""
    return pieces.sparkSession.sparkContext.broadcast({r["piece"]: r["score"] for r in pieces.toLocalIterator()})


def segmented(text: Column, model: Segmenter) -> Column:
    """The words of a text in order: runs of the model's letters cut in the likeliest way, others as they are.

    Other words are runs of letters, digits and marks, as elsewhere. A null text has no words.
    """
    shared, unknown, longest = _shared(model.pieces), model.unknown, model.longest
    own = re.compile(f"[{model.letters}]+")
    word = re.compile(f"([{model.letters}]+)|[^\\W{model.letters}]+")

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                words: list[str] = []
                for found in word.finditer(t or ""):
                    words += best_cut(found[0], shared.value, unknown, longest) if own.match(found[0]) else [found[0]]
                out.append(words)
            yield pd.Series(out, dtype="object")

    return cut(text)

"""Toxicity by compression distance.

Two zstandard dictionaries, one of toxic and one of ordinary text, compress each window of a text.
What the toxic one saves over the other is the distance; a logistic curve fitted on the labelled
texts turns the distances of a text's windows into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.llm.quality_model import held_out
from textgrove.llm.words import column

#: Bytes of a window; commonest words in both dictionaries.
WINDOW, COMMON = 256, 100
#: Labelled rows of each label that are learned from at most, the characters a row of them may have,
#: and the characters that all rows of a label may have together.
ROWS, ROW_CHARS, ALL_CHARS = 2000, 1 << 16, 1 << 24
#: Shares of the ordinary windows that may reach the thresholds; these are calibrated on the fitting rows.
TAILS = (0.3, 0.1, 0.03, 0.01)
#: Lengths of the segments that may tell a side, and the least documents that hold one.
SEGMENTS, LEAST = (5, 6, 7, 8, 9, 10), 5


def windows(text: str | None, size: int = WINDOW) -> Iterator[bytes]:
    """The whole lower-cased text in windows of about ``size`` bytes, cut at white space where there is some."""
    data = (text or "").lower().encode()
    start = 0
    while start < len(data):
        stop = start + size
        if stop < len(data):
            space = data.rfind(b" ", start + size // 2, stop)
            stop = space if space > start else stop
        yield data[start:stop]
        start = stop


@lru_cache(1 << 16)
def _word_segments(word: str) -> tuple[str, ...]:
    word = f" {word} "
    return tuple({word[i : i + n] for n in SEGMENTS for i in range(len(word) - n + 1)})


def segments(text: str) -> set[str]:
    """Runs of characters inside the words of a text, the space before and after them included."""
    return set().union(*map(_word_segments, set(re.findall(r"\w+", text.lower()))))


def telling(own: Iterable[str], other: Iterable[str], most: int = 400) -> list[str]:
    """Segments that more texts of one side hold than of the other, the most telling first.

    A segment counts by the documents that hold it, so that repeats within a text do not matter. It
    is telling if its share is at least twice that of the other side and the log-likelihood ratio
    exceeds the logarithm of the number of segments looked at. Of segments that overlap in
    ``SEGMENTS[0]`` characters the most telling stays.
    """
    counts, others, n, m, looked = Counter(), Counter(), 1, 1, Counter()
    for text in own:
        looked.update(segments(text))
        n += 1
    counts = {s: k for s, k in looked.items() if k >= LEAST}
    for text in other:
        others.update(segments(text) & counts.keys())
        m += 1
    rated = []
    for segment, a in counts.items():
        b = others[segment]
        if a / n >= 2 * (b + 0.5) / m:
            share = (a + b) / (n + m)
            ratio = a * math.log(a / n / share) + (b * math.log(b / m / share) if b else 0.0)
            if ratio > math.log(len(looked)):
                rated.append((-round(ratio, 6), -len(segment), segment))
    chosen: list[str] = []
    parts: set[str] = set()
    for _, _, segment in sorted(rated):
        own_parts = {segment[i : i + SEGMENTS[0]] for i in range(len(segment) - SEGMENTS[0] + 1)}
        if len(chosen) < most and not own_parts & parts:
            chosen.append(segment)
            parts |= own_parts
    return chosen


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the two dictionaries, equally long.

    Both begin with the words that are commonest in all texts; then come the segments that tell the
    side, the most telling last, where matches are cheapest. The shorter one is filled up with
    blanks before them, so that windows of neither kind compress alike under both.
    """
    common = Counter(w for text in (*toxic, *ordinary) for w in set(text.lower().split()) if len(w) < 40)
    base = " ".join(w for w, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:COMMON][::-1]).encode()
    tails = ["".join(telling(a, b)[::-1]).encode() for a, b in ((toxic, ordinary), (ordinary, toxic))]
    size = max(map(len, tails))
    return base + b" " + tails[0].rjust(size), base + b" " + tails[1].rjust(size)


class Distances:
    """Compressors primed with the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes, thresholds: tuple[int, ...] = ()):
        self.thresholds = thresholds
        settings = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=14, chain_log=14, search_log=6, min_match=3, target_length=32,
            strategy=zstandard.STRATEGY_BTOPT, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        self.sides = []
        for content in (toxic, ordinary):
            primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(compression_params=settings)
            self.sides.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=primed))

    def saved(self, text: str | None) -> tuple[list[int], int]:
        """Bytes that the toxic dictionary saves on each window, and bytes of all of them."""
        toxic, ordinary = (side.compress for side in self.sides)
        saved, size = [], 0
        for window in windows(text):
            saved.append(len(ordinary(window)) - len(toxic(window)))
            size += len(window)
        return saved, size

    def of(self, text: str | None) -> list[float]:
        """Bytes saved by the toxic dictionary: a hundred bytes, a window, at most, shares that reach the thresholds."""
        saved, size = self.saved(text)
        values = np.array(saved or [0])
        rate = 100 * values.sum() / (size + 50)
        return [rate, values.mean(), np.log1p(max(values.max(), 0)), *[(values >= t).mean() for t in self.thresholds]]


def thresholds(distances: Distances, ordinary: list[str], tails: tuple[float, ...] = TAILS) -> tuple[int, ...]:
    """For each of ``tails`` the least saving that no larger share of the ordinary texts' windows reaches.

    Savings are whole bytes; thresholds are 1 at least, and each is above the one before.
    """
    values = np.sort([v for text in ordinary for v in distances.saved(text)[0]] or [0])
    out: list[int] = []
    for tail in tails:
        at = values[min(len(values) - 1, int(np.ceil(len(values) * (1 - tail))))]
        out.append(int(max(at + (np.mean(values >= at) > tail), out[-1] + 1 if out else 1)))
    return tuple(out)


@dataclass
class Calibration:
    """Logistic curve over the distances."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> Calibration:
    """Ridge logistic regression by Newton steps; ``weight`` says for how many rows a row stands."""
    center, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - center) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - penalty @ w
        step = np.linalg.solve((z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Calibration(center, scale, w[:-1], float(w[-1]))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 4,
    fold: int = 2,
    threshold: float = 0.3,
    rows: int = ROWS,
    row_chars: int = ROW_CHARS,
    all_chars: int = ALL_CHARS,
    seed: int = 42,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row; ``score`` is the probability of label 1.

    Learned from a bounded sample, on the driver: up to ``rows`` labelled rows of each label outside
    the test fold, whole texts of up to ``row_chars`` characters, the first by a seeded hash of the
    id, until they have ``all_chars`` together. Ids are chosen first, and as there are ``rows`` at most, they are sent to the documents. The
    curve weighs the rows by the true counts of the labels. All windows of every text of any length are
    compressed; null and empty texts have none and get the curve's value at zero. Null labels and
    ids without a document are left out. Without labels of both classes every score is the share of
    label 1, 0.5 if there is none. Null ids and repeated rows are scored each; an empty table gives
    no rows. The documents stay where they are; the dictionaries are a few kilobytes.
    """
    known = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out("id", folds, fold))
    plain = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    there = plain.filter(F.length("text") <= row_chars).select("id").distinct()
    texts = {}
    for label in (0, 1):
        ids = known.filter(F.col("label") == label).select("id").distinct().join(there, "id", "left_semi")
        chosen = ids.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(rows)
        found = plain.join(F.broadcast(chosen), "id").filter(F.length("text") <= row_chars)
        order = [F.xxhash64(F.lit(seed), "id"), "id", "text"]
        first = found.orderBy(*order).limit(rows)
        so_far = F.sum(F.length("text")).over(Window.orderBy(*order))  # over ``rows`` rows at most
        texts[label] = [r["text"] for r in first.withColumn("so_far", so_far).filter(F.col("so_far") <= all_chars).orderBy(*order).collect()]
    if not (texts[0] and texts[1]):
        total = sum(counts.values())
        score = F.lit(counts.get(1, 0) / total if total else 0.5)
    else:
        contents = dictionaries(texts[1], texts[0])
        measure = Distances(*contents)
        measure.thresholds = levels = thresholds(measure, texts[0])
        x = np.array([measure.of(t) for k in (0, 1) for t in texts[k]])
        y = np.repeat([0.0, 1.0], [len(texts[0]), len(texts[1])])
        curve = calibrate(x, y, np.repeat([counts[k] / len(texts[k]) for k in (0, 1)], [len(texts[0]), len(texts[1])]))

        @F.pandas_udf("double")
        def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            distances = Distances(*contents, levels)
            for part in batches:
                values = np.array([distances.of(t) for t in part]).reshape(len(part), len(curve.weights))
                yield pd.Series(curve.probability(values), dtype="float64")

        score = probability(F.col("text"))
    return plain.select(F.col("id").alias(id_col), held_out("id", folds, fold).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )

"""Benchmark decontamination by Wu-Manber search over words.

The alphabet is words. For each length ``m`` of test strings there is a table of blocks (the last
one or two words of a search window): how far the window may move before any test string could end
there, and for a shift of zero a bucket of the test strings that end in the block, told apart by
their first block as well and confirmed word by word.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.llm.words import column, packed
from textgrove.operators.scale import settle

#: Lower-cased UTF-8 bytes: digits, a-z and everything outside ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Bytes of benchmark text in one set of tables, which is sent to every executor.
BLOCK_BYTES = 4 << 20
RESULT = "struct<n_words:long,spans:array<struct<start:long,stop:long>>,items:array<string>>"


def _place(words: Sequence[int], mask: int) -> int:
    """Cell of a block of one or two words in a table of ``mask`` + 1 cells."""
    return (words[0] * 0x9E3779B1 + words[-1]) & mask


class _Length:
    """Wu-Manber tables of the test strings of ``m`` words, in flat arrays.

    ``shift`` has a byte for each cell of blocks; blocks that share a cell have the least of their
    shifts, which only makes the window move less. ``heads`` and ``chain`` are the buckets of the test
    strings by their last and first blocks. ``strings`` holds the words of all test strings.
    """

    def __init__(self, m: int, windows: np.ndarray, owners: np.ndarray):
        """``windows`` has a row of word numbers for each window of an item, ``owners`` its item."""
        self.m, self.block, self.wide = m, min(2, m), 4 * m
        self.most = min(m - self.block + 1, 255)
        strings, row = np.unique(windows, axis=0, return_inverse=True)
        self.strings = strings.astype(np.int32).tobytes()
        pairs = np.unique(np.stack([row.ravel(), owners], 1), axis=0)
        self.starts = array("i", np.searchsorted(pairs[:, 0], np.arange(len(strings) + 1)).tolist())
        self.owners = array("i", pairs[:, 1].tolist())
        self.mask = (1 << max(12, (4 * len(strings)).bit_length())) - 1
        shift = np.full(self.mask + 1, self.most, np.uint8)
        wide = strings.astype(np.int64)
        for end in range(self.block, m + 1):
            cell = (wide[:, end - self.block] * 0x9E3779B1 + wide[:, end - 1]) & self.mask
            np.minimum.at(shift, cell, min(m - end, 255))
        self.shift = shift.tobytes()
        heads, chain = [-1] * (self.mask + 1), []
        for k, words in enumerate(strings.tolist()):
            cell = self._bucket(words)
            chain.append(heads[cell])
            heads[cell] = k
        self.heads, self.chain = array("i", heads), array("i", chain)

    def _bucket(self, words: list[int]) -> int:
        return (_place(words[-self.block :], self.mask) * 31 + _place(words[: self.block], self.mask)) & self.mask

    def search(self, words: list[int], data: bytes) -> Iterator[tuple[int, array]]:
        """(start, items) of every occurrence; word 0 is in no test string. ``data`` holds ``words``."""
        m, block, shift, mask, n, end = self.m, self.block, self.shift, self.mask, len(words), self.m
        while end <= n:
            step = shift[(words[end - block] * 0x9E3779B1 + words[end - 1]) & mask]
            if step:
                end += step
                continue
            start = end - m
            k = self.heads[self._bucket(words[start:end])]
            while k >= 0:
                if self.strings[k * self.wide : (k + 1) * self.wide] == data[4 * start : 4 * end]:
                    yield start, self.owners[self.starts[k] : self.starts[k + 1]]
                    break
                k = self.chain[k]
            end += 1


class Searcher:
    """All test strings of a block of benchmark items: windows of ``window`` words, or whole items of fewer.

    The tables take about 100 bytes for each word of the benchmark; ``tests/llm`` holds them to 20
    times the bytes of its text.
    """

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.items = sorted({item for item, _ in items})
        place = {item: k for k, item in enumerate(self.items)}
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item, text in items:
            found = WORD.findall(text.encode().lower())
            words = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in found], np.int32)
            if m := min(window, len(words)):
                by_length.setdefault(m, []).append((np.lib.stride_tricks.sliding_window_view(words, m), place[item]))
        self.lengths = []
        for m, parts in sorted(by_length.items()):
            owners = np.concatenate([np.full(len(w), item, np.int64) for w, item in parts])
            self.lengths.append(_Length(m, np.concatenate([w for w, _ in parts]), owners))

    def find(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, disjoint spans of words inside an occurrence, items in order."""
        ids, found, items = self.ids.get, [], set()
        words = [ids(w, 0) for w in WORD.findall((text or "").encode().lower())]
        if any(words):
            data = array("i", words).tobytes()
            for table in self.lengths:
                for start, owners in table.search(words, data):
                    found.append((start, start + table.m))
                    items.update(owners)
        return len(words), merged(found), [self.items[k] for k in sorted(items)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same positions as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int, window: int) -> Iterator[list[tuple[str, str]]]:
    """Items in lists of at most ``block_bytes`` of text; a longer item is cut into parts that overlap."""
    items = benchmark.select(F.coalesce(column(item_col).cast("string"), F.lit("")).alias("i"), column(text_col).alias("t"))
    part: list[tuple[str, str]] = []
    size = 0
    step = max(window, block_bytes // 8)
    for row in items.filter("t is not null").distinct().toLocalIterator():
        texts = [row.t]
        if len(row.t.encode()) > block_bytes:
            words = WORD.findall(row.t.encode().lower())
            texts = [b" ".join(words[k : k + step + window - 1]).decode() for k in range(0, max(1, len(words) - window + 1), step)]
        for text in texts:
            if part and size + len(text.encode()) > block_bytes:
                yield part
                part, size = [], 0
            part.append((row.i, text))
            size += len(text.encode())
    if part:
        yield part


def _search(text: Column, known: Column | None, searcher) -> Column:
    """Search one block of test strings; ``known`` holds what earlier blocks found."""

    def add(t, before):
        n, spans, items = searcher.value.find(t)
        if before is not None:
            spans = merged(spans + [(s["start"], s["stop"]) for s in before["spans"]])
            items = sorted({*items, *before["items"]})
        return {"n_words": n, "spans": [{"start": a, "stop": b} for a, b in spans], "items": items}

    if known is None:

        @F.pandas_udf(RESULT)
        def first(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                yield pd.DataFrame([add(t, None) for t in texts], columns=["n_words", "spans", "items"])

        return first(text)

    @F.pandas_udf(RESULT)
    def more(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for texts, before in batches:
            rows = [add(t, b) for t, b in zip(texts, before.to_dict("records"), strict=True)]
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return more(text, known)


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` as one struct column ``_doc``, with ``n_words``, ``spans`` and ``items`` of each row.

    ``spans`` are the disjoint word ranges (start, stop) of a document that lie inside occurrences
    of test strings; ``items`` are the ids, as strings in order, of the items they belong to. A test
    string is a run of ``window`` words of an item, or all words of an item of fewer. A-Z are
    lower-cased, words are runs of digits, a-z and non-ASCII characters.

    The documents stay where they are: a narrow step over all their words, no shuffle. The
    benchmark is read in blocks of at most ``block_bytes`` of text, of which one set of tables is
    sent to the executors at a time; a benchmark of more blocks takes a pass for each, with the
    result so far written in between. Null and empty texts have no words and no hits; null texts of
    items and items without words are in no document; an item without an id is one of the id ""; repeated items and rows count as they stand; an empty
    benchmark finds nothing. Each document is searched whole.
    """
    spark = docs.sparkSession
    found: DataFrame | None = None
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes, window):
        tables = spark.sparkContext.broadcast(Searcher(items, window))
        if found is None:
            found = packed(docs, _found=_search(column(text_col), None, tables))
        else:
            text = F.col("_doc").getField(text_col)
            found = settle(found, "found").select("_doc", _search(text, F.col("_found"), tables).alias("_found"))
    if found is None:
        none = spark.sparkContext.broadcast(Searcher([], window))
        found = packed(docs, _found=_search(column(text_col), None, none))
    return found.select("_doc", "_found.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no test string occurs, with their own columns."""
    return occurrences(docs, benchmark, text_col, **options).filter(F.size("items") == 0).select("_doc.*")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Counts per document: ``n_words, n_hit, n_items, items_sha256, contaminated``."""
    rows = occurrences(docs.select(column(id_col), column(text_col)), benchmark, text_col, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return rows.select(
        F.col("_doc").getField(id_col).alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )

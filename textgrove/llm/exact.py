"""Exact duplicates by polynomial fingerprints that compose, confirmed chunk by chunk.

A text is a row of 16-bit words; its fingerprint is their polynomial at two bases, both modulo
2^31 - 1. Fingerprints of neighbouring chunks compose: that of the left one is shifted by the length
of the right one and added. So the chunks of a huge text are hashed by different tasks, and the sum
of their shifted fingerprints is the fingerprint of the whole, in whatever order they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.llm.words import column, packed, row_hash, unpacked
from textgrove.operators.scale import match, settle

#: Bytes of a chunk, an even number; a text of more is hashed and compared in chunks of this size.
#: At most 2^17, so that sums of products of 16 and 31 bits stay below 2^64.
CHUNK = 1 << 16
PRIME = (1 << 31) - 1
BASES = (1_000_003_333, 1_999_999_943)
#: Cells of the table of fingerprints that repeat, one bit each; its size does not depend on the data.
CELLS = 1 << 26


def powers(words: int) -> np.ndarray:
    """``BASES`` to the powers words - 1 .. 0, a row for each base."""
    out = np.ones((len(BASES), words), np.uint64)
    done = 1
    while done < words:  # from the right: the next powers are those done, shifted by their number
        n = min(done, words - done)
        shift = np.array([[pow(b, done, PRIME)] for b in BASES], np.uint64)
        out[:, words - done - n : words - done] = out[:, words - n :] * shift % np.uint64(PRIME)
        done += n
    return out


TABLE: dict[int, np.ndarray] = {}


def chunk_hash(data: bytes) -> tuple[int, int]:
    """Fingerprint of at most one chunk of bytes; an odd one is filled up with a zero byte."""
    if not data:
        return 0, 0
    if len(data) % 2:
        data = bytes(data) + b"\0"
    words = np.frombuffer(data, "<u2").astype(np.uint64)
    table = TABLE.get(0)
    if table is None or table.shape[1] < len(words):
        table = TABLE[0] = powers(max(len(words), CHUNK // 2))
    high, low = (table[:, table.shape[1] - len(words) :] * words).sum(1) % np.uint64(PRIME)
    return int(high), int(low)


def shifted(value: tuple[int, int], size: int) -> tuple[int, int]:
    """Fingerprint of a chunk as a part of a text that goes on for ``size`` bytes after it."""
    words = (size + 1) // 2
    high, low = (v * pow(b, words, PRIME) % PRIME for v, b in zip(value, BASES, strict=True))
    return high, low


def joined(left: tuple[int, int], right: tuple[int, int], size: int) -> tuple[int, int]:
    """Fingerprint of two neighbours, the right one of ``size`` bytes."""
    high, low = ((a + b) % PRIME for a, b in zip(shifted(left, size), right, strict=True))
    return high, low


def fingerprint(data: bytes, chunk: int = CHUNK) -> int:
    """Fingerprint of a whole text, below 2^62; texts of different lengths may share one."""
    view, value = memoryview(data), (0, 0)
    for at in range(0, len(view), chunk):
        part = view[at : at + chunk]
        value = joined(value, chunk_hash(part), len(part))
    return value[0] << 31 | value[1]


def _hashed(repeated: bytes | None = None, keep: int = -1):
    """Fingerprints of a column of bytes. With a table, null for those of which no other has the cell.

    ``keep`` is a mask that tests set to make fingerprints collide.
    """

    @F.pandas_udf("long")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cells = None if repeated is None else np.frombuffer(repeated, np.uint8)
        for texts in batches:
            values = np.array([fingerprint(t) & keep for t in texts], np.int64)
            out = pd.Series(values, dtype="Int64")
            if cells is not None:
                cell = values % CELLS
                out[(cells[cell >> 3] >> (cell & 7) & 1) == 0] = None
            yield out

    return hashes


def _shifted_parts(data: str, after: Column) -> Column:
    """Fingerprint of a chunk with ``after`` bytes behind it, as two numbers to sum up."""

    @F.pandas_udf("high long, low long")
    def parts(data: pd.Series, after: pd.Series) -> pd.DataFrame:
        both = [shifted(chunk_hash(d), a) for d, a in zip(data, after, strict=True)]
        return pd.DataFrame(both, columns=["high", "low"], dtype="int64")

    return parts(data, after)


def _chunks(data: Column, chunk: int) -> Column:
    """Array of the chunks of a column of bytes; substrings of bytes need no scan."""
    last = F.floor((F.octet_length(data) - 1) / chunk).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(data, k * chunk + 1, chunk))


def _huge(rows: DataFrame, chunk: int, keep: int) -> tuple[DataFrame, DataFrame]:
    """Chunks ``(row, k, _id, size, sha, data)`` of the texts above one chunk, and ``(row, fp)`` of each text.

    The chunks are written to the shared folder and dealt over the tasks by row and place. Rows
    have negative numbers, so that they differ from those of other texts.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.filter(F.col("size") > chunk).select(
        (-1 - F.monotonically_increasing_id()).alias("row"), "_id", "size", F.sha2("data", 256).alias("sha"), "data"
    )
    cut = settle(
        numbered.select("row", "_id", "size", "sha", F.posexplode(_chunks(F.col("data"), chunk)).alias("k", "data")).repartition(tasks, "row", "k"),
        "chunks",
    )
    after = F.greatest(F.col("size") - (F.col("k") + 1) * F.lit(chunk).cast("long"), F.lit(0))
    parts = cut.select("row", _shifted_parts("data", after).alias("part"))
    total = lambda c: F.sum(f"part.{c}") % PRIME  # noqa: E731  below 2^62: a text has no 2^31 chunks
    fp = (F.call_function("shiftleft", total("high"), F.lit(31)) + total("low")).bitwiseAND(F.lit(keep))
    return cut, settle(parts.groupBy("row").agg(fp.alias("fp")), "huge")


def _cells(groups: DataFrame) -> bytes:
    """Table of ``CELLS`` bits in which the fingerprints of ``groups`` are set: 8 MB, whatever their number."""
    block = 1 << 17
    cell = F.pmod("fp", F.lit(CELLS))

    def marked(part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(block, np.uint8)
        bits[part["cell"].to_numpy() % block] = 1
        return pd.DataFrame({"block": part["block"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    cells = groups.select(cell.alias("cell")).distinct().withColumn("block", F.floor(F.col("cell") / block).cast("long"))
    table = bytearray(CELLS // 8)
    for at, bits in cells.groupBy("block").applyInPandas(marked, "block long, bits binary").collect():
        table[at * block // 8 : (at + 1) * block // 8] = bits
    return bytes(table)


def _differing(rows: DataFrame, chunks: DataFrame, huge: DataFrame, groups: DataFrame, chunk: int, keep: int) -> DataFrame:
    """``(fp, size)`` under which there are texts that differ.

    The texts of repeated fingerprints are read again; most others stop at the table of cells. One
    text of each group is chosen by partial aggregation, and every chunk is compared with the chunk
    at the same place of that text, in a join that streams both sides; adaptive execution splits the
    side of a group that many rows share.
    """
    again = _hashed(_cells(groups), keep)
    small = (
        rows.filter(F.col("size") <= chunk)
        .select(F.lit(0).cast("long").alias("row"), F.lit(0).alias("k"), "size", "data", again("data").alias("fp"))
        .filter("fp is not null")
    )
    large = chunks.join(huge, "row").join(groups.filter(F.col("size") > chunk).select("fp", "size"), ["fp", "size"], "left_semi")
    texts = small.unionByName(large.select("row", "k", "size", "data", "fp"))
    first = settle(
        texts.groupBy("fp", "size", "k").agg(F.max(F.struct("row", "data")).alias("first"), F.count("*").alias("n")).filter("n > 1"),
        "first",
    )
    compared = texts.join(first, ["fp", "size", "k"]).filter(F.col("data") != F.col("first.data"))
    return settle(compared.select("fp", "size").distinct(), "differing")


def duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, keep: int = -1
) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` of every row; groups are rows of equal text.

    Of a group the row with the largest id stays, null ids being the smallest; ``keep_id`` is its id.
    Of several rows with that id one stays. A null text counts as an empty one, and these are equal
    to each other. Texts are compared as they are, in UTF-8, whole and of any length. Columns of
    other names play no part; an empty table gives no rows.

    Rows are grouped by fingerprint and length, and the texts of a group are compared chunk by chunk
    (``_differing``). Should a fingerprint stand for texts that differ, its rows are told apart by
    the SHA-256 of the text, which the result holds anyway. ``chunk`` is even; ``keep`` is a mask on
    fingerprints, with which tests make them collide.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    rows = docs.select(column(id_col).alias("_id"), F.octet_length(text).cast("long").alias("size"), F.encode(text, "utf-8").alias("data"))
    chunks, huge = _huge(rows, chunk, keep)
    small = rows.filter(F.col("size") <= chunk).select(
        "_id", F.monotonically_increasing_id().alias("row"), "size", F.sha2("data", 256).alias("sha"), _hashed(None, keep)("data").alias("fp")
    )
    large = chunks.filter("k = 0").join(huge, "row").select("_id", "row", "size", "sha", "fp")
    marks = settle(small.union(large), "marks")
    counted = lambda df, by: df.groupBy(*by).agg(
        F.count("*").alias("n"), F.max(F.struct("_id", "row")).alias("top")
    ).filter("n > 1")
    by = ["fp", "size"]
    groups = settle(counted(marks, by), "groups")
    differing = _differing(rows, chunks, huge, groups, chunk, keep)
    if not differing.isEmpty():
        apart = differing.withColumn("apart", F.lit(True))
        told = F.when(F.col("apart"), F.col("sha")).otherwise(F.lit(""))
        marks = settle(marks.join(apart, by, "left").withColumn("told", told).drop("apart"), "told")
        by = [*by, "told"]
        groups = settle(counted(marks, by), "groups")
    top = F.coalesce("top", F.struct("_id", "row"))
    return marks.join(groups, by, "left").select(
        F.col("_id").alias(id_col),
        top["_id"].alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (top["row"] == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one row of each text, that of the largest id; cases as in ``duplicates``.

    All columns are kept; rows that share id and text but differ elsewhere are one, of the largest hash.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    stay = duplicates(docs, id_col, text_col, chunk).filter("kept").select(column(id_col).alias("_id"), F.col("text_sha256").alias("_sha"))
    rows = packed(docs, _id=column(id_col), _sha=F.sha2(text, 256), _row=row_hash(docs))
    best = settle(rows.groupBy("_id", "_sha").agg(F.max("_row").alias("_row")), "best")
    chosen = settle(match(best, stay, ["_id", "_sha"], "left_semi"), "chosen")
    return unpacked(match(rows, chosen, ["_id", "_sha", "_row"], "left_semi").dropDuplicates(["_id", "_sha", "_row"]))

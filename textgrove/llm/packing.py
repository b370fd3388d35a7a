"""Token ids packed into rows of equal length by best-fit-decreasing.

A text is cut into token ids, ids longer than a row are split without loss, and the pieces are
packed into the fullest row that still has room. A segment tree over the capacities finds it.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type

from textgrove.llm.words import column

VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The pattern that the byte-level vocabulary was made with, and its free id.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
END = 50256
LENGTH = 2048
#: Tokens that a task holds before it packs them; packed rows made at a time.
POOL, ROWS = 1 << 22, 256


def tokenizer(path: str = VOCABULARY, pattern: str = PATTERN) -> Callable[[str], np.ndarray]:
    """Text to ids by a byte-level vocabulary file of ranks; each text is encoded whole."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
    return lambda text: encode(text).astype(np.int32)

KINDS = ("ids", "positions", "bounds", "offsets")
MANIFEST = {"part": pa.int64(), "file": pa.string(), "rows": pa.int64(), "length": pa.int64()} | {
    k: pa.int64() for k in ("segments", "tokens", "crc")
}


class Capacities:
    """Rows by free space; a segment tree finds the smallest space of at least a wanted size."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.some = [0] * (2 * self.leaves)  # rows below each node
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _count(self, space: int, change: int) -> None:
        node = space + self.leaves
        while node:
            self.some[node] += change
            node >>= 1

    def put(self, row: int, space: int) -> None:
        self.rows[space].append(row)
        self._count(space, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Row and space of the tightest row with room for ``size``, which is removed."""
        node = size + self.leaves
        while not self.some[node]:
            while node & 1:  # up to where a right sibling exists
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        space = node - self.leaves
        self._count(space, -1)
        return self.rows[space].pop(), space


def best_fit(sizes: list[int], most: int) -> list[list[int]]:
    """Positions of ``sizes`` in rows of at most ``most``, larger ones first; equal ones in order."""
    rows: list[list[int]] = []
    free = Capacities(most)
    for place in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        found = free.take(sizes[place])
        if found is None:
            rows.append([])
            found = len(rows) - 1, most
        row, space = found
        rows[row].append(place)
        if space > sizes[place]:
            free.put(row, space - sizes[place])
    return rows


class Block(NamedTuple):
    """Packed rows: matrices of ids and positions, and of each row its bounds and segments."""

    ids: np.ndarray
    positions: np.ndarray
    bounds: list[np.ndarray]
    segments: list[list[tuple]]


def blocks(pieces: list[tuple], length: int, pad: int) -> Iterator[Block]:
    """Packed rows of (id, start, ids), ``ROWS`` at a time."""
    rows = best_fit([len(p[2]) for p in pieces], length)
    for at in range(0, len(rows), ROWS):
        part = [[pieces[k] for k in row] for row in rows[at : at + ROWS]]
        ids = np.full((len(part), length), pad, np.int32)
        positions = np.zeros((len(part), length), np.int32)
        bounds = []
        for r, row in enumerate(part):
            sizes = np.fromiter((len(p[2]) for p in row), np.int32, len(row))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids[r, : ends[-1]] = np.concatenate([p[2] for p in row])
            positions[r, : ends[-1]] = np.arange(ends[-1], dtype=np.int32) - np.repeat(ends[:-1], sizes)
            bounds.append(ends)
        yield Block(ids, positions, bounds, part)


def pooled(
    batches: Iterator[pa.RecordBatch], vocabulary: str, length: int, end: int | None, pad: int, pool: int
) -> Iterator[Block]:
    """Blocks of the texts of one task, packed whenever ``pool`` ids have gathered."""
    encode = tokenizer(vocabulary)
    last = np.array([] if end is None else [end], np.int32)
    pieces: list[tuple] = []
    held = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = encode(text.as_py() or "")
            if not len(ids):
                continue
            whole = np.concatenate([ids, last])
            pieces += [(doc, start, whole[start : start + length]) for start in range(0, len(whole), length)]
            held += len(whole)
            if held >= pool:
                yield from blocks(pieces, length, pad)
                pieces, held = [], 0
    if pieces:
        yield from blocks(pieces, length, pad)


def _offsets(lengths: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    vocabulary: str = VOCABULARY,
    end: int | None = END,
    pad: int = END,
    pool: int = POOL,
) -> DataFrame:
    """Rows of ``length`` token ids.

    ``pack_id``, unique; ``input_ids``, filled up with ``pad``; ``cu_seqlens``, cumulative lengths
    of the segments from 0, so that ids from its last value on are padding; ``position_ids``, which
    start again at 0 with each segment and are 0 in the padding; ``doc_ids`` and ``starts``, of each
    segment its document and the place of its first id in that document's ids.

    Each text is followed by the id ``end`` (none if null). A document of more than ``length`` ids
    becomes full rows and one shorter segment; nothing is lost. Null and empty texts have no
    segment; null ids and repeated rows are packed like any other; an empty table has no rows.

    The texts stay where they are: each task tokenizes its input and packs it whenever ``pool``
    ids have gathered, so memory is bounded, nothing is shuffled, and a lost task repeats the same
    rows. The vocabulary file must be at the same path on every executor.
    """
    kind = docs.schema[id_col].dataType
    schema = (
        "pack_id long, input_ids array<int>, cu_seqlens array<int>, position_ids array<int>, "
        f"doc_ids array<{kind.simpleString()}>, starts array<long>"
    )
    numbers = pa.list_(pa.int32())
    out = pa.schema(
        [
            ("pack_id", pa.int64()),
            ("input_ids", numbers),
            ("cu_seqlens", numbers),
            ("position_ids", numbers),
            ("doc_ids", pa.list_(to_arrow_type(kind))),
            ("starts", pa.list_(pa.int64())),
        ]
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for block in pooled(batches, vocabulary, length, end, pad, pool):
            even = _offsets([length] * len(block.ids))
            rows = [
                pa.array(np.arange(first, first + len(block.ids))),
                pa.ListArray.from_arrays(even, pa.array(block.ids.ravel())),
                pa.ListArray.from_arrays(_offsets([len(b) for b in block.bounds]), pa.array(np.concatenate(block.bounds))),
                pa.ListArray.from_arrays(even, pa.array(block.positions.ravel())),
                pa.array([[p[0] for p in row] for row in block.segments], out.field("doc_ids").type),
                pa.array([[p[1] for p in row] for row in block.segments], pa.list_(pa.int64())),
            ]
            first += len(block.ids)
            yield pa.RecordBatch.from_arrays(rows, schema=out)

    return docs.select(column(id_col).alias("id"), column(text_col).alias("text")).mapInArrow(packed, schema)


def write_binary(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    vocabulary: str = VOCABULARY,
    end: int | None = END,
    pad: int = END,
    pool: int = POOL,
) -> DataFrame:
    """Packed rows as flat little-endian files below ``folder``; returns the manifest, which is written too.

    Each task attempt writes files of its own:

    ``*.ids``        int32, rows x ``length``
    ``*.positions``  int32, rows x ``length``, 0 where a segment begins and in the padding
    ``*.bounds``     int32, the cumulative segment lengths of all rows one after the other, from 0 in each
    ``*.offsets``    int64, rows + 1 places in ``*.bounds``

    A manifest row ``(part, file, rows, length, segments, tokens, crc)`` names the attempt that
    counts, so that a repeated or speculative task does no harm: what a lost attempt left is in no
    manifest row. ``crc`` is that of the ids. Cases as in ``pack``; a task without ids writes nothing.
    ``folder`` is a path or URI that every executor reaches; it must be new.
    """
    target = f"{folder.rstrip('/')}/data"
    docs.sparkSession._jvm.org.apache.hadoop.fs.Path(target).getFileSystem(
        docs.sparkSession._jsc.hadoopConfiguration()
    ).mkdirs(docs.sparkSession._jvm.org.apache.hadoop.fs.Path(target))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        rows = segments = tokens = crc = place = 0
        with ExitStack() as files:
            out: dict = {}
            for block in pooled(batches, vocabulary, length, end, pad, pool):
                if not out:
                    store, path = FileSystem.from_uri(target)
                    out = {k: files.enter_context(store.open_output_stream(f"{path}/{name}.{k}")) for k in KINDS}
                    out["offsets"].write(np.zeros(1, "<i8").tobytes())
                data = block.ids.astype("<i4").tobytes()
                crc = zlib.crc32(data, crc)
                out["ids"].write(data)
                out["positions"].write(block.positions.astype("<i4").tobytes())
                out["bounds"].write(np.concatenate(block.bounds).astype("<i4").tobytes())
                places = place + np.cumsum([len(b) for b in block.bounds])
                out["offsets"].write(places.astype("<i8").tobytes())
                place = int(places[-1])
                rows += len(block.ids)
                segments += sum(map(len, block.segments))
                tokens += sum(int(b[-1]) for b in block.bounds)
        if rows:
            one = (context.partitionId(), name, rows, length, segments, tokens, crc)
            yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST, one, strict=True))], schema=pa.schema(list(MANIFEST.items())))

    chosen = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kinds = "part long, file string, rows long, length long, segments long, tokens long, crc long"
    manifest = f"{folder.rstrip('/')}/manifest"
    chosen.mapInArrow(written, kinds).write.parquet(manifest)
    return docs.sparkSession.read.schema(kinds).parquet(manifest)


def read_binary(spark: SparkSession, folder: str) -> DataFrame:
    """``(part, row, input_ids, cu_seqlens, position_ids)`` of the files that the manifest names.

    Files are mapped by tasks, one for each manifest row, and given out ``ROWS`` rows at a time. A
    file of another content than its ``crc`` is an error.
    """
    target = f"{folder.rstrip('/')}/data"
    schema = "part long, row long, input_ids array<int>, cu_seqlens array<int>, position_ids array<int>"

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = FileSystem.from_uri(target)
        for one in (x for batch in batches for x in batch.to_pylist()):
            width, crc = one["length"], 0
            files = {k: store.open_input_file(f"{path}/{one['file']}.{k}") for k in KINDS}
            for at in range(0, one["rows"], ROWS):
                n = min(ROWS, one["rows"] - at)
                data = files["ids"].read(n * width * 4)
                crc = zlib.crc32(data, crc)
                places = np.frombuffer(files["offsets"].read_at((n + 1) * 8, at * 8), "<i8")
                bounds = files["bounds"].read_at(int(places[-1] - places[0]) * 4, int(places[0]) * 4)
                even = _offsets([width] * n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, one["part"])),
                        pa.array(np.arange(at, at + n)),
                        pa.ListArray.from_arrays(even, pa.array(np.frombuffer(data, "<i4"))),
                        pa.ListArray.from_arrays(pa.array((places - places[0]).astype(np.int32)), pa.array(np.frombuffer(bounds, "<i4"))),
                        pa.ListArray.from_arrays(even, pa.array(np.frombuffer(files["positions"].read(n * width * 4), "<i4"))),
                    ],
                    names=["part", "row", "input_ids", "cu_seqlens", "position_ids"],
                )
            if crc != one["crc"]:
                raise ValueError(f"{one['file']} is not what the manifest says")

    manifest = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    return manifest.repartition(spark.sparkContext.defaultParallelism, "part").mapInArrow(opened, schema)

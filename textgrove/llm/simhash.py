"""SimHash near-duplicates: fingerprints whose links are found by one-wildcard segments."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.llm.components import components
from textgrove.llm.words import column, packed, row_hash, unpacked
from textgrove.operators.scale import match, settle

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bits of a segment. 64 bits are two segments: of two or three differing bits at most one falls
#: into one of them.
SEGMENT = 32
#: A bucket of more fingerprints is not compared pair by pair.
PAIRED = 16
#: Words hashed at a time, which bounds the memory of a very long text.
BLOCK = 1 << 17


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the word shingles of a text, 0 without words."""
    words = (m.group() for m in WORD.finditer((text or "").encode().lower()))
    part = list(islice(words, BLOCK))
    counts, total = np.zeros(64, np.int64), 0
    if 0 < len(part) < shingle:
        part, shingle = [b" ".join(part)], 1
    while len(part) >= shingle:
        runs = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False)) if shingle > 1 else part
        hashes = np.array([xxhash.xxh64_intdigest(run, seed) for run in runs], np.uint64)
        counts += _bits(hashes)
        total += len(hashes)
        part = part[len(part) - shingle + 1 :] + list(islice(words, BLOCK))
    ones = np.packbits(2 * counts > total, bitorder="little")
    return int(ones.view(np.int64)[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """SimHash of a text column in Arrow batches; only the texts go to Python."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return hashed(text)


def _variants(fp: Column) -> Column:
    """The index keys of a fingerprint: segment, place of the wildcard, segment with that bit unset."""

    def key(i: Column) -> Column:
        place, high = i % SEGMENT, F.floor(i / SEGMENT).cast("long")
        segment = F.when(high == 1, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
        return i.cast("long") * F.lit(1 << 32) + segment.bitwiseAND(F.bitwise_not(bit))

    return F.transform(F.sequence(F.lit(0), F.lit(2 * SEGMENT - 1)), key)


def _ball(fp: Column) -> Column:
    """The fingerprint and the 64 that differ from it in one bit."""
    one = lambda i: fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
    return F.concat(F.array(fp), F.transform(F.sequence(F.lit(0), F.lit(63)), one))


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """Enough links ``(a, b)`` between fingerprints at ``bits`` or fewer differing bits (at most 2).

    ``distinct`` holds one row per fingerprint, ``fp``. Each is indexed under 64 variants of its
    two segments, each with one bit left open. Two fingerprints that differ in 2 bits have a
    segment in which they differ in one bit at most, so they meet under a variant; a bucket of two
    is its minimum and maximum and needs no second pass. Buckets of up to ``PAIRED`` are joined
    with themselves and verified. Those of larger buckets, where pairs would grow with the square,
    go on to an exact way that is linear: they are listed under each fingerprint at one bit or
    none; all under one such centre differ in 2 bits at most, and any two that do so share a
    centre. A chain to the smallest of the list keeps them connected. (With ``bits`` below 2 the
    centre is the fingerprint with one bit left open.) All links of small buckets are returned;
    for larger ones, enough for the same components.
    """
    if not 0 <= bits <= 2:
        raise ValueError("links are found for 0, 1 or 2 differing bits")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    keyed = distinct.select("fp", F.explode(_variants(F.col("fp"))).alias("key"))
    buckets = settle(
        keyed.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1 and (n > 2 or bit_count(a ^ b) <= 2)"),
        "buckets",
    )
    twos = buckets.filter("n = 2").filter(near).select("a", "b")
    # buckets grow with the fingerprints: joined by merging at every size, like the table they come from
    members = settle(keyed.join(buckets.filter("n > 2").select("key", "n").hint("merge"), "key"), "members")
    small = members.filter(F.col("n") <= PAIRED)
    pairs = (
        small.select("key", F.col("fp").alias("a"))
        .join(small.select("key", F.col("fp").alias("b")), "key")
        .filter(F.col("a") < F.col("b"))
        .filter(near)
        .select("a", "b")
    )
    crowd = members.filter(F.col("n") > PAIRED).select("fp").distinct()
    if bits == 2:
        centred = crowd.select("fp", F.explode(_ball(F.col("fp"))).alias("centre"))
    else:
        open_bit = F.transform(
            F.sequence(F.lit(0), F.lit(63)),
            lambda i: F.struct(
                i.alias("i"),
                F.col("fp").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("v"),
            ),
        )
        centred = crowd.filter(F.lit(bits == 1)).select("fp", F.explode(open_bit).alias("centre"))
    least = centred.groupBy("centre").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n"))
    shared = least.filter("n > 1").select("centre", "a")
    stars = centred.join(shared, "centre").select("a", F.col("fp").alias("b")).filter("a <> b")
    return twos.union(pairs).union(stars).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2
) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row; components of linked fingerprints.

    Fingerprints link at ``bits`` or fewer differing bits. ``component_id`` is the smallest id
    reachable, the row's own included. Null and empty texts have fingerprint zero and link like
    any other; texts of fewer words than a shingle are one shingle. Rows with null ids link, too,
    but give a component its id only if it has no other, which then is null. Repeated rows and
    repeated ids each give a row. Only the id and text columns are read; the id keeps its name.

    The work is on distinct fingerprints: copies meet in a map-side aggregate, and ids come back
    by a join on the fingerprint, whose hot side adaptive execution splits.
    """
    rows = settle(docs.select(column(id_col).alias("_id"), fingerprints(column(text_col), shingle).alias("fp")), "fingerprints")
    distinct = settle(rows.groupBy("fp").agg(F.min("_id").alias("least")), "distinct")
    roots = settle(components(links(distinct.select("fp"), bits)), "roots")
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    linked = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = settle(named.join(linked, "root").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select(
        F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id.

    Ids sort before nulls. Rows that share the smallest id are told apart by a hash of all their
    columns; of fully equal rows one stays. All columns are kept.

    The decisions are made on ids and hashes. The documents are then read once more and lose the rows
    of a table of those that go; only rows that are repeated in full are compared with each other.
    """
    marked = docs.select(
        row_hash(docs).alias("row"), fingerprints(column(text_col), shingle).alias("fp"), column(id_col).alias("id")
    )
    marks = settle(marked, "marks")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    rows = settle(marks.groupBy("fp").agg(F.min(order).alias("first")), "firsts")
    roots = settle(components(links(rows.select("fp"), bits)), "roots")
    named = rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    stays = settle(named.join(best, "root").select("fp", F.col("best.id").alias("_id"), F.col("best.row").alias("_row")), "stays")
    other = ~(F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")))
    gone = settle(marks.join(stays, "fp").filter(other).select(F.col("id").alias("_id"), F.col("row").alias("_row")).distinct(), "gone")
    several = marks.groupBy(F.col("id").alias("_id"), F.col("row").alias("_row")).agg(F.count("*").alias("n")).filter("n > 1")
    repeated = settle(match(several.drop("n"), gone, ["_id", "_row"], "left_anti"), "repeated")
    whole = packed(docs, _row=row_hash(docs), _id=column(id_col))
    # rows that go are a share of the documents: joined by merging at every size
    kept = match(whole, gone.union(repeated).hint("merge"), ["_id", "_row"], "left_anti")
    if not repeated.isEmpty():
        kept = kept.union(match(whole, repeated, ["_id", "_row"], "left_semi").dropDuplicates(["_id", "_row"]))
    return unpacked(kept)

"""Mixing sources to target weights by pivotal dependent rounding.

Every row of a source is wanted the same number of times, target over source size. The whole part
is taken by all; the fractions are rounded together: two rows exchange words until the copy
probability of one is 0 or 1. The words of the pair do not change, and the side is drawn so that
the expected copies of each row do not change either. Rows are dealt to groups by a hash of their
content, each group leaves one row at most undecided, and these meet in a reduction tree.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.llm.words import WORD, column, packed, row_hash, unpacked
from textgrove.operators.scale import match, running_totals, settle

WEIGHTS = (5, 2, 1)
#: Rows of a source in one group of the first level, and undecided rows in one group of the later ones.
GROUP, FAN = 1 << 12, 64
MASK = (1 << 64) - 1
#: Nearer to 0 or 1 than this, a probability is one of them.
NEAR = 1e-9
DECIDED = "p <= 0 or p >= 1"


def _draw(a: int, b: int, seed: int) -> float:
    """Repeatable number in [0, 1) for a pair of keys (the finaliser of SplitMix64)."""
    x = (a * 0x9E3779B97F4A7C15 + b + seed) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def _snapped(p: float) -> float:
    """``p`` without what rounding left beside 0 and 1."""
    return 0.0 if p < NEAR else 1.0 if p > 1 - NEAR else p


def pivot(rows: list[tuple[int, int, float]], seed: int = 42) -> list[float]:
    """Rounds the probabilities of (key, size, p) in the given order; one at most stays fractional.

    Sizes are positive. The sum of size times probability stays as it is.
    """
    out = [p for _, _, p in rows]
    held: int | None = None
    for j, (key, size, p) in enumerate(rows):
        if not 0 < p < 1:
            continue
        if held is None:
            held = j
            continue
        i, other, q = held, rows[held][1], out[held]
        up = min((1 - q) * other, p * size)  # words that the held row can win
        down = min(q * other, (1 - p) * size)  # and lose
        if _draw(rows[i][0] & MASK, key & MASK, seed) * (up + down) < down:
            full = (1 - q) * other <= p * size
            out[i], out[j] = (1.0, p - up / size) if full else (q + up / other, 0.0)
        else:
            full = q * other <= (1 - p) * size
            out[i], out[j] = (0.0, p + down / size) if full else (q - down / other, 1.0)
        out[i], out[j] = _snapped(out[i]), _snapped(out[j])
        held = next((k for k in (i, j) if 0 < out[k] < 1), None)
    return out


def _pivoted(seed: int):
    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "size"], kind="stable")
        rows = zip(group["key"].tolist(), group["size"].tolist(), group["p"].tolist(), strict=True)
        return group.assign(p=pivot(list(rows), seed))

    return reduce


def _decide(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with ``p`` 0 or 1; they have ``source, size, key, p, groups`` (groups of the source) and more."""
    done = rows.filter(f"{DECIDED} or size = 0").withColumn(
        "p", F.when(F.col("size") == 0, F.round("p")).otherwise(F.col("p"))
    )
    open_rows = rows.filter(f"not ({DECIDED} or size = 0)").withColumn("group", F.expr("pmod(key, groups)"))
    columns = rows.columns
    left = True
    while left:
        schema = open_rows.schema
        level = settle(open_rows.groupBy("source", "group").applyInPandas(_pivoted(seed), schema), "level")
        done = done.union(level.filter(DECIDED).select(columns))
        undecided = level.filter(f"not ({DECIDED})")
        last = undecided.filter("groups = 1").withColumn("p", F.round("p"))
        done = done.union(last.select(columns))
        open_rows = (
            undecided.filter("groups > 1")
            .withColumn("group", F.floor(F.col("group") / FAN).cast("long"))
            .withColumn("groups", F.ceil(F.col("groups") / FAN).cast("long"))
        )
        left = not open_rows.isEmpty()
    return done


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, share: float = 1.0) -> DataFrame:
    """``sizes`` (source, source_size) with the ``target`` words of each source.

    Sources in order of code points, null last, have the ``weights`` in turn and share ``share`` of
    all words; a target stops at ``most`` times its source's size, and the excess goes to the others
    by weight until none is above. The sources are ranked by range, not in one task: in order of
    the rate at which they fill up, a source is full if the words left for it and the later ones
    exceed what they take at that rate.
    """
    ranked = running_totals(
        sizes.withColumns({"none": F.col("source").isNull(), "one": F.lit(1)}), ["none", "source"], ["one"]
    )
    weight = F.array(*[F.lit(w) for w in weights])[(F.col("one_before") % len(weights)).cast("int")]
    filling = ranked.select("none", "source", "source_size", weight.cast("long").alias("weight")).withColumns(
        {"cap": F.col("source_size") * most, "rate": F.col("source_size") * float(most) / F.col("weight")}
    )
    placed = running_totals(filling, ["rate", "none", "source"], ["cap", "weight"])
    words = F.col("cap_total") * F.lit(share / most)
    full = F.col("rate") * (F.col("weight_total") - F.col("weight_before")) < words - F.col("cap_before")
    placed = settle(placed.withColumns({"words": words, "full": full}), "filled")
    rest = placed.agg(
        (F.first("words") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0))).alias("words"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"),
    ).first()
    rate = rest["words"] / rest["weight"] if rest["weight"] else 0.0
    return placed.select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(rate)).alias("target"),
    )


def word_count(text: Column) -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _mixed(rows: DataFrame, weights: tuple[int, ...], most: int, share: float, seed: int) -> DataFrame:
    """``(source, key, size, times, copies)`` and facts of the source, for rows ``(source, key, size)`` of a table.

    Rows that are equal in these are one row ``times`` as often, counted in the tasks first, so that
    repeats make no group larger; ``copies`` are those of all of them.
    """
    equal = settle(rows.groupBy("source", "key", "size").agg(F.count("*").alias("times")), "equal")
    sizes = equal.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("n"))
    wanted = settle(
        match(targets(sizes.select("source", "source_size"), weights, most, share), sizes.select("source", "n"), ["source"]), "targets"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)) * F.col("times")
    open_rows = match(equal, wanted, ["source"]).withColumns(
        {
            "whole": F.floor(rate).cast("long"),
            "p": rate - F.floor(rate),
            "groups": F.ceil(F.col("n") / GROUP).cast("long"),
        }
    )
    return _decide(open_rows, seed).withColumn("copies", F.col("whole") + F.col("p").cast("long"))


def _dealt(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """``rows`` with the copies of each: equal rows share theirs as evenly as whole numbers can.

    Equal rows are numbered inside each task's part of the table, behind those of the parts before.
    """
    both = match(rows, mixed, ["source", "key", "size"])
    single, several = both.filter("times = 1"), both.filter("times > 1")
    by = ["source", "key", "size"]
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = several.groupBy(*by, "part").agg(F.count("*").alias("own"))
    offsets = settle(counts.select(*by, "part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("offset")), "offsets")
    inside = F.row_number().over(Window.partitionBy(*by, "part").orderBy("place"))
    numbered = match(several.withColumn("inside", inside), offsets, [*by, "part"])
    extra = (F.col("offset") + F.col("inside") <= F.col("copies") % F.col("times")).cast("long")
    shared = numbered.withColumn("copies", F.floor(F.col("copies") / F.col("times")).cast("long") + extra)
    return single.unionByName(shared.drop("inside", "offset"))


def taken(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = 3,
    share: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """``(id, size, source_size, target, copies, taken)`` of every row.

    ``size`` is the number of words, 0 for a null or empty text; ``taken`` is copies times size, at
    most ``most`` times the size. The words taken from a source differ from its target by half of
    one document at most: the tree's last undecided row goes to the nearer side. The draws come
    from hashes of the rows, so that reruns agree, whatever the partitions. Rows of null source are
    a source of their own; null ids are ids like any other; repeated rows are rounded as one and
    share their copies evenly; rows without words are copied the nearest whole number of times. An empty table gives no rows. Only ids, sources
    and sizes are shuffled.
    """
    text, source = column(text_col), column(source_col).cast("string")
    rows = settle(
        docs.select(
            column(id_col).alias("id"),
            source.alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(F.lit(seed), column(id_col), source, text).alias("key"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "sizes",
    )
    return _dealt(rows, _mixed(rows, weights, most, share, seed)).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(
    docs: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = 3,
    share: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns and values stay as they are.

    Cases as in ``taken``. Fully equal rows share their copies.
    """
    key = row_hash(docs)
    rows = settle(
        docs.select(key.alias("key"), column(source_col).cast("string").alias("source"), word_count(column(text_col)).alias("size")),
        "sizes",
    )
    mixed = _mixed(rows, weights, most, share, seed)
    by_key = mixed.groupBy("key").agg(F.sum("copies").alias("copies"), F.sum("times").alias("times"))
    copies = settle(by_key.filter("copies > 0"), "copies")
    whole, several = packed(docs, key=key), copies.filter("times > 1")
    # as many rows as documents: joined by merging at every size
    chosen = whole.join(copies.filter("times = 1").hint("merge"), "key")
    if not several.isEmpty():
        chosen = chosen.union(whole.join(several, "key").dropDuplicates(["key"]))
    return unpacked(chosen.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies")))))

"""Chat formatting of logged conversations, in DataFrame functions only.

Logs hold a conversation again and again as it grows. Rolling hashes of its first turns tell which
conversations are the beginning of a longer one; those go, and what is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.llm.words import column
from textgrove.operators.scale import match, running_totals, settle

#: Turns of one row of the result; a longer conversation takes several rows.
PART = 1000


def turn_hashes(place: Column, role: Column, text: Column) -> list[Column]:
    """Two hashes of a turn at its place; the XOR of those up to a turn is the rolling hash there."""
    return [F.xxhash64(F.lit(k), place, role, role.isNull(), text, text.isNull()) for k in (1, 2)]


def _parts(turns: DataFrame, part: int) -> DataFrame:
    """``(conv, part, first, turns)``: turns in order, at most ``part`` in a row.

    Conversations are counted first. Those of up to ``part`` turns are collected; the turns of the
    others, which may be a large share of all, get their places by ranges instead.
    """
    turn = F.struct("turn", "role", "text")
    long_ones = settle(turns.groupBy("conv").agg(F.count("*").alias("n")).filter(F.col("n") > part).select("conv"), "long")
    if long_ones.isEmpty():
        short, split = turns, None
    else:
        short = match(turns, long_ones, ["conv"], "left_anti")
        counted = match(turns, long_ones, ["conv"], "left_semi").groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n"))
        placed = running_totals(counted, ["turn", "role", "text"], ["n"], ["conv"])
        each = placed.select(
            "conv", "turn", "role", "text", F.explode(F.sequence(F.col("n_before"), F.col("n_before") + F.col("n") - 1)).alias("place")
        )
        split = each.groupBy("conv", F.floor(F.col("place") / part).cast("long").alias("part")).agg(
            F.sort_array(F.collect_list(turn)).alias("turns")
        )
    whole = short.groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = whole.select("conv", F.lit(0).cast("long").alias("part"), "turns")
    return (whole if split is None else whole.union(split)).withColumn("first", F.col("part") * part)


def maximal(parts: DataFrame) -> DataFrame:
    """``conv`` of the conversations that are not the beginning of a longer one, one of equal ones.

    Only hashes and ids move. Copies meet in a map-side aggregate and the beginnings are distinct
    before they are joined, so that a common first turn or conversation is one row.
    """
    each = parts.select("conv", "part", F.posexplode("turns").alias("i", "t"), "first").select(
        "conv", "part", (F.col("first") + F.col("i") + 1).alias("place"), "t"
    )
    h1, h2 = turn_hashes(F.col("place"), F.col("t.role"), F.col("t.text"))
    each = each.select("conv", "part", "place", h1.alias("h1"), h2.alias("h2"))
    upto = Window.partitionBy("conv", "part").orderBy("place")
    rolling = each.select(
        "conv", "part", "place", *[F.bit_xor(h).over(upto).alias(p) for h, p in (("h1", "p1"), ("h2", "p2"))]
    )
    totals = each.groupBy("conv", "part").agg(F.bit_xor("h1").alias("o1"), F.bit_xor("h2").alias("o2"), F.max("place").alias("upto"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_parts = Window.partitionBy("conv")
    zero = F.lit(0).cast("long")
    offsets = settle(
        totals.select(
            "conv",
            "part",
            *[F.coalesce(F.bit_xor(o).over(earlier), zero).alias(f"before{k}") for k, o in ((1, "o1"), (2, "o2"))],
            *[F.bit_xor(o).over(all_parts).alias(f"whole{k}") for k, o in ((1, "o1"), (2, "o2"))],
            F.max("upto").over(all_parts).alias("n"),
        ),
        "offsets",
    )
    first = F.struct(F.col("conv").isNull().alias("none"), "conv")
    whole = (
        offsets.filter("part = 0")
        .groupBy("whole1", "whole2", "n")
        .agg(F.min(first).alias("first"))
        .select("whole1", "whole2", F.col("n").alias("place"), F.col("first.conv").alias("conv"))
    )
    beginnings = (
        match(rolling, offsets, ["conv", "part"])
        .filter(F.col("place") < F.col("n"))
        .select(
            F.col("p1").bitwiseXOR(F.col("before1")).alias("whole1"), F.col("p2").bitwiseXOR(F.col("before2")).alias("whole2"), "place"
        )
        .distinct()
    )
    return whole.join(beginnings, ["whole1", "whole2", "place"], "left_anti").select("conv", F.col("place").alias("n_turns"))


def render(turns: Column) -> Column:
    """Turns between markers; marks inside a text are broken up by a blank, so that none is forged."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    line = lambda t: F.concat(
        F.lit("<|im_start|>"), safe(F.coalesce(t["role"], F.lit("unknown"))), F.lit("\n"), safe(F.coalesce(t["text"], F.lit(""))), F.lit("<|im_end|>\n")
    )
    return F.array_join(F.transform(turns, line), "")


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part: int = PART,
) -> DataFrame:
    """``(conv_id, part, n_turns, text)``: rendered conversations that are no beginning of a longer one.

    A conversation is a beginning of another if its roles and texts, in order of the turns, are the
    first ones of the other; of equal conversations that of the smallest id stays, null last. Turns
    of one number are ordered by role and text, nulls first, and repeated rows are repeated turns.
    Rows of null id are one conversation. A null role is rendered as "unknown", a null text as an
    empty one; for comparison null and empty differ. ``n_turns`` is that of the conversation; one of
    more than ``part`` turns takes several rows, numbered from 0. An empty table gives no rows.
    """
    plain = turns.select(
        column(conv_col).alias("conv"), column(turn_col).alias("turn"), column(role_col).alias("role"), column(text_col).alias("text")
    )
    parts = settle(_parts(plain, part), "parts")
    stays = settle(maximal(parts), "maximal")
    return match(parts, stays, ["conv"]).select(
        F.col("conv").alias(conv_col), "part", "n_turns", render(F.col("turns")).alias("text")
    )

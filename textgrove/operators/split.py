"""Seeded samples and exact splits.

No operator here sorts or shuffles whole rows: the cut-off of every sample is
found on ids alone and then compared row by row (see ``scale.seeded_cuts``).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textgrove.operators.scale import match, running_totals, seeded_cuts, within


#: Classes up to this number are ranked by one task, more of them by ranges.
FEW = 10_000


def largest_remainder(
    classes: DataFrame, size: str, total: int, take: int, by: str, name: str, many: bool = False
) -> DataFrame:
    """Share out ``take`` rows over classes in proportion to their sizes.

    Each class gets the whole part of its quota; what is left goes to the
    largest fractions, smaller label first. ``many`` ranks the classes in
    ranges of a total order, with the same result.
    """
    quota = F.lit(take) * F.col(size) / F.lit(total)
    parts = classes.withColumn("_whole", F.floor(quota)).withColumn("_less", F.floor(quota) - quota)
    if many:
        named = parts.withColumns({"_named": F.col(by).isNotNull(), "_one": F.lit(1)})
        ranked = running_totals(named, ["_less", "_named", by], ["_one", "_whole"])
        order, whole = F.col("_one_before") + 1, F.col("_whole_total")
    else:
        ranked = parts
        order = F.row_number().over(Window.orderBy("_less", F.col(by).asc_nulls_first()))
        whole = F.sum("_whole").over(Window.partitionBy())
    extra = (order <= F.lit(take) - whole).cast("int")
    return ranked.withColumn(name, (F.col("_whole") + extra).cast("long")).select(*classes.columns, name)


def _wanted(counts: DataFrame, key: str, cuts: list[tuple[str, Column]]) -> DataFrame:
    """One row per stratum and cut, as ``seeded_cuts`` takes it."""
    rows = F.array(*[F.struct(F.lit(n).alias("cut"), k.cast("long").alias("k")) for n, k in cuts])
    return counts.select(key, F.inline(rows))


def _share_out(df: DataFrame, label: str, shares: dict[str, float]) -> DataFrame:
    """Rows each class gives to each named part, taken one part after the other.

    A share refers to the rows that the parts before it have left over.
    """
    classes = df.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_size"))
    facts = classes.agg(F.min("_size"), F.sum("_size"), F.count("*")).first()
    least, rest, many = facts[0], facts[1] or 0, facts[2] > FEW
    if least == 1:
        raise ValueError(f"a class of {label} has a single row and cannot be stratified")
    counts, taken, cuts = classes.withColumn("_rest", F.col("_size")), F.lit(0), []
    for name, share in shares.items():
        take = min(math.ceil(share * rest), rest)
        counts = largest_remainder(counts, "_rest", max(rest, 1), take, "_label", f"_{name}", many)
        counts = counts.withColumn("_rest", F.col("_rest") - F.col(f"_{name}"))
        taken, rest = taken + F.col(f"_{name}"), rest - take
        cuts.append((name, taken))
    return _wanted(counts, "_label", cuts)


def stratified_parts(
    df: DataFrame, id_col: str, label: str, shares: dict[str, float], rest: str, seed: int | str = 42
) -> DataFrame:
    """Tag each row with a part; every part has its exact stratified size."""
    keyed, names = df.withColumn("_label", F.col(label)), list(shares)
    cuts = seeded_cuts(keyed, _share_out(df, label, shares), names, id_col, ["_label"], seed)
    tag = reduce(
        lambda acc, name: acc.when(within(id_col, seed, name), name),
        names,
        F.when(F.lit(False), F.lit(rest)),
    ).otherwise(rest)
    return match(keyed, cuts, ["_label"], "left").withColumn("split", tag).select(*df.columns, "split")


def stratified_split(
    df: DataFrame, id_col: str, label: str, test: float = 0.1, seed: int | str = 42
) -> DataFrame:
    """Two-way stratified split (SPL-3): ``test`` has exactly ``ceil(test * n)`` rows."""
    return stratified_parts(df, id_col, label, {"test": test}, "train", seed)


def three_way_split(
    df: DataFrame, id_col: str, label: str, validation: float = 0.2, test: float = 0.1, seed: int | str = 42
) -> DataFrame:
    """Stratified train, validation and test (SPL-4, SPL-5) in one column ``split``."""
    shares = {"test": test, "validation": validation / (1 - test)}
    return stratified_parts(df, id_col, label, shares, "train", seed)


def take_seeded(
    df: DataFrame, id_col: str, n: int | None, seed: int | str = 42
) -> DataFrame:
    """First ``n`` rows of the shuffled table (SPL-6, SPL-9); ``None`` takes all."""
    if n is None:
        return df
    chosen = tag_first(df, id_col, {"_taken": n}, seed)
    return chosen.filter(F.col("_part") == "_taken").drop("_part")


def tag_first(
    df: DataFrame, id_col: str, counts: dict[str, int], seed: int | str = 42, rest: str = "rest"
) -> DataFrame:
    """Tag the first rows of the shuffled table with ``_part``, unstratified."""
    flat = df.withColumn("_all", F.lit(0))
    sizes, upto, cuts = flat.groupBy("_all").agg(F.count("*").alias("_size")), 0, []
    for name, n in counts.items():
        upto += n
        cuts.append((name, F.least(F.lit(upto), "_size")))
    cuts = seeded_cuts(flat, _wanted(sizes, "_all", cuts), list(counts), id_col, ["_all"], seed)
    tag = reduce(
        lambda acc, name: acc.when(within(id_col, seed, name), name),
        counts,
        F.when(F.lit(False), F.lit(rest)),
    ).otherwise(rest)
    return match(flat, cuts, ["_all"], "left").withColumn("_part", tag).select(*df.columns, "_part")


def carve_validation(
    df: DataFrame, id_col: str, share: float = 0.2, seed: int | str = 42, split: str = "split"
) -> DataFrame:
    """Move ``ceil(share * n)`` seeded training rows to validation (SPL-2)."""
    train = df.filter(F.col(split) == "train")
    others = df.filter(~F.col(split).eqNullSafe("train"))
    n = math.ceil(share * train.count())
    carved = tag_first(train, id_col, {"validation": n}, seed, "train")
    return carved.withColumn(split, F.col("_part")).drop("_part").unionByName(others)


def prepare_splits(
    df: DataFrame,
    id_col: str,
    label: str,
    validation: float = 0.2,
    test: float = 0.1,
    seed: int | str = 42,
    split: str = "split",
    others: str = "drop",
) -> DataFrame:
    """Train, validation and test of any table (SPL-1 to SPL-5).

    Given train and test rows stay where they are, and a missing validation
    part is carved out of train. A table without both is split afresh. Rows of
    given splits with another name or none are dropped, kept as they are or an
    error, as ``others`` says: "drop", "keep" or "error".
    """
    if others not in ("drop", "keep", "error"):
        raise ValueError(f"others is drop, keep or error, not {others}")
    if split in df.columns:
        has = df.agg(
            *[
                F.coalesce(F.bool_or(F.col(split) == s), F.lit(False)).alias(s)
                for s in ("train", "validation", "test")
            ]
        ).first()
        if has["train"] and has["test"]:
            known = F.coalesce(F.col(split).isin("train", "validation", "test"), F.lit(False))
            if others == "error" and not df.filter(~known).isEmpty():
                raise ValueError(f"{split} has rows that are not train, validation or test")
            kept = df.filter(known) if others == "drop" else df
            return kept if has["validation"] else carve_validation(kept, id_col, validation, seed, split)
        df = df.drop(split)
    return three_way_split(df, id_col, label, validation, test, seed)


def sample_splits(
    df: DataFrame, id_col: str, size: int | None, seed: int | str = 42, split: str = "split"
) -> DataFrame:
    """``size`` seeded training rows and a quarter as many test rows (SPL-6).

    Other splits stay whole.
    """
    if not size:
        return df
    return cap_splits(df, id_col, {"train": size, "test": size // 4}, seed, split)


def cap_splits(
    df: DataFrame, id_col: str, limits: dict[str, int | None], seed: int | str = 42, split: str = "split"
) -> DataFrame:
    """At most the given number of seeded rows of each named split (SPL-9)."""
    limits = {name: n for name, n in limits.items() if n is not None}
    if not limits:
        return df
    sizes = df.groupBy(F.col(split).alias("_split")).agg(F.count("*").alias("_size"))
    limit = reduce(
        lambda acc, item: acc.when(F.col("_split") == item[0], F.lit(item[1])),
        limits.items(),
        F.when(F.lit(False), F.lit(0)),
    )
    sizes = sizes.filter(F.col("_split").isin(*limits))
    wanted = _wanted(sizes, "_split", [("_kept", F.least(limit, "_size"))])
    keyed = df.withColumn("_split", F.col(split))
    cuts = seeded_cuts(keyed, wanted, ["_kept"], id_col, ["_split"], seed)
    free = ~F.coalesce(F.col(split).isin(*limits), F.lit(False))
    return (
        match(keyed, cuts, ["_split"], "left")
        .filter(free | within(id_col, seed, "_kept"))
        .select(*df.columns)
    )


def first_rows(df: DataFrame, id_col: str, k: int = 3) -> DataFrame:
    """The k rows with the smallest ids (SPL-7)."""
    return df.orderBy(id_col).limit(k)


def first_per_label(df: DataFrame, id_col: str, label: str, columns: list[str]) -> DataFrame:
    """The row with the smallest id of each label (SPL-8)."""
    row = F.min_by(F.struct(id_col, *columns), id_col).alias("_row")
    return df.groupBy(label).agg(row).select(label, "_row.*")

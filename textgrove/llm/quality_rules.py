"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at statistics of a text and votes that it is good, bad, or abstains. Expectation
maximisation over the vote patterns estimates how often each rule is right on good and on bad
texts, and a text stays if its posterior probability of being good is high enough.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.llm.words import column, packed, unpacked
from textgrove.operators.scale import settle

SPAN = 8  # words of a repeated window
LEAST = 20  # words
ROUNDS, SETTLED = 25, 1e-6
#: A word of letters and digits with marks of punctuation, but no symbols, between white space.
PLAIN = (
    r"(?<![^\x20\x09-\x0D])[\p{P}&&[^#*%&]]*+[\p{L}\p{N}][\p{L}\p{N}\p{M}\p{P}&&[^#*%&]]*+(?![^\x20\x09-\x0D])"
)

#: Votes good where the first condition holds, bad where the second does, else abstains.
RULES = {
    "length": ("n_words >= 50", "n_words < 30 and n_words > 0"),
    "word_length": ("word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    "symbols": ("50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "repeated_lines": ("n_lines > 1 and 10 * n_dup_lines <= n_lines", "2 * n_dup_lines > n_lines"),
    "repeated_words": ("100 * n_repeat_words <= 5 * n_words", "100 * n_repeat_words > 25 * n_words"),
    "variety": ("n_words between 30 and 2000 and 10 * n_distinct >= 3 * n_words", "10 * n_distinct < n_words and n_words < 5000"),
    "letters": ("100 * n_letters >= 85 * word_chars", "100 * n_letters < 70 * word_chars"),
    "plain_words": ("10 * n_plain >= 8 * n_words", "10 * n_plain < 7 * n_words"),
    "stutter": ("20 * n_stutter <= n_words", "5 * n_stutter > n_words"),
    "marks": ("20 * n_marks <= n_words", "5 * n_marks > n_words"),
    "capitals": ("100 * n_capitals <= 15 * word_chars", "100 * n_capitals > 40 * word_chars"),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``hashes``, the hashes of the words.

    Windows are compared by a 64-bit hash of their word hashes. Texts in which all windows differ
    need no more; of the others the windows are sorted, those that equal a neighbour keep their
    place, and the words they cover are counted once.
    """
    window = lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(SPAN)])
    long_enough = F.size("hashes") >= SPAN
    windows = F.when(long_enough, F.transform(F.sequence(F.lit(0), F.size("hashes") - SPAN), window))
    df = df.withColumn("windows", F.coalesce(windows, F.array().cast("array<bigint>")))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    df = df.withColumn("placed", F.when(some, placed))
    same = lambda k, v: F.coalesce(F.get("placed", k)["v"] == v, F.lit(False))
    again = F.transform("placed", lambda s, k: F.when(same(k - 1, s["v"]) | same(k + 1, s["v"]), s["i"]))
    starts = F.sort_array(F.array_compact(again))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    step = lambda c, i: F.struct(
        (i + SPAN).alias("upto"), (c["n"] + i + SPAN - F.greatest(i, c["upto"])).alias("n")
    )
    covered = F.aggregate(starts, zero, step, lambda c: c["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("windows", "placed")


def statistics(df: DataFrame, text: str) -> DataFrame:
    """Adds the counts that the rules look at; ``text`` names a column, null is an empty text."""
    df = df.withColumn("whole", F.coalesce(column(text), F.lit(""))).withColumn("words", _words(F.col("whole")))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    df = df.withColumn("lines", F.filter(F.split("whole", "\n"), has_word)).withColumn(
        "hashes", F.transform("words", lambda w: F.xxhash64(w))
    )
    df = df.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.regexp_count("whole", F.lit("[#*$%&|<>]")).cast("long"),
            "n_marks": F.regexp_count("whole", F.lit("[!?]")).cast("long"),
            "n_capitals": F.regexp_count("whole", F.lit(r"\p{Lu}")).cast("long"),
            "n_letters": F.regexp_count("whole", F.lit(r"\p{L}")).cast("long"),
            "n_plain": F.regexp_count("whole", F.lit(PLAIN)).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_stutter": F.size(
                F.filter("hashes", lambda h, i: F.coalesce(F.get("hashes", i - 1) == h, F.lit(False)))
            ).cast("long"),
            "n_distinct": F.size(F.array_distinct("hashes")).cast("long"),
        }
    ).drop("whole", "words", "lines")
    return _repeat_words(df).drop("hashes")


def votes() -> Column:
    """1 good, -1 bad, 0 abstained, one for each rule."""
    return F.array(*[F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for good, bad in RULES.values()])


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST} or 100 * n_repeat_words > 30 * n_words")


def log_odds(model: dict, pattern: Column | str = "votes") -> Column:
    """Log-odds that a text with these votes is good."""
    total = F.lit(math.log(model["good"] / (1 - model["good"])))
    for j, (on_good, on_bad) in enumerate(model["rules"]):
        vote = F.get(pattern, F.lit(j))
        right, wrong = math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)
        total = total + F.when(vote > 0, right).when(vote < 0, wrong).otherwise(0.0)
    return total


def _model(sums: list[float], rules: int, smooth: float = 1.0) -> dict:
    """Accuracies from expected counts; no rule may be worse than chance on bad against good."""
    n, good, *rest = sums
    out = []
    for j in range(rules):
        good_yes, good_no, bad_yes, bad_no = rest[4 * j : 4 * j + 4]
        on_good = (good_yes + 9 * smooth) / (good_yes + good_no + 10 * smooth)
        on_bad = (bad_no + smooth) / (bad_yes + bad_no + 2 * smooth)
        on_good = min(max(on_good, 0.5), 0.999)
        out.append((on_good, min(max(on_bad, 1 - on_good), 0.999)))
    return {"good": min(max((good + 9 * smooth) / (n + 10 * smooth), 0.05), 0.99), "rules": out}


def fit(voted: DataFrame, rounds: int = ROUNDS) -> dict:
    """Accuracies of the rules by expectation maximisation over all rows of ``votes``.

    The rows are counted by pattern first: at most 3 to the number of rules (177,147), whatever the
    size of the corpus. Each round is one aggregate over that table; its sums are the only thing
    that comes to the driver. It starts from texts without a bad vote as good, those with one as
    doubtful and those with more as bad. Without rows the model is the prior.
    """
    patterns = settle(
        voted.groupBy("votes").agg(F.count("*").cast("double").alias("n")).coalesce(1).sortWithinPartitions("votes"), "patterns"
    ).coalesce(1)
    bad_votes = F.size(F.filter("votes", lambda v: v < 0))
    weight = F.when(bad_votes == 0, 0.98).when(bad_votes == 1, 0.5).otherwise(0.05)
    model = _model([0.0] * (2 + 4 * len(RULES)), len(RULES))
    for _ in range(rounds + 1):
        rated = patterns.withColumn("q", weight)
        sums = [F.sum("n"), F.sum(F.expr("n * q"))]
        for j in range(len(RULES)):
            vote = F.get("votes", F.lit(j))
            for share in (F.expr("n * q"), F.expr("n * (1 - q)")):
                sums += [F.sum(F.when(vote > 0, share).otherwise(0.0)), F.sum(F.when(vote < 0, share).otherwise(0.0))]
        row = rated.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()
        before, model = model, _model([v or 0.0 for v in row], len(RULES))
        moved = max(abs(a - b) for x, y in zip(before["rules"], model["rules"], strict=True) for a, b in zip(x, y, strict=True))
        if moved < SETTLED:
            break
        weight = 1 / (1 + F.exp(-log_odds(model)))
    return model


def verdict(model: dict, threshold: float = 0.5) -> tuple[Column, Column]:
    """Posterior probability that a text is good, and whether it stays."""
    quality = 1 / (1 + F.exp(-log_odds(model)))
    return quality, ~base_failed() & (quality >= threshold)


def rate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Statistics, ``base_failed``, posterior ``quality`` and ``kept`` of every row.

    Null and empty texts have no words and fail; null ids and repeated rows are rated like any
    other; an empty table gives no rows. Statistics and votes are written once, without the texts.
    """
    plain = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    rated = settle(statistics(plain, "text").drop("text").withColumn("votes", votes()), "votes")
    quality, kept = verdict(fit(rated), threshold)
    return rated.select(
        F.col("id").alias(id_col), *BASE, base_failed().alias("base_failed"), kept.alias("kept"), quality.alias("quality"), "votes"
    )


def good_documents(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; cases as in ``rate``.

    The rows are written once with their votes, so that no text is measured twice.
    """
    doc = packed(docs, text=column(text_col))
    rated = settle(statistics(doc, "text").drop("text").withColumn("votes", votes()), "rated")
    _, kept = verdict(fit(rated), threshold)
    return unpacked(rated.filter(kept))

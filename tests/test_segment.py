"""Words of unspaced text against all cuts of short strings."""

import itertools
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from textgrove.operators import segment as G


def every_cut(run):
    for marks in itertools.product((False, True), repeat=max(0, len(run) - 1)):
        cut, start = [], 0
        for i, mark in enumerate(marks, 1):
            if mark:
                cut.append(run[start:i])
                start = i
        yield [*cut, run[start:]] if run else []


def plain_best(run, scores, unknown, longest):
    rated = []
    for cut in every_cut(run):
        costs = [scores.get(p, unknown if len(p) == 1 else None) if len(p) <= longest else None for p in cut]
        if None not in costs:
            rated.append((sum(costs), len(cut), [-len(p) for p in cut], cut))
    return min(rated)[-1]


def test_cuts_against_all_cuts():
    rng = random.Random(5)
    for _ in range(400):
        letters = "abcd"[: rng.randint(1, 4)]
        scores = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 4))): rng.randint(1, 9) for _ in range(12)}
        run = "".join(rng.choice(letters + "z") for _ in range(rng.randint(0, 9)))
        assert G.best_cut(run, scores, 12, 3) == plain_best(run, scores, 12, 3), (run, scores)


def plain_model(runs, longest, least, rounds):
    """The same learning on a counter of runs, in plain loops."""


    def scored(counts):
        counts = {p: n for p, n in counts.items() if n >= least or len(p) == 1}
        total = sum(counts.values())
        return {p: round((math.log(total) - math.log(n)) * G.UNIT) for p, n in counts.items()}, round(math.log(total + 1) * G.UNIT) + G.UNIT

    counts = Counter()
    for run, n in runs.items():
        for i in range(len(run)):
            for size in range(1, min(longest, len(run) - i) + 1):
                counts[run[i : i + size]] += n
    model, unknown = scored(counts)
    for _ in range(rounds):
        counts = Counter()
        for run, n in runs.items():
            for piece in plain_best(run, model, unknown, longest):
                counts[piece] += n
        model, unknown = scored(counts)
    return model, unknown


def test_learned_model(spark):
    """Words put together without spaces, beside others; nulls; the model and the cuts restated."""
    rng = random.Random(2)
    words = ["你好", "世界", "我们", "是", "学生", "天气", "很好", "今天"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = [(i, f"Hello, {t}! x_1 {texts[-1 - i]}" if i % 3 else t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "plain words only")]
    table = spark.createDataFrame(rows, "id long, text string").repartition(3)
    runs = Counter(r for _, t in rows for r in re.findall(f"[{G.UNSPACED}]+", t or ""))
    for rounds in (0, 2):
        model = G.learn_segments(table, rounds=rounds)
        plain, unknown = plain_model(runs, G.LONGEST, 2, rounds)
        assert {r["piece"]: r["score"] for r in model.pieces.collect()} == plain and model.unknown == unknown
    got = {r["id"]: r["w"] for r in table.select("id", G.segmented(F.col("text"), model).alias("w")).collect()}
    assert got[900] == got[901] == [] and got[902] == ["plain", "words", "only"]
    for i, t in rows[:30]:
        assert "".join(got[i]) == "".join(re.findall(r"\w+", t))
        if i % 3 == 0:
            assert got[i] == plain_best(t, plain, unknown, G.LONGEST)
    assert got[1][0] == "Hello" and "x_1" in got[1]
    stop = F.filter(G.segmented(F.lit("今天是天气"), model), lambda w: ~w.isin("是"))
    assert "是" not in spark.range(1).select(stop.alias("w")).first()["w"]


def test_bounded_model(spark):
    """Beyond the bytes allowed rare pieces go, letters stay, and texts are still cut without a loss."""
    rng = random.Random(3)
    texts = ["".join(chr(0x4E00 + rng.randint(0, 60)) for _ in range(rng.randint(5, 30))) for _ in range(300)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    whole = G.learn_segments(table, rounds=0)
    small = G.learn_segments(table, rounds=0, max_bytes=30000)
    letters = whole.pieces.filter(F.length("piece") == 1).count()
    assert letters <= small.pieces.count() < whole.pieces.count()
    assert all("".join(r["w"]) == r["text"] for r in table.select("text", G.segmented(F.col("text"), small).alias("w")).collect())
    assert G.learn_segments(table.limit(0)).pieces.count() == 0

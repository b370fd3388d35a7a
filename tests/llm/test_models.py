"""Classifiers and the language model: held-out accuracy, counts and probabilities."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from textgrove.llm import brown, quality_model, toxicity


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet")


@pytest.fixture(scope="module")
def more_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")


def area(rows, truth):
    pos = [r["score"] for r in rows if truth.get(r["doc_id"]) == 1]
    neg = [r["score"] for r in rows if truth.get(r["doc_id"]) == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_quality_model(more_docs, labels, odd, empty):
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality_model.classify(more_docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert area(held, truth) > 0.95
    for some in (labels, labels.limit(0), labels.filter("quality = 1")):
        scored = quality_model.classify(odd, some).collect()
        assert len(scored) == 11 and all(0 <= r["score"] <= 1 for r in scored)
    assert quality_model.classify(empty, labels).count() == 0


def test_discriminant_against_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(200, 3)) * (1, 2, 3), rng.normal(size=(300, 3)) + 1]
    model = quality_model.discriminant([200, 300], [a.sum(0) for a in x], [a.T @ a for a in x], 0.0, 0.0)
    point = np.array([[0.3, -1.0, 2.0]])
    logs = []
    for a, n in zip(x, (200, 300), strict=True):
        cov, d = np.cov(a.T, bias=True), point[0] - a.mean(0)
        logs.append(math.log(n / 500) - 0.5 * (np.linalg.slogdet(cov)[1] + d @ np.linalg.inv(cov) @ d))
    assert model.probability(point)[0] == pytest.approx(1 / (1 + math.exp(logs[0] - logs[1])))


def test_labels_of_the_test_fold_are_not_used(more_docs, labels):
    turned = labels.withColumn("quality", F.when(quality_model.held_out("doc_id", 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda some: sorted((r["doc_id"], r["score"]) for r in quality_model.classify(more_docs, some).collect())
    a, b = score(turned), score(labels)
    assert [i for i, _ in a] == [i for i, _ in b]
    assert np.allclose([s for _, s in a], [s for _, s in b])


def test_toxicity(more_docs, labels, odd, empty):
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity.classify(more_docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert area([r for r in rows if r["held_out"]], truth) > 0.75
    for some in (labels, labels.limit(0), labels.filter("toxic = 1")):
        scored = toxicity.classify(odd, some).collect()
        assert len(scored) == 11 and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.classify(empty, labels).count() == 0


def test_windows_hold_the_whole_text():
    for text in ("", "a", "word " * 500, "x" * 1000, "Ünï " * 300):
        assert b"".join(toxicity.windows(text)) == text.lower().encode()


def test_language_model_counts(docs, texts):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, t in texts.items() if not held(i) for w in brown.tokens(t))
    n, v = sum(counts.values()), len(counts)
    rows = brown.score(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = brown.tokens(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(words), sum(w in counts for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel=1e-9)
    held_rows = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held_rows) > sum(r["base_score"] for r in held_rows)


def test_toxicity_held_out(spark, sf_dir):
    """What the two dictionaries tell about rows that nothing was learned from."""
    larger = sf_dir.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    docs = spark.read.parquet(f"{larger}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity.classify(docs, labels).collect() if r["held_out"]]
    assert area(rows, truth) > 0.9


def plain_features(text, contents, levels):
    """Windows, compressed lengths and features of a text, one call after the other."""
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=14, chain_log=14, search_log=6, min_match=3, target_length=32,
        strategy=zstandard.STRATEGY_BTOPT, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    data, saved, size = (text or "").lower().encode(), [], 0
    while data:
        stop = 256
        if len(data) > 256 and b" " in data[128:256]:
            stop = 128 + data[128:256].rindex(b" ")
        window, data = data[:stop], data[stop:]
        lengths = []
        for content in contents:
            primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            lengths.append(len(zstandard.ZstdCompressor(compression_params=settings, dict_data=primed).compress(window)))
        saved.append(lengths[1] - lengths[0])
        size += len(window)
    saved = saved or [0]
    share = [sum(v >= t for v in saved) / len(saved) for t in levels]
    return [100 * sum(saved) / (size + 50), sum(saved) / len(saved), math.log1p(max(*saved, 0)), *share]


def test_toxicity_restated(more_docs, labels):
    """Scores from their definition: sample, dictionaries, windows, lengths, thresholds, curve."""
    known = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    few = sorted(known)[:120]
    known = {i: known[i] for i in few}
    table = more_docs.filter(F.col("doc_id").isin(few))
    order = [r["doc_id"] for r in table.orderBy(F.xxhash64(F.lit(42), "doc_id"), "doc_id").select("doc_id").collect()]
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    sides = [[texts[i] for i in order if known[i] == k] for k in (0, 1)]
    contents = toxicity.dictionaries(sides[1], sides[0])
    ordinary = sorted(v for t in sides[0] for v in toxicity.Distances(*contents).saved(t)[0])
    levels = []
    for tail in toxicity.TAILS:
        least = next(t for t in range(-999, 999) if sum(v >= t for v in ordinary) <= tail * len(ordinary))
        levels.append(max(1, least, levels[-1] + 1 if levels else 1))
    assert tuple(levels) == toxicity.thresholds(toxicity.Distances(*contents), sides[0])
    x = np.array([plain_features(t, contents, levels) for side in sides for t in side])
    y = np.repeat([0.0, 1.0], [len(s) for s in sides])
    curve = toxicity.calibrate(x, y, np.ones(len(y)))
    got = {r["doc_id"]: r["score"] for r in toxicity.classify(table, labels.filter(F.col("doc_id").isin(few))).collect()}
    want = curve.probability(x)
    ids = [i for k in (0, 1) for i in order if known[i] == k]
    assert [got[i] for i in ids] == pytest.approx(want.tolist(), abs=1e-6)


def test_toxicity_sample_is_bounded(more_docs, labels):
    """Rows and characters of the sample have bounds; scores stay probabilities."""
    rows = toxicity.classify(more_docs, labels, rows=30, all_chars=20000).collect()
    assert len(rows) == more_docs.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_score_restated(docs, texts):
    """The probability of each text from its definition, given the class of each word."""
    rows, model = brown.scored(docs, "doc_id", "text")
    places, near = model.table.places, len(model.table.places)
    kind = lambda w: int(model.kinds[places.get(brown.short(w), near + brown.bin_of(w))])
    learned = [brown.tokens(t) for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for words in learned for w in words)
    assert {w for w, n in counts.items() if n >= brown.EVIDENCE} | {brown.END} == set(places)  # every such word has its own class
    pairs, inside, kinds = Counter(), Counter(), Counter()
    for words in learned:
        pairs.update(zip(map(kind, [brown.END, *words]), map(kind, words), strict=False))
    for w, n in counts.items():
        inside[kind(w)] += n
        kinds[kind(w)] += 1
    left = Counter()
    for (a, _), n in pairs.items():
        left[a] += n
    total = sum(counts.values()) + 0.1 * (len(counts) + 1)
    for r in rows.collect():
        words, log = brown.tokens(texts[r["doc_id"]]), 0.0
        for v, w in zip([brown.END, *words], words, strict=False):
            a, b, n = kind(v), kind(w), counts[w] + 0.1
            follow = (pairs[a, b] + 0.1) / (left[a] + 0.1 * brown.CLASSES)
            log += math.log10(brown.TRUST * follow * n / (inside[b] + 0.1 * (kinds[b] + 1)) + (1 - brown.TRUST) * n / total)
        assert r["score"] == pytest.approx(log, rel=1e-6)
    assert model.history == sorted(model.history) or len(model.history) <= brown.SWEEPS


def test_held_out_texts_teach_nothing(docs):
    """Other held-out texts, with frequent new words: the same words, classes and probabilities."""
    text = F.when(brown.held_out("doc_id", 10, 0), F.repeat(F.lit("newword other the "), 3000)).otherwise(F.col("text"))
    _, model = brown.scored(docs, "doc_id", "text", rounds=4)
    _, other = brown.scored(docs.withColumn("text", text), "doc_id", "text", rounds=4)
    assert model.table.places == other.table.places and (model.kinds == other.kinds).all()
    assert np.allclose(model.step, other.step) and model.total == other.total


def test_long_words_have_classes(spark):
    """A frequent word of any length is a row of its own in clustering and scored as others are."""
    long = "x" * 300
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a"), F.lit(long), F.lit("b"), (F.col("id") % 3).cast("string")).alias("text"))
    rows, model = brown.scored(docs, "doc_id", "text")
    assert brown.short(long.encode()) in model.table.places and len(model.table.places) == 7
    assert all(r["n_known"] == 5 and r["score"] > r["base_score"] for r in rows.collect())


def test_far_words_are_joined(docs, monkeypatch):
    """The same scores whether words are looked up in place or joined."""
    units = lambda rows: {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in rows}
    near = units(brown.score(docs, rounds=1).collect())
    monkeypatch.setattr(brown, "NEAR", 8)
    assert units(brown.score(docs, rounds=1).collect()) == near


def test_class_probabilities_add_up():
    rng = np.random.default_rng(0)
    matrix = rng.integers(0, 50, (4, 4)).astype(float)
    inside, kinds = matrix.sum(0), np.array([5, 7, 2, 9])
    total = inside.sum() + brown.ADD * (kinds.sum() + 1)
    step = 10 ** brown.transitions(matrix, inside, kinds, total, trust=1.0)
    assert (step * (inside + brown.ADD * (kinds + 1))).sum(1) == pytest.approx(np.ones(4))


def test_moves_raise_the_likelihood():
    rng = np.random.default_rng(3)
    pairs = rng.integers(0, 5, (12, 12)).astype(float)
    pairs[:6, 6:] += 20
    kind = np.arange(12) % 3
    for unit in range(12):
        member = np.eye(3)[kind]
        matrix = member.T @ pairs @ member
        scores = []
        for c in range(3):
            other = np.eye(3)[np.where(np.arange(12) == unit, c, kind)]
            scores.append(brown.likelihood(other.T @ pairs @ other))
        to = brown.moved(matrix, int(kind[unit]), pairs[unit] @ member, member.T @ pairs[:, unit], pairs[unit, unit])
        assert scores[to] == pytest.approx(max(scores))
        kind[unit] = to
        member = np.eye(3)[kind]
        assert np.allclose(matrix, member.T @ pairs @ member)


def test_language_model_of_odd_documents(odd, empty):
    rows = brown.score(odd).collect()
    assert len(rows) == 11 and all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (1, 2, 3, 6))
    assert brown.score(empty).count() == 0

"""Decontamination, rules, mixing and packing: brute force, exact sums and round trips."""

import pickle
import random
import re
import sys
from collections import Counter, defaultdict

import pytest

from textgrove.llm import decontaminate, mixing, packing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_hits(text, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    words, hit, found = cut(text), set(), set()
    for item, t in items:
        own = cut(t)
        m = min(window, len(own))
        tests = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in tests:
                hit |= set(range(i, i + m))
                found.add(item)
    return len(words), len(hit), sorted(found)


ITEMS = [(1, "one"), (2, "Two, three"), (3, "a b c d e f g h i j k l"), (4, None), (5, "..."), (6, "c d e f g h i j k l m n"), (3, "a b c d e f g h i j k l"), (12, "x y x y x")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_occurrences(spark, odd, empty, block_bytes):
    texts = ["ONE two three", "a b c d e f g h i j k l m n o", "b c d e f g h i j k", "x y x y x y x", "", None, "nothing", "three two", "one one", "a b c d e f g h i j " * 3]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.report(docs, benchmark, block_bytes=block_bytes).collect()}
    spans = {r["_doc"]["doc_id"]: r["items"] for r in decontaminate.occurrences(docs, benchmark, block_bytes=block_bytes).collect()}
    for i, text in enumerate(texts):
        n, hit, items = plain_hits(text, [(str(k), t) for k, t in ITEMS])
        assert (got[i]["n_words"], got[i]["n_hit"], spans[i], got[i]["contaminated"]) == (n, hit, items, hit > 0), text
    nameless = spark.createDataFrame([(None, "b c d e f g h i j k")], benchmark.schema)
    got = decontaminate.report(docs, nameless, block_bytes=block_bytes).filter("contaminated")
    assert sorted((r["doc_id"], r["n_hit"], r["n_items"]) for r in got.collect()) == [(1, 10, 1), (2, 10, 1)]
    clean = decontaminate.clean_documents(odd, benchmark, block_bytes=block_bytes)
    assert clean.columns == odd.columns and clean.count() == 11
    assert decontaminate.report(odd, benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.report(empty, benchmark).count() == 0


def test_tables_are_bounded(spark):
    """Bytes of the tables for each byte of benchmark text; long items are cut without losing a window."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(20000)]
    items = [(str(k), " ".join(rng.choice(words) for _ in range(rng.choice([5, 60, 400])))) for k in range(300)]
    tables = decontaminate.Searcher(items)
    text = sum(len(t) for _, t in items)
    assert len(pickle.dumps(tables)) < 12 * text
    assert sum(sys.getsizeof(x) for t in tables.lengths for x in vars(t).values()) + sum(map(sys.getsizeof, tables.ids)) + sys.getsizeof(tables.ids) < 20 * text
    for item, t in items[:40]:
        n, spans, found = tables.find("zzz " + t + " zzz")
        assert spans == [(1, n - 1)] and item in found
    benchmark = spark.createDataFrame(items[:3] + [("long", " ".join(words[:3000]))], "item_id string, text string")
    blocks = list(decontaminate._blocks(benchmark, "item_id", "text", 4096, 10))
    assert len(blocks) > 5 and all(sum(len(t) for _, t in b) <= 2 * 4096 for b in blocks)
    whole = {tuple(words[k : k + 10]) for k in range(2991)}
    parts = {tuple(p[k : k + 10]) for b in blocks for i, t in b if i == "long" for p in [t.split()] for k in range(len(p) - 9)}
    assert parts == whole


def plain_statistics(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words)


def test_statistics(docs, texts, odd):
    for table in (docs, odd):
        want = Counter((r["doc_id"], *plain_statistics(r["text"])) for r in table.collect())
        rated = quality_rules.rate(table).collect()
        assert Counter((r["doc_id"], *[r[c] for c in quality_rules.BASE], r["base_failed"]) for r in rated) == want
        assert not any(r["kept"] and r["base_failed"] for r in rated)


def test_expectation_maximisation(spark):
    """Against the same steps in plain Python; a rule that disagrees with all others is trusted less."""
    k = len(quality_rules.RULES)
    good, bad, mixed = [1] * k, [1, 1] + [-1] * (k - 2), [1] * (k - 1) + [-1]
    table = {tuple(good): 900, tuple(bad): 60, tuple(mixed): 40}
    rows = spark.createDataFrame([(list(v),) for v, n in table.items() for _ in range(n)], "votes array<int>")
    model = quality_rules.fit(rows)
    weights = {v: {0: 0.98, 1: 0.5}.get(v.count(-1), 0.05) for v in table}
    for _ in range(quality_rules.ROUNDS + 1):
        sums = [sum(table.values()), sum(n * weights[v] for v, n in table.items())]
        for j in range(k):
            for side in (1, 0):
                for vote in (1, -1):
                    sums.append(sum(n * (weights[v] if side else 1 - weights[v]) for v, n in table.items() if v[j] == vote))
        plain = quality_rules._model(sums, k)
        odds = lambda v: plain["good"] / (1 - plain["good"]) * __import__("math").prod(
            (a / (1 - b) if x > 0 else (1 - a) / b) for x, (a, b) in zip(v, plain["rules"], strict=True) if x  # noqa: B023
        )
        weights = {v: odds(v) / (1 + odds(v)) for v in table}
    assert model["good"] == pytest.approx(plain["good"], abs=1e-3)
    assert weights[tuple(good)] > 0.9 and weights[tuple(bad)] < 0.1 and weights[tuple(mixed)] > 0.5


def test_rules_keep_clean_texts(docs, odd, empty):
    kept = quality_rules.good_documents(docs)
    rated = {r["doc_id"]: r["kept"] for r in quality_rules.rate(docs).collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, k in rated.items() if k}
    assert quality_rules.good_documents(odd).columns == odd.columns
    assert quality_rules.good_documents(empty).count() == quality_rules.rate(empty).count() == 0


def plain_targets(sizes, most=3):
    total = sum(sizes.values())
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, out = set(), {}
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_weight = sum(w for s, w in weight.items() if s not in full)
        out = {s: most * sizes[s] if s in full else (rest * weight[s] / open_weight) for s in names}
        above = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


@pytest.mark.parametrize("group", [1 << 14, 4])
def test_mix_meets_targets(spark, docs, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP", group)
    monkeypatch.setattr(mixing, "FAN", 4)
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    rows = mixing.taken(docs).collect()
    assert len(rows) == len(sources)
    sizes, took, biggest = Counter(), Counter(), Counter()
    for r in rows:
        s = sources[r["doc_id"]]
        sizes[s] += r["size"]
        took[s] += r["taken"]
        biggest[s] = max(biggest[s], r["size"])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = plain_targets(dict(sizes))
    assert {sources[r["doc_id"]]: round(r["target"], 6) for r in rows} == {s: round(t, 6) for s, t in want.items()}
    assert all(abs(took[s] - want[s]) <= biggest[s] / 2 + 1e-6 for s in want)
    again = {r["doc_id"]: r["taken"] for r in mixing.taken(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_pivot_keeps_expected_copies():
    rows = [(0, 3, 0.25), (0, 5, 0.5), (0, 2, 0.8)]
    total = [0.0, 0.0, 0.0]
    for seed in range(4000):
        out = mixing.pivot([(k + seed * 7919 + i, s, p) for i, (k, s, p) in enumerate(rows)], seed)
        assert sum(0 < p < 1 for p in out) <= 1
        assert sum(s * p for (_, s, _), p in zip(rows, out, strict=True)) == pytest.approx(4.85)
        total = [a + b for a, b in zip(total, out, strict=True)]
    assert [t / 4000 for t in total] == pytest.approx([p for _, _, p in rows], abs=0.03)


def test_mix_of_odd_documents(odd, empty, docs):
    rows = mixing.taken(odd).collect()
    assert len(rows) == 11 and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(odd).columns == odd.columns
    want = {r["doc_id"]: r["copies"] for r in mixing.taken(docs).collect()}
    mixed = mixing.mix(docs)
    got = Counter(r["doc_id"] for r in mixed.collect())
    size = Counter(r["source"] for r in docs.collect())
    assert set(got) <= set(want) and max(got.values()) <= 3 and sum(size.values()) == len(want)
    assert mixing.taken(empty).count() == mixing.mix(empty).count() == 0


@pytest.mark.parametrize(("length", "pool"), [(2048, 1 << 22), (16, 100)])
def test_packed_ids_round_trip(docs, odd, length, pool):
    for table in (docs, odd.drop("id")):
        rows = packing.pack(table, length=length, pool=pool).collect()
        assert len({r["pack_id"] for r in rows}) == len(rows)
        pieces = defaultdict(dict)
        for r in rows:
            ends = r["cu_seqlens"]
            assert len(r["input_ids"]) == len(r["position_ids"]) == length and ends[0] == 0 and ends[-1] <= length
            assert set(r["input_ids"][ends[-1] :]) <= {packing.END} and not any(r["position_ids"][ends[-1] :])
            for doc, start, a, b in zip(r["doc_ids"], r["starts"], ends, ends[1:], strict=False):
                assert r["position_ids"][a:b] == list(range(b - a))
                pieces[doc].setdefault(start, []).append(tuple(r["input_ids"][a:b]))
        encode = packing.tokenizer()
        want = defaultdict(Counter)
        for r in table.collect():
            ids = encode(r["text"] or "").tolist()
            ids = [*ids, packing.END] if ids else []
            for start in range(0, len(ids), length):
                want[r["doc_id"]][(start, tuple(ids[start : start + length]))] += 1
        assert {d: Counter((s, p) for s, ps in parts.items() for p in ps) for d, parts in pieces.items()} == {d: c for d, c in want.items() if c}


def test_tokenizer_agrees_with_library(texts):
    import base64

    import tiktoken

    with open(packing.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("plain", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = packing.tokenizer()
    odd = ["", " ", "  ", " a", "a ", "a  b", "a\n b \n\n c", "\n", "x\t y", "don't we'll", "中文 ünï", "a \n b", "e f  g"]
    for text in [*texts.values(), *odd]:
        assert encode(text).tolist() == library.encode_ordinary(text), repr(text[:50])


def test_best_fit_takes_the_tightest_row():
    assert packing.best_fit([5, 4, 3, 2, 2], 8) == [[0, 2], [1, 3, 4]]
    assert packing.best_fit([], 8) == [] and packing.best_fit([8, 8], 8) == [[0], [1]]
    free = packing.Capacities(10)
    for row, space in enumerate((3, 7, 7, 10)):
        free.put(row, space)
    assert [free.take(4)[1], free.take(1)[1], free.take(8)[1], free.take(7)[1], free.take(1)] == [7, 3, 10, 7, None]


def test_empty_table(empty):
    assert packing.pack(empty).count() == 0

"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from textgrove.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    totals = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            mark = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if mark % 31 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            totals[run] += 1
    return {w: n for w, n in totals.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words, times=10):
    by_size, out = {}, {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    form = {}
    for w, n in words.items():
        near = [v for size in (-1, 0, 1) for v in by_size.get(len(w) + size, ()) if v != w and one_edit(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if near and words[best] >= times * n else None
        out[w] = [form[w], None, n, len(near), words[form[w]] if form[w] else None]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


FIELDS = ("form", "root", "n", "n_near", "form_n")


def found(rows):
    rows = rows.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[f] for f in FIELDS) for r in rows}


def test_documents(spark, docs, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    words = plain_words(rows)
    # all pairs by their deletions, which words at one edit share
    index = {}
    for w in words:
        for v in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            index.setdefault(v, set()).add(w)
    near = {(a, b) for ws in index.values() for a in ws for b in ws if a < b and one_edit(a, b)}
    got = found(queries.QUERIES["op13_spelling"](spark, sf_dir))
    assert near and got.keys() == words.keys()
    counts = Counter(w for pair in near for w in pair)
    assert {w: (r[2], r[3]) for w, r in got.items()} == {w: (n, counts[w]) for w, n in words.items()}
    few = set(random.Random(1).sample(sorted(words), 60)) | set(sorted({w for p in near for w in p})[:60])
    plain = {w: min((v for p in near if w in p for v in p if v != w), key=lambda v: (-words[v], v), default=None) for w in few}
    for w, best in plain.items():
        assert got[w][0] == (best if best and words[best] >= 10 * words[w] else None)


@pytest.mark.parametrize("block", [spelling.BLOCK, 8])
def test_variants(spark, block):
    """Small alphabets, so that groups are crowded and edits lie in runs; chains of forms; ties."""
    rng = random.Random(block)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 10))) for _ in range(500)}
    words |= {"".join(rng.choice("éÿàz") for _ in range(rng.randint(1, 8))) for _ in range(200)}
    words |= {"hotword" + c for c in "abcdefghijklmnopqrstuvwxyz"} | {"hotword"} | {"x" * 3000, "x" * 3001, "x" * 2999 + "y"}
    counts = {w: rng.choice([2, 3, 20, 35, 200, 2500]) for w in sorted(words)}
    table = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long").repartition(7)
    assert found(spelling.variants(table, block=block)) == plain_variants(counts)


def test_tiles_of_one_group():
    words = ["abcdefg", "abcdefgh", "bcdefgh", "abcdxfg", "abcdefgi"]
    pairs = set()
    for most in range(7, 10):
        for segment in range(4):
            n = len(words)
            of = lambda v: np.full(n, v)  # noqa: B023, E731
            i, k = spelling.near_pairs(words, of(1), of(0), of(False), of(most), of(segment), 4)
            new = {(words[a], words[b]) for a, b in zip(i, k, strict=True)}
            assert not new & pairs  # each pair under one length and segment
            pairs |= new
    assert pairs == {(a, b) for x, a in enumerate(words) for b in words[x + 1 :] if one_edit(a, b)}


def test_odd_documents(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert found(spelling.spelling_variants(odd)) == plain_variants(plain_words(rows))
    assert spelling.spelling_variants(empty).count() == 0
    made = [(k, "Misprint misprint MISPRINT Straßen straßen ÉTAGES étages×÷ " * 3 + "Ärztinnen " * (k % 2)) for k in range(400)] + [(None, "misprint")]
    table = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    got = found(spelling.spelling_variants(table))
    assert got == plain_variants(plain_words(made)) and any(r[0] == "misprint" for r in got.values())

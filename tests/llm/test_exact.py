"""Exact duplicates: fingerprints against their definition, groups against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

from textgrove.llm import exact


def plain_hash(data):
    data = data + b"\0" * (len(data) % 2)
    values = []
    for base in exact.BASES:
        value = 0
        for at in range(0, len(data), 2):
            value = (value * base + int.from_bytes(data[at : at + 2], "little")) % exact.PRIME
        values.append(value)
    return values[0] << 31 | values[1]


def test_fingerprints_compose():
    rng = random.Random(3)
    for size in (0, 1, 2, 3, 7, 64, 129, 1000):
        data = rng.randbytes(size)
        assert {exact.fingerprint(data, chunk) for chunk in (2, 6, 64, 1 << 16)} == {plain_hash(data)}
        for cut in range(0, size, 2):  # in any order: the sum of the shifted parts
            left, right = data[:cut], data[cut:]
            both = exact.joined(exact.chunk_hash(left), exact.chunk_hash(right), len(right))
            assert both[0] << 31 | both[1] == plain_hash(data)
    data = b"\xff" * exact.CHUNK  # the largest sums
    assert exact.fingerprint(data) == plain_hash(data)


def plain_groups(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = []
    for text, keys in groups.items():
        top = max(keys, key=lambda k: (k is not None, k or 0))
        stays = True
        for key in sorted(keys, key=lambda k: (k is None, -(k or 0))):
            out.append((key, top, len(keys), stays, hashlib.sha256(text.encode()).hexdigest()))
            stays = False
    return out


def order(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(("chunk", "keep"), [(exact.CHUNK, -1), (16, -1), (1 << 10, 3), (4, 0)])
def test_groups(spark, docs, odd, empty, chunk, keep):
    """Also with texts of many chunks and with fingerprints of two bits or none, so that texts collide."""
    rng = random.Random(chunk)
    made = ["ab" * n for n in (0, 1, 7, 8, 9, 40)] + ["ab" * 8 + "x", "ba" * 8, "ü" * 8, "ab" * 20 + "c" + "ab" * 19, "\0", "\0\0"]
    rows = [(rng.choice([None, *range(9)]), rng.choice([None, *made])) for _ in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert order(exact.duplicates(table, chunk=chunk, keep=keep).collect()) == order(plain_groups(rows))
    if chunk >= 1 << 10:
        for table in (odd, docs):
            rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
            assert order(exact.duplicates(table, chunk=chunk, keep=keep).collect()) == order(plain_groups(rows))
    assert exact.duplicates(empty, chunk=chunk, keep=keep).count() == 0


def test_one_of_each(odd, empty):
    stay = exact.one_of_each(odd)
    assert stay.columns == odd.columns and exact.one_of_each(empty).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = sorted((repr(k), s) for k, _, _, kept, s in plain_groups(rows) if kept)
    assert sorted((repr(r["doc_id"]), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in stay.collect()) == want


def test_one_group_of_many_rows(spark):
    """A third of all rows are one text of several chunks."""
    rows = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('same', 50), cast(id as string)) as text")
    got = exact.duplicates(rows, chunk=64).filter("group_size > 1").collect()
    assert len(got) == 1000 and {(r["keep_id"], r["group_size"]) for r in got} == {(2997, 1000)} and sum(r["kept"] for r in got) == 1

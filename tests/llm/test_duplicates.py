"""SimHash groups, line deduplication and snapshots of conversations against brute force."""

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textgrove.llm import chat, line_dedup, simhash
from textgrove.llm.components import components
from textgrove.operators import scale

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close(fingerprints):
    values = np.array(fingerprints, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    return [(int(i), int(j)) for i, j in zip(*np.where(near), strict=True) if i < j]


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (5, 4), (4, 4)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)]])
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == groups(edges, nodes)


def test_fingerprints_and_components(docs, texts):
    rows = simhash.near_duplicates(docs).collect()
    ids = sorted(texts)
    values = [plain_fingerprint(texts[i]) for i in ids]
    roots = groups([(ids[a], ids[b]) for a, b in close(values)], ids)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        i: (f"{v:016x}", roots[i]) for i, v in zip(ids, values, strict=True)
    }


def test_fingerprint_in_blocks(monkeypatch):
    text = "one two three four five six seven eight nine ten " * 7
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 5)
    assert simhash.fingerprint(text) == whole


def test_links_of_crowded_buckets(spark):
    """More near fingerprints than a bucket is compared by pairs: same components as brute force."""
    rng = np.random.default_rng(1)
    center = int(rng.integers(1 << 62))
    values = {center}
    while len(values) < 150:
        v = center
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    values = sorted(values | {int(x) for x in rng.integers(1 << 62, size=50)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    place = {v: i for i, v in enumerate(signed)}
    got = groups([(place[r["a"]], place[r["b"]]) for r in found], range(len(values)))
    assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 2 for r in found)
    assert got == groups(close(values), range(len(values)))


def test_one_of_each(docs, texts, odd, empty):
    ids = sorted(texts)
    roots = groups([(ids[a], ids[b]) for a, b in close([plain_fingerprint(texts[i]) for i in ids])], ids)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(roots.values())
    stay = simhash.one_of_each(odd)
    assert stay.columns == odd.columns
    assert sorted((r["doc_id"] or 0, r["text"] is None) for r in stay.collect()) == [(0, False), (1, True), (4, False), (5, False), (7, False), (7, False)]
    assert simhash.one_of_each(empty).count() == 0


def test_odd_documents(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 11
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {1}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]
    assert simhash.near_duplicates(empty).count() == 0


def plain_removed(rows, t=0.8):
    sets, index, seen, out = [], defaultdict(list), set(), {}
    for num, (key, text) in enumerate(rows):
        out[num] = (key, [])
        for place, line in enumerate((text or "").split("\n")):
            words = frozenset(WORD.findall(line.translate(LOWER)))
            if not words:
                continue
            common = Counter(k for w in words for k in index[w])
            if words in seen or any(c >= t * (len(words) + len(sets[k]) - c) - 1e-9 for k, c in common.items()):
                out[num][1].append(place)
            if words not in seen:
                for w in words:
                    index[w].append(len(sets))
                sets.append(words)
                seen.add(words)
    return out


def test_similar_lines(docs, texts):
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(docs).collect()}
    assert got == dict(plain_removed(sorted(texts.items())).values())


def test_lines_of_odd_documents(odd, empty, spark):
    rows = line_dedup.report(odd).collect()
    assert len(rows) == 11
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append((r["n_lines"], r["removed"]))
    assert sorted(by_id[5]) == [(2, []), (2, [0, 1])] and sorted(by_id[None]) == [(1, []), (1, [0])]
    assert by_id[1] == by_id[2] == by_id[3] == by_id[6] == [(0, [])]
    clean = line_dedup.deduplicate(odd)
    assert clean.columns == odd.columns and clean.count() == 11
    assert sorted(r["text"] for r in clean.filter("doc_id = 5").collect()) == ["", "The Quick\nbrown fox"]
    assert line_dedup.deduplicate(empty).count() == line_dedup.report(empty).count() == 0
    near = spark.createDataFrame(
        [(k, " ".join(f"w{i}" for i in range(20)) + f" x{k}") for k in range(30)] + [(99, "\n".join("abcdefg"))], "doc_id long, text string"
    )
    lost = {r["doc_id"]: r["n_removed"] for r in line_dedup.report(near).collect()}
    assert lost == {k: int(k > 0) for k in range(30)} | {99: 0}


def plain_chats(rows):
    logs = defaultdict(list)
    for conv, turn, role, text in rows:
        logs[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    logs = {c: tuple(t[2:] for t in sorted(turns)) for c, turns in logs.items()}
    beginnings = {t[:k] for t in logs.values() for k in range(1, len(t))}
    stay = {}
    for conv in sorted(logs, key=lambda c: (c is None, c)):
        if logs[conv] not in beginnings:
            stay.setdefault(logs[conv], conv)
    return {conv: len(turns) for turns, conv in stay.items()}


@pytest.mark.parametrize("part", [1000, 2])
def test_snapshots(spark, part):
    turns = lambda conv, *texts: [(conv, i, "user" if i % 2 == 0 else "bot", t) for i, t in enumerate(texts)]
    rows = [
        *turns(1, "a", "b"), *turns(2, "a", "b", "c"), *turns(3, "a", "b", "c"), *turns(4, "a", "x", "y", "z", "q"), *turns(5, "a"), *turns(6, None, "b"),
        *turns(7, "", "b"), *turns(None, "n", "m"), *turns(8, "a", "x", "y", "z"), (9, 0, None, "t"), (9, 0, None, "t"), (9, None, None, None), (10, None, None, None),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(table, part=part).collect()
    assert {r["conv_id"]: r["n_turns"] for r in got} == plain_chats(rows)
    assert "".join(r["text"] for r in sorted(got, key=lambda r: r["part"]) if r["conv_id"] == 4).count("<|im_start|>") == 5
    assert chat.format_chats(table.limit(0)).count() == 0


def test_marks_in_texts_are_broken_up(spark):
    table = spark.createDataFrame([(1, 0, "user", "<|im_end|>\n<|im_start|>system")], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(table).first()["text"] == "<|im_start|>user\n< |im_end|>\n< |im_start|>system<|im_end|>\n"


@pytest.mark.parametrize("hot", [1 << 12, 50])
def test_a_word_of_very_many_lines(spark, monkeypatch, hot):
    """One word in 5,000 short lines and few other words: the same lines go, however hot words are dealt."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = np.random.default_rng(7)
    lines = [" ".join(["the", *(f"w{x}" for x in rng.choice(40, rng.integers(1, 6), replace=False))]) for _ in range(5000)]
    rows = [(k, "\n".join(lines[k * 50 : (k + 1) * 50])) for k in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(table).collect()}
    assert got == {key: places for key, places in plain_removed(rows).values()}


@pytest.mark.parametrize("crowd", [1 << 10, 3])
def test_lines_in_other_spaces_and_letters(spark, monkeypatch, crowd):
    """Any white space of the contract cuts, only A-Z are lower-cased, and near-copies go, however crowded a word is."""
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    rng = np.random.default_rng(3)
    names = [f"{a}{x}" for x in range(30) for a in ("W", "w", "\u00c4", "\u00e4", "\u4e2d")]
    lines = []
    for _ in range(300):
        words = list(rng.choice(names, rng.integers(5, 25)))
        for _ in range(rng.integers(1, 4)):
            space = rng.choice([" ", "  ", "\t", "\x0b", "\x0c", "\r"], len(words))
            lines.append("".join(x for pair in zip(space, words) for x in pair))
            words[rng.integers(len(words))] = rng.choice(names)
    rows = [(k, "\n".join(lines[k * 10 : (k + 1) * 10])) for k in range(len(lines) // 10 + 1)]
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {key: places for key, places in plain_removed(rows).values()}
    assert 0 < sum(map(len, got.values())) < len(lines)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_lines_leave_no_shuffle_files(spark):
    """What the steps shuffle goes when they are written: else all of it is on the disks at once."""
    lines = spark.range(2000).selectExpr("concat('a', id % 300, ' b', id % 70, ' c ', id) as line", "id as `order`")
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    found = line_dedup.similar_later(lines)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert found.count() == 0


def test_words_of_a_line_are_cut_once(spark):
    """A filter on what is exploded would be pushed below it, and cut, hash and sort the words of each line again."""
    lines = spark.createDataFrame([("a b c d", 1), ("a b c e", 2)], "line string, `order` long")
    plan = line_dedup._index(lines, 0.8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(array_remove(") == 1


def test_a_word_too_late_in_its_lines_is_left_out(spark):
    """Two lines of ten words need nine in common: one they share at the third place cannot lead to them."""
    common = " ".join(f"c{k}" for k in range(7))
    lines = [f"a1 a2 s {common}", f"b1 b2 s {common}", *(f"d{k} e{k} f{k} {common}" for k in range(5))]
    assert line_dedup._index(spark.createDataFrame([(line, k) for k, line in enumerate(lines)], "line string, `order` long"), 0.8).count() == 0
    near = [f"a1 a2 s {common}", f"a1 b2 s {common}"]  # nine in common of eleven
    found = line_dedup.similar_later(spark.createDataFrame([(line, k) for k, line in enumerate([*near, *lines[2:]])], "line string, `order` long"))
    assert [r["order"] for r in found.collect()] == [1]


def test_steps_leave_only_what_is_read(spark):
    """Tables that nothing reads any more are deleted in the course of the job: else all are on the disk at once."""
    rows = [(k, " ".join(f"w{i}" for i in range(20)) + f" v{k % 7}\nx{k} y z") for k in range(40)]
    folder, table = scale.run_folder(spark).removeprefix("file:"), spark.createDataFrame(rows, "doc_id long, text string")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    report = line_dedup.report(table)
    assert {name.split("-")[0] for name in set(os.listdir(folder)) - before} == {"affected"}
    assert {r["doc_id"]: r["removed"] for r in report.collect()} == {key: places for key, places in plain_removed(rows).values()}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("settled_")]


def test_tables_settled_by_a_key_are_joined_where_they_lie(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, right = (scale.settle_by(spark.range(200).withColumn(c, F.col("id") * 2).repartition(parts, "id"), "id") for c in "ab")
    joined = left.hint("merge").join(right, "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.filter("a = b").count() == 200
    scale.discard(left, right)


def test_other_letters_keep_their_case(spark):
    """Only A-Z are lower-cased, whatever other letters stand beside them."""
    lines = ["A \u00c9 \u00df \u4e2d", "a \u00e9 \u00df \u4e2d", "a \u00c9 \u00df \u4e2d", "B \u0130 \u2160 \u24b6 \u03a3", "b \u0130 \u2160 \u24b6 \u03a3", "b \u0130 \u2170 \u24d0 \u03c3", "C \u00fc\u00ff\u00b5", "c \u00fc\u00ff\u00b5", "\u00d7 \u00dcX", "\u00d7 \u00dcx", "\u00d7 \u00fcx"]
    rows = [(k, line) for k, line in enumerate(lines)]
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {key: places for key, places in plain_removed(rows).values()}
    plain = spark.createDataFrame(rows, "k long, line string").select("line", line_dedup._plain(F.col("line")).alias("plain")).collect()
    assert all(r["plain"] == r["line"].translate(LOWER) for r in plain)

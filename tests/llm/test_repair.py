"""Repair of conversations: cheapest edits and the whole report against brute force."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textgrove.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
ROWS = "user assistant system other".split()


def plain_edits(rows):
    """Cheapest (cost, audit, kept) by a search over all edits; rows are (role, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, initials, out = heapq.heappop(heap)
        tail = initials if len(initials) < 2 else initials[-1] + "+"  # what decides how it may go on
        if (at, tail) in done:
            continue
        done.add((at, tail))
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, out
        for new in ("user", "assistant"):
            if re.fullmatch("s?(ua)*u?", initials + new[0]):
                heapq.heappush(heap, (cost + 5, audit + "I", at, initials + new[0], (*out, (new, None))))
        if at < len(rows):
            role, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, initials, out))
            if fault in (None, "truncated"):
                late = 5 if fault else 0
                for new, edit, price in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                    if re.fullmatch("s?(ua)*u?", initials + new[:1]) and new[:1]:
                        heapq.heappush(heap, (cost + price + late, audit + edit, at + 1, initials + new[:1], (*out, (new, at))))


def every_edit(rows):
    """The same by trying all edits of each row, with up to two insertions anywhere."""
    gaps = [g for n in range(3) for g in itertools.product("ua", repeat=n)]
    options = []
    for role, fault in rows:
        options.append([("D", "", 2)])
        if fault in (None, "truncated"):
            late = 5 if fault else 0
            options[-1] += [("K", role[0], late), ("R", "u", 1 + late), ("R", "a", 1 + late)]
    best = (99, "")
    for edits in itertools.product(*options):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(e[2] for e in edits) + 5 * sum(map(len, inserts))
            if cost > best[0]:
                continue
            initials = "".join(inserts[0]) + "".join(e[1] + "".join(g) for e, g in zip(edits, inserts[1:], strict=True))
            if re.fullmatch("(s?(ua)+)?", initials):
                best = min(best, (cost, "I" * len(inserts[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, inserts[1:], strict=True))))
    return best


def letter(role, fault):
    return "x" if fault == "gone" else role[0].upper() if fault else role[0]


def solved(words):
    return {w: (cost, audit) for w, cost, audit in repair.solutions(iter(sorted(set(words), key=lambda w: w[::-1])))}


def test_edits_against_all_edits():
    kinds = [(r, f) for r in ROWS for f in (None, "truncated")] + [("user", "gone")]
    cases = [rows for n in range(3) for rows in itertools.product(kinds, repeat=n)]
    rng = random.Random(1)
    cases += [tuple(rng.choice(kinds) for _ in range(3)) for _ in range(25)]
    found = solved(["".join(letter(*r) for r in rows) for rows in cases])
    for rows in cases:
        assert found["".join(letter(*r) for r in rows)] == every_edit(rows) == plain_edits(rows)[:2], rows


def test_long_words_share_their_ends():
    rng = random.Random(2)
    kinds = [(r, f) for r in ROWS for f in (None, None, "truncated")] + [("user", "gone")]
    cases = [[rng.choice(kinds) for _ in range(rng.randint(0, 14))] for _ in range(400)]
    repair.before.cache_clear()
    found = solved(["".join(letter(*r) for r in rows) for rows in cases])
    for rows in cases:
        assert found["".join(letter(*r) for r in rows)] == plain_edits(rows)[:2], rows
    known = repair.before.cache_info().misses
    solved(["ua" * 20000 + "oUxsA" * 2000])
    assert known < 2000 and repair.before.cache_info().misses < 2 * known  # nodes are few, however long the words


def plain_report(table):
    """All columns of the query from ``(conv_id, turn, role, text)``."""
    space = lambda v: " " if v is None else str(v)
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        fault, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, kept = plain_edits([(r[1], f) for r, f in zip(rows, faults, strict=True)])
        text = "\n".join(f"{role}:{'' if at is None else rows[at][2]}" for role, at in kept)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), kept, rows
    return out


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(table):
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    wanted = plain_report(rows)
    damaged = repair.damaged(table)
    got = repair.report(damaged, copies=F.col("copies")).collect()
    assert len(got) == len(wanted)
    assert {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in got} == {c: w[0] for c, w in wanted.items()}
    texts = defaultdict(list)
    for r in repair.repaired(damaged, copies=F.col("copies")).collect():
        texts[r["conv_id"]].append((r["place"], r["role"], r["text"]))
    plain = {c: [(k, role, "" if at is None else rows[at][2]) for k, (role, at) in enumerate(kept)] for c, (_, kept, rows) in wanted.items()}
    assert {c: sorted(v) for c, v in texts.items()} == {c: v for c, v in plain.items() if v}


def test_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    check(table)
    assert queries.QUERIES["op12_repair"](spark, sf_dir).count() == table.select("conv_id").distinct().count()


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_conversations(spark, seed):
    """Nulls in every column, empty and long texts, ties, repeated rows, other roles, clashing columns, one hot conversation."""
    rng = random.Random(seed)
    texts = [None, "", " \t", "a.", "b", "b?", "long " * 20000 + "!", "ü。", " ", "x!\n"]
    rows = [
        (rng.choice([None, *range(12), 3, 3, 3, 3]), rng.choice([None, *range(6), 40]), rng.choice([None, "", "system", "user", "assistant", "tool", "Ärzte"]), rng.choice(texts))
        for _ in range(250)
    ]
    table = spark.createDataFrame(rows + rows[:20], "conv_id long, turn long, role string, text string")
    check(table.select("*", *[F.lit(None).cast("string").alias(c) for c in ("conv", "copies_", "digest", "letter", "audit", "part", "seen", "cost")]).repartition(4))
    assert repair.report(table.limit(0)).count() == repair.repaired(table.limit(0)).count() == 0
    assert repair.report(table).count() == len({r[0] for r in rows})

"""Repair of conversation structure by cheapest edits, solved once per shared suffix.

Each row of a conversation is a letter: what its role begins with, or that it must go, and whether
its text is cut off. A conversation is the word of its letters. All words are minimised from the end
into one automaton: words that end alike share the nodes of that end. At each node the cheapest cost
to the end and the first edit of the best audit are computed once for each state of the grammar;
every conversation that passes through the node reads them.

The audits from a node and a state begin with different letters for different edits, since an edit
leads to one state only. So of equally cheap edits the one of the least letter is the least audit,
and no audits have to be compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from io import StringIO
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from textgrove.llm.words import SPACE, column
from textgrove.operators.scale import match, settle

#: Costs of the edits, of a truncated row that stays, and the roles that may be inserted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FULL = {"u": "user", "a": "assistant"}
#: The grammar ``(s?(ua)+)?``: at each state the roles that may come next and the states they lead to.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
LEGAL = ("su", "ua", "au")
#: A row that must be deleted; a capital letter is a row with a truncated text.
GONE = "x"
#: Rows that a task gives out at a time.
BATCH = 1024
#: Costs of a node's states above its least one, and the first edits; "." is the end of the audit.
Node = tuple[tuple[int, ...], str]
START = 0


def insertion(state: int) -> str:
    """Initial of the row that an insertion or a change of role puts at a state."""
    return "u" if "u" in GRAMMAR[state] else "a"


def _node(costs: list[int], edits: list[str]) -> tuple[int, Node]:
    """Least cost and node of the given states, when rows may also be inserted before it."""
    for _ in GRAMMAR:  # a chain of insertions visits no state twice
        for state, moves in enumerate(GRAMMAR):
            cost = INSERT + costs[moves[insertion(state)]]
            if (cost, "I") < (costs[state], edits[state]):
                costs[state], edits[state] = cost, "I"
    least = min(costs)
    return least, (tuple(c - least for c in costs), "".join(edits))


def end() -> tuple[int, Node]:
    """The node behind the last row."""
    final = [s in FINAL for s in range(len(GRAMMAR))]
    return _node([0 if f else 1 << 40 for f in final], ["." if f else "~" for f in final])


@lru_cache(maxsize=1 << 16)
def before(letter: str, node: Node) -> tuple[int, Node]:
    """Cost to add and node of a row in front of ``node``; nodes are few, as costs differ by little."""
    late = TRUNCATED if letter.isupper() else 0
    costs, edits = [], []
    for state, moves in enumerate(GRAMMAR):
        options = [(DELETE + node[0][state], "D")]
        if letter != GONE:
            options.append((late + REROLE + node[0][moves[insertion(state)]], "R"))
        if letter.lower() in moves:
            options.append((late + node[0][moves[letter.lower()]], "K"))
        cost, edit = min(options)
        costs.append(cost)
        edits.append(edit)
    return _node(costs, edits)


def solutions(words: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """``(word, cost, audit)`` of words that come in the order of their reversals.

    Words that end alike are neighbours in that order, so the nodes of their common end are on the
    path that the last word has left; only the rest of the path is new.
    """
    path, last = [end()], ""
    for word in words:
        back = word[::-1]
        common = next((k for k, (a, b) in enumerate(zip(back, last, strict=False)) if a != b), min(len(back), len(last)))
        del path[common + 1 :]
        for letter in back[common:]:
            cost, node = before(letter, path[-1][1])
            path.append((path[-1][0] + cost, node))
        last, state, audit, left = back, START, [], len(word)
        while (edit := path[left][1][1][state]) != ".":
            audit.append(edit)
            state = moved(state, edit, back[left - 1].lower() if left else "")
            left -= edit != "I"
        yield word, path[-1][0] + path[-1][1][0][START], "".join(audit)


def moved(state: int, edit: str, initial: str) -> int:
    """State of the grammar after an edit of a row with this initial."""
    return state if edit == "D" else GRAMMAR[state][initial if edit == "K" else insertion(state)]


def _solved(signatures: DataFrame) -> DataFrame:
    """``(signature, cost, audit)`` of distinct signatures, dealt over the tasks by their ends."""
    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    back = signatures.withColumn("back", F.reverse("signature"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = (w for batch in batches for w in batch.column("signature").to_pylist())
        found = solutions(words)
        while rows := list(islice(found, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["signature", "cost", "audit"])

    return back.repartitionByRange(parts, "back").sortWithinPartitions("back").mapInArrow(solve, "signature string, cost long, audit string")


def _rows(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, copies: Column) -> DataFrame:
    """The table in the terms of this module; ``digest`` stands for the text where texts need not be moved."""
    role, text = (F.coalesce(column(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    return rows.select(
        column(id_col).alias("conv"), column(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.sha2(text, 256).alias("digest"), copies.cast("long").alias("copies"),
    )


def _by_conversation(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Each conversation in one task, sorted; it is read as a stream there and never held."""
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


def _examined(rows: DataFrame) -> DataFrame:
    """Per conversation ``gaps, blank, duplicate, truncated, illegal`` and its signature.

    No text is moved: rows carry its digest and what ends it.
    """
    kind = rows.schema["conv"].dataType
    bare = F.rtrim("text", F.lit(SPACE))
    seen = F.row_number().over(Window.partitionBy("conv", "role", "digest", F.col("copies") > 0).orderBy("turn")) > 1
    cut = ~F.substring(bare, -1, 1).isin(*".!?")
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    marked = (
        rows.select("conv", "turn", "role", "digest", "copies", (bare == "").alias("blank"), cut.alias("cut"))
        .repartition("conv")
        .withColumn("seen", seen)
        .withColumn("letter", F.when(F.col("blank") | F.col("seen"), F.lit(GONE)).when(F.col("cut"), F.upper(letter)).otherwise(letter))
        .sortWithinPartitions("conv", "turn", "role", "digest", "seen")
        .select("conv", "turn", initial.alias("initial"), "copies", "blank", "seen", "cut", "letter")
    )
    names = ["gaps", "blank", "duplicate", "truncated", "illegal"]
    out = pa.schema([("conv", to_arrow_type(kind)), *[(n, pa.int64()) for n in names], ("signature", pa.string())])

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        found = (_examine(conv, own) for conv, own in groupby(rows, key=itemgetter(0)))
        while part := list(islice(found, BATCH)):
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in part], out)

    ddl = f"conv {kind.simpleString()}, " + ", ".join(f"{n} long" for n in names) + ", signature string"
    return marked.mapInArrow(examine, ddl)


def _examine(conv, rows: Iterator[tuple]) -> tuple:
    """One row of ``_examined`` from the sorted rows of a conversation."""
    first = last = None
    turns = blank = duplicate = truncated = illegal = 0
    initials, signature = "", StringIO()
    for _, turn, initial, copies, is_blank, seen, cut, letter in rows:
        if not copies:
            continue
        if turn is not None and turn != last:
            first, last, turns = turn if first is None else first, turn, turns + 1
        blank += copies if is_blank else 0
        duplicate += 0 if is_blank else copies - 1 + seen
        truncated += not is_blank and not seen and cut
        illegal += (initials != "" and initials + initial not in LEGAL) + copies - 1
        initials = initial or " "
        signature.write(letter + GONE * (copies - 1))
    gaps = 0 if first is None else last - first + 1 - turns
    return conv, gaps, blank, duplicate, truncated, illegal, signature.getvalue()


def _edited(rows: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` of the rows that stay; the first row has the audit as its text."""
    audit, state = next(rows)[-2], START
    edits = iter(audit)

    def inserted(state: int) -> Iterator[tuple]:
        for edit in edits:
            if edit != "I":
                return edit, state
            yield "I", FULL[insertion(state)], ""
            state = moved(state, "I", "")
        return "", state

    for *_, role, text, copies in rows:
        for _ in range(copies):
            edit, state = yield from inserted(state)
            if edit != "D":
                yield edit, role if edit == "K" else FULL[insertion(state)], text
            state = moved(state, edit, role[:1])
    yield from inserted(state)


def _streamed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``(conv, role, text, copies)`` sorted, in front of the rows of a conversation one with its audit."""
    head = audits.select(
        "conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.col("audit").alias("text"), F.lit("").alias("digest"), F.lit(1).cast("long").alias("copies"),
    )
    own = rows.filter("copies > 0").withColumn("part", F.lit(1))
    return _by_conversation(head.unionByName(own), "part", "turn", "role", "digest").select("conv", "role", "text", "copies")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    rows = (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    return groupby(rows, key=itemgetter(0))


def audits(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None
) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation.

    Rows are taken by turn, nulls first; rows of one turn by role and then by a hash of the text.
    A null role or text is one space. The first fault of a row counts: blank, no character but white
    space; duplicate, role and text as in an earlier row; truncated, not ended by one of ``.!?``.
    ``illegal`` counts neighbours whose roles do not begin with su, ua or au, ``gaps`` the numbers that
    are missing between the least and the greatest turn. ``audit`` has a letter for each edit of the
    cheapest repair, K(eep), R(erole), D(elete), I(nsert); the least of several. Rows with a null id
    are a conversation. ``copies`` says how often a row counts, 0 being possible: a conversation of
    which no row is left has zeros and an empty audit. An empty table gives no rows.

    A conversation is one letter a row in this step, as in its audit. Signatures that many
    conversations share are solved once.
    """
    rows = _rows(rows, id_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies)
    found = settle(_examined(rows), "signatures")
    solved = settle(_solved(found.select("signature").distinct()), "solved")
    return settle(found.join(solved, "signature").drop("signature"), "audits")


def repaired(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None
) -> DataFrame:
    """The repaired conversations: ``(id, place, edit, role, text)``, places from 0. Cases as in ``audits``."""
    own = _rows(rows, id_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies)
    stream = _streamed(own, audits(rows, id_col, turn_col, role_col, text_col, copies))
    kind = stream.schema["conv"].dataType
    out = pa.schema([("conv", to_arrow_type(kind)), ("place", pa.int64()), *[(n, pa.string()) for n in ("edit", "role", "text")]])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((conv, k, *row) for conv, own in _conversations(batches) for k, row in enumerate(_edited(own)))
        while part := list(islice(found, BATCH)):
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in part], out)

    ddl = f"conv {kind.simpleString()}, place long, edit string, role string, text string"
    return stream.mapInArrow(apply, ddl).withColumnRenamed("conv", id_col)


def report(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None
) -> DataFrame:
    """``audits`` with ``repaired_sha256``, of the repaired rows as ``role:text`` joined by newlines.

    The digest of a conversation is made while its rows stream by; it can only be made in order, so
    a conversation is read by one task.
    """
    own = _rows(rows, id_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies)
    found = audits(rows, id_col, turn_col, role_col, text_col, copies)
    stream = _streamed(own, found)
    kind = stream.schema["conv"].dataType
    out = pa.schema([("conv", to_arrow_type(kind)), ("repaired_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = ((conv, _digest(_edited(own))) for conv, own in _conversations(batches))
        while part := list(islice(digests, BATCH)):
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in part], out)

    digests = stream.mapInArrow(digest, f"conv {kind.simpleString()}, repaired_sha256 string")
    return match(found, digests, ["conv"]).withColumnRenamed("conv", id_col)


def _digest(rows: Iterator[tuple[str, str, str]]) -> str:
    made = hashlib.sha256()
    for k, (_, role, text) in enumerate(rows):
        made.update(f"{chr(10) if k else ''}{role}:{text}".encode())
    return made.hexdigest()


def damaged(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(id, turn, role, text, copies)`` with faults by a hash of id and turn, so that repairs can be tested.

    One of twenty hashes each drops the row (``copies`` 0), empties its text, takes its ``.!?`` away,
    repeats it (``copies`` 2) or makes its role user. Nulls are one space.
    """
    space = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.encode(F.concat(space(id_col), F.lit(":"), space(turn_col)), "utf-8")) % 20
    return conversations.select(
        column(id_col),
        column(turn_col),
        F.when(fault == 4, F.lit("user")).otherwise(space(role_col)).alias(role_col),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(space(text_col), ".!?", "")).otherwise(space(text_col)).alias(text_col),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )

"""Cleaning: edge strings with expected outputs, and properties on generated strings."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textgrove.functions import text as T

EDGES = [
    ("Won't CAN'T shan't I'M you're It's", "will not cannot sha not i am you are it is", None),
    ("a<br/>b < c > d <\n>x", "ab d x", None),
    ("awwwful httpx http:// see https://a.b/c?d e", "a see e", None),
    ("mail a@b.c x @ y@ @z", "mail x @ y@ @z", "mail x y z"),
    ("tab\tnbsp\xa0em nel\x85fs\x1cus\x1fzw​end ", "tab nbsp em nel fs us zw​end", None),
    ("'dog' 'my o'd", "wouldog' amy o would", "wouldog amy o would"),
    ("ΟΔΟΣ STRASSE ẞ", "οδος strasse ß", None),
    ("don’t", "don’t", None),
    ("Price: $12.50 (٣ items) -- ok!", "price: $12.50 (٣ items) -- ok!", "price items ok"),
    ("a_b [c]\\d^e", "a_b [c]\\d^e", "ab cde"),
    ("", "", None),
    ("   ", "", None),
    (None, "", None),
]


def one(spark, values, *columns):
    return spark.createDataFrame([(v,) for v in values], "t string").select(*columns).collect()


def test_edge_strings(spark):
    full = T.clean_text(F.col("t"), remove_numbers=True, remove_punctuation=True)
    rows = one(spark, [e[0] for e in EDGES], T.clean_text(F.col("t")), full)
    assert [(r[0], r[1]) for r in rows] == [(d, d if f is None else f) for _, d, f in EDGES]


def test_switches(spark):
    off = T.clean_text(F.col("t"), lowercase=False, remove_extra_whitespace=False, contractions=False)
    assert one(spark, ["It's  <b>X</b> 1!"], off)[0][0] == "It's  X 1!"


def test_word_boundary(spark):
    c = T.expand_contractions(F.col("t"), word_boundary=True)
    rows = one(spark, ["'my 'dog' don't it's we've"], c)
    assert rows[0][0] == "'my 'dog' do not it is we have"


def test_late_rules_see_the_result_of_earlier_ones(spark):
    assert one(spark, ["don'that's"], T.expand_contractions(F.col("t")))[0][0] == "do nothat is"


def test_odd_letters_take_the_long_way(spark):
    texts = ["\u0131t's", "\u0130T'S", "it'\u017f", "ΣN'T Σ", "ΑΣ it's"]
    got = [r[0] for r in one(spark, texts, T.clean_text(F.col("t")))]
    assert got == [restated(t) for t in texts]


def test_linear_on_long_runs(spark):
    long = "x" * 300_000
    rows = one(spark, [long, "<" * 100_000, "a@" * 50_000], F.length(T.clean_text(F.col("t"))))
    assert [r[0] for r in rows] == [300_000, 100_000, 0]


def restated(text):
    """The rules of cleaning with their plain patterns."""
    text = re.sub(r"<[^>]+>", "", text)
    text = re.sub(r"http\S+|www\S+", "", text)
    text = re.sub(r"\S+@\S+", "", text)
    for short, long in T.CONTRACTIONS:
        text = re.sub(re.escape(short), long, text, flags=re.IGNORECASE)
    return re.sub(r"\s+", " ", text.lower()).strip()


PIECES = st.sampled_from(
    ["<", ">", "@", "http", "www", "'s", "n't", "it", "don't", " ", "\n", "\xa0", "\x1c", "A", "ß", "é", "中", "1", ".", "Σ", "ı", "can't", "won't", "where", "that", "t", "who", "let", "n", "is", "You'RE", "'d", "'m", "I"]
)


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=30, max_size=30))
def test_clean_text_equals_its_rules(spark, texts):
    got = [r[0] for r in one(spark, texts, T.clean_text(F.col("t")))]
    assert got == [restated(t) for t in texts]
    assert not any("  " in t or t != t.strip() for t in got)


def test_counts_and_previews(spark):
    rows = one(
        spark,
        ["", "a  b\n c", "x" * 201, None],
        T.word_count(F.col("t")),
        T.char_count(F.col("t")),
        F.length(T.preview(F.col("t"))),
        F.length(T.preview(F.col("t"), always=True)),
    )
    assert [tuple(r) for r in rows] == [(0, 0, 0, 3), (3, 7, 7, 10), (1, 201, 203, 203), (None,) * 4]


def test_label_names(spark):
    rows = spark.createDataFrame([(0,), (1,), (5,), (-1,), (None,)], "l int").select(
        T.label_name(F.col("l"), ["NEGATIVE", "POSITIVE"]).alias("n")
    )
    names = [r[0] for r in rows.collect()]
    assert names == ["NEGATIVE", "POSITIVE", "LABEL_5", "LABEL_-1", None]
    back = rows.select(T.label_id(F.col("n"), ["NEGATIVE", "POSITIVE"])).collect()
    assert [r[0] for r in back] == [0, 1, None, None, None]


@pytest.mark.parametrize("text, tokens", [
    ("Café $5 a+b", ["cafe", "$", "5", "a", "+", "b"]),
    ("中文 text", ["中", "文", "text"]),
    ("don't", ["don", "'", "t"]),
    ("áb\x00c​d", ["abcd"]),
    ("", []),
])
def test_pretokenize(spark, text, tokens):
    from textgrove.functions.tokens import pretokenize

    assert one(spark, [text], pretokenize(F.col("t")))[0][0] == tokens

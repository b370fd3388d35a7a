"""Text cleaning and text measures as column expressions.

Every function takes a column and returns a column, stays inside the JVM, and
is linear in the length of the text: patterns that could rescan a long run of
characters are anchored at the start of the run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgrove.functions.binding import once

Step = Callable[[Column], Column]

# Whitespace as a regex class body (the Unicode set plus the four
# ASCII separators U+001C to U+001F), to be used under (?U).
SPACE = r"\s\x1c-\x1f"

# Ordered contraction rules, each applied to the result of the
# one before. Matching ignores case and word boundaries.
CONTRACTIONS = [
    ("don't", "do not"),
    ("won't", "will not"),
    ("can't", "cannot"),
    ("n't", " not"),
    ("'re", " are"),
    ("'ve", " have"),
    ("'ll", " will"),
    ("'d", " would"),
    ("'m", " am"),
    ("i'm", "i am"),
    ("you're", "you are"),
    ("it's", "it is"),
    ("that's", "that is"),
    ("what's", "what is"),
    ("where's", "where is"),
    ("how's", "how is"),
    ("here's", "here is"),
    ("there's", "there is"),
    ("who's", "who is"),
    ("let's", "let us"),
]

# The 32 ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _keep(text: Column) -> Column:
    return text


def _if_contains(
    text: Column, marks: list[str], change: Step, other: Step = _keep
) -> Column:
    """``change(text)`` where a mark occurs, else ``other(text)``.

    A byte search for the mark is much faster than a search for the pattern.
    """

    def choose(t: Column) -> Column:
        found = reduce(lambda a, b: a | b, [F.contains(t, F.lit(m)) for m in marks])
        return F.when(found, change(t)).otherwise(other(t))

    return once(text, choose)


def fill_missing(text: Column) -> Column:
    """Null becomes the empty string (TXT-1)."""
    return F.coalesce(text.cast("string"), F.lit(""))


def strip_html(text: Column) -> Column:
    """Delete ``<...>`` tags without leaving a gap (TXT-2).

    Only the part up to the last ``>`` is searched, so that a text with many
    ``<`` and no closing mark is not rescanned from each of them.
    """

    def change(t: Column) -> Column:
        tail = F.substring_index(t, ">", -1)
        head = F.left(t, F.length(t) - F.length(tail))
        return F.concat(F.regexp_replace(head, r"<[^>]++>", ""), tail)

    return _if_contains(text, [">"], change)


def strip_urls(text: Column) -> Column:
    """Delete every run that starts with ``http`` or ``www``, even inside a word (TXT-3)."""
    pattern = rf"(?U)(?:http|www)[^{SPACE}]+"
    return _if_contains(text, ["http", "www"], lambda t: F.regexp_replace(t, pattern, ""))


def strip_emails(text: Column) -> Column:
    """Delete each run of non-space characters with an ``@`` inside it (TXT-4)."""
    pattern = rf"(?U)(?<![^{SPACE}])[^{SPACE}][^@{SPACE}]*+@[^{SPACE}]+"
    return _if_contains(text, ["@"], lambda t: F.regexp_replace(t, pattern, ""))


def expand_contractions(text: Column, word_boundary: bool = False) -> Column:
    """Apply the contraction rules in order (TXT-5).

    ``word_boundary=True`` keeps a rule from matching inside a longer word:
    whole-word rules must start and suffix rules must end at a boundary.
    """

    def change(t: Column) -> Column:
        for short, long in CONTRACTIONS:
            pattern = short
            if word_boundary:
                suffix_rule = short.startswith("'") or short == "n't"
                pattern = (r"(?<=\w)" if suffix_rule else r"\b") + short + r"\b"
            t = F.regexp_replace(t, "(?iU)" + pattern, long)
        return t

    return _if_contains(text, ["'"], change)


# Letters for which lower-casing and ignoring case go different
# ways, or whose lower case depends on the letters around them.
ODD_LETTERS = ["\u0130", "\u0131", "\u017f", "\u03a3"]


def expand_and_lower(text: Column) -> Column:
    """``lower(expand_contractions(text))`` at the cost of a few byte searches.

    On lower-case text most rules are plain replacements. Those that another
    rule makes redundant are left out, and the ones that only turn ``'s`` into
    ``is`` share a pattern, which looks back from the apostrophe. Texts with odd letters take the long way.
    """
    rules = dict(CONTRACTIONS)

    def replaced(t: Column) -> Column:
        t = F.lower(t)
        for short in ("won't", "can't", "n't", "'re", "'ve", "'ll", "'d", "'m", "let's"):
            t = F.replace(t, F.lit(short), F.lit(rules[short]))
        return F.regexp_replace(t, "'(?<=(?:it|that|what|where|how|here|who)')s", " is")

    def change(t: Column) -> Column:
        return _if_contains(t, ODD_LETTERS, lambda t: F.lower(expand_contractions(t)), replaced)

    return _if_contains(text, ["'"], change, F.lower)


def strip_digits(text: Column) -> Column:
    """Delete Unicode decimal digits (TXT-7)."""
    return F.regexp_replace(text, r"(?U)\d+", "")


def strip_punctuation(text: Column) -> Column:
    """Delete ASCII punctuation; typographic marks stay (TXT-8)."""
    return F.translate(text, PUNCTUATION, "")


def collapse_spaces(text: Column) -> Column:
    """One space for each whitespace run, none at the ends (TXT-9)."""
    return F.trim(F.regexp_replace(text, rf"(?U)[{SPACE}]+", " "))


def clean_text(
    text: Column,
    lowercase: bool = True,
    remove_punctuation: bool = False,
    remove_numbers: bool = False,
    remove_extra_whitespace: bool = True,
    contractions: bool = True,
) -> Column:
    """Clean a text column (TXT-10); the order of the steps is fixed."""
    steps = [
        (True, fill_missing),
        (True, strip_html),
        (True, strip_urls),
        (True, strip_emails),
        (contractions and lowercase, expand_and_lower),
        (contractions and not lowercase, expand_contractions),
        (lowercase and not contractions, F.lower),
        (remove_numbers, strip_digits),
        (remove_punctuation, strip_punctuation),
        (remove_extra_whitespace, collapse_spaces),
    ]
    for wanted, step in steps:
        if wanted:
            text = step(text)
    return text


def char_count(text: Column) -> Column:
    """Code points of a text (TXT-12)."""
    return F.length(text)


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words, 0 for an empty text (TXT-13)."""
    return F.regexp_count(text, F.lit(rf"(?U)[^{SPACE}]+"))


def preview(text: Column, chars: int = 200, always: bool = False) -> Column:
    """First characters with an ellipsis, which ``always`` adds even to short texts (TXT-14)."""
    cut = F.concat(F.substring(text, 1, chars), F.lit("..."))
    return cut if always else F.when(F.length(text) > chars, cut).otherwise(text)


def label_name(label: Column, names: list[str]) -> Column:
    """Name of a label id; ids outside the list become ``LABEL_<id>`` (TXT-15)."""
    known = F.get(F.array(*[F.lit(n) for n in names]), label.cast("int"))
    return F.coalesce(known, F.concat(F.lit("LABEL_"), label.cast("string")))


def label_id(name: Column, names: list[str]) -> Column:
    """Id of a label name, null when unknown (TXT-15)."""
    position = F.array_position(F.array(*[F.lit(n) for n in names]), name)
    return F.when(position > 0, position - 1).cast("int")

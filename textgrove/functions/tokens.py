"""Pre-tokenization and token-id arrays as column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII symbols that count as punctuation although Unicode does
# not class them so, and the blocks of CJK ideographs.
SYMBOLS = "$+<=>^~`|"
CJK = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
LAST_DECOMPOSABLE = 0x2FA1D  # no code point beyond has a decomposition

_SINGLE = r"\p{P}$+<=>\^~`|" + CJK
# ASCII letters and digits come first: they are part of the words anyway, and are found without the long class.
TOKEN = rf"(?U)[a-z0-9[^\s{_SINGLE}]]+|[{_SINGLE}]"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Arguments of ``translate`` that strip accents and control characters.

    Letters go to the base of their canonical decomposition where that is one
    character; marks and control characters, at the end, are deleted.
    """
    letters, bases, deleted = [], [], []
    for code in range(LAST_DECOMPOSABLE + 1):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Mn" or (kind in ("Cc", "Cf") and char not in "\t\n\r") or code == 0xFFFD:
            deleted.append(char)
        elif kind != "Cs" and unicodedata.decomposition(char):
            base = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
            if len(base) == 1 and base[0] != char:
                letters.append(char)
                bases.append(base[0])
    return "".join(letters + deleted), "".join(bases)


def normalize(text: Column) -> Column:
    """Lower case without accents and control characters."""
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), *accent_table())


def pretokenize(text: Column) -> Column:
    """Words, with punctuation marks and CJK ideographs on their own (TOK-1)."""
    return F.regexp_extract_all(normalize(text), F.lit(TOKEN), F.lit(0))


def frame(ids: Column, cls: int, sep: int, max_length: int = 512) -> Column:
    """Add the start and end tokens and keep at most ``max_length`` ids (TOK-5)."""
    return F.concat(F.array(F.lit(cls)), F.slice(ids, 1, max_length - 2), F.array(F.lit(sep)))


def pad(ids: Column, length: Column, pad_id: int = 0) -> Column:
    """Fill up with padding ids to a length."""
    missing = F.greatest(length - F.size(ids), F.lit(0)).cast("int")
    return F.concat(ids, F.array_repeat(F.lit(pad_id), missing))


def attention_mask(ids: Column, length: Column) -> Column:
    """One for each id and zero for each place to be padded."""
    missing = F.greatest(length - F.size(ids), F.lit(0)).cast("int")
    return F.concat(F.transform(ids, lambda _: F.lit(1)), F.array_repeat(F.lit(0), missing))

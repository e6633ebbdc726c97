"""Names on a record split by fixed delimiters, for part-by-part matching."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from .titles import balance

# Words between names, and the further ones of composer fields.
WORDS = ["FT", "FT.", "FEAT", "FEAT.", "FEATURING", "WITH", "AND", "VS", "VS.", "EN", "AKA", "AKA.", "A.K.A."]
COMPOSER_WORDS = ["COMPOSER", "MUSIC BY", "LYRICS BY", "WORDS BY", "ARRANGEMENT BY", "CO WRITER", "CO COMPOSER", "ORIGINALLY BY", "WRITTEN BY"]
# Characters between names.
MARKS = r"|/#\\,;`_&+"


def _splitter(words: list[str], marks: str):
    alternatives = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    return re.compile(rf"[{re.escape(marks)}]|(?<!\S)(?:{alternatives})(?!\S)")


_SPLIT = {"artist": _splitter(WORDS, MARKS), "composer": _splitter(WORDS + COMPOSER_WORDS, MARKS)}
_INSIDE = {k: _splitter(v, "|/,&+-") for k, v in (("artist", WORDS), ("composer", WORDS + COMPOSER_WORDS))}
_ASIDE = re.compile(r"[(\[{]([^()\[\]{}]*)[)\]}]")


def plain(part: str) -> str:
    """Capitals without accents, quotes, hyphens and brackets, single blanks."""
    part = "".join(c for c in unicodedata.normalize("NFD", part.upper()) if not unicodedata.combining(c))
    return " ".join(re.sub(r"['\"`\-()\[\]{}?]", "", part).split())


def credit_parts(name: str | None, entity: str = "artist", quotes_split: bool = False) -> list[str]:
    """The distinct names in a credit, main text first, then what stands in brackets; parts of one character are left out.

    quotes_split: apostrophes and question marks separate words instead of vanishing.
    """
    if not name or not name.strip():
        return []
    text = balance(re.sub(r"['?]", " " if quotes_split else "", name.upper()))
    asides = [m.group(1) for m in _ASIDE.finditer(text)]
    pieces = _SPLIT[entity].split(_ASIDE.sub(" ", text))
    for a in asides:
        pieces += _INSIDE[entity].split(a)
    return list(dict.fromkeys(p for p in map(plain, pieces) if len(p) > 1))


def credit_parts_col(c, entity: str = "artist", quotes_split: bool = False):
    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([credit_parts(v, entity, quotes_split) for v in s], dtype=object)

    return run(F.col(c) if isinstance(c, str) else c)

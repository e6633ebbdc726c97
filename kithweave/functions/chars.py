"""Character tables and text normalisers, as built-in column expressions and as plain Python for Arrow code."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Letters of other scripts that look like a Latin letter, and that Latin letter.
LOOK_ALIKES = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Һ": "H", "Ӏ": "I", "З": "3",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԍ": "g", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    # Armenian
    "Օ": "O", "Ս": "U", "Տ": "S", "Լ": "L", "օ": "o", "ս": "u", "ո": "n", "հ": "h", "ց": "g", "զ": "q", "յ": "j",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭵ": "i", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
# Letters with a stroke and the like, which have no decomposition.
STROKES = {"Ł": "L", "ł": "l", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "TH", "þ": "th", "Ð": "D", "ð": "d", "ı": "i"}
# Hyphens other than the ordinary one.
HYPHENS = "‐‑‒–—―−⁃﹘﹣－֊־᠆"
# Blanks other than the ordinary one.
BLANKS = "               　"
# Characters without a shape of their own (beside category Cf).
SHAPELESS = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"
#: As classes of Java's and of the regex module's patterns.
INVISIBLE_CLASS = r"\p{Cf}" + SHAPELESS + "︀-️"


@lru_cache(maxsize=1)
def compatibility_pairs() -> tuple[str, str]:
    """Characters whose compatibility form is one other character, and that character; built by rule from the Unicode tables."""
    source, target = [], []
    for code in range(0xA0, 0x30000):
        ch = chr(code)
        if not unicodedata.decomposition(ch).startswith("<"):
            continue
        form = unicodedata.normalize("NFKC", ch)
        if len(form) == 1 and form != ch:
            source.append(ch)
            target.append(form)
    return "".join(source), "".join(target)


@lru_cache(maxsize=65536)
def _is_compatibility(ch: str) -> bool:
    return unicodedata.category(ch)[0] in "LNP" and unicodedata.normalize("NFKC", ch) != unicodedata.normalize("NFC", ch)


@lru_cache(maxsize=65536)
def script(ch: str) -> str:
    """The script of a letter by its Unicode name; empty for all else."""
    if not ch.isalpha():
        return ""
    name = unicodedata.name(ch, "")
    return "LATIN" if name.startswith(("LATIN", "FULLWIDTH LATIN")) else name.split(" ", 1)[0]


def unify(text: str) -> str:
    """One form of text that looks alike: compatibility forms, composed accents, ordinary blanks and hyphens, no invisible characters, and in words
    that have Latin letters the Latin look-alikes. Accented letters and words wholly in another script stay."""
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKC", text)
    text = "".join(" " if ch in BLANKS else "-" if ch in HYPHENS else ch for ch in text if unicodedata.category(ch) != "Cf" and ch not in SHAPELESS and not "︀" <= ch <= "️")
    if not text.isascii():
        text = " ".join(_latinise(w) for w in text.split(" "))
    return unicodedata.normalize("NFC", text)


def _latinise(word: str) -> str:
    if word.isascii() or not any(script(ch) == "LATIN" for ch in word):
        return word
    return "".join(LOOK_ALIKES.get(ch, ch) for ch in word)


def bare(text: str) -> str:
    """unify(), then upper case and no accents: for comparing, never for showing."""
    text = unify(text).upper()
    if text.isascii():
        return text
    text = "".join(STROKES.get(ch, ch) for ch in unicodedata.normalize("NFD", text))
    return "".join(ch for ch in text if not unicodedata.combining(ch)).upper()


def looks_odd(text: str) -> bool:
    """Holds compatibility forms, separate accents, invisible characters, odd blanks or hyphens, or a foreign letter within a Latin word."""
    if text.isascii():
        return False
    if unicodedata.normalize("NFC", text) != text:
        return True
    for ch in text:
        if ch in BLANKS or ch in HYPHENS or ch in SHAPELESS or unicodedata.category(ch) == "Cf" or "︀" <= ch <= "️" or _is_compatibility(ch):
            return True
    for word in re.split(r"[ \n\t\r]+", text):
        scripts = {script(ch) for ch in word} - {""}
        if len(scripts) > 1 and "LATIN" in scripts:
            return True
    return False

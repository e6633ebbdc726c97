"""Several names in one field: segmentation guided by a dictionary of known whole names.

A multi-pattern automaton marks every known name in the field. A dynamic programme over the possible cuts then picks the cheapest cover: known names
cost nothing and protect the delimiters inside them, a part of one word that nobody knows costs most, and so does leaving a delimiter uncut.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

from .chars import bare

# Words saying who did what, before a name.
CREDIT = re.compile(
    r"^(?:(?:words|lyrics?|music|text|composed|written|arranged|arrangement|produced|adapted|performed|sung|originally|orchestrated|translated)(?:\s*(?:and|&|/|,)\s*(?:words|lyrics?|music|composed|arranged|produced))?\s+by\b|(?:composer|lyricist|author|arranger|producer|by|feat|featuring|ft|with|vs|versus)\b(?:\.|\s*:)?)\s*:?\s*",
    re.I,
)
# Delimiters that always separate, and those that occur inside names too.
HARD = re.compile(r"[\n\r\t|;；｜]+")
SOFT = re.compile(r"\s*(?:,\s*(?:and|&)(?=\s)|[,，、/\\&＆+＋／])\s*|\s+(?:feat(?:uring)?|ft|versus|vs|with|and|x)\b\.?(?=\s)\s*", re.I)
GUEST = re.compile(r"[(\[{]\s*((?:feat(?:uring)?|ft|with|vs|and|plus|starring)\b\.?\s*:?\s*)([^()\[\]{}]*)[)\]}]", re.I)
# Articles that follow an act's name after a comma.
ARTICLES = {"THE", "DIE", "DER", "DAS", "LOS", "LAS", "LES", "EL", "LA", "LE", "A", "AN"}
# Placeholders for unknown or traditional authors.
PLACEHOLDERS = {"TRAD", "TRADITIONAL", "ARR", "UNKNOWN", "ANON", "ANONYMOUS", "N/A", "NA", "NONE", "NULL", "DP", "PD", "PUBLIC DOMAIN", "VARIOUS", "VARIOUS ARTISTS", "UNKNOWN AUTHOR", "UNKNOWN ARTIST", "UNKNOWN COMPOSER", "UNKNOWN WRITER", "NOT KNOWN", "TBA", "TBC", "COPYRIGHT CONTROL", "CONTROL"}
#: What a part costs: a name of several words, a word nobody knows, a delimiter left inside a name.
WHOLE, WORD, UNCUT = 2, 7, 5


def folded(text: str) -> str:
    """Upper case letter by letter, so that every place keeps its offset: a letter whose upper case is longer stays as it is."""
    up = text.upper()
    return up if len(up) == len(text) else "".join(u if len(u := c.upper()) == 1 else c for c in text)


class Known:
    """An automaton over the known names that hold a delimiter; others need no protection."""

    def __init__(self, names):
        self.names = sorted({folded(n.strip()) for n in names if n and (SOFT.search(n.strip()) or HARD.search(n.strip()))})
        self.automaton, self.trie = None, {}
        try:
            import ahocorasick

            if self.names:
                self.automaton = ahocorasick.Automaton()
                for n in self.names:
                    self.automaton.add_word(n, n)
                self.automaton.make_automaton()
        except ImportError:
            for n in self.names:
                node = self.trie
                for ch in n:
                    node = node.setdefault(ch, {})
                node[""] = n

    def _walk(self, up: str):
        """The same by a walk of a trie from the start of every word, where there is no automaton."""
        for at in range(len(up)):
            if at and up[at - 1].isalnum():
                continue
            node = self.trie
            for e in range(at, len(up)):
                node = node.get(up[e])
                if node is None:
                    break
                if "" in node:
                    yield at, e + 1

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Where known names stand as whole words."""
        up = folded(text)
        if self.automaton is not None:
            found = [(e + 1 - len(n), e + 1) for e, n in self.automaton.iter(up)]
        else:
            found = list(self._walk(up))
        return [(a, b) for a, b in found if (a == 0 or not up[a - 1].isalnum()) and (b == len(up) or not up[b].isalnum())]


def is_placeholder(name: str) -> bool:
    return re.sub(r"[.\s]+", " ", bare(name)).strip(" .()[]") in PLACEHOLDERS


def _turned(left: str, right: str) -> bool:
    """Does a comma between these only turn a name round?"""
    r = right.split()
    if len(r) == 1 and r[0].upper().rstrip(".") in ARTICLES and len(left.split()) > 1:
        return True
    return len(left.split()) == 1 and 1 <= len(r) <= 3 and (len(r) == 1 or len(r[-1].rstrip(".")) == 1 or len(r[0].rstrip(".")) <= 12 and not r[0].upper() in ARTICLES and len(r) == 2)


def _cost(part: str, cuts: int, known: bool, commas: int) -> float:
    if known:
        return 0
    words = part.split()
    if not words:
        return 0
    if cuts and cuts == commas == 1:
        left, _, right = part.replace("，", ",").partition(",")
        if _turned(left.strip(), right.strip()):
            return WHOLE
    if len(words) == 1:
        return WORD if not is_placeholder(part) else WHOLE
    if len(words) == 2 and words[0].upper() in ARTICLES and cuts == 0:
        return WHOLE + 1
    return WHOLE + UNCUT * cuts


#: Delimiters up to which a part's cost is computed from its text. That of a longer part follows from where it starts and ends, so that a field of many thousand names takes
#: no time in the square of their number; the cover is the same for any number from 2 on.
NEAR = 12


def _segment(text: str, known: Known, near: int = NEAR) -> list[str]:
    """The cheapest cover of one stretch without hard delimiters; of covers that cost the same, the one whose last part is longest."""
    cuts = [(m.start(), m.end()) for m in SOFT.finditer(text) if m.end() > m.start()]
    if not cuts:
        return [text]
    spanned = set(known.spans(text))
    starts, ends = [0] + [y for _, y in cuts], [x for x, _ in cuts] + [len(text)]
    comma = [0]
    for x, y in cuts:
        comma.append(comma[-1] + ("," in text[x:y] or "，" in text[x:y]))
    n, size = len(starts), len(text)
    left, right = [], []
    for a in starts:
        while a < size and text[a].isspace():
            a += 1
        left.append(a)
    for b in ends:
        while b > 0 and text[b - 1].isspace():
            b -= 1
        right.append(b)
    blank_after = [size] * (size + 1)
    for at in range(size - 1, -1, -1):
        blank_after[at] = at if text[at].isspace() else blank_after[at + 1]
    at_end: dict[int, list[int]] = {}
    for a, b in spanned:
        at_end.setdefault(b, []).append(a)
    best, back = [0.0] + [float("inf")] * n, [0] * (n + 1)
    begin: dict[int, list[int]] = {}  # where a part's text begins, with or without its credit: parts that start there
    joined = (float("inf"), 0)  # least cost of a long part of several words, less what its delimiters cost
    unbroken: dict[int, tuple[float, int]] = {}  # by the next blank: least cost before a long part without one
    for j in range(n):
        far = j - near - 1
        if far >= 0:  # the part that starts there is long from now on
            credit = CREDIT.match(text[left[far] : left[far] + 200])
            inner = left[far] + (credit.end() if credit else 0)
            for a in {left[far], inner}:
                begin.setdefault(a, []).append(far)
            joined = min(joined, (best[far] - UNCUT * far, far))
            gap = blank_after[inner]
            unbroken[gap] = min(unbroken.get(gap, (float("inf"), 0)), (best[far], far))
            options = [(joined[0] + WHOLE + UNCUT * j, joined[1])]
            gap = blank_after[max(right[j] - 1, 0)]
            if gap in unbroken:
                options.append((unbroken[gap][0] + WORD, unbroken[gap][1]))
            options += [(best[i], i) for a in at_end.get(right[j], ()) for i in begin.get(a, ())]
            best[j + 1], back[j + 1] = min(options)
        for i in range(max(0, j - near), j + 1):
            a, b = left[i], max(left[i], right[j])
            part = text[a:b]
            core = CREDIT.sub("", part)
            is_known = (a, b) in spanned or (core != part and (b - len(core), b) in spanned)
            c = best[i] + _cost(core, j - i, is_known, comma[j] - comma[i])
            if c < best[j + 1]:
                best[j + 1], back[j + 1] = c, i
    parts, j = [], n
    while j:
        i = back[j]
        parts.append(text[left[i] : max(left[i], right[j - 1])])
        j = i
    return [p for p in reversed(parts) if p]


def _unquote(text: str) -> list[str] | None:
    """Fields in quotes with doubled quotes inside, separated by commas or semicolons; None where the text isn't of that kind."""
    s = text.strip()
    if '"' not in s or not re.search(r'(^|[,;|/]\s*)"', s):
        return None
    out, i, n = [], 0, len(s)
    while i < n:
        while i < n and (s[i].isspace() or s[i] in ",;|/"):
            i += 1
        if i < n and s[i] == '"':
            i, item = i + 1, []
            while i < n:
                if s[i] == '"':
                    if s[i + 1 : i + 2] == '"':
                        item.append('"')
                        i += 2
                        continue
                    break
                item.append(s[i])
                i += 1
            out.append("".join(item))
            i += 1
        elif i < n:
            m = re.compile(r"[,;|]").search(s, i)
            e = m.start() if m else n
            out.append(s[i:e])
            i = e
    return out


def _tidy(part: str) -> str:
    part = part.strip()
    for _ in range(3):
        before = part
        part = CREDIT.sub("", part, count=1).strip()
        if len(part) > 1 and part[0] + part[-1] in ('""', "“”", "«»", "()", "[]", "{}") and part[0] not in part[1:-1]:
            part = part[1:-1].strip()
        part = part.strip(",/&+|;").strip() if part.strip(",/&+|;").strip() else ""
        if part == before:
            break
    return part


def split_names(text: str | None, known: Known) -> list[str]:
    """The names in a field, in order and as stored; one for a field with a single name, none for null and blank fields."""
    if text is None or not text.strip():
        return []
    s = text.strip()
    if s[0] == "[" and s[-1] == "]":
        try:
            items = json.loads(s)
            if isinstance(items, list):
                return [t for t in (_tidy(str(x)) for x in items if x is not None) if t]
        except ValueError:
            pass
    items = _unquote(s)
    if items is not None:
        return [t for t in (_tidy(x) for x in items) if t]
    parts: list[str] = []
    for stretch in HARD.split(s):
        guests = [m for m in GUEST.finditer(stretch) if not any(a < m.start() and m.end() <= b for a, b in known.spans(stretch))] if ("(" in stretch or "[" in stretch or "{" in stretch) else []
        at = 0
        for m in guests:
            parts += _segment(stretch[at : m.start()], known)
            parts += _segment(m.group(2), known)
            at = m.end()
        parts += _segment(stretch[at:], known)
    return [t for t in (_tidy(p) for p in parts) if t]


def cached_splitter(names):
    """split_names over a fixed dictionary, remembering what it has split: names repeat."""
    known = Known(names)
    return lru_cache(maxsize=200_000)(lambda text: tuple(split_names(text, known)))

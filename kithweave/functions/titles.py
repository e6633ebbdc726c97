"""Variants of a title by which of its bracketed stretches are kept."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F

_PAIRS = {")": "(", "]": "[", "}": "{"}
_BRACKET = re.compile(r"[\[({]([^\[\](){}]*)[\])}]")


def _squeeze(s: str) -> str:
    return " ".join(s.split())


def drop_articles(title: str) -> str:
    """Without one article at either end."""
    w = title.split()
    if w and w[0].upper() in ("A", "AN", "THE"):
        w = w[1:]
    if w and w[-1].upper() in ("A", "AN", "THE"):
        w = w[:-1]
    return " ".join(w)


def drop_unmatched(title: str) -> str:
    """Without brackets that have no partner."""
    open_, keep = [], [True] * len(title)
    for i, ch in enumerate(title):
        if ch in "([{":
            open_.append(i)
        elif ch in _PAIRS:
            if open_ and title[open_[-1]] == _PAIRS[ch]:
                open_.pop()
            else:
                keep[i] = False
    for i in open_:
        keep[i] = False
    return _squeeze("".join(ch for ch, k in zip(title, keep) if k))


def balance(text: str) -> str:
    """Closers without an opener are dropped, wrong closers turned into the right ones, missing ones added at the end."""
    want, out = [], []
    close = {v: k for k, v in _PAIRS.items()}
    for ch in text:
        if ch in close:
            want.append(close[ch])
        elif ch in _PAIRS:
            if not want:
                continue
            ch = want.pop()
        out.append(ch)
    return "".join(out) + "".join(reversed(want))


def title_variants(title: str | None) -> list[str]:
    """Sorted variants of a title, without the title itself; brackets that stand side by side are a group.

    The text alone; with the first bracket of every group; of the first and the last group; of the last group; and for a title that opens with a bracket, that bracket's
    content before the text, and alone where another bracket touches it.
    """
    if not title:
        return []
    clean = drop_unmatched(title)
    found = list(_BRACKET.finditer(clean))
    own = drop_articles(title.upper())
    if not found:
        bare = drop_articles(clean) if re.search(r"[\[\](){}]", title) else ""
        return [bare] if bare else []
    # the title as a list of texts and of groups of brackets
    texts, groups, at = [], [], 0
    for m in found:
        between = clean[at : m.start()]
        if groups and not between.strip():
            groups[-1].append(m)
        else:
            texts.append(between)
            groups.append([m])
        at = m.end()
    texts.append(clean[at:])

    def build(kept: set[int]) -> str:
        parts = [texts[0]]
        for i, g in enumerate(groups):
            parts += [g[0].group(1) if i in kept else "", texts[i + 1]]
        return drop_articles(_squeeze(" ".join(parts)))

    last = len(groups) - 1
    made = [drop_articles(_squeeze(_BRACKET.sub("", clean))), build(set(range(last + 1)))]
    if last:
        made += [build({0, last}), build({last})]
    if found[0].start() == 0:
        head = _squeeze(found[0].group(1))
        made.append(drop_articles(_squeeze(head + " " + _BRACKET.sub("", clean[found[0].end() :]))))
        if len(found) > 1 and found[1].start() == found[0].end():
            made.append(drop_articles(head))
    return sorted({v for v in made if v and v.upper() != own})


def title_variants_col(c):
    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([title_variants(t) for t in s], dtype=object)

    return run(F.col(c) if isinstance(c, str) else c)

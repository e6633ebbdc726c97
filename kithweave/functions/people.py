"""Names of people compared over all ways to read them, and names counted in points."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import functions as F

from .similarity import edit_ratio, indel_ratio, jaro_winkler

# Particles that open a surname, and suffixes that follow a name.
PARTICLES = {"VAN", "VON", "DE", "DER", "LA", "LE", "DI", "DEL", "DOS", "DA", "DU", "AL", "EL", "JESUS", "CHAVEZ"}
SUFFIXES = ("SENIOR", "SNR", "SR", "JUNIOR", "JNR", "JR")
# Words at the end of names of ensembles.
ENSEMBLES = {"ORCHESTRA", "QUARTET", "QUINTET", "TRIO", "DUO", "BAND", "CHOIR", "ENSEMBLE", "SINGERS", "PHILHARMONIC", "SYMPHONY", "PLAYERS", "GROUP", "COLLECTIVE", "BROTHERS", "SISTERS"}
#: Least similarity of surnames to read on, weights of surname, given and middle name where surnames are close and where they are fair.
LEAST_LAST, CLOSE, FAIR = 0.7, (0.60, 0.35, 0.05), (0.75, 0.20, 0.05)


class Reading(NamedTuple):
    first: str
    last: str
    middle: str = ""


def comparison_form(name: str) -> str:
    name = re.sub(r"\([^)]*\)", "", name or "").upper().strip()
    name = re.sub(r"\b(?:I{1,3}|IV|V|1ST|2ND|3RD|[4-9]TH)$", "", name).strip()
    return " ".join(name.replace("-", " ").split())


@lru_cache(maxsize=100_000)
def readings(name: str) -> tuple[Reading, ...]:
    """The ways to read a name: which words are the surname, the given name and the middle name."""
    w = comparison_form(name).split()
    for s in SUFFIXES:
        if s in w and len(w) > 1:
            w.remove(s)
            break
    if not w:
        return ()
    if len(w) == 1:
        return (Reading("", w[0]),)
    cut = lambda i, j: " ".join(w[i:j])
    n, out = len(w), []
    at = next((i for i, x in enumerate(w) if x in PARTICLES), None)
    if at == 0:  # the surname opens the name
        out += [Reading("", cut(0, n))] if n == 2 else [Reading(w[1], f"{w[0]} {w[2]}", cut(3, n)), Reading(w[2], cut(0, 2), cut(3, n))]
    elif at is not None:
        out.append(Reading(cut(0, at), cut(at, n)))
    if n == 2:
        out += [Reading(w[0], w[1]), Reading(w[1], w[0])]
    else:
        out += [Reading(w[1], w[0], cut(2, n)), Reading(w[0], w[-1], cut(1, n - 1))]
        out += [Reading(cut(0, n - 1), w[-1]), Reading(w[-1], cut(0, n - 1)), Reading(cut(2, n), cut(0, 2)), Reading(cut(0, n - 2), cut(n - 2, n))]
    return tuple(dict.fromkeys(out))


@lru_cache(maxsize=200_000)
def _ratio(a: str, b: str) -> float:
    return 1.0 if a == b and a else edit_ratio(a, b)


def reading_score(x: Reading, y: Reading, last: float | None = None) -> float:
    """How well two readings agree; surnames carry most of the weight."""
    last = _ratio(x.last, y.last) if last is None else last
    if last < 0.8:
        return last * 0.7
    one_letter = (len(x.first) == 1) != (len(y.first) == 1)
    if not x.first or not y.first:
        first = 0.0 if x.first or y.first else 1.0
    elif last >= 0.9 and one_letter:
        first = 0.95 if x.first[0] == y.first[0] else 0.0
    else:
        first = _ratio(x.first, y.first)
    if x.middle and y.middle:
        middle = _ratio(x.middle, y.middle)
    else:
        middle = 1.0 if x.middle == y.middle else 0.9 if last >= 0.9 else 0.6
    weights = CLOSE if last >= 0.95 else FAIR
    return min(1.0, sum(w * s for w, s in zip(weights, (last, first, middle))))


class NameMatch(NamedTuple):
    jaro_winkler_score: float
    enhanced_score: float
    best_format_match: float
    normalized_match: float
    last_name_match: float


NO_MATCH = NameMatch(0.0, 0.0, 0.0, 0.0, 0.0)


def match_names(a: str | None, b: str | None, empty_equal: bool = False) -> NameMatch:
    """Two names compared as written, normalised, and over all readings of both; the best of the three is the score.

    Null and empty names match nothing. Names that normalise to nothing match nothing either, unless empty_equal.
    """
    if not a or not b:
        return NO_MATCH
    x, y = comparison_form(a), comparison_form(b)
    whole = (1.0 if empty_equal else 0.0) if not x and not y else 1.0 if x == y else _ratio(x, y)
    last = best = 0.0
    for p in readings(a):
        for q in readings(b):
            s = _ratio(p.last, q.last)
            last = max(last, s)
            if s >= LEAST_LAST:
                best = max(best, reading_score(p, q, s))
    jw = jaro_winkler(a, b)
    return NameMatch(jw, max(jw, whole, best), best, whole, last)


MATCH_TYPE = ", ".join(f"{f} double" for f in NameMatch._fields)


def match_names_col(a, b):
    """match_names as a struct column."""

    @F.pandas_udf(MATCH_TYPE)
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        known = lru_cache(maxsize=200_000)(match_names)
        return pd.DataFrame([known(p, q) for p, q in zip(x, y)], columns=list(NameMatch._fields), dtype="float64")

    return run(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def plain_reading(name: str | None) -> Reading:
    """One reading: an initial tells the given name, a particle opens the surname, else the first word is the given name."""
    w = (name or "").split()
    if len(w) < 2:
        return Reading("", w[0] if w else "")
    if len(w) == 2 and len(w[1]) == 1:
        return Reading(w[1], w[0])
    at = next((i for i, x in enumerate(w[:-1]) if x in PARTICLES), None)
    if at is not None and not (len(w) == 2 and len(w[0]) == 1):
        return Reading(" ".join(w[:at]), " ".join(w[at:]))
    return Reading(w[0], " ".join(w[1:]))


def name_points(name: str | None) -> float:
    """2 for a surname, 1 for a given name, 0.5 for an initial."""
    r = plain_reading(name)
    return (2 if r.last else 0) + (0 if not r.first else 0.5 if len(r.first) == 1 else 1)


def _points(x: Reading, y: Reading, least: float) -> float:
    score = 0.0
    if x.last and y.last:
        score += 2 if x.last == y.last else 1.5 if indel_ratio(x.last, y.last) >= least else 0
    if x.first and y.first:
        if x.first == y.first:
            score += 1
        elif len(x.first) == len(y.first) == 1:
            return 0.0
        elif min(len(x.first), len(y.first)) == 1:
            score += 0.5 * (x.first[0] == y.first[0]) or 0.5 * (indel_ratio(x.first, y.first) >= least)
        else:
            score += 0.5 * (indel_ratio(x.first, y.first) >= least)
    return score


def pair_points(a: str | None, b: str | None, least: float = 0.93) -> float:
    """Points of the best of both orders of two-word names. Differing initials give none."""
    def both(name):
        w = (name or "").split()
        return [plain_reading(name)] + ([Reading(w[1], w[0])] if len(w) == 2 else [])

    return max(_points(x, y, least) for x in both(a) for y in both(b))


def assign(a: list[str], b: list[str]) -> dict:
    """Names of two sides paired one to one, the best pairs first; ties by position on side b, then a. Totals are of points."""
    pairs = [(pair_points(x, y), j, i) for j, y in enumerate(b) for i, x in enumerate(a)]
    used_a, used_b, taken = set(), set(), []
    for s, j, i in sorted((p for p in pairs if p[0] > 0), key=lambda p: (-p[0], p[1], p[2])):
        if i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            taken.append((i, j, s))
    atap, stap, smp = sum(map(name_points, a)), sum(map(name_points, b)), sum(t[2] for t in taken)
    tap = max(atap, stap)
    return {"atap": atap, "stap": stap, "tap": tap, "smp": smp, "percent": round(100 * smp / tap) if tap else 0, "pairs": taken}


def different_ensembles(a: str, b: str) -> bool:
    """Do both names end with one word for an ensemble and differ in all else?"""
    x, y = a.upper().split(), b.upper().split()
    return bool(x and y) and x[-1] == y[-1] and x[-1] in ENSEMBLES and not set(x[:-1]) & set(y[:-1])


def rule_score(a: str | None, b: str | None) -> float:
    """Names of acts by rules, the first that applies: ensembles that differ 0, equal 1, equal without brackets, in another order or without the article 0.98,
    all words of one in the other 0.95, a shared part 0.9, else the sequence ratio where it is 0.8 or more."""
    from .splitting import SOFT
    from .similarity import sequence_ratio

    if not a or not b:
        return 0.0
    x, y = a.upper().strip(), b.upper().strip()
    if x == y:
        return 1.0
    if different_ensembles(x, y):
        return 0.0
    clean = lambda s: " ".join(w for w in re.findall(r"[^\W_]+", re.sub(r"\([^)]*\)", " ", s)) if w != "THE")
    p, q = clean(x), clean(y)
    if p and (p == q or sorted(p.split()) == sorted(q.split())):
        return 0.98
    ws, vs = set(p.split()), set(q.split())
    if min(len(ws), len(vs)) > 1 and (ws <= vs or vs <= ws):
        return 0.95
    parts = lambda s: {clean(t) for t in SOFT.split(s)} - {""}
    if parts(x) & parts(y):
        return 0.9
    r = sequence_ratio(p, q)
    return r if r >= 0.8 else 0.0

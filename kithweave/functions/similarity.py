"""String similarities that Spark lacks: plain functions, and column functions over Arrow batches that remember pairs."""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F


def jaro(a: str, b: str, whole_transpositions: bool = True) -> float:
    """Jaro similarity. whole_transpositions: an odd half transposition is dropped."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = bytearray(len(b))
    left = []
    for i, ch in enumerate(a):
        j = b.find(ch, max(0, i - reach), i + reach + 1)
        while j >= 0 and taken[j]:
            j = b.find(ch, j + 1, i + reach + 1)
        if j >= 0:
            taken[j] = 1
            left.append(ch)
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(left, (b[j] for j in range(len(b)) if taken[j])))
    t = moved // 2 if whole_transpositions else moved / 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def jaro_winkler(a: str | None, b: str | None, whole_transpositions: bool = True) -> float:
    """Jaro similarity raised by a common prefix of up to four characters; 0 for null and empty."""
    if not a or not b:
        return 0.0
    j = jaro(a, b, whole_transpositions)
    p = 0
    while p < min(4, len(a), len(b)) and a[p] == b[p]:
        p += 1
    return j + p * 0.1 * (1 - j)


def edit_distance(a: str, b: str) -> int:
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return row[-1]


def edit_ratio(a: str | None, b: str | None) -> float:
    """1 - distance / longer length on trimmed capitals; 0 if either is empty."""
    a, b = (a or "").strip().upper(), (b or "").strip().upper()
    return (1 - edit_distance(a, b) / max(len(a), len(b))) if a and b else 0.0


def indel_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths, as the common fuzzy-matching libraries have it."""
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        corner = 0
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], corner + 1 if x == y else max(row[j], row[j - 1])
    return 2 * row[-1] / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """Similarity of the shared words with and without what each side has besides."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared = " ".join(sorted(x & y))
    one, two = (f"{shared} {' '.join(sorted(s))}".strip() for s in (x - y, y - x))
    if shared and (x <= y or y <= x):
        return 1.0
    return max(indel_ratio(one, two), *( (indel_ratio(shared, one), indel_ratio(shared, two)) if shared else (0.0,) ))


def weighted_ratio(a: str, b: str) -> float:
    """The best of the plain ratio and 0.95 of the ratios over sorted and over shared words."""
    sort = lambda s: " ".join(sorted(s.split()))
    return max(indel_ratio(a, b), 0.95 * indel_ratio(sort(a), sort(b)), 0.95 * token_set_ratio(a, b))


def crude_similarity(a: str, b: str) -> float:
    """Mean of the ratio of lengths and the share of common characters."""
    if not a or not b:
        return 0.0
    common = sum((Counter(a) & Counter(b)).values())
    return (min(len(a), len(b)) / max(len(a), len(b)) + common / max(len(a), len(b))) / 2


def sequence_ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def _column(fn):
    def over(a, b):
        @F.pandas_udf("double")
        def run(x: pd.Series, y: pd.Series) -> pd.Series:
            known = lru_cache(maxsize=100_000)(fn)
            return pd.Series([known(p or "", q or "") for p, q in zip(x, y)], dtype="float64")

        return run(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)

    return over


jaro_winkler_col = _column(jaro_winkler)
jaro_winkler_half_col = _column(lambda a, b: jaro_winkler(a, b, whole_transpositions=False))
token_set_col, weighted_ratio_col, sequence_col, crude_col = _column(token_set_ratio), _column(weighted_ratio), _column(sequence_ratio), _column(crude_similarity)


def may_reach(a, b, least: float):
    """A lossless test before Jaro-Winkler >= least, inside the JVM.

    No more characters can match than either text shares with the other, so Jaro is at most (m / length + m / other length + 1) / 3; and the common
    prefix of p characters tells which Jaro is needed.
    """
    share = max(0.0, 3 * (least - 0.4) / 0.6 - 2)
    x, y = F.length(a), F.length(b)
    a_, b_ = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
    lengths = F.least(x, y) >= share * F.greatest(x, y) - 1e-9
    m = F.least(x - F.length(F.call_function("translate", a_, b_, F.lit(""))), y - F.length(F.call_function("translate", b_, a_, F.lit(""))))
    p = F.lit(0)
    for n in (1, 2, 3, 4):
        p = F.when((x >= n) & (y >= n) & (F.substring(a_, 1, n) == F.substring(b_, 1, n)), n).otherwise(p)
    return lengths & ((m / x + m / y + 1) / 3 >= (least - 0.1 * p) / (1 - 0.1 * p) - 1e-9)

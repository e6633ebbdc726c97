"""Pairs of similar texts of two lists: matrices of what any two have in common leave out those that can't reach a score, and the rest is scored exactly."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .people import CLOSE, FAIR, comparison_form, match_names, readings
from .similarity import jaro_winkler

#: What rounding in single precision may take from a bound.
SLACK = 1e-4
#: Pairs that are scored at once.
PAIRS = 20_000


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters as numbers, a row for each text, 0 beyond its end; and the lengths."""
    lengths = np.array([len(t) for t in texts], dtype=np.float32)
    width = max(int(lengths.max(initial=0)), 1)
    return np.array([t.replace("\0", "￾") for t in texts], dtype=f"U{width}").view(np.uint32).reshape(len(texts), width), lengths


def _numbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of both sides, and the rows by their numbers among these."""
    both = np.concatenate([a.ravel(), b.ravel()])
    if both.max(initial=0) < 1 << 12:
        seen = np.zeros(int(both.max(initial=0)) + 1, dtype=bool)
        seen[both] = True
        values, at = np.flatnonzero(seen), (np.cumsum(seen) - 1)[both]
    else:
        values, at = np.unique(both, return_inverse=True)
    return values, at[: a.size].reshape(a.shape), at[a.size :].reshape(b.shape)


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A column for each character and number of times that a row of both sides has it so often; their product counts the shared characters."""
    values, *both = _numbered(a, b)
    n, sides = len(values), []
    for rows, codes in zip((a, b), both):
        times = np.bincount((codes + n * np.arange(len(rows))[:, None]).ravel(), minlength=n * len(rows)).reshape(len(rows), n)
        times[:, values == 0] = 0
        sides.append(times)
    most = np.minimum(*(t.max(axis=0, initial=0) for t in sides))
    column, least = np.repeat(np.arange(n), most), np.concatenate([np.arange(1, k + 1) for k in most] or [[]])
    return tuple((t[:, column] >= least).astype(np.float32) for t in sides)


def shared_characters(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many characters each row of a has in common with each of b, repeated ones as often as both have them."""
    left, right = _counted(a, b)
    return left @ right.T


def _reaching(a, b, least: float, same: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the rows that similarity.may_reach lets through. The longest prefix needs the least: only the pairs that would do with it are looked at one by one."""
    (a, la), (b, lb) = a, b
    need = np.array([3 * (least - 0.1 * p) / (1 - 0.1 * p) - 1 - SLACK for p in range(5)], dtype=np.float32)
    m = shared_characters(a, b)
    m *= (1 / np.maximum(la, 1))[:, None] + (1 / np.maximum(lb, 1))[None, :]
    may = (m >= need.min()) & (m > 0)
    if same is not None:
        may &= same
    i, j = np.nonzero(may)
    p, going = np.zeros(len(i), dtype=np.int8), np.ones(len(i), dtype=bool)
    for n in range(min(4, a.shape[1], b.shape[1])):
        going &= (a[i, n] == b[j, n]) & (a[i, n] > 0)
        p += going
    reach = m[i, j] >= need[p]
    return i[reach], j[reach]


def _may_reach(xs: list[str], ys: list[str], least: float) -> np.ndarray:
    """As similarity.may_reach, for any two."""
    out = np.zeros((len(xs), len(ys)), dtype=bool)
    out[_reaching(_codes(xs), _codes(ys), least)] = True
    return out


#: Texts up to so many characters are compared by the bits of one number.
BITS = 64


def jaro_winkler_of(a, b, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """similarity.jaro_winkler of rows i of a and j of b, none of them empty or longer than BITS, all pairs at once: where a character stands in a text of b are the bits of a number."""
    (a, la), (b, lb) = a, b
    values, x, y = _numbered(a, b)
    n = len(values)
    places = np.zeros(len(b) * n, dtype=np.uint64)
    for k in range(min(b.shape[1], BITS)):
        # a row has one character at a place, so no index comes twice
        places[np.arange(len(b)) * n + y[:, k]] |= np.uint64(1) << np.uint64(k)
    la, lb, row = la[i].astype(np.int64), lb[j].astype(np.int64), j * n
    one, reach = np.uint64(1), np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    near, taken, left = (one << (reach + 1).astype(np.uint64)) - one, np.zeros(len(i), dtype=np.uint64), np.zeros(len(i), dtype=np.uint64)
    width = int(la.max(initial=0))
    for k in range(width):
        free = places[row + x[i, k]] & near & ~taken
        free[la <= k] = 0
        first = free & (~free + one)
        taken |= first
        left |= (first != 0).astype(np.uint64) << np.uint64(k)
        near = (near << one) | (k < reach).astype(np.uint64)
    m, moved, rest = np.bitwise_count(taken).astype(np.int64), np.zeros(len(i), dtype=np.int64), taken.copy()
    for k in range(width):
        has = (left >> np.uint64(k)) & one != 0
        first = np.where(has, rest & (~rest + one), np.uint64(0))
        moved += has & (places[row + x[i, k]] & first == 0)
        rest ^= first
    some = np.maximum(m, 1)
    jaro = np.where(m > 0, (m / la + m / lb + (m - moved // 2) / some) / 3, 0.0)
    p, going = np.zeros(len(i), dtype=np.int64), np.ones(len(i), dtype=bool)
    for k in range(min(4, a.shape[1], b.shape[1])):
        going &= (a[i, k] == b[j, k]) & (a[i, k] > 0)
        p += going
    return jaro + p * 0.1 * (1 - jaro)


def _may_edit(a, b, least: float) -> np.ndarray:
    """Whether an edit ratio of `least` is within reach: the distance is no less than what the longer text has beyond the shared characters."""
    most = np.maximum(a[1][:, None], b[1][None, :])
    return (shared_characters(a[0], b[0]) >= least * most - SLACK) & (most > 0)


def _may_read(xs: list[str], ys: list[str], least: float) -> np.ndarray:
    """Whether two readings may reach a score of `least`: by their surnames, and by their given names or initials."""
    x, y = [(i, r) for i, t in enumerate(xs) for r in readings(t)], [(i, r) for i, t in enumerate(ys) for r in readings(t)]
    out = np.zeros((len(xs), len(ys)), dtype=bool)
    if not x or not y:
        return out
    # all but the surname, or all but the given name, at its best; surnames are close from 0.95 on
    last = max(0.8, min(max(0.95, (least - 1 + CLOSE[0]) / CLOSE[0]), (least - 1 + FAIR[0]) / FAIR[0]))
    first = min((least - 1 + CLOSE[1]) / CLOSE[1], (least - 0.95 * FAIR[0] - FAIR[2]) / FAIR[1])
    surnames = _may_edit(_codes([r.last for _, r in x]), _codes([r.last for _, r in y]), last)
    (a, la), (b, lb) = _codes([r.first for _, r in x]), _codes([r.first for _, r in y])
    one = (la == 1)[:, None] != (lb == 1)[None, :]
    given = _may_edit((a, la), (b, lb), first) | ((la == 0)[:, None] & (lb == 0)[None, :]) | (one & (a[:, 0, None] == b[None, :, 0]))
    i, j = np.nonzero(surnames & given)
    out[np.array([n for n, _ in x])[i], np.array([n for n, _ in y])[j]] = True
    return out


def _near(may, score, xs, ys, least, same):
    if same is not None:
        may = may & same
    for i, j in zip(*(v.tolist() for v in np.nonzero(may))):
        s = score(xs[i], ys[j])
        if s >= least:
            yield i, j, s


def near_jaro_winkler(xs: list[str], ys: list[str], least: float, same: np.ndarray | None = None):
    """(i, j, score) of the pairs whose Jaro-Winkler similarity is `least` or more; same: the pairs that count."""
    a, b = _codes(xs), _codes(ys)
    i, j = _reaching(a, b, least, same)
    short = (a[1][i] <= BITS) & (b[1][j] <= BITS)
    for p, q in zip(i[~short].tolist(), j[~short].tolist()):
        if (s := jaro_winkler(xs[p], ys[q])) >= least:
            yield p, q, s
    i, j = i[short], j[short]
    for n in range(0, len(i), PAIRS):
        p, q = i[n : n + PAIRS], j[n : n + PAIRS]
        s = jaro_winkler_of(a, b, p, q)
        yield from zip(*(v[s >= least].tolist() for v in (p, q, s)))


@lru_cache(maxsize=200_000)
def _names_score(a: str, b: str) -> float:
    return match_names(a, b).enhanced_score


#: Below this score, readings with no given name on one side, or with surnames that differ much, might count.
LEAST_NAMES = 0.85


def near_names(xs: list[str], ys: list[str], least: float, same: np.ndarray | None = None):
    """The same by people.match_names."""
    if least < LEAST_NAMES:
        raise ValueError(f"names can be told by their parts from {LEAST_NAMES} on")
    whole = _may_edit(_codes([comparison_form(t) for t in xs]), _codes([comparison_form(t) for t in ys]), least)
    may = _may_reach(xs, ys, least) | whole | _may_read(xs, ys, least)
    return _near(may, _names_score, xs, ys, least, same)

"""Splitting of packed names against a plain dynamic programme over every part, and the query against the function row by row."""

import os
import random

import pytest

from kithweave.functions import splitting as sp
from kithweave.operators import split
from kithweave.runtime import table

DIR = os.environ.get("KITHWEAVE_TEST_TABLES", "/root/testdata/sf0.001")
FOURTEEN = ", ".join(f"Uncle {c}" for c in "ABCDEFGHIJKLM") + " & Sons"
KNOWN = ["Simon, Garfunkel & Co", "Earth/Wind/Fire", "Straße & Weg", "AC/DC", FOURTEEN]


def brute(text, known):
    """The cheapest cover, every part's cost computed from its text."""
    cuts = [(m.start(), m.end()) for m in sp.SOFT.finditer(text) if m.end() > m.start()]
    if not cuts:
        return [text]
    spans = set(known.spans(text))
    starts, ends = [0] + [y for _, y in cuts], [x for x, _ in cuts] + [len(text)]
    best = [(0.0, [])]
    for j in range(len(starts)):
        options = []
        for i in range(j + 1):
            a, b = starts[i], ends[j]
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            part = text[a:b]
            core = sp.CREDIT.sub("", part)
            is_known = (a, b) in spans or (core != part and (b - len(core), b) in spans)
            commas = sum("," in text[slice(*c)] or "，" in text[slice(*c)] for c in cuts[i:j])
            options.append((best[i][0] + sp._cost(core, j - i, is_known, commas), i, part))
        cost, i, part = min(options)
        best.append((cost, best[i][1] + ([part] if part else [])))
    return best[-1][1]


@pytest.mark.parametrize("near", [2, 3, 12])
@pytest.mark.parametrize("automaton", [True, False])
def test_cover_is_the_cheapest(near, automaton):
    known = sp.Known(KNOWN)
    if not automaton:
        known.automaton = None
        for n in known.names:
            node = known.trie
            for ch in n:
                node = node.setdefault(ch, {})
            node[""] = n
    rng = random.Random(near)
    pieces = ["Ella Weiss", "Ella Weiß", "Prince", "by", "written by Ann Lee", "by Cher", "AC/DC", "Earth/Wind/Fire", "simon, garfunkel & co", "Straße & Weg", "The Cure", "Lee, Ann", "a", "", "N/A", FOURTEEN, "words and music by Jo"]
    for _ in range(250):
        text = "".join(rng.choice(pieces) + rng.choice([" / ", "/", ", ", ",", " & ", " and ", " feat. ", "&"]) for _ in range(rng.randint(1, 22))) + rng.choice(pieces)
        assert sp._segment(text, known, near) == brute(text, known), text


def test_known_names_stay_whole():
    known = sp.Known(KNOWN)
    assert sp.split_names(FOURTEEN, known) == [FOURTEEN] and sp.split_names(f"Ann Lee / {FOURTEEN.upper()}", known) == ["Ann Lee", FOURTEEN.upper()]
    assert sp.split_names("Simon, Garfunkel & Co / Ella Weiß", known) == ["Simon, Garfunkel & Co", "Ella Weiß"]
    assert sp.split_names("ﬁne Day / Simon, Garfunkel & Co", known) == ["ﬁne Day", "Simon, Garfunkel & Co"]
    assert sp.split_names("STRAßE & WEG & Ann Lee", known) == ["STRAßE & WEG", "Ann Lee"]


def test_very_long_field():
    names = [f"Ann{i} Lee{i}" for i in range(20_000)]
    assert sp.split_names(" / ".join(names), sp.Known(KNOWN)) == names
    assert sp.split_names("/".join("x" * 40 for _ in range(20_000)), sp.Known([]))[0].count("/") == 19_999


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_queries_against_row_by_row(spark):
    known = sp.Known(split.known_names(spark, DIR))
    want = set()
    for t, i, c in (("recordings", "recordings_id", "artist_name"), ("composers", "composer_id", "composer")):
        for r in table(spark, DIR, t).select(i, c).collect():
            want |= {(t, str(r[0]) if r[0] is not None else None, n, v, len(parts)) for parts in [sp.split_names(r[1], known)] for n, v in enumerate(parts, 1)}
    assert {tuple(r) for r in split.p7_all_names(spark, DIR).collect()} == {w[:4] for w in want} and len(want) > 100
    found = split.p7_found(spark, DIR).collect()
    assert {tuple(r) for r in found} == {w[:4] for w in want if w[4] > 1} and len(found) == len({tuple(r) for r in found})

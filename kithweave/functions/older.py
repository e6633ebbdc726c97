"""Older forms of the cleansers and matchers, where their results differ from the present ones."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .people import PARTICLES, SUFFIXES, Reading, name_points, plain_reading
from .similarity import edit_ratio, indel_ratio, jaro_winkler
from .strings import squeeze

# Words that the older cleanser of names leaves out, in the order in which it does.
STOP_WORDS = ["A", "AN", "THE", "BAND", "FEAT", "FEAT.", "FT", "FT.", "AND", "ORCHESTRA", "ORCHES", "QUARTET", "WITH", "HIS", "HER"]
# Characters and words between names in the older expansion.
EXPANSION_MARKS = "|/#\\,;'\"`-_&+]["
EXPANSION_WORDS = ["A", "AN", "THE", "AND", "FT", "FT.", "FEAT", "FEAT.", "BAND", "WITH", "QUARTET", "ORCHES", "ORCHESTRA", "HIS", "HER"]
# Ends of names of ensembles that many ensembles share.
ENSEMBLE_ENDS = [
    "& HIS ORCHESTRA", "AND HIS ORCHESTRA", "& HER ORCHESTRA", "AND HER ORCHESTRA", "& THE ORCHESTRA", "AND THE ORCHESTRA", "& HIS BAND", "AND HIS BAND", "& THE BAND", "AND THE BAND",
    "ORCHESTRA", "BAND", "QUARTET", "TRIO", "DUO", "PHILHARMONIC", "SYMPHONY", "PHILHARMONIC ORCHESTRA", "SYMPHONY ORCHESTRA", "CHOIR", "KARAOKE", "BRASS BAND",
]
# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_title(c: Column) -> Column:
    """Lower case, no leading article, no ASCII punctuation, single blanks; empty for null. A sigma is one letter wherever it stands in a word."""
    out = F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), "ς", "σ"), r"^(a|an|the)\s+", "")
    return squeeze(F.translate(out, PUNCTUATION, ""))


def late_upper(c: Column, kind: str = "clean") -> Column:
    """Forms made before the text is put into capitals, so that all but capitals and digits is lost: clean (blanks for the rest), compact, no_article."""
    clean = F.regexp_replace(c, r"[^A-Z0-9\s]", " ")
    out = {"clean": clean, "compact": F.regexp_replace(c, "[^A-Z0-9]", ""), "no_article": F.regexp_replace(clean, r"^(THE|A|AN)\s+", "")}
    return F.upper(out[kind])


def stop_word_name(c: Column) -> Column:
    """Capitals without bracketed text, marks as blanks, letters, digits and single blanks only, and without STOP_WORDS; what was there before where nothing is left."""
    bare = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"\([^)]*\)", "")
    spaced = F.regexp_replace(bare, r"['\"`\-_&+\[\]]", " ")
    kept = squeeze(F.regexp_replace(spaced, "[^a-zA-Z0-9 ]", ""))
    less = kept
    for w in STOP_WORDS:
        less = F.regexp_replace(less, rf"\b{w}\b", " ")
    less = squeeze(less)
    return F.when(kept == "", bare).when(less == "", F.trim(spaced)).otherwise(less)


def expansion_parts(c: Column) -> Column:
    """Every mark and every word of EXPANSION_WORDS becomes a slash, one after the other, and the text is cut at the slashes; parts of three and more characters that differ
    from the text."""
    out = F.translate(F.upper(c), EXPANSION_MARKS, "/" * len(EXPANSION_MARKS))
    for w in EXPANSION_WORDS:
        out = F.trim(F.replace(F.concat(F.lit(" "), out, F.lit(" ")), F.lit(f" {w} "), F.lit("/")))
    return F.filter(F.transform(F.split(out, "/"), lambda p: F.trim(p)), lambda p: (F.length(p) > 2) & (p != c))


def stored_numbers(c: Column) -> Column:
    """A list of numbers kept as text: JSON, or the digits between commas where it is none; empty for null and empty."""
    loose = F.filter(F.split(F.regexp_replace(c, r"[\[\]\s]", ""), ","), lambda x: x != "")
    return F.coalesce(F.from_json(c, "array<bigint>"), F.transform(loose, lambda x: x.cast("bigint")), F.array().cast("array<bigint>"))


def words_overlap(a: Column, b: Column) -> Column:
    """Words of a that b has, repeats counted, over the larger number of words; 0 where either has none."""
    x, y = (F.filter(F.split(c, " "), lambda w: w != "") for c in (a, b))
    most = F.greatest(F.size(x), F.size(y))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.filter(x, lambda w: F.array_contains(y, w))) / most).otherwise(0.0)


# --- names ------------------------------------------------------------------------------------------------------------------------
def _older_readings(name: str) -> list[Reading]:
    w = [x for x in re.sub(r"[^\w\s]", " ", name.upper()).split() if x not in SUFFIXES]
    if len(w) < 2:
        return [Reading("", w[0] if w else "")]
    return [Reading(w[0], w[-1], " ".join(w[1:-1])), Reading(w[-1], w[0], " ".join(w[1:-1]))]


def older_name_score(a: str | None, b: str | None) -> float:
    """The earlier matcher: 1 for equal names, for a name turned round and for the same words in any order; else the best reading of both, surname .65, given name .30, middle
    name .05, an initial that fits counting .9; never less than Jaro-Winkler. 0 for null and empty."""
    if not a or not b:
        return 0.0
    x, y = (" ".join(re.sub(r"[^\w\s]", " ", n.upper()).split()) for n in (a, b))
    if not x or not y:
        return 0.0
    if x == y or sorted(x.split()) == sorted(y.split()):
        return 1.0

    def part(p: str, q: str) -> float:
        if p == q:
            return 1.0
        if not p or not q:
            return 0.0
        if min(len(p), len(q)) == 1:
            return 0.9 if p[0] == q[0] else 0.0
        return edit_ratio(p, q)

    best = max(0.65 * part(p.last, q.last) + 0.30 * part(p.first, q.first) + 0.05 * part(p.middle, q.middle) for p in _older_readings(a) for q in _older_readings(b))
    return max(best, jaro_winkler(x, y))


LAYOUTS = ("first last", "last first", "particle", "initials", "middle as last")


def layouts(name: str | None) -> list[Reading]:
    """Five ways to lay a name out: as read, turned round, a particle opening the surname, initials as given name, and the middle words as part of the surname."""
    w = (name or "").upper().split()
    if len(w) < 2:
        return [Reading("", w[0])] if w else []
    at = next((i for i, x in enumerate(w) if x in PARTICLES), None)
    some = [plain_reading(" ".join(w)), Reading(w[-1], " ".join(w[:-1]))]
    some.append(Reading(" ".join(w[:at]), " ".join(w[at:])) if at else some[0])
    some.append(Reading(w[0][0], w[-1]) if len(w[0]) > 1 else Reading(w[0], w[-1]))
    some.append(Reading(w[0], " ".join(w[1:])))
    return list(dict.fromkeys(some))


def _layout_points(x: Reading, y: Reading, least: float) -> float:
    last = 2.0 if x.last == y.last and x.last else 1.5 if x.last and y.last and indel_ratio(x.last, y.last) >= least else 0.0
    if not x.first or not y.first:
        return last
    if x.first == y.first:
        return last + (1.0 if len(x.first) > 1 else 0.5)
    if min(len(x.first), len(y.first)) == 1:
        return last + (0.5 if x.first[0] == y.first[0] else 0.0)
    return last + (0.5 if indel_ratio(x.first, y.first) >= least else 0.0)


def layout_similarity(a: str | None, b: str | None, least: float = 0.93, needs_last: bool = False, drop_prefixes: bool = False) -> float:
    """Points of the best pair of layouts over the points of the larger name, at most 1.

    needs_last: without a surname in common the names have nothing in common. drop_prefixes: particles before a surname don't count.
    """
    if not a or not b:
        return 0.0
    strip = lambda r: Reading(r.first, " ".join([w for w in r.last.split() if w not in PARTICLES]) or r.last, r.middle)
    xs, ys = layouts(a), layouts(b)
    if drop_prefixes:
        xs, ys = [strip(r) for r in xs], [strip(r) for r in ys]
    most = max(name_points(a.upper()), name_points(b.upper()))
    best, turned = 0.0, (xs[1], ys[1]) if min(len(xs), len(ys)) > 1 else None
    for x in xs:
        for y in ys:
            if (x, y) == turned:  # both read the wrong way round tell nothing new
                continue
            if needs_last and not (x.last and y.last and (x.last == y.last or indel_ratio(x.last, y.last) >= least)):
                continue
            best = max(best, _layout_points(x, y, least))
    return min(best / most, 1.0) if most else 0.0


_OWNERS = {"HIS", "HER", "THE", "AND"}
_MARKS = re.compile("[" + re.escape("|/#\\,;'\"`-_&+][") + "]")


def ensembles_apart(a: str | None, b: str | None, least_words: int = 2) -> bool:
    """Do two names, or a part of each, end like ensembles of one kind and differ before that? The longest end counts; names that share `least_words` words or more before it,
    or all of the shorter one, are not apart."""
    if not a or not b:
        return False
    cut = lambda n: [n, *(p for p in (x.strip() for x in _MARKS.split(n)) if p)]
    ends = sorted(ENSEMBLE_ENDS, key=len, reverse=True)
    told = lambda n: next(((n[: -len(e)].strip(), e) for e in ends if n.endswith(" " + e)), None)
    for x in cut(a.upper().strip()):
        for y in cut(b.upper().strip()):
            p, q = told(x), told(y)
            if p and q and set(p[0].split()) - _OWNERS and set(q[0].split()) - _OWNERS and p[1].split()[-1] == q[1].split()[-1]:
                u, v = set(p[0].split()), set(q[0].split())
                common = len(u & v)
                if common < min(least_words, len(u), len(v)) and common < min(len(u), len(v)):
                    return True
    return False


def _scores(fn):
    def over(a: str, b: str):
        @F.pandas_udf("double")
        def run(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series([float(fn(p, q)) for p, q in zip(x, y)], dtype="float64")

        return run(F.col(a), F.col(b))

    return over


older_name_score_col, layout_similarity_col, ensembles_apart_col = _scores(older_name_score), _scores(layout_similarity), _scores(ensembles_apart)
last_name_similarity_col = _scores(lambda a, b: layout_similarity(a, b, needs_last=True, drop_prefixes=True))


# --- variants of titles -----------------------------------------------------------------------------------------------------------
_ROUND = re.compile(r"\(([^()]*)\)")


@lru_cache(maxsize=50_000)
def round_bracket_variants(title: str | None) -> tuple[str, ...]:
    """The older variants, round brackets only: the title without them, with the first, with the last, with both ends and, of three groups or more, with those between; in the
    order of the code points, without the title itself."""
    if not title:
        return ()
    groups = list(_ROUND.finditer(title))
    if not groups:
        return ()
    tidy = lambda t: " ".join(t.split())

    def keep(chosen: set[int]) -> str:
        out, at = [], 0
        for i, g in enumerate(groups):
            out += [title[at : g.start()], f" {g.group(1)} " if i in chosen else " "]
            at = g.end()
        return tidy("".join([*out, title[at:]]))

    n = len(groups)
    made = {keep(set()), keep({0}), keep({n - 1}), keep({0, n - 1}), keep(set(range(1, n - 1))) if n > 2 else keep(set())}
    return tuple(sorted(v for v in made if v and v != tidy(title)))


def round_bracket_variants_col(c: str):
    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([list(round_bracket_variants(t)) for t in s], dtype=object)

    return run(F.col(c))


def dash_credit_parts_col(c: str):
    """Parts of a performer's credit by the second version of the splitter, for which a dash after a blank separates too."""
    from .credits import credit_parts

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([credit_parts(v.replace(" -", " / ") if v else v) for v in s], dtype=object)

    return run(F.col(c))

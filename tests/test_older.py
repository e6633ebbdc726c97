"""Older forms of cleansers and matchers, the pipeline over whole titles, and queries without SQL against plain Python over all rows."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kithweave import queries
from kithweave.functions import acts, credits, older, people, similarity, titles
from kithweave.operators import linkage
from kithweave.plans import older as plans
from kithweave.runtime import table

DIR = os.environ.get("KITHWEAVE_TEST_TABLES", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def column(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_cleansers(spark):
    assert column(spark, older.plain_title, ["The  Rock-n'Roll (Live)!", "A", "", None, "THE CAFÉ"]) == ["rocknroll live", "a", "", "", "café"]
    assert column(spark, older.stop_word_name, ["JOE'S BAND (AKA X)", "THE BAND", "(X)", None, "ANN AND HER ORCHESTRA", "BAND OF GOLD"]) == ["JOE S", "THE BAND", "", "", "ANN", "OF GOLD"]
    assert column(spark, older.expansion_parts, ["ANN LEE & THE GOLD", "ANN AND BEN", "ANN", None, "A/BC/DEF"]) == [["ANN LEE", "GOLD"], ["BEN", "ANN"][::-1], [], None, ["DEF"]]
    assert column(spark, older.stored_numbers, ["[1, 2,3]", "4, 5 ,", "[]", "", None, "[ 6\n7 ]"]) == [[1, 2, 3], [4, 5], [], [], [], [67]]
    assert column(spark, older.late_upper, ["BIG Day 9", None]) == ["BIG D   9", None]


def test_older_names():
    s = older.older_name_score
    assert s("JOHN SMITH", "SMITH JOHN") == s("Ann Mary Lee", "LEE ANN MARY") == 1.0 and s(None, "X") == s("", "X") == s("!", "?") == 0.0
    assert s("J SMITH", "JOHN SMITH") == pytest.approx(0.65 + 0.27 + 0.05) and s("JOHN SMITH", "MARY BROWN") < 0.6
    assert all(s(a, b) == s(b, a) for a in ("ANN LEE", "A LEE", "LEE") for b in ("ANNE LEE", "BEN LEO"))


def test_layouts():
    s = older.layout_similarity
    assert s("JOHN SMITH", "SMITH JOHN") == 1.0 and s("JOHN SMITH", "JOHN SMITH") == 1.0 and s(None, "X") == s("", "") == 0.0
    assert s("J SMITH", "JOHN SMITH") == pytest.approx(2.5 / 3) and s("LUDWIG VAN BEETHOVEN", "VAN BEETHOVEN, LUDWIG".replace(",", "")) > 0
    assert s("JOHN SMITH", "JOHN BROWN") > 0 == s("JOHN SMITH", "JOHN BROWN", needs_last=True)
    assert s("LUDWIG VAN BEETHOVEN", "LUDWIG BEETHOVEN", needs_last=True, drop_prefixes=True) == 1.0 > s("LUDWIG VAN BEETHOVEN", "LUDWIG BEETHOVEN", needs_last=True)


def test_ensembles():
    e = older.ensembles_apart
    assert e("GLENN MILLER & HIS ORCHESTRA", "BENNY GOODMAN AND HIS ORCHESTRA") and e("VIENNA PHILHARMONIC", "BERLIN PHILHARMONIC") and e("ANN LEE / GOLD BAND", "BLUE BAND")
    assert not e("GLENN MILLER ORCHESTRA", "GLENN MILLER & HIS ORCHESTRA") and not e("VIENNA PHILHARMONIC", "VIENNA CHOIR") and not e(None, "X BAND") and not e("BAND", "BAND")


def test_round_brackets():
    v = older.round_bracket_variants
    assert v(None) == v("PLAIN") == v("[ONLY] SQUARE") == ()
    assert v("(A) SONG") == ("A SONG", "SONG") and v("ONE (TWO) THREE (FOUR)") == ("ONE THREE", "ONE THREE FOUR", "ONE TWO THREE", "ONE TWO THREE FOUR")
    assert "A C D E" in v("A (B) C (D) E (F)") and len(v("A (B) C (D) E (F)")) == 5


@pytest.mark.parametrize("a,b,want", [("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("LOVE ME", "LOVE ME DO", 0.94), ("SMITH K", "SMITH P", 0.942857), ("TAYLOR D", "DAVID TAYLOR", 0.430556), ("growing away", "running away", 0.7962962962962963), ("winter tango", "winter tan", 0.9666666666666667), ("", "X", 0.0), (None, "X", 0.0)])
def test_golden_jaro_winkler(a, b, want):
    assert similarity.jaro_winkler(a, b) == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("a,b,want", [("JOHN SMITH", "SMITH JOHN", 1.0), ("LENNON JOHN WINSTON", "JOHN LENNON", 0.995), ("TAYLOR D", "DAVID TAYLOR", 0.9825), ("SMITH K", "SMITH P", 0.942857), (None, "X", 0.0)])
def test_golden_names(a, b, want):
    assert people.match_names(a, b).enhanced_score == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize(
    "title,want",
    [("[hey brother]", ["hey brother"]), ("[hello] hey brother", ["hello hey brother", "hey brother"]), ("stay don't go away [", ["stay don't go away"]), ("the a team", []), ("a thousand years [pt. 2] [the twilight saga: breaking dawn soundtrack]", ["thousand years", "thousand years pt. 2"])],
)
def test_golden_variants(title, want):
    assert titles.title_variants(title) == want


# --- whole tables ----------------------------------------------------------------------------------------------------------------
def rows(spark, name):
    df = queries.QUERIES[name](spark, DIR)
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), df.columns


@tables
def test_title_variant_rows(spark):
    want = Counter()
    for r in table(spark, DIR, "adcworks").select("apra_work_id", "title").distinct().collect():
        found = titles.title_variants(r.title)
        want[(r.apra_work_id, r.title, None if found else r.title, False)] += 1
        want.update((r.apra_work_id, r.title, v, True) for v in found)
    got, cols = rows(spark, "ref_title_variants")
    assert cols == ["apra_work_id", "original_title", "title_variant", "is_variant"] and got == want
    n = sum(k[3] for k in want.elements())
    assert rows(spark, "ref_title_variant_counts")[0] == Counter({(sum(want.values()) - n, n, sum(want.values())): 1})


@tables
def test_credit_part_rows(spark):
    want = set()
    for t, i, c, kind in (("recordings", "recordings_id", "artist_name", "artist"), ("composers", "composer_id", "composer", "composer")):
        for r in table(spark, DIR, t).select(i, c).collect():
            want |= {(t, r[0], n, p) for n, p in enumerate(credits.credit_parts(r[1], kind))}
    assert rows(spark, "ref_credit_parts")[0] == Counter(want)
    dashes = {(v, n, p) for v in {r[0] for r in table(spark, DIR, "recordings").select("artist_name").collect()} if v is not None for n, p in enumerate(credits.credit_parts(v.replace(" -", " / ")))}
    assert rows(spark, "ref_dash_parts")[0] == Counter(dashes)


def lists(spark):
    """Names of the works and of the tracks with an equal identifier, by plain Python."""
    key = lambda c: "".join(x for x in (c or "") if x.isascii() and x.isalnum()).upper()
    up = lambda i: (i or "").strip(" ").upper() or None
    works, tracks, a, m = {}, {}, {}, {}
    for r in table(spark, DIR, "adcworks").collect():
        works.setdefault(key(r.iswc), set()).add(r.apra_work_id)
    for r in table(spark, DIR, "tracks").collect():
        tracks.setdefault(key(r.iswc), set()).add(r.track_id.upper())
    for r in table(spark, DIR, "adc_composers").collect():
        if r.name:
            a.setdefault(r.apra_work_id, set()).add(r.name.upper())
    for r in table(spark, DIR, "composers").collect():
        for p in (r.composer or "").upper().replace(";", "/").split("/"):
            if p.strip(" "):
                m.setdefault(up(r.track_id), set()).add(p.strip(" "))
    return {(w, t): (a[w], m[t]) for c in set(works) & set(tracks) - {"", "T0000000000"} for w in works[c] for t in tracks[c] if w in a and t in m}


@tables
def test_name_scores_of_all_pairs(spark):
    both = lists(spark)
    got, cols = rows(spark, "ref_name_matches")
    assert cols[:4] == ["a", "b", "apra_work_id", "track_id"]
    want = Counter((x, y, w, t, *(round(v, 9) for v in people.match_names(x, y))) for (w, t), (xs, ys) in both.items() for x in xs for y in ys)
    assert got == want and len(want) > 20
    pairs = {(x, y) for xs, ys in both.values() for x in xs for y in ys}
    assert rows(spark, "ref_point_scores")[0] == Counter((x, y, round(acts.point_similarity(x, y), 9), round(acts.composition_ratio(x, y), 9)) for x, y in pairs)
    scores = lambda x, y: (older.older_name_score(x, y), older.layout_similarity(x, y), older.layout_similarity(x, y, needs_last=True, drop_prefixes=True), float(older.ensembles_apart(x, y)))
    assert rows(spark, "ref_older_name_scores")[0] == Counter((x, y, *(round(v, 9) for v in scores(x, y))) for x, y in pairs)
    out = Counter()
    for (w, t), (xs, ys) in both.items():
        r = people.assign(sorted(xs), sorted(ys))
        out[(w, t, float(r["atap"]), float(r["stap"]), float(r["tap"]), float(r["smp"]), r["percent"], len(r["pairs"]))] += 1
    assert rows(spark, "ref_assignment")[0] == out


@tables
def test_text_similarities_of_all_pairs(spark):
    got = queries.QUERIES["ref_text_similarities"](spark, DIR).collect()
    t = {(r.x, r.y): r for r in __import__("kithweave.plans.reference", fromlist=["x"])._title_pairs(spark, DIR).collect()}
    assert len(got) == len(t) > 100
    for r in got:
        p = t[r.x, r.y]
        want = (similarity.jaro_winkler(p.fx, p.fy, False), similarity.token_set_ratio(p.fx, p.fy), similarity.weighted_ratio(p.fx, p.fy), similarity.sequence_ratio(p.fx, p.fy), similarity.crude_similarity(p.fx, p.fy))
        assert (r.jw_half, r.token_set, r.weighted, r.sequence, r.crude) == pytest.approx(want, abs=1e-9)


@tables
def test_canonical_titles_against_all_pairs(spark):
    """Variants of both sides, equal or similar within a block of three characters, by plain Python over all pairs."""
    a, m = (plans.variant_titles(table(spark, DIR, t), k).collect() for t, k in (("adcworks", "apra_work_id"), ("tracks", "track_id")))
    known, want = {x.title for x in a}, {}
    for x in a:
        for y in m:
            s = 100.0 if x.title == y.title else round(similarity.jaro_winkler(x.title, y.title) * 100, 4) if y.title not in known and x.title[:3] == y.title[:3] else 0.0
            if s >= 90.0:
                want.setdefault((x.apra_work_id, y.track_id), set()).add((x.title, y.title, s))
    for k, v in want.items():  # equal titles count where no similar ones join the pair
        want[k] = {r for r in v if r[2] < 100} or v
    got = {}
    for r in plans.ref_canonical_matches(spark, DIR).collect():
        got.setdefault((r.apra_work_id, r.track_id), set()).add((r.apra_title, r.muzooka_title, r.score))
    assert got == want and len(want) > 50
    assert any(not t.isascii() for v in got.values() for t, _, _ in v) or all(r.title.isascii() for r in a)


@tables
def test_canonical_names_are_scored_over_readings(spark):
    got = plans.ref_canonical_composers(spark, DIR).collect()
    assert len(got) > 50 and all(0 <= r.name_match_score <= 1 for r in got) and {r.rdc_works_id for r in got} <= {r.rdc_works_id for r in plans.canonical_matches(spark, DIR).collect()}
    names = {}
    for r in table(spark, DIR, "adc_composers").collect():
        names.setdefault(r.adc_composer_id, set()).update(credits.credit_parts(r.name, "composer"))
    tracks = {}
    for r in table(spark, DIR, "composers").collect():
        tracks.setdefault((r.track_id or "").strip().upper(), set()).update(credits.credit_parts(r.composer, "composer"))
    for r in got[:150]:
        best = max((people.match_names(p, q).enhanced_score for p in names[r.entity_id] for q in tracks.get(r.track_id, ())), default=0.0)
        assert r.name_match_score == pytest.approx(best if best >= 0.92 else 0.0, abs=1e-6)


def test_empty_tables_and_nulls(spark, folder):
    works = "apra_work_id string, title string, iswc string, extra string"
    d = folder(adcworks=([], works), tracks=([("T1", None, None, None), (None, "X", None, None)], "track_id string, title string, iswc string, extra string"))
    assert plans.ref_canonical_matches(spark, d).count() == plans.ref_full_title_exact(spark, d).count() == plans.ref_round_variants(spark, d).count() == 0
    assert linkage.band_titles(plans.variant_titles(table(spark, d, "adcworks"), "apra_work_id"), plans.variant_titles(table(spark, d, "tracks"), "track_id")).count() == 0


def test_equal_names_need_no_search(spark, folder, monkeypatch):
    """A name that a recording has is its own best; only the others are compared with those that begin alike."""
    d = folder(
        adcartists=([("W1", "A1", "ANNA UNDERHILL", None), ("W2", "A2", "ANNA UNDERHIL", "T0345246801"), ("W3", "A3", "ANNA UNDERHILL", "")], "apra_work_id string, adc_artist_id string, name string, iswc string"),
        recordings=([("R2", "ANNA UNDERHILL", None), ("R1", "ANNA UNDERHILL", "T9"), ("R3", "ANNA UNDERHILLS", None), ("R4", None, None)], "recordings_id string, artist_name string, iswc string"),
    )
    search, looked = plans.pairs.near_pairs, []
    monkeypatch.setattr(plans.pairs, "near_pairs", lambda x, *rest: looked.extend(r.t for r in x.collect()) or search(x, *rest))
    got = {r.adc_artist_id: (r.a, r.recordings_id, r.m, r.score) for r in plans.ref_best_without_code(spark, d).collect()}
    assert looked == ["ANNA UNDERHIL"] and set(got) == {"A1", "A2", "A3"}
    assert got["A1"] == got["A3"] == ("ANNA UNDERHILL", "R1", "ANNA UNDERHILL", 1.0) and got["A2"][1] == "R1" and got["A2"][3] < 1

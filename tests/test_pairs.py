"""Pairs by classes of titles: the same rows as the plain joins, and no shuffle of pairs."""

import itertools
import random
import re

import numpy as np
import pytest

from kithweave import queries
from kithweave.functions import near
from kithweave.functions.near import near_jaro_winkler, near_names
from kithweave.functions.people import match_names
from kithweave.functions.similarity import jaro_winkler
from kithweave.operators import composite, ids, linkage, pairs
from kithweave.plans import reference as R

NAMES = ["ANNA UNDERHILL", "UNDERHILL ANNA", "A UNDERHILL", "ANNA UNDERHIL", "BENNO VAN STRANDVIK", "BENNO STRANDVIK", "STRANDVIK", "STRANDWIK", "EVA-MARIA MOUNTJOY", "EVA MARIA MOUNTJOY JNR", "E M MOUNTJOY", "MOUNTJOY II", "DORA", "DÖRA HÖGMOOR", "DORA HOGMOOR", "(DORA)", "", "LE ROI", "ROI LE GRAND", "李 雷", "雷 李", "AAAA BBBB", "ABAB ABAB"]
TITLES = ["GOLDEN RIVER", "GOLDEN RIVERS", "GOLDEN RIVRE", "RIVER GOLDEN", "GOLD", "G", "SILVER LAKESIDE", "SILVER LAKESIDES", "SILVER"]


@pytest.mark.parametrize("least", [0.9, 0.92])
def test_matrices_lose_no_pair(least):
    texts = NAMES + TITLES
    for near, score in ((near_jaro_winkler, jaro_winkler), (near_names, lambda a, b: match_names(a, b).enhanced_score)):
        want = {(i, j): score(x, y) for (i, x), (j, y) in itertools.product(enumerate(texts), repeat=2)}
        assert {(i, j): s for i, j, s in near(texts, texts, least)} == {k: s for k, s in want.items() if s >= least}
    with pytest.raises(ValueError):
        near_names(texts, texts, 0.8)


def test_blocks_stay_apart(spark):
    rows = [(k, t) for k in "abc" for t in TITLES]
    df = spark.createDataFrame(rows + rows, "k string, t string")
    got = [tuple(r) for r in pairs.near_pairs(df, df, 0.9).collect()]
    want = {(k, x, y, jaro_winkler(x, y)) for k in "abc" for x in TITLES for y in TITLES if jaro_winkler(x, y) >= 0.9}
    assert len(got) == len(want) and set(got) == want


@pytest.fixture
def sides(spark):
    """Works and tracks of several titles and identifiers, ids that differ by case, a pair that is both equal and similar."""
    a = [("W1", "GOLDEN RIVER", "T1"), ("W1", "GOLDEN RIVER", "T2"), ("W2", "GOLDEN RIVER", ""), ("W3", "SILVER LAKESIDE", "T3"), ("W3", "GOLDEN RIVER", "T3"), ("W4", "GOLDEN LAKE", ""), (None, "SILVER LAKESIDE", "T3")]
    m = [("t1", "GOLDEN RIVER", "T1"), ("T1", "GOLDEN RIVER", ""), ("t2", "GOLDEN RIVERS", "T2"), ("t2", "GOLDEN RIVER", "T2"), ("t3", "SILVER LAKESIDES", "T3"), ("t4", "GOLDEN RIVER", "T2"), ("t4", "GOLDEN RIVER", "T1"), ("t5", "OTHER", "")]
    schema = "{} string, title string, iswc string"
    return spark.createDataFrame(a, schema.format("apra_work_id")), spark.createDataFrame(m, schema.format("track_id"))


def test_classes_have_all_rows(sides):
    plain = ids.dense_ids(linkage.combine_titles(linkage.exact_titles(*sides), linkage.prefix_block_titles(*sides)), ["apra_work_id", "track_id"], "rdc_works_id")
    got = pairs.matched(*sides).numbered().rows()
    order = lambda df: sorted(map(str, df.select(sorted(plain.columns)).collect()))
    assert order(got) == order(plain) and got.count() > 15
    few = plain.selectExpr("apra_work_id", "upper(track_id) up").where("apra_work_id = 'W3'").distinct()
    assert order(pairs.matched(*sides).numbered().rows(few)) == order(plain.where("apra_work_id = 'W3'"))
    assert order(pairs.band_titles(*sides).selectExpr("*", "null iswc_match", "0 rdc_works_id")) == order(linkage.band_titles(*sides).selectExpr("*", "null iswc_match", "0 rdc_works_id"))


@pytest.mark.parametrize("kind", ["composers", "artists"])
@pytest.mark.parametrize("scorer", ["jaro_winkler", "names"])
def test_names_over_classes_are_those_over_pairs(spark, sides, kind, scorer):
    met = pairs.matched(*sides)
    one = lambda rows, key: composite.count_parts(composite.expand_names(spark.createDataFrame(rows, f"{key} string, entity_id string, nm string"), "nm", "artist"), key)
    a = one([("W1", "A1", "ANNA UNDERHILL & BENNO STRANDVIK"), ("W1", "A1", "ANNA UNDERHILL"), ("W1", None, "DORA"), ("W2", "A2", "EVA MOUNTJOY"), ("W3", "A3", "EVA MOUNTJOY")], "apra_work_id")
    m = one([("T1", "1", "UNDERHILL ANNA"), ("T1", "2", "X & Y & Z"), ("T2", "3", "BENNO STRANDVIK"), ("T3", "4", "EVA MOUNTJOY")], "track_id")
    works, tracks = met.sides()
    plain = (composite.match_composers if kind == "composers" else composite.match_artists)(a, m, pairs.product(works, tracks).select("apra_work_id", "track_id").distinct(), scorer)
    got = pairs.names_over(a, m, works, tracks, kind, scorer)
    assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_names_are_scored_in_shares_of_works(spark, sides, monkeypatch):
    """Share by share gives the rows of all works at once, and every share is written before the next."""
    one = lambda rows, key: composite.count_parts(composite.expand_names(spark.createDataFrame(rows, f"{key} string, entity_id string, nm string"), "nm", "artist"), key)
    a = one([(w, f"A{w}", n) for w, n in (("W1", "ANNA UNDERHILL & BENNO STRANDVIK"), ("W1", "DORA"), ("W2", "EVA MOUNTJOY"), ("W3", "EVA MOUNTJOY"))], "apra_work_id")
    m = one([("T1", "1", "ANNA UNDERHILL"), ("T2", "3", "BENNO STRANDVIK"), ("T3", "4", "EVA MOUNTJOY"), ("T4", "5", "EVA MOUNTJOY & DORA")], "track_id")
    works, tracks = pairs.matched(*sides).sides()
    got, parts = [], []
    each = pairs.cut_each
    monkeypatch.setattr(pairs, "cut_each", lambda of: each(parts.append(d) or d for d in of))
    for n in (1, 3):
        monkeypatch.setattr(pairs, "SHARES", n)
        got.append(sorted(map(str, pairs.names_over(a, m, works, tracks, "artists", "jaro_winkler").collect())))
    assert got[0] == got[1] and sum("part_match_score=1.0" in r for r in got[0]) > 3 and len(parts) == 2 * 1 + 2 * 3


def test_hot_class_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(pairs, "CLASS_ROWS", 10)
    w, t = spark.range(100).selectExpr("'c' cls", "string(id) apra_work_id"), spark.range(7).selectExpr("'c' cls", "string(id) track_id")
    got = pairs.product(w, t, keys=True).collect()
    assert len({(r.apra_work_id, r.track_id) for r in got}) == len(got) == 700 and len({r._part for r in got}) > 5


PAIRS_DIR = {"adcworks": ([("W1", "GOLDEN RIVER", "T0345246801"), ("W2", "GOLDEN RIVER", None)], "apra_work_id string, title string, iswc string"), "tracks": ([("t1", "Golden River", None), ("t2", "Golden Rivers", None)], "track_id string, title string, iswc string")}


def test_pairs_are_not_shuffled(spark, folder):
    """All matches: what follows the last join needs no exchange, as its rows are many more than the records."""
    plan = queries.QUERIES["ref_title_matches"](spark, folder(**PAIRS_DIR))._jdf.queryExecution().executedPlan().toString()
    above = plan[: re.search(r"SortMergeJoin|BroadcastHashJoin", plan).start()]
    assert "Exchange" not in above


def test_grouping_by_parts_shuffles_nothing(spark, sides):
    plan = pairs.matched(*sides).rows(keys=True).groupBy(*pairs.PARTS, "apra_work_id", "track_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: re.search("SortMergeJoin", plan).start()]


def test_similarity_by_bits_is_exact():
    """Whole arrays at once give the very numbers of one pair at a time, up to the longest text that a number's bits hold and beyond it."""
    chance = random.Random(7)
    texts = ["".join(chance.choice(letters) for _ in range(chance.randint(1, n))) for letters, n in (("AB", 9), ("ABCD Ö李😀", 30), ("ABC ", near.BITS)) for _ in range(40)]
    codes, n = near._codes(texts), len(texts)
    got = near.jaro_winkler_of(codes, codes, np.repeat(np.arange(n), n), np.tile(np.arange(n), n))
    assert got.tolist() == [jaro_winkler(x, y) for x in texts for y in texts]
    long = ["A" * 70 + t for t in texts[:20]] + texts[80:]
    assert {(i, j): s for i, j, s in near_jaro_winkler(long, long, 0.9)} == {(i, j): s for (i, x), (j, y) in itertools.product(enumerate(long), repeat=2) if (s := jaro_winkler(x, y)) >= 0.9}


@pytest.mark.parametrize("kind", ["composers", "artists"])
def test_parts_are_scored_once(spark, sides, kind, monkeypatch):
    """The scores of parts that the search for pairs has found aren't made again for every pair of parts of the pairs."""
    monkeypatch.setattr(composite, "match_names_col", lambda *_: pytest.fail("scored twice"))
    one = lambda rows, key: composite.count_parts(composite.expand_names(spark.createDataFrame(rows, f"{key} string, entity_id string, nm string"), "nm", "artist"), key)
    a, m = one([("W1", "A1", "ANNA UNDERHILL & BENNO STRANDVIK")], "apra_work_id"), one([("T1", "1", "UNDERHILL ANNA")], "track_id")
    got = pairs.names_over(a, m, *pairs.matched(*sides).sides(), kind, "names").where("name_match_score > 0").collect()
    assert {(r.apra_work_id, r.track_id) for r in got} == {("W1", "T1")}


@pytest.mark.parametrize("kind", ["composers", "artists"])
def test_scored_pairs_are_written_before_the_rest(spark, sides, kind):
    """What the scores of alike names shuffled is off the disk when the many other pairs are made."""
    one = lambda rows, key: composite.count_parts(composite.expand_names(spark.createDataFrame(rows, f"{key} string, entity_id string, nm string"), "nm", "artist"), key)
    a, m = one([("W1", "A1", "ANNA UNDERHILL & BENNO STRANDVIK")], "apra_work_id"), one([("T1", "1", "UNDERHILL ANNA")], "track_id")
    told = pairs.names_over(a, m, *pairs.matched(*sides).sides(), kind, "names")._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
    assert "Join" not in told and "Aggregate" not in told

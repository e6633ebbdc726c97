"""The part-by-part scores and the published tables run over all title matches, not only over those of equal identifiers."""

import pytest

from kithweave import queries
from kithweave.plans import reference

TABLES = {
    "adcworks": "apra_work_id string, title string, iswc string", "tracks": "track_id string, title string, iswc string", "adc_composers": "apra_work_id string, adc_composer_id string, name string, ipi string",
    "composers": "track_id string, composer_id string, composer string, ipi string", "adcartists": "apra_work_id string, adc_artist_id string, name string", "recordings": "track_id string, recordings_id string, artist_name string, isrc string, iswc string",
}


@pytest.fixture
def d(folder):
    """W1 and t1 have one title, W2 and t2 similar ones; W1 has an identifier that a recording of t1 has but the track has not."""
    return folder(
        adcworks=([("W1", "GOLDEN RIVER", "T0345246801"), ("W2", "SILVER LAKESIDE", None)], TABLES["adcworks"]),
        tracks=([("t1", "Golden River", None), ("t2", "Silver Lakesides", None), ("t3", "Elsewhere", None)], TABLES["tracks"]),
        adc_composers=([("W1", "C1", "ANNA UNDERHILL", "1"), ("W2", "C2", "BENNO STRANDVIK", "2")], TABLES["adc_composers"]),
        composers=([("t1", "K1", "ANNA UNDERHILL", "1"), ("t2 ", "K2", "EVA MOUNTJOY", "3"), ("t3", "K3", "ANNA UNDERHILL", "1")], TABLES["composers"]),
        adcartists=([("W1", "A1", "THE GRANITES"), ("W2", "A2", "DORA HIGHMOOR")], TABLES["adcartists"]),
        recordings=([("t1", "R1", "THE GRANITES", "AU-AAA-00-00001", "T0345246801"), ("t2", "R2", "DORA HIGHMOOR", None, None)], TABLES["recordings"]),
    )


PAIRS = {("W1", "T1"), ("W2", "T2")}


@pytest.mark.parametrize("name", ["ref_composer_names", "ref_artist_names", "ref_title_composer_parts", "ref_title_artist_parts", "ref_title_published_composers", "ref_title_published_artists"])
def test_title_matches_are_scored(spark, d, name):
    assert {(r.apra_work_id, r.track_id) for r in queries.QUERIES[name](spark, d).collect()} == PAIRS


def test_title_matches_are_published(spark, d):
    got = {(r.apra_work_id, r.track_id): r for r in queries.QUERIES["ref_title_published_works"](spark, d).collect()}
    assert set(got) == {("W1", "t1"), ("W2", "t2")}
    r = got["W1", "t1"]
    assert (r.title_score, r.composer_score, r.artist_score, r.iswc_match) == (1.0, 100.0, 1.0, "N")
    assert got["W2", "t2"].composer_score == 0.0 and got["W2", "t2"].artist_score == 1.0
    assert {(r.apra_work_id, r.track_id, r.isrc_match) for r in queries.QUERIES["ref_title_isrc_matches"](spark, d).collect()} == {("W1", "T1", "Y")}


def test_names_and_codes_are_made_once(spark, d):
    """What several steps of the part scores read is written, not made again for each."""
    assert all(hasattr(x, "_kithweave_path") for x in reference._composite_inputs(spark, d, "composers", reference.code_pairs(spark, d)))

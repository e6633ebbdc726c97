import pytest
from pyspark.sql import functions as F

from kithweave.functions.splitting import Known, split_names
from kithweave.operators import assignment, blocking, composite, ids, linkage, skew, split
from kithweave.runtime import cut, drop_cut
from kithweave.sources import sinks, tables

KNOWN = Known(["MINKVAIDZE X MARROW", "KINTAETTI/FORGLESTAD", "LINSVORDAHL, TINDER AND LANTERNS", "NANORERO & THE FLINT", "PLAIN NAME"])


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, []), ("", []), ("   ", []), ("ANNA LEE", ["ANNA LEE"]), ("LEE, ANNA", ["LEE, ANNA"]), ("GOLD CHOIR, THE", ["GOLD CHOIR, THE"]),
        ("ANNA LEE & BEN ROW", ["ANNA LEE", "BEN ROW"]), ("ANNA LEE/BEN ROW / ", ["ANNA LEE", "BEN ROW"]), ("| ANNA LEE |  | BEN ROW", ["ANNA LEE", "BEN ROW"]),
        ("LEE, ANNA\nROW, BEN", ["LEE, ANNA", "ROW, BEN"]), ('["LEE, ANNA", "BEN ROW"]', ["LEE, ANNA", "BEN ROW"]), ('"ANNA ""ACE"" LEE";"ROW, BEN"', ['ANNA "ACE" LEE', "ROW, BEN"]),
        ("Lyrics by ANNA LEE; music by ROW BEN", ["ANNA LEE", "ROW BEN"]), ("WRITTEN BY ANNA LEE AND BEN ROW", ["ANNA LEE", "BEN ROW"]), ("GOLD CHOIR (FEAT. ANNA LEE, BEN ROW)", ["GOLD CHOIR", "ANNA LEE", "BEN ROW"]),
        ("GOLD CHOIR (OFFICIAL)", ["GOLD CHOIR (OFFICIAL)"]), ("ANNA LEE FT. KINTAETTI/FORGLESTAD", ["ANNA LEE", "KINTAETTI/FORGLESTAD"]), ("MINKVAIDZE X MARROW", ["MINKVAIDZE X MARROW"]),
        ("LINSVORDAHL, TINDER AND LANTERNS / ANNA LEE", ["LINSVORDAHL, TINDER AND LANTERNS", "ANNA LEE"]), ("ANNA LEE, BEN ROW, AND NANORERO & THE FLINT", ["ANNA LEE", "BEN ROW", "NANORERO & THE FLINT"]),
        ("ANNA X LEE", ["ANNA X LEE"]), ("ANNA LEE X BEN ROW", ["ANNA LEE", "BEN ROW"]),
    ],
)
def test_split_names(text, expected):
    assert split_names(text, KNOWN) == expected


def test_split_long_field():
    names = [f"GIVEN{i} FAMILY{i}" for i in range(3000)]
    assert split_names(" / ".join(names), KNOWN) == names


def test_split_query(spark, folder):
    d = folder(
        recordings=([("1", "ANNA LEE & BEN ROW", "x"), ("1", "ANNA LEE & BEN ROW", "y"), ("2", None, None), ("3", "", None), ("4", "ANNA LEE", None), (None, "A B / C D", None)], "recordings_id string, artist_name string, pos string"),
        composers=([("7", "LEE, ANNA\nROW, BEN")], "composer_id string, composer string"), act_names=([("X & Y",), (None,)], "act_name string"),
    )
    rows = sorted(map(tuple, split.p7_found(spark, d).collect()), key=str)
    assert rows == sorted([("recordings", "1", 1, "ANNA LEE"), ("recordings", "1", 2, "BEN ROW"), ("recordings", None, 1, "A B"), ("recordings", None, 2, "C D"), ("composers", "7", 1, "LEE, ANNA"), ("composers", "7", 2, "ROW, BEN")], key=str)
    assert split.p7_all_names(spark, d).where("record_id = '4'").count() == 1


def test_split_empty_tables(spark, folder):
    d = folder(recordings=([], "recordings_id string, artist_name string"), composers=([], "composer_id string, composer string"), act_names=([], "act_name string"))
    assert split.p7_found(spark, d).count() == 0


MATCHES = "match_id long, apra_work_id string, apra_cleaned_title string, muzooka_cleaned_title string, muzooka_track_id string, match_score double, title string, field string"


def test_title_stats(spark):
    rows = [(i, f"w{i % 7} ", "HOT", f"T{i % 50}", f" t{i % 3}", i / 100, "clash", "clash") for i in range(100)] + [(200, None, None, "", None, None, None, None), (201, None, "HOT", None, " ", None, None, None)]
    df = spark.createDataFrame(rows, MATCHES)
    for chunk in (3, 10, 100_000):
        got = {(r.field, r.title): r for r in skew.title_stats(df, chunk).collect()}
        hot = got["apra_cleaned_title", "HOT"]
        assert (hot.n_rows, hot.n_works, hot.n_tracks, hot.best_score) == (101, 7, 3, 0.99)
        blank = got["muzooka_cleaned_title", ""]
        assert (blank.n_rows, blank.n_works, blank.n_tracks, blank.best_score) == (1, 0, 0, None)
        assert len(got) == 52
        assert {tuple(r) for r in skew.heavy_titles(df, 0.5, chunk).collect()} == {("apra_cleaned_title", "HOT")}
    empty = spark.createDataFrame([], MATCHES)
    assert skew.title_stats(empty).count() == 0 and skew.heavy_titles(empty).count() == 0


def test_dense_ids(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), (None, 3), ("a", 1)], "k string, v int")
    got = {(r.k, r.v): r.n for r in ids.dense_ids(df, ["k", "v"], "n", 3).collect()}
    assert got == {(None, 3): 1, ("a", 1): 2, ("a", 2): 3, ("b", 1): 4}
    assert ids.dense_ids(df, ["k", "v"], "n", 3).count() == 5 and ids.dense_ids(df.limit(0), ["k"], "n").count() == 0


def titles_of(spark, rows, key):
    return spark.createDataFrame([(i, t, t, "") for i, t in rows], f"{key} string, original_title string, title string, iswc string")


def test_blocking_is_within_the_cross_join(spark):
    from kithweave.functions.similarity import jaro_winkler

    a = ["GOLDEN RIVER", "GOLDEN RIVERS", "SILVER LAKE", "GO", "G"]
    m = ["GOLDEN RIVVER", "SILVER LAKES", "GO", "OTHER"]
    x, y = titles_of(spark, [(f"a{i}", t) for i, t in enumerate(a)], "apra_work_id"), titles_of(spark, [(f"m{i}", t) for i, t in enumerate(m)], "track_id")
    got = {(r.apra_title, r.muzooka_title) for r in linkage.prefix_block_titles(x, y, keep="both").collect()}
    assert got == {(p, q) for p in a for q in m if p[:3] == q[:3] and jaro_winkler(p, q) >= 0.9}
    band = {(r.apra_title, r.muzooka_title) for r in linkage.band_titles(x, y).collect()}
    assert band == {(p, q) for p in a for q in m if p[0] == q[0] and abs(len(p) - len(q)) <= 5 and jaro_winkler(p, q) >= 0.9}


def test_simhash_join_finds_all(spark):
    from kithweave.functions.hashes import simhash
    from kithweave.functions.similarity import token_set_ratio

    texts = [f"{w} of the {v} {u}" for w in ("night", "nights", "day") for v in ("river", "rivers", "lake") for u in ("song", "songs")]
    x, y = titles_of(spark, [(t, t) for t in texts], "apra_work_id"), titles_of(spark, [(t, t) for t in texts], "track_id")
    tok = lambda t: t.split() + [t[i : i + 3] for i in range(len(t) - 2)]
    want = {(p, q) for p in texts for q in texts if bin((simhash(tok(p)) ^ simhash(tok(q))) & (1 << 64) - 1).count("1") <= 3 and token_set_ratio(p, q) >= 0.8}
    assert {(r.apra_title, r.muzooka_title) for r in blocking.simhash_pairs(x, y).collect()} == want
    assert {(p, p) for p in texts} <= {(r.apra_title, r.muzooka_title) for r in blocking.minhash_pairs(x, y).collect()}


def test_part_by_part(spark):
    def side(rows, rec):
        df = spark.createDataFrame(rows, f"{rec} string, entity_id string, nm string")
        return composite.count_parts(composite.expand_names(df, "nm", "artist"), rec)

    a = side([("w", "1", "ANNA LEE & BEN ROW"), ("w", "2", "GOLD CHOIR")], "apra_work_id")
    m = side([("t", "9", "LEE ANNA"), ("t", "8", "GOLD CHOIRS")], "track_id")
    pairs = spark.createDataFrame([("w", "t")], "apra_work_id string, track_id string")
    got = {(r.entity_id, r.normalized_name): r for r in composite.match_artists(a, m, pairs).collect()}
    assert got["2", "GOLD CHOIR"].name_match_score >= 0.92 and got["1", "ANNA LEE & BEN ROW"].name_match_score == 0.5
    c = {r.entity_id: r for r in composite.match_composers(a, m, pairs).collect()}
    assert c["1"].name_match_score == 1.0 and c["1"].parts_matched == 1 and c["1"].apra_total == 4
    empty = pairs.limit(0)
    assert composite.match_artists(a, m, empty).count() == 0 and composite.match_composers(a, m, empty).count() == 0


def test_assign_rows(spark):
    df = spark.createDataFrame([("w", "t", ["JOHN SMITH"], ["SMITH JOHN", None]), ("w", "u", [], [])], "apra_work_id string, track_id string, apra_names array<string>, muzooka_names array<string>")
    got = {r.track_id: r for r in assignment.assign_names(df).collect()}
    assert got["t"].match_percent == 100 and got["u"].match_percent == 0 and got["u"].n_pairs == 0


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, f"k{i % 5}", float(i)) for i in range(50)], "i int, k string, v double")
    keys = tables.sample_keys(df, "k", 50.0)
    assert keys.groupBy("k").count().where("count <> 10").count() == 0
    assert tables.sample_rows(df, 7, "i").collect() == tables.sample_rows(df, 7, "i").collect()
    sinks.write_csv(df, str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c")).count() == 50 and dict(tables.read_csv(spark, str(tmp_path / "c")).dtypes)["i"] == "string"
    sinks.write_partitions(df, str(tmp_path / "p"), "k")
    sinks.write_partitions(df.where("k = 'k1'").limit(1), str(tmp_path / "p"), "k")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 41
    new = spark.createDataFrame([(1, -1.0)], "i int, v double")
    merged = sinks.merge_update(df, new, ["i"], ["v"])
    assert merged.count() == 50 and merged.where("i = 1").first().v == -1.0 and merged.columns == df.columns
    assert linkage.by_ids(df, "i", [1, 2, 99]).count() == 2 and linkage.by_ids(df, "i", list(range(200))).count() == 50
    c = cut(df)
    assert c.count() == 50
    drop_cut(c)


def test_stream_links_arrivals(spark, tmp_path):
    from kithweave.streaming.incremental import link_arrivals

    works = titles_of(spark, [("w1", "GOLDEN RIVER")], "apra_work_id")
    spark.createDataFrame([("t1", "The Golden River", None), ("t2", "OTHER", None)], "track_id string, title string, iswc string").write.parquet(str(tmp_path / "in"))
    q = link_arrivals(spark.readStream.schema("track_id string, title string, iswc string").parquet(str(tmp_path / "in")), works, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination()
    assert [r.track_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["t1"]

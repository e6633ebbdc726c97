"""Buckets alone: works and tracks with a person in common, however it is spelt, and titles a typing error apart share one."""

import numpy as np

from kithweave.llm import entities

RECORD = "rid long, side string, core string, code string, writers array<string>, artists array<string>"


def test_mistyped_titles_share_a_bucket(spark):
    pairs = [
        ("GOLDEN RIVER", ["UNDERHILL"], "GOLDEN RIVERS", ["UNDERHILL"]), ("HOME", ["STRANDVIK"], "HOEM", ["STRANDVIK"]), ("SILVER LAKE", ["MOUNT"], "SILVRE LAKE", ["MOUNT", "OTHER"]),
        ("MOON LIGHT", ["OVERDALE"], "MOONLIGHT", ["OVERDALE"]), ("QUEEN OF ICE", ["GARDENIA"], "QUEEN OFF ICE", ["GARDENIA"]), ("SUN", ["HILLTOP"], "SUNN", ["HILLTOP"]),
    ]
    rows = [r for i, (t, p, u, q) in enumerate(pairs) for r in ((i, "a", t, None, p, []), (100 + i, "m", u, None, q, []))]
    rows += [(9, "a", None, None, [], []), (109, "m", "", "T0345246801", [], []), (8, "a", "X", "T0345246801", [], [])]
    h = entities.hashed(spark.createDataFrame(rows, RECORD), np.zeros((entities.ROWS, entities.DIM), dtype=np.float32))
    got = {tuple(r) for r in entities.candidates(h).collect()}
    assert {(i, 100 + i) for i in range(len(pairs))} | {(8, 109)} <= got and (0, 102) not in got and (9, 109) not in got


def test_persons_are_one_however_spelt(spark, folder):
    """The leading word of a person is the same for its spellings, so records meet by it."""
    from kithweave.llm import variants

    values = ["MATTHEW UNDERHILLER", "UNDERHILLER, MATTHEW", "MATTHEW UNDERHILER", "MATTHEW BROSTIN", "MATTHEW KVADREN", "MATTHEW PLORGLAN", "ANNA UNDERHILLER"]
    words = spark.createDataFrame([(v, variants.parse_name(v)[0], None) for v in values], "value string, words array<string>, nick string")
    named = variants.named_words(words)
    lead = {r.node: set(r.leads) for r in variants.lead_words(named).collect()}
    got = {r.value: lead[r.node] for r in named.collect()}
    assert all("UNDERHILER" in got[v] for v in values if "UNDERHIL" in v) and "BROSTIN" in got["MATTHEW BROSTIN"] and not got["MATTHEW KVADREN"] & {"UNDERHILER", "BROSTIN"}


def test_shares_lose_no_pair(spark, monkeypatch):
    """Buckets are gone through share by share: the pairs are those of all buckets at once."""
    rows = [(i, "am"[i % 2], ["GOLDEN RIVER", "GOLDEN RIVERS", "HOME", "SILVER LAKE"][i % 4], "T0345246801" if i % 5 == 0 else None, ["UNDERHILL", "MOUNT", "HOME"][: i % 3 + 1], []) for i in range(60)]
    h = entities.cut(entities.hashed(spark.createDataFrame(rows, RECORD), np.zeros((entities.ROWS, entities.DIM), dtype=np.float32)))
    got = []
    for n in (1, 5):
        monkeypatch.setattr(entities, "BUCKET_SHARES", n)
        got.append(sorted(tuple(r) for r in entities.candidates(h, bucket_rows=3).collect()))
    assert got[0] == got[1] and len(got[0]) == len(set(got[0])) > 100

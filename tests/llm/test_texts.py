import math
import os
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kithweave.llm import lookalikes, mixing, quality, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.vocabulary()), reason="no public vocabulary")


@pytest.fixture(scope="module")
def small():
    return tokens.Encoder(tokens.vocabulary(), leaf=16, window=2)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1 .'s\n\té☃<|>", max_size=200))
def test_tree_encoding_equals_direct(text):
    e = tokens.Encoder(tokens.vocabulary(), leaf=16, window=2) if not hasattr(test_tree_encoding_equals_direct, "e") else test_tree_encoding_equals_direct.e
    test_tree_encoding_equals_direct.e = e
    ids = e.encode(text)
    assert ids == e.encoding.encode_ordinary(text) and e.decode(ids, leaf=3) == text


def test_texts_without_a_safe_place(small):
    for t in ("x" * 500, " " * 300, "é" * 100, "it's it's it's " * 30, "<|endoftext|>" * 20, "a\n\n\n b" * 50):
        assert small.encode(t) == small.encoding.encode_ordinary(t)
    assert small.encode(None) == small.encode("") == []


def test_long_text_against_the_other_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    text = "It's a long text, isn't it? <|endoftext|> Ünïcode 　 and 12345 numbers.\r\n" * 2000
    assert tokens.encoder(tokens.vocabulary()).encode(text) == t.encode(text, add_special_tokens=False).ids


def test_encode_corpus(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, "", "x"), (3, None, "x"), (3, "twice", "x"), (None, "no id", None)], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in tokens.encode_corpus(df, "doc_id", "text").collect()), key=str)
    e = tokens.encoder(tokens.vocabulary())
    assert got == sorted([(1, e.encode("hello world")), (2, []), (3, []), (3, e.encode("twice")), (None, e.encode("no id"))], key=str)
    assert tokens.encode_corpus(df.limit(0), "doc_id", "text").count() == 0
    assert {(r.doc_id, r.n_tokens) for r in tokens.count_tokens(df.where("doc_id = 3"), ["doc_id"], "text").collect()} == {(3, 0), (3, len(e.encode("twice")))}


def test_canonical_values(spark):
    values = ["CAFÉ", "CAFÉ", "CAFE", "ＨＯＭＥ", "HOME", "HOME", "H​OME", "VIKТOR", "ПЁТР", "", None, "A B", "home", "Ⅲ", "x" * 50_000 + "­"]
    df = spark.createDataFrame([(v, 1) for v in values], "value string, canonical int")
    got = {r.value: (r.canonical, r.odd) for r in lookalikes.canonical_values(df).collect()}
    assert len(got) == 13
    assert got["CAFÉ"] == ("CAFÉ", True) and got["CAFE"] == ("CAFE", False) and got["ＨＯＭＥ"] == ("HOME", True) and got["H​OME"] == ("HOME", True)
    assert got["VIKТOR"] == ("VIKTOR", True) and got["ПЁТР"] == ("ПЁТР", False) and got[""] == ("", False) and got["A B"] == ("A B", True) and got["home"] == ("home", False)
    assert got["Ⅲ"] == ("III", True) and got["x" * 50_000 + "­"][0] == "x" * 50_000
    assert lookalikes.canonical_values(df.limit(0)).count() == 0


def test_odd_rows(spark, folder):
    d = folder(composers=([("1", "ＡＢ", None), ("1", "ＡＢ", None), ("2", "AB", None), (None, None, None)], "composer_id string, composer string, value string"), title_matches_lsh=([(5, "A‐B"), (6, None), (7, "ДОМ")], "match_id long, muzooka_cleaned_title string"))
    assert sorted(map(tuple, lookalikes.p5_found(spark, d).collect())) == [("composers", "1"), ("title_matches_lsh", "5")]
    assert lookalikes.p5_canonical(spark, d).count() == 4


SIZED = "doc_id long, source string, n_tokens long"
TARGETS = "mix_name string, source string, target_share double, max_repeats int, note string"


def test_mix_reaches_its_shares(spark):
    docs = [(i, s, 10 + (i * 7919) % 90) for s, n in (("big", 6000), ("mid", 900), ("tiny", 60)) for i in range({"big": 0, "mid": 10_000, "tiny": 20_000}[s], {"big": 0, "mid": 10_000, "tiny": 20_000}[s] + n)]
    docs += [(90_001, "big", 0), (90_002, None, 50), (90_003, "other", 5)]
    sized = spark.createDataFrame(docs, SIZED)
    targets = spark.createDataFrame([("m", "BIG ", 50.0, 1, None), ("m", "mid", 30.0, None, None), ("m", "tiny", 20.0, 7, None), ("m", "absent", 40.0, 2, None), ("m", "big", 50.0, 1, "twice"), ("z", "big", 0.0, 1, None), (None, "big", 1.0, 1, None), ("n", "tiny", None, 1, None)], TARGETS)
    plan = mixing.plan_mix(sized, targets)
    got = mixing.draw(sized, plan).collect()
    of, copies = defaultdict(int), Counter()
    for r in got:
        assert r.mix_name == "m"
        of[r.source] += r.n_tokens
        copies[r.source, r.doc_id] += 1
    total = sum(of.values())
    for s, share in (("big", 0.5), ("mid", 0.3), ("tiny", 0.2)):
        assert of[s] / total == pytest.approx(share, abs=0.01)
    assert max(copies.values()) <= 7 and max(n for (s, _), n in copies.items() if s == "big") <= 1
    assert 90_001 not in {r.doc_id for r in got} and len({(r.source, r.doc_id, r.copy) for r in got}) == len(got)
    # each document as often as the rate says, up or down to a whole number
    rates = {r.source: r.rate for r in plan.where("mix_name = 'm'").collect()}
    for (s, _), n in copies.items():
        assert n in (math.floor(rates[s]), math.ceil(rates[s]))


def test_positions_do_not_depend_on_blocks(spark):
    sized = spark.createDataFrame([(i, "s", 1 + i % 5) for i in range(500)], SIZED)
    for per in (7, 100, 10_000):
        rows = mixing.ranked_documents(sized, per).collect()
        assert sorted(r.position for r in rows) == list(range(500))


def test_mix_of_nothing(spark):
    none, t = spark.createDataFrame([], SIZED), spark.createDataFrame([("m", "s", 1.0, 2, None)], TARGETS)
    assert mixing.draw(none, mixing.plan_mix(none, t)).count() == 0
    some = spark.createDataFrame([(1, "s", 5)], SIZED)
    assert mixing.draw(some, mixing.plan_mix(some, t.limit(0))).count() == 0


COMMON = {"en": frozenset("the of and a in to is that for it as was with by on".split()), "de": frozenset("der die das und in zu den von".split())}


def test_statistics():
    assert quality.text_statistics(None, COMMON) is quality.text_statistics(" \n\t", COMMON) is None
    s = quality.text_statistics("The cat is in the house. It was a day.\n- item one\n- item two", COMMON)
    assert s["n_words"] == 14 and s["n_lines"] == 3 and s["n_sentences"] == 2 and s["language"] == "en" and s["punctuated_lines"] == pytest.approx(1 / 3)
    assert quality.text_statistics("$x$", COMMON)["n_words"] == 0 and quality.text_statistics("die katze und das haus", COMMON, "EN")["language"] == "de"
    assert quality.text_statistics("word " * 200_000, COMMON)["fresh_trigrams"] < 0.01


def test_prose_from_junk(spark):
    import random

    rng = random.Random(5)
    nouns = [f"noun{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    nouns = [n.replace("noun", rng.choice(["lat", "mor", "vec", "pil"])) for n in nouns]

    def sentence():
        a, b, c = rng.sample(nouns, 3)
        return rng.choice([f"The {a} of the {b} is in the {c}.", f"It was the {a} that is for a {b} and a {c}.", f"A {a} with the {b} was by the {c}."])

    docs = [(i, " ".join(sentence() for _ in range(rng.randint(15, 40))), "en", "x") for i in range(300)]
    docs += [(1000, "\n".join(f"{a} & 1.2 & 3.4 \\\\" for a in nouns[:60]), "en", "x"), (1001, "\n".join(f"\\item {a} {b}" for a, b in zip(nouns[:60], nouns[60:])), "en", "x"), (1002, "zq9 #$% k2 " * 80, "en", "x"), (1003, "The lat is in the mor. " * 60, "en", "x")]
    docs += [(2000, None, "en", "x"), (2001, "", None, "x"), (2002, "  \n", "xx", None)]
    stats = quality.document_statistics(spark.createDataFrame(docs, "doc_id long, text string, lang string, n_chars string"), COMMON)
    got = {r.doc_id: r.is_prose for r in quality.quality(stats).collect()}
    assert {d for d, p in got.items() if p is False} == {1000, 1001, 1002, 1003}
    assert {d for d, p in got.items() if p is None} == {2000, 2001, 2002}
    empty = quality.document_statistics(spark.createDataFrame([], "doc_id long, text string, lang string"), COMMON)
    assert quality.quality(empty).count() == 0


def test_long_blocks_repeated_look_stale():
    block = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(600))
    s = quality.text_statistics(" ".join([block] * 20), COMMON)
    assert s["fresh_trigrams"] > 0.9 and s["fresh_runs"] < 0.1 and quality.text_statistics(block, COMMON)["fresh_runs"] == 1


@pytest.fixture(scope="module")
def measured(spark):
    import random

    rng = random.Random(8)
    return [(i, "en" if i % 3 else "de", rng.gauss(5, 1) if i % 100 else 40.0, rng.expovariate(2), 0.0) for i in range(900)] + [(i, "ru", rng.gauss(5, 1), None, 0.0) for i in range(900, 905)] + [(990, None, 5.0, 1.0, 3.0)]


def test_flags_do_not_depend_on_the_unit(spark, measured):
    def far(factor, shift):
        df = spark.createDataFrame(measured, "doc_id long, language string, x double, y double, k double").selectExpr("doc_id", "language", f"x * {factor} + {shift} x", f"y * {factor} y", "k")
        return {(r.doc_id, abs(r.z_x) > 4, r.z_y is not None and r.z_y > 4, r.z_k) for r in quality.tail_scores(df, ["x", "y", "k"]).collect()}

    one = far(1, 0)
    assert one == far(10, 0) == far(0.001, 7)
    assert {d for d, x, _, _ in one if x} == {d for d, _, x, _, _ in measured if x == 40.0}
    assert {d for d, _, _, z in one if z == math.inf} == {990} and all(z == 0 for d, _, _, z in one if d != 990)


def quantiles(values):
    v = sorted(values)
    return [v[min(len(v) - 1, max(0, math.ceil(i / 100 * len(v)) - 1))] for i in range(101)]


def test_scores_against_plain_python(spark, measured):
    """Sketches of so few values are nearly exact; z-scores and percentiles must be those of a plain computation."""
    df = spark.createDataFrame(measured, "doc_id long, language string, x double, y double, k double").drop("k")
    pooled = {c: quantiles([r[c] for r in measured if r[c] is not None]) for c in (2, 3)}
    got = quality.tail_scores(df, ["x", "y"]).collect()
    assert len(got) == len(measured)
    close = 0
    for r in got:
        if r.language in ("en", "de"):
            own = [m[2] for m in measured if m[1] == r.language]
            q = [(len(own) * a + quality.PRIOR * b) / (len(own) + quality.PRIOR) for a, b in zip(quantiles(own), pooled[2])]
            wide = (q[90] - q[50] if r.x > q[50] else q[50] - q[10]) / quality.DECILE
            close += abs((r.x - q[50]) / wide - r.z_x) <= 0.1 + 0.05 * abs(r.z_x) and abs(max(sum(g <= r.x for g in q) - 1, 0) - r.p_x) <= 3
        if r.language == "ru":
            assert r.z_y is None and r.p_y is None and r.z_x is not None
    assert close >= 0.98 * 900


def test_small_languages_are_not_their_own_scale(spark):
    """Five documents far from all others are far, though they are like each other."""
    rows = [(i, "en", 5 + (i % 50) / 50) for i in range(500)] + [(600 + i, "xx", 30.0 + i) for i in range(5)]
    got = {r.doc_id: r.z_x for r in quality.tail_scores(spark.createDataFrame(rows, "doc_id long, language string, x double"), ["x"]).collect()}
    assert all(got[600 + i] > 4 for i in range(5)) and all(abs(got[i]) < 4 for i in range(500))

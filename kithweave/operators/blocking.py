"""Candidate pairs from signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.hashes import hamming_col, minhash_col, simhash_col
from ..functions.similarity import jaro_winkler_col, token_set_col


def minhash_pairs(a: DataFrame, m: DataFrame, bands: int = 25, rows: int = 5, least: float = 0.7) -> DataFrame:
    """Pairs of titles that agree in a band of their MinHash signatures of three-character substrings, kept if Jaro-Winkler is at least `least`.

    Titles shorter than three characters have no signature. Pairs of texts are found once, however many records share a text.
    """
    def banded(df, name):
        sig = df.select(F.col("title").alias(name)).distinct().withColumn("_s", minhash_col(S.shingles(S.word_form(F.col(name))), bands * rows)).where("_s is not null")
        parts = F.array(*(F.struct(F.lit(b).alias("b"), F.xxhash64(F.slice("_s", b * rows + 1, rows)).alias("h")) for b in range(bands)))
        return sig.select(name, F.explode(parts).alias("k")).select(name, "k.b", "k.h")

    texts = banded(a, "apra_title").join(banded(m, "muzooka_title"), ["b", "h"]).select("apra_title", "muzooka_title").distinct()
    texts = texts.withColumn("match_score", jaro_winkler_col(S.word_form(F.col("apra_title")), S.word_form(F.col("muzooka_title")))).where(F.col("match_score") >= least)
    return texts.join(a.select("apra_work_id", F.col("title").alias("apra_title")), "apra_title").join(m.select("track_id", F.col("title").alias("muzooka_title")), "muzooka_title").distinct()


def simhash_pairs(a: DataFrame, m: DataFrame, distance: int = 3, least: float = 0.8) -> DataFrame:
    """Pairs of titles whose 64-bit SimHashes differ in at most `distance` (up to 3) bits and that share most words.

    Of four stretches of 16 bits one at least agrees in such a pair, so joining on each loses none.
    """
    if not 0 <= distance <= 3:
        raise ValueError("four stretches find distances up to 3")

    def cut16(df, name):
        h = df.select(F.col("title").alias(name)).distinct().withColumn(f"{name}_hash", simhash_col(S.word_and_gram_tokens(S.word_form(F.col(name)))))
        stretches = F.array(*(F.struct(F.lit(i).alias("i"), F.shiftrightunsigned(f"{name}_hash", 16 * i).bitwiseAND(0xFFFF).alias("v")) for i in range(4)))
        return h.select(name, f"{name}_hash", F.explode(stretches).alias("k")).select(name, f"{name}_hash", "k.i", "k.v")

    j = cut16(a, "apra_title").join(cut16(m, "muzooka_title"), ["i", "v"]).where(hamming_col(F.col("apra_title_hash"), F.col("muzooka_title_hash")) <= distance)
    texts = j.select("apra_title", "muzooka_title").distinct()
    texts = texts.withColumn("match_score", token_set_col(S.word_form(F.col("apra_title")), S.word_form(F.col("muzooka_title")))).where(F.col("match_score") >= least)
    return texts.join(a.select("apra_work_id", F.col("title").alias("apra_title")), "apra_title").join(m.select("track_id", F.col("title").alias("muzooka_title")), "muzooka_title").distinct()

"""Joins that find and narrow candidate pairs of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.similarity import jaro_winkler_col, may_reach


def works_titles(works: DataFrame) -> DataFrame:
    """(apra_work_id, original_title, title, iswc) of side A, blank titles left out, repeated rows once."""
    t = works.select("apra_work_id", F.col("title").alias("original_title"), S.cleanse_title(F.col("title")).alias("title"), S.iswc_key(F.col("iswc")).alias("iswc"))
    return t.where("title <> ''").distinct()


def tracks_titles(tracks: DataFrame) -> DataFrame:
    """(track_id, original_title, title, iswc) of side M."""
    t = tracks.select("track_id", F.col("title").alias("original_title"), S.cleanse_title(F.col("title")).alias("title"), S.iswc_key(F.col("iswc")).alias("iswc"))
    return t.where("title <> ''").distinct()


def ascii_titles(titles: DataFrame) -> DataFrame:
    """The same with titles of letters A to Z, digits and blanks only; titles that have none are left out."""
    return titles.withColumn("title", S.squeeze(F.regexp_replace("title", "[^A-Z0-9 ]", ""))).where("title <> ''").distinct()


def exact_titles(a: DataFrame, m: DataFrame) -> DataFrame:
    """Pairs of equal titles, score 100, and whether the identifiers agree; an equi-join on the title."""
    x = a.select("apra_work_id", "title", F.col("iswc").alias("apra_iswc"))
    y = m.select("track_id", "title", F.col("iswc").alias("muzooka_iswc"))
    j = x.join(y, "title")
    return j.select("apra_work_id", "track_id", F.col("title").alias("apra_title"), F.col("title").alias("muzooka_title"), F.lit(100.0).alias("score"), _iswc_flag()).distinct()


def _iswc_flag():
    return F.when((F.col("apra_iswc") == F.col("muzooka_iswc")) & (F.col("apra_iswc") != ""), "Y").otherwise("N").alias("iswc_match")


def _scored(pairs: DataFrame, left: str, right: str, least: float) -> DataFrame:
    """Scores the distinct pairs of texts once, in Arrow batches, after a lossless test of their lengths."""
    texts = pairs.select(left, right).where(may_reach(left, right, least)).distinct()
    texts = texts.withColumn("similarity", jaro_winkler_col(left, right)).where(F.col("similarity") >= least)
    return pairs.join(texts, [left, right])


def prefix_block_titles(a: DataFrame, m: DataFrame, least: float = 0.90, prefix: int = 3, keep: str = "m") -> DataFrame:
    """Pairs of similar titles whose first characters agree. keep: the side whose titles have no exact partner (m, a, or none of both)."""
    if keep == "m":
        m = m.join(a.select("title").distinct(), "title", "left_anti")
    elif keep == "a":
        a = a.join(m.select("title").distinct(), "title", "left_anti")
    x = a.select("apra_work_id", F.col("title").alias("apra_title"), F.col("iswc").alias("apra_iswc"), F.substring("title", 1, prefix).alias("block"))
    y = m.select("track_id", F.col("title").alias("muzooka_title"), F.col("iswc").alias("muzooka_iswc"), F.substring("title", 1, prefix).alias("block"))
    # titles repeat heavily: similar pairs of texts first, records after
    texts = x.select("block", "apra_title").distinct().join(y.select("block", "muzooka_title").distinct(), "block").drop("block")
    texts = texts.where(may_reach("apra_title", "muzooka_title", least)).withColumn("similarity", jaro_winkler_col("apra_title", "muzooka_title")).where(F.col("similarity") >= least)
    j = texts.join(x.drop("block"), "apra_title").join(y.drop("block"), "muzooka_title")
    return j.select("apra_work_id", "track_id", "apra_title", "muzooka_title", F.round(F.col("similarity") * 100, 4).alias("score"), _iswc_flag()).distinct()


def band_titles(a: DataFrame, m: DataFrame, width: int = 5, least: float = 0.90) -> DataFrame:
    """Pairs of similar titles of equal first character and lengths at most `width` apart: lengths are cut into bands, each title goes to its own and
    the neighbouring ones of the other side, and the join is on first character and band."""
    band = lambda c: F.floor(F.length(c) / (width + 1)).cast("int")
    x = a.select(F.col("title").alias("apra_title")).distinct().withColumn("first", F.substring("apra_title", 1, 1)).withColumn("band", band("apra_title"))
    y = m.select(F.col("title").alias("muzooka_title")).distinct().withColumn("first", F.substring("muzooka_title", 1, 1))
    y = y.withColumn("band", F.explode(F.array(band("muzooka_title") - 1, band("muzooka_title"), band("muzooka_title") + 1)))
    texts = x.join(y, ["first", "band"]).where(F.abs(F.length("apra_title") - F.length("muzooka_title")) <= width)
    texts = texts.where(may_reach("apra_title", "muzooka_title", least)).select("apra_title", "muzooka_title").withColumn("similarity", jaro_winkler_col("apra_title", "muzooka_title")).where(F.col("similarity") >= least)
    j = texts.join(a.select("apra_work_id", F.col("title").alias("apra_title")), "apra_title").join(m.select("track_id", F.col("title").alias("muzooka_title")), "muzooka_title")
    return j.select("apra_work_id", "track_id", "apra_title", "muzooka_title", F.round(F.col("similarity") * 100, 4).alias("score")).distinct()


def combine_titles(exact: DataFrame, fuzzy: DataFrame) -> DataFrame:
    """Similar pairs, and the equal ones whose records no similar pair joins."""
    return fuzzy.unionByName(exact.join(fuzzy.select("apra_work_id", "track_id").distinct(), ["apra_work_id", "track_id"], "left_anti")).distinct()


def title_ladder(a, b):
    """1.0 for equal clean forms, 0.95 for equal compact forms, 0.90 without articles, 0.85 if one contains the other, else 0."""
    return (
        F.when(S.clean_form(a) == S.clean_form(b), 1.0)
        .when(S.compact_form(a) == S.compact_form(b), 0.95)
        .when(S.no_article_form(a) == S.no_article_form(b), 0.90)
        .when(F.contains(S.compact_form(a), S.compact_form(b)) | F.contains(S.compact_form(b), S.compact_form(a)), 0.85)
        .otherwise(0.0)
    )


def by_ids(df: DataFrame, column: str, ids: list) -> DataFrame:
    """Rows of the given ids: a predicate for a short list, a semi-join for a long one."""
    if len(ids) <= 100:
        return df.where(F.col(column).isin(ids))
    listed = df.sparkSession.createDataFrame([(i,) for i in ids], f"{column} {dict(df.dtypes)[column]}").distinct()
    return df.join(listed, column, "left_semi")

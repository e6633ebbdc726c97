"""Part-by-part matching of the names on works and on tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.credits import credit_parts_col
from ..functions.people import match_names_col
from ..functions.similarity import jaro_winkler_col
from .ids import best_of

#: Least score of a pair of name parts that counts.
LEAST_PART = 0.92


def expand_names(df: DataFrame, name: str, entity: str, quotes_split: bool = False, parts=None) -> DataFrame:
    """A row of kind ORIGINAL with the name's parts, and a VARIANT row without parts for each part that differs from it and is longer than two characters."""
    up = F.upper(F.trim(F.col(name)))
    base = df.where(F.trim(F.col(name)) != "").withColumn("delimited_parts", parts if parts is not None else credit_parts_col(name, entity, quotes_split)).withColumn("normalized_name", up)
    base = base.withColumn("is_variant", F.lit("ORIGINAL"))
    others = F.filter("delimited_parts", lambda p: (p != F.col("normalized_name")) & (F.length(p) > 2))
    more = base.withColumn("normalized_name", F.explode(others)).withColumn("is_variant", F.lit("VARIANT")).withColumn("delimited_parts", F.array().cast("array<string>"))
    return base.unionByName(more)


def count_parts(df: DataFrame, record: str) -> DataFrame:
    """With part_ct, the parts of the row, and total_names, the distinct names of the record (of VARIANT rows too)."""
    totals = df.groupBy(record).agg(F.count_distinct(F.when(F.trim("normalized_name") != "", F.col("normalized_name"))).alias("total_names"))
    return df.withColumn("part_ct", F.size("delimited_parts").cast("bigint")).join(totals, record)


def part_scores(a: DataFrame, m: DataFrame, pairs: DataFrame, scorer: str = "names", least: float = LEAST_PART, best: DataFrame | None = None) -> DataFrame:
    """(apra_work_id, track_id, entity_id, apra_part, best): the best score, at least `least`, of each part of an A name among the parts on the track.

    The distinct pairs of parts are scored once, unless `best` has (apra_work_id, track_id, apra_part, best) of all pairs already. One M part may serve several A parts.
    """
    x = a.select("apra_work_id", "entity_id", F.explode("delimited_parts").alias("apra_part")).distinct()
    if best is not None:
        return x.join(best, ["apra_work_id", "apra_part"]).select("apra_work_id", "track_id", "entity_id", "apra_part", "best")
    y = m.select("track_id", F.explode("delimited_parts").alias("muzooka_part")).distinct()
    both = x.join(pairs, "apra_work_id").join(y, "track_id")
    score = match_names_col("apra_part", "muzooka_part")["enhanced_score"] if scorer == "names" else jaro_winkler_col("apra_part", "muzooka_part")
    texts = both.select("apra_part", "muzooka_part").distinct().withColumn("part_score", score).where(F.col("part_score") >= least)
    return both.join(texts, ["apra_part", "muzooka_part"]).groupBy("apra_work_id", "track_id", "entity_id", "apra_part").agg(F.max("part_score").alias("best"))


def _candidates(a: DataFrame, m: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every name of a work beside every track of the work, with the counts of the track's rows."""
    meta = m.groupBy("track_id", "delimited_parts", "total_names").agg(F.max("part_ct").alias("muzooka_part_ct")).select("track_id", "muzooka_part_ct", F.col("total_names").alias("muzooka_total"))
    return pairs.join(a.select("apra_work_id", "entity_id", "normalized_name", F.col("part_ct").alias("apra_part_ct"), F.col("total_names").alias("apra_total")).distinct(), "apra_work_id").join(meta.distinct(), "track_id", "left")


def match_artists(a: DataFrame, m: DataFrame, pairs: DataFrame, scorer: str = "names", best: DataFrame | None = None) -> DataFrame:
    """Artists: the sum of the best part scores over the larger number of parts for each name, and the sum over names for each pair of work and track.

    A name of several rows of counts keeps the row of the highest score, then of the larger counts.
    """
    scores = part_scores(a, m, pairs, scorer, best=best).groupBy("apra_work_id", "track_id", "entity_id").agg(F.sum("best").alias("part_match_score"))
    c = _candidates(a, m, pairs).join(scores, ["apra_work_id", "track_id", "entity_id"], "left").withColumn("part_match_score", F.coalesce("part_match_score", F.lit(0.0)))
    most = F.greatest(F.coalesce("apra_part_ct", F.lit(0)), F.coalesce("muzooka_part_ct", F.lit(0)))
    c = c.withColumn("name_match_score", F.round(F.when(most > 0, F.col("part_match_score") / most).otherwise(0.0), 6))
    c = best_of(c, ["apra_work_id", "track_id", "entity_id", "normalized_name"], [F.desc("name_match_score"), F.desc("apra_part_ct"), F.desc_nulls_last("muzooka_part_ct"), F.desc_nulls_last("muzooka_total")])
    totals = c.groupBy("apra_work_id", "track_id", "normalized_name").agg(F.max(F.when(F.col("name_match_score") >= LEAST_PART, F.col("name_match_score"))).alias("_n")).groupBy("apra_work_id", "track_id").agg(F.round(F.coalesce(F.sum("_n"), F.lit(0.0)), 6).alias("artist_match_total"))
    return c.join(totals, ["apra_work_id", "track_id"]).select(
        "apra_work_id", "track_id", "entity_id", "normalized_name", "apra_total", "muzooka_total", "apra_part_ct", "muzooka_part_ct", F.round("part_match_score", 6).alias("part_match_score"), "name_match_score", "artist_match_total"
    )


def match_composers(a: DataFrame, m: DataFrame, pairs: DataFrame, scorer: str = "names", best: DataFrame | None = None) -> DataFrame:
    """Composers: the best part score of each name, how many parts matched, and the matched share of a work's composers on a track."""
    scores = part_scores(a, m, pairs, scorer, best=best).groupBy("apra_work_id", "track_id", "entity_id").agg(F.max("best").alias("name_match_score"), F.count(F.lit(1)).alias("parts_matched"))
    c = _candidates(a, m, pairs).join(scores, ["apra_work_id", "track_id", "entity_id"], "left")
    each = c.groupBy("apra_work_id", "track_id", "entity_id").agg(
        F.max(F.coalesce("name_match_score", F.lit(0.0))).alias("name_match_score"), F.max(F.coalesce("parts_matched", F.lit(0))).alias("parts_matched"), F.max("apra_total").alias("apra_total"), F.max(F.coalesce("muzooka_total", F.lit(0))).alias("muzooka_total")
    )
    share = each.groupBy("apra_work_id", "track_id").agg(F.sum(F.when(F.col("name_match_score") >= LEAST_PART, F.col("name_match_score")).otherwise(0.0)).alias("_s"), F.max(F.greatest("apra_total", "muzooka_total")).alias("_t"))
    share = share.select("apra_work_id", "track_id", F.round(F.when(F.col("_t") > 0, F.col("_s") / F.col("_t")).otherwise(0.0), 6).alias("composer_match_share"))
    return each.join(share, ["apra_work_id", "track_id"]).withColumn("name_match_score", F.round("name_match_score", 6))

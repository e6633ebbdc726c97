"""Top N items of every group by a rank window; the optimiser's group limit prunes before and after the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import clean_id, table


def top_n(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """(group, item, score, rank): per group the n items of highest score, ties by the item's code points.

    A pair counts once with its highest score. Rows with a null group, item or score, and scores that are no number, are left out; groups with fewer
    than n items give what they have; an empty table gives an empty result. Only the three columns are read, so others can't clash. Pairs are made
    unique by a hash aggregate on (group, item), which spreads a hot group over all tasks; row_number with a filter on the rank then keeps n rows a group
    and task before the shuffle on the group, so that shuffle carries n rows a group and task at most.
    """
    base = df.select(F.col(group).alias("_g"), F.col(item).alias("_i"), F.col(score).cast("double").alias("_s")).where("_g is not null and _i is not null and _s is not null and not isnan(_s)")
    best = base.groupBy("_g", "_i").agg(F.max("_s").alias("_s"))
    view = "kithweave_top_n_best"
    best.createOrReplaceTempView(view)
    ranked = df.sparkSession.sql(
        f"SELECT _g, _i, _s, _r FROM (SELECT _g, _i, _s, row_number() OVER (PARTITION BY _g ORDER BY _s DESC, _i ASC) AS _r FROM {view}) WHERE _r <= {int(n)}"
    )
    return ranked.select(F.col("_g").alias(group), F.col("_i").alias(item), F.col("_s").alias(score), F.col("_r").alias("rank"))


def _matches(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "title_matches_lsh").select(clean_id("apra_work_id").alias("apra_work_id"), clean_id("muzooka_track_id").alias("muzooka_track_id"), "match_score")


def p3_found(spark, sf_dir: str) -> DataFrame:
    return top_n(_matches(spark, sf_dir), "apra_work_id", "muzooka_track_id", "match_score", 3).select("apra_work_id", "muzooka_track_id")


def p3_ranked(spark, sf_dir: str) -> DataFrame:
    """As p3_found, with score and rank."""
    return top_n(_matches(spark, sf_dir), "apra_work_id", "muzooka_track_id", "match_score", 3)


_BEST = """
    WITH b AS (SELECT nullif(upper(trim(apra_work_id)), '') AS apra_work_id, nullif(upper(trim(muzooka_track_id)), '') AS muzooka_track_id, max(match_score) AS match_score
               FROM title_matches_lsh WHERE match_score IS NOT NULL AND NOT isnan(match_score) GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY apra_work_id ORDER BY match_score DESC, muzooka_track_id) AS rank FROM b
          WHERE apra_work_id IS NOT NULL AND muzooka_track_id IS NOT NULL)
"""
SQL = {
    "p3_found": _BEST + "SELECT apra_work_id, muzooka_track_id FROM r WHERE rank <= 3",
    "p3_ranked": _BEST + "SELECT apra_work_id, muzooka_track_id, match_score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3",
}

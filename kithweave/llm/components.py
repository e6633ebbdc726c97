"""Pairwise matches consolidated into groups.

The giant component is peeled off by frontier breadth-first joins from the vertex of highest degree; what a frontier touches is anti-joined away. A giant may be deep, a
chain of thousands of records for one, so once a search has gone some rounds the edges that are left are pulled towards their smallest ends between two rounds: that
keeps who is connected to whom and halves the distances, and the search ends after logarithmically many rounds, with the whole giant. The components that are left
take their smallest record by the same pulling, repeated until every one is a star around it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import clean_id, cut, drop_cut, table

#: Breadth-first rounds before the edges that are left are shortened between rounds. Any number gives the same groups.
PLAIN_ROUNDS = 4


def _pull(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step. edges: (a, b), a < b, unique; so is the result, over the same vertices, connected in the same way.

    Large star: the larger neighbours of each vertex are linked to the smallest of the vertex and its neighbours instead. Small star: the smaller neighbours of each
    vertex, and the vertex, are linked to the smallest of them. Both count as many edges at most as before. A vertex's minimum is combined before the shuffle, and the
    join that hands it out has one row per vertex on its other side, so a hub's edges may be split.
    """
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    low = both.groupBy("v").agg(F.min("u").alias("u")).select(F.col("v").alias("a"), F.least("v", "u").alias("m"))
    large = cut(edges.join(low, "a").select(F.col("m").alias("a"), "b").distinct())
    least = large.groupBy("b").agg(F.min("a").alias("m"))
    held = large.join(least, "b")
    small = held.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(least.select(F.col("m").alias("a"), "b"))
    out = cut(small.distinct())
    drop_cut(large)
    return out


def _settled(edges: DataFrame) -> bool:
    """Is every component a star around its smallest vertex? No vertex is then both a smaller and a larger end, nor the larger end of two edges."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("lo"), F.lit(0).alias("hi")).unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("lo"), F.lit(1).alias("hi")))
    return ends.groupBy("v").agg(F.max("lo").alias("lo"), F.sum("hi").alias("hi")).where("hi > 1 or (lo > 0 and hi > 0)").isEmpty()


def _peel(edges: DataFrame, seed: DataFrame, plain_rounds: int) -> tuple[list[DataFrame], DataFrame]:
    """The vertices of the component of `seed`, by rounds, and the edges of the other components. edges: a cut, which is removed."""
    found, rest, round_ = [cut(seed)], edges, 0
    while True:
        round_ += 1
        if round_ > plain_rounds:
            shorter = _pull(rest)
            drop_cut(rest)
            rest = shorter
        a, b = found[-1].withColumnRenamed("v", "a"), found[-1].withColumnRenamed("v", "b")
        ends = rest.join(a, "a").select(F.col("b").alias("v")).unionByName(rest.join(b, "b").select(F.col("a").alias("v")))
        fresh = cut(ends.distinct().join(found[-1], "v", "left_anti"))
        kept = cut(rest.join(a, "a", "left_anti").join(b, "b", "left_anti"))
        drop_cut(rest)
        rest = kept
        if fresh.isEmpty():
            drop_cut(fresh)
            return found, rest
        found.append(fresh)


def connected_components(pairs: DataFrame, a: str = "a", b: str = "b", plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """(record_id, group_id) of every record with a link, group_id being the smallest record id of its group by code point.

    Pairs with a null end are no links; a pair of a record with itself makes it a group of its own unless other pairs join it; repeated and turned-round pairs count once;
    an empty table gives an empty result. Only the two columns are read.
    """
    raw = pairs.select(F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).where("x is not null and y is not null")
    links = cut(raw.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    edges, alone = links.where("a <> b"), links.where("a = b").select(F.col("a").alias("record_id"))
    top = edges.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").count().orderBy(F.desc("count"), "v").limit(1).select("v").collect()
    if not top:
        return alone.select("record_id", F.col("record_id").alias("group_id"))
    # the first cut stays, as the records linked to themselves are read from it; the others go as they are replaced
    found, rest = _peel(cut(edges), pairs.sparkSession.createDataFrame(top, "v string"), plain_rounds)
    giant = found[0]
    for f in found[1:]:
        giant = giant.unionByName(f)
    smallest = giant.agg(F.min("v")).collect()[0][0]
    labels = giant.select(F.col("v").alias("record_id"), F.lit(smallest).alias("group_id"))
    if not rest.isEmpty():
        while not _settled(rest):
            pulled = _pull(rest)
            drop_cut(rest)
            rest = pulled
        stars = rest.select(F.col("b").alias("record_id"), F.col("a").alias("group_id")).unionByName(rest.select(F.col("a").alias("record_id"), F.col("a").alias("group_id")).distinct())
        labels = labels.unionByName(stars)
    own = alone.join(labels.select("record_id"), "record_id", "left_anti").select("record_id", F.col("record_id").alias("group_id"))
    return labels.unionByName(own)


def p4_found(spark, sf_dir: str, least_score: float = 0.90) -> DataFrame:
    df = table(spark, sf_dir, "title_matches_lsh").where(F.col("match_score") >= least_score).where(~F.isnan("match_score"))
    return connected_components(df.select(clean_id("apra_work_id").alias("a"), clean_id("muzooka_track_id").alias("b")))


SQL = {
    "p4_found": """
        WITH RECURSIVE e AS (SELECT DISTINCT nullif(upper(trim(apra_work_id)), '') AS a, nullif(upper(trim(muzooka_track_id)), '') AS b
                             FROM title_matches_lsh WHERE match_score >= 0.90 AND NOT isnan(match_score)),
        l AS (SELECT a, b FROM e WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e WHERE a IS NOT NULL AND b IS NOT NULL),
        r AS (SELECT a AS record_id, a AS g FROM l UNION SELECT l.b, r.g FROM r JOIN l ON r.record_id = l.a WHERE r.g < l.b)
        SELECT record_id, min(g) AS group_id FROM r GROUP BY record_id"""
}

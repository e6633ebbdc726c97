"""Per-key results where a few keys hold most rows: aggregation as a tree of bounded fan-in."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import clean_id, table

#: Rows of a chunk that is combined locally, and chunks that one merge takes in.
CHUNK_ROWS, FAN_IN = 100_000, 16


def tree_aggregate(df: DataFrame, keys: list[str], leaf: list, merge: list, chunks: int, chunk_by, fan_in: int = FAN_IN) -> DataFrame:
    """Aggregates df by `keys` in ceil(log_fan_in(chunks)) + 1 rounds.

    leaf: aggregates of a chunk's rows, aliased; merge: aggregates over those columns, aliased as these. chunk_by: a column of integers; rows of one
    value share a chunk. A key of any weight is spread over all chunks, and no merge takes more than fan_in states of a key.
    """
    states = df.withColumn("_chunk", F.pmod(chunk_by, F.lit(chunks)).cast("int")).groupBy(*keys, "_chunk").agg(*leaf)
    left = chunks
    while left > fan_in:
        left = math.ceil(left / fan_in)
        states = states.groupBy(*keys, F.floor(F.col("_chunk") / fan_in).cast("int").alias("_chunk")).agg(*merge)
    return states.groupBy(*keys).agg(*merge)


def chunks_for(rows: int, chunk_rows: int = CHUNK_ROWS) -> int:
    return max(1, math.ceil(rows / chunk_rows))


def _long(df: DataFrame) -> DataFrame:
    """Both title fields below each other, with what their statistics need."""
    df = df.select("apra_cleaned_title", "muzooka_cleaned_title", clean_id("apra_work_id").alias("work"), clean_id("muzooka_track_id").alias("track"), "match_score")
    fields = [F.struct(F.lit(f).alias("field"), F.col(f).alias("title")) for f in ("apra_cleaned_title", "muzooka_cleaned_title")]
    return df.select(F.explode(F.array(*fields)).alias("_f"), "work", "track", "match_score").select("_f.field", "_f.title", "work", "track", "match_score").where("title is not null")


def title_rows(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(field, title, n_rows): rows of every non-null title, exactly as stored."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("title")) for f in ("apra_cleaned_title", "muzooka_cleaned_title")])).alias("_f")).select("_f.*").where("title is not null")
    n = chunks_for(2 * df.count(), chunk_rows)
    return tree_aggregate(long, ["field", "title"], [F.count(F.lit(1)).alias("n_rows")], [F.sum("n_rows").alias("n_rows")], n, F.spark_partition_id())


def title_stats(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(field, title, n_rows, n_works, n_tracks, best_score) of every non-null title, exactly as stored.

    Ids are compared trimmed and in capitals, null and blank ids aren't counted, null scores don't take part in the best (null if there is no other);
    repeated rows count as rows. The empty title is a title. An empty table gives an empty result. Distinct ids are counted by splitting each
    title's ids over the chunks by the id's hash: the sets of two chunks are disjoint, so their sizes add up and no set travels.
    """
    n = chunks_for(2 * df.count(), chunk_rows)
    long, keys = _long(df), ["field", "title"]
    none = F.lit(None).cast("string")
    ids = long.select(*keys, F.explode(F.array(F.struct(F.lit("w").alias("kind"), F.col("work").alias("id")), F.struct(F.lit("t").alias("kind"), F.col("track").alias("id")))).alias("_i")).select(*keys, "_i.kind", "_i.id").where("id is not null").distinct()
    ids = ids.select(*keys, "kind", "id", F.lit(0).cast("bigint").alias("rows"), F.lit(None).cast("double").alias("score"))
    flat = long.groupBy(*keys, F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("rows"), F.max("match_score").alias("score"))
    flat = flat.select(*keys, none.alias("kind"), none.alias("id"), "rows", "score")
    leaf = [F.sum("rows").alias("n_rows"), F.count_if(F.col("kind") == "w").alias("n_works"), F.count_if(F.col("kind") == "t").alias("n_tracks"), F.max("score").alias("best_score")]
    merge = [F.sum("n_rows").alias("n_rows"), F.sum("n_works").alias("n_works"), F.sum("n_tracks").alias("n_tracks"), F.max("best_score").alias("best_score")]
    return tree_aggregate(ids.unionByName(flat), keys, leaf, merge, n, F.xxhash64("id"))


def heavy_titles(df: DataFrame, share: float = 0.01, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(field, title) of the non-null titles that hold at least `share` of all rows; rows with a null title count among all rows."""
    rows = df.count()
    return title_rows(df, chunk_rows).where(F.col("n_rows") >= share * rows).select("field", "title")


def p6_found(spark, sf_dir: str) -> DataFrame:
    return heavy_titles(table(spark, sf_dir, "title_matches_lsh"))


def p6_title_stats(spark, sf_dir: str) -> DataFrame:
    return title_stats(table(spark, sf_dir, "title_matches_lsh"))


SQL = {
    "p6_found": """
        WITH l AS (SELECT 'apra_cleaned_title' AS field, apra_cleaned_title AS title FROM title_matches_lsh
                   UNION ALL SELECT 'muzooka_cleaned_title', muzooka_cleaned_title FROM title_matches_lsh)
        SELECT field, title FROM l WHERE title IS NOT NULL GROUP BY field, title
        HAVING count(*) >= 0.01 * (SELECT count(*) FROM title_matches_lsh)""",
    "p6_title_stats": """
        WITH l AS (SELECT 'apra_cleaned_title' AS field, apra_cleaned_title AS title, nullif(upper(trim(apra_work_id)), '') AS w, nullif(upper(trim(muzooka_track_id)), '') AS t, match_score FROM title_matches_lsh
                   UNION ALL SELECT 'muzooka_cleaned_title', muzooka_cleaned_title, nullif(upper(trim(apra_work_id)), ''), nullif(upper(trim(muzooka_track_id)), ''), match_score FROM title_matches_lsh)
        SELECT field, title, count(*) AS n_rows, count(DISTINCT w) AS n_works, count(DISTINCT t) AS n_tracks, max(match_score) AS best_score
        FROM l WHERE title IS NOT NULL GROUP BY field, title""",
}

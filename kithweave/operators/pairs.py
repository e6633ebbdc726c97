"""Pairs of works and tracks of matched titles, kept by classes of works with the same titles: what is the same for all works of a class is joined, numbered and told once,
and pairs come out of the last join without a shuffle of their own."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.near import near_jaro_winkler, near_names
from ..runtime import cut, cut_each, kept, release, settled
from . import composite

#: Texts of a block that are compared by one matrix; works of a class from which on its tracks are repeated for parts of it.
CHUNK, CLASS_ROWS = 400, 500
#: Shares of the works whose names are scored one after the other: all of them, but what they shuffle is not on disk at once.
SHARES = 4
#: What products are partitioned by.
PARTS = ["cls", "_part"]
SCORERS = {"jaro_winkler": near_jaro_winkler, "names": near_names}


def _tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def _chunks(df: DataFrame, side: str) -> DataFrame:
    """(k, c, texts): the distinct texts of each block in chunks of about CHUNK by their hash."""
    n = df.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("n"))
    return df.join(n, "k").groupBy("k", F.pmod(F.xxhash64("t"), "n").alias(f"c{side}")).agg(F.collect_list("t").alias(side))


def near_pairs(x: DataFrame, y: DataFrame, least: float, scorer: str = "jaro_winkler", gap: int | None = None) -> DataFrame:
    """(k, x, y, score): the pairs of texts of a block k, one of x (k, t) and one of y (k, t), that score `least` or more; gap: by how much their lengths may differ.

    Chunks of both sides are compared as matrices, small blocks several at a time; texts of different blocks never make a pair.
    """
    near = SCORERS[scorer]

    def found(block):
        ks, xs, ys = ([], []), [], []
        for k, p, q in block:
            xs += list(p)
            ys += list(q)
            ks[0].extend([k] * len(p))
            ks[1].extend([k] * len(q))
        same = None
        if len(block) > 1:
            at = {k: n for n, k in enumerate(dict.fromkeys(ks[0]))}
            same = np.array([at[k] for k in ks[0]], dtype=np.int32)[:, None] == np.array([at[k] for k in ks[1]], dtype=np.int32)[None, :]
        if gap is not None:
            close = np.abs(np.array([len(t) for t in xs], dtype=np.int32)[:, None] - np.array([len(t) for t in ys], dtype=np.int32)[None, :]) <= gap
            same = close if same is None else same & close
        got = [(ks[0][i], xs[i], ys[j], s) for i, j, s in near(xs, ys, least, same)]
        return pd.DataFrame(got, columns=["k", "x", "y", "score"])

    def run(batches):
        block, a, b = {}, 0, 0
        for batch in batches:
            for k, p, q in zip(batch["k"], batch["x"], batch["y"]):
                # chunks of one block may share texts, so no two of them stand in one matrix
                if block and (k in block or max(a + len(p), b + len(q)) > CHUNK // 2):
                    yield found(list(block.values()))
                    block, a, b = {}, 0, 0
                block[k] = (k, p, q)
                a, b = a + len(p), b + len(q)
        if block:
            yield found(list(block.values()))

    both = _chunks(x.distinct(), "x").join(_chunks(y.distinct(), "y"), "k")
    kind = dict(x.dtypes)["k"]
    return both.repartition(_tasks(x), "k", "cx", "cy").select("k", "x", "y").mapInPandas(run, f"k {kind}, x string, y string, score double")


def fuzzy_texts(a: DataFrame, m: DataFrame, least: float = 0.90, prefix: int = 3) -> DataFrame:
    """(x, y, score): titles of a and m of the same first characters that are similar; those of m have no equal one in a."""
    xs, ys = a.select(F.col("title").alias("t")).distinct(), m.select(F.col("title").alias("t")).distinct()
    block = F.substring("t", 1, prefix).alias("k")
    return near_pairs(xs.select(block, "t"), ys.join(xs, "t", "left_anti").select(block, "t"), least).select("x", "y", F.round(F.col("score") * 100, 4).alias("score"))


def band_titles(a: DataFrame, m: DataFrame, width: int = 5, least: float = 0.90) -> DataFrame:
    """Pairs of similar titles of equal first character and lengths at most `width` apart: lengths are cut into bands, each title goes to its own and
    the neighbouring ones of the other side, and first character and band are the block."""
    band = lambda n: F.concat(F.substring("t", 1, 1), F.lit(":"), n.cast("string")).alias("k")
    own = F.floor(F.length("t") / (width + 1)).cast("int")
    xs, ys = a.select(F.col("title").alias("t")).distinct(), m.select(F.col("title").alias("t")).distinct()
    texts = near_pairs(xs.select(band(own), "t"), ys.select("t", F.explode(F.array(own - 1, own, own + 1)).alias("n")).select(band(F.col("n")), "t"), least, gap=width)
    tracks = texts.drop("k").join(m.select("track_id", F.col("title").alias("y")).distinct(), "y").withColumnRenamed("x", "cls")
    j = product(a.select(F.col("title").alias("cls"), "apra_work_id").distinct(), tracks)
    return j.select("apra_work_id", "track_id", F.col("cls").alias("apra_title"), F.col("y").alias("muzooka_title"), F.round(F.col("score") * 100, 4).alias("score"))


def match_stats(met: Matched) -> DataFrame:
    """Counts of the pairs by whether the identifiers agree. A pair's rows are in one partition, and so are a work's of a class: only tracks are made distinct over all."""
    j = met.rows(keys=True)
    pair = j.groupBy(*PARTS, "apra_work_id", "iswc_match", "track_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") == 100).alias("e"), F.sum("score").alias("s"))
    work = pair.groupBy(*PARTS, "apra_work_id", "iswc_match").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("p"), F.sum("e").alias("e"), F.sum("s").alias("s"))
    out = work.groupBy("iswc_match").agg(F.sum("n").alias("n_rows"), F.count("apra_work_id").alias("n_works"), F.sum("p").alias("n_pairs"), F.sum("e").alias("n_exact"), F.sum("s").alias("s"))
    tracks = j.groupBy("iswc_match").agg(F.count_distinct("track_id").alias("n_tracks"))
    return out.join(tracks, "iswc_match").select("iswc_match", "n_rows", "n_works", "n_tracks", "n_pairs", "n_exact", F.round(F.col("s") / F.col("n_rows"), 6).alias("mean_score"))


@dataclass
class Matched:
    """works: (cls, apra_work_id, x, codes), a row for each title x of a work; tracks: (cls, track_id, x, y, score, codes_m), a row for each pair of titles by which a class meets a track."""

    works: DataFrame
    tracks: DataFrame

    def numbered(self) -> Matched:
        """With `before` and `rank`, whose sum is the dense rank of (apra_work_id, track_id) over all pairs."""
        # one shuffle by class serves both windows and the counts
        by = self.tracks.repartition(_tasks(self.tracks), "cls")
        tracks = by.withColumn("rank", F.dense_rank().over(Window.partitionBy("cls").orderBy(F.asc_nulls_first("track_id"))).cast("bigint"))
        n = tracks.groupBy("cls").agg(F.max("rank").alias("n"))
        works = self.works.select("apra_work_id", "cls").distinct().join(n, "cls")
        spread = cut(works.repartitionByRange(int(works.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.asc_nulls_first("apra_work_id")).withColumn("_p", F.spark_partition_id()))
        before = spread.groupBy("_p").agg(F.sum("n").alias("s")).select("_p", F.coalesce(F.sum("s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
        inside = Window.partitionBy("_p").orderBy(F.asc_nulls_first("apra_work_id")).rowsBetween(Window.unboundedPreceding, -1)
        # one row for each partition: small enough to broadcast
        offset = spread.withColumn("_i", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(before), "_p").select("cls", F.col("apra_work_id").alias("_w"), (F.col("_b") + F.col("_i")).cast("bigint").alias("before"))
        w = self.works.join(offset.withColumnRenamed("cls", "_c"), (F.col("cls") == F.col("_c")) & F.col("apra_work_id").eqNullSafe(F.col("_w"))).drop("_c", "_w")
        return Matched(w, tracks)

    def rows(self, pairs: DataFrame | None = None, keys: bool = False) -> DataFrame:
        """(apra_work_id, track_id, apra_title, muzooka_title, score, iswc_match, ...) of all pairs, or of `pairs` (apra_work_id, up), up being the track's id in capitals. keys: with
        PARTS, by which all rows of a pair are in one partition already, so that grouping by these and more shuffles nothing."""
        # a title of a work or a track may come with several identifiers; what can be told of one side is told before the pairs are made
        works = self.works.withColumn("_told", F.filter("codes", lambda c: c != "")).withColumn("_one", F.size("codes") == 1).drop("codes")
        tracks = self.tracks.withColumn("_one_m", F.size("codes_m") == 1)
        if pairs is None:
            # as two comparisons, since an equation would become a key of the join and change what it is partitioned by
            j = product(works, tracks.withColumnRenamed("x", "_x"), keys=True).where("x <= _x and x >= _x").drop("_x")
        else:
            j = pairs.join(works, "apra_work_id").join(tracks.withColumn("up", F.upper("track_id")), ["cls", "x", "up"]).drop("up")
        alike = (F.size("_told") > 0) & F.arrays_overlap("_told", "codes_m")
        flags = F.when(~alike, F.array(F.lit("N"))).when(F.col("_one") & F.col("_one_m"), F.array(F.lit("Y"))).otherwise(F.array(F.lit("Y"), F.lit("N")))
        j = j.withColumn("iswc_match", F.explode(flags)).drop("_told", "_one", "_one_m").withColumnsRenamed({"x": "apra_title", "y": "muzooka_title"})
        rank = [(F.col("before") + F.col("rank")).alias("rdc_works_id")] if "rank" in j.columns else []
        return j.select("apra_work_id", "track_id", "apra_title", "muzooka_title", "score", "iswc_match", *rank, *[c for c in j.columns if c.startswith("_") and c != "_part"], *(PARTS if keys else []))

    def sides(self, upper: bool = True) -> tuple[DataFrame, DataFrame]:
        """(cls, apra_work_id), (cls, track_id): of both sides, whose classes make the pairs; track ids in capitals."""
        return self.works.select("cls", "apra_work_id").distinct(), self.tracks.select("cls", (F.upper("track_id") if upper else F.col("track_id")).alias("track_id")).distinct()


def product(works: DataFrame, tracks: DataFrame, keys: bool = False) -> DataFrame:
    """works and tracks joined by class; a class of many works is cut into parts by their hash, and its tracks are repeated for each, so no class is met in one task."""
    parts = works.groupBy("cls").agg(F.ceil(F.count(F.lit(1)) / CLASS_ROWS).cast("int").alias("_n"))
    w = works.join(parts, "cls").withColumn("_part", F.pmod(F.xxhash64("apra_work_id"), "_n").cast("int")).drop("_n")
    t = tracks.join(parts, "cls").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    n = _tasks(works)
    j = w.repartition(n, *PARTS).join(t.repartition(n, *PARTS).hint("merge"), PARTS)
    return j if keys else j.drop("_part")


def matched(a: DataFrame, m: DataFrame, keep: bool = True) -> Matched:
    """Works and tracks of equal or of similar titles. A pair that a similar title joins isn't joined by equal ones too. keep: both sides, cleansed, and the class rows are written once, as several steps read them."""
    works = a.groupBy("apra_work_id", F.col("title").alias("x")).agg(F.collect_set("iswc").alias("codes"))
    if keep:  # else titles are cleansed once more for the classes
        works = cut(works)
    named = works.groupBy("apra_work_id").agg(F.array_sort(F.collect_set("x")).alias("xs"))
    # cleansed titles hold no line ends
    named = named.select(F.col("apra_work_id").alias("_w"), F.array_join("xs", "\n").alias("cls"))
    works = works.join(named, F.col("apra_work_id").eqNullSafe(F.col("_w"))).select("cls", "apra_work_id", "x", "codes")
    tracks = m.groupBy("track_id", F.col("title").alias("y")).agg(F.collect_set("iswc").alias("codes_m"))
    if keep:
        works, tracks = cut(works), cut(tracks)
    titles = works.select("cls", "x").distinct()
    xs = titles.select("x").distinct()
    same = tracks.join(xs, F.col("y") == F.col("x"), "left_semi").select(F.col("y").alias("x"), "y", F.lit(100.0).alias("score"), "track_id", "codes_m", F.lit(False).alias("fuzzy"))
    close = fuzzy_texts(works.select(F.col("x").alias("title")), tracks.select(F.col("y").alias("title"))).join(tracks, "y").select("x", "y", "score", "track_id", "codes_m", F.lit(True).alias("fuzzy"))
    met = titles.join(same.unionByName(close), "x")
    told = F.max("fuzzy").over(Window.partitionBy("cls", "track_id"))
    met = met.withColumn("_f", told).where("fuzzy or not _f").select("cls", "track_id", "x", "y", "score", "codes_m")
    return Matched(works, cut(met) if keep else met)


# --- names ------------------------------------------------------------------------------------------------------------------------
def hit_scores(a: DataFrame, m: DataFrame, works: DataFrame, tracks: DataFrame, scorer: str) -> DataFrame:
    """(apra_work_id, track_id, apra_part, best): of the pairs of a class of which any two parts of names are alike, each part of the work that is with its best score on the track.
    With rdc_works_id where works have `before` and tracks `rank`. A cut."""
    given = "rank" in tracks.columns
    p = works.join(a.select("apra_work_id", F.explode("delimited_parts").alias("t")).distinct(), "apra_work_id").select("cls", "apra_work_id", "t", *(["before"] if given else []))
    q = tracks.join(m.select("track_id", F.explode("delimited_parts").alias("t")).distinct(), "track_id").select("cls", "track_id", "t", *(["rank"] if given else []))
    near = cut(near_pairs(p.select(F.col("cls").alias("k"), "t"), q.select(F.col("cls").alias("k"), "t"), composite.LEAST_PART, scorer).withColumnRenamed("k", "cls"))
    release(near.sparkSession)
    number = [(F.col("before") + F.col("rank")).alias("rdc_works_id")] if given else []

    def of(i: int) -> DataFrame:
        alike = near.join(shared(p, i).withColumnRenamed("t", "x"), ["cls", "x"]).join(q.withColumnRenamed("t", "y"), ["cls", "y"])
        return alike.groupBy("apra_work_id", "track_id", F.col("x").alias("apra_part"), *number).agg(F.max("score").alias("best"))

    return cut_each(of(i) for i in range(SHARES))


def shared(df: DataFrame, i: int) -> DataFrame:
    """The rows of the works of share i."""
    return df.where(F.pmod(F.xxhash64("apra_work_id", F.lit("share")), F.lit(SHARES)) == i)


def without(works: DataFrame, hits: DataFrame) -> DataFrame:
    """works with `_hits`, their tracks of the pairs that are told elsewhere."""
    return works.join(hits.groupBy("apra_work_id").agg(F.collect_set("track_id").alias("_hits")), "apra_work_id", "left")


def untold(j: DataFrame, track: str = "track_id") -> DataFrame:
    return j.where(F.col("_hits").isNull() | ~F.array_contains("_hits", F.col(track))).drop("_hits")


def names_over(a: DataFrame, m: DataFrame, works: DataFrame, tracks: DataFrame, kind: str, scorer: str) -> DataFrame:
    """composite.match_composers or match_artists over all pairs of the classes. Pairs of which no two parts are alike score nothing, so only the others are scored; the rest is the
    names of the works beside the counts of the tracks. works may have `before`, tracks `rank`; their sum is the pair's rdc_works_id then."""
    given = "rank" in tracks.columns
    # the names of both sides are cut into parts once, and read by several steps; so are the classes. What a step shuffles is off the disk when the next begins
    a, m, works, tracks = map(kept, (a, m, works, tracks))
    best = settled(lambda: hit_scores(a, m, works, tracks, scorer))
    hits = best.select("apra_work_id", "track_id").distinct()

    def scored(i: int) -> DataFrame:
        match = composite.match_composers if kind == "composers" else composite.match_artists
        ours = shared(best, i)
        told = match(shared(a, i), m, ours.select("apra_work_id", "track_id").distinct(), scorer, ours.select("apra_work_id", "track_id", "apra_part", "best").distinct() if given else ours)
        return told.join(ours.select("apra_work_id", "track_id", "rdc_works_id").distinct(), ["apra_work_id", "track_id"]) if given else told

    told = cut_each(scored(i) for i in range(SHARES))
    zero = F.lit(0.0)
    if kind == "composers":
        names = a.groupBy("apra_work_id", "entity_id").agg(F.max("total_names").alias("apra_total"))
        meta = m.groupBy("track_id").agg(F.max("total_names").alias("muzooka_total"))
        out = [zero.alias("name_match_score"), F.lit(0).cast("bigint").alias("parts_matched"), "apra_total", F.coalesce("muzooka_total", F.lit(0)).alias("muzooka_total"), zero.alias("composer_match_share")]
    else:
        names = a.groupBy("apra_work_id", "entity_id", "normalized_name").agg(F.max("part_ct").alias("apra_part_ct"), F.max("total_names").alias("apra_total"))
        most = m.groupBy("track_id").agg(F.max(F.struct("part_ct", "total_names")).alias("_m"))
        meta = most.select("track_id", F.col("_m.part_ct").alias("muzooka_part_ct"), F.col("_m.total_names").alias("muzooka_total"))
        out = ["normalized_name", "apra_total", "muzooka_total", "apra_part_ct", "muzooka_part_ct", zero.alias("part_match_score"), zero.alias("name_match_score"), zero.alias("artist_match_total")]
    rest = untold(product(without(works, hits).join(names, "apra_work_id"), tracks.join(meta, "track_id", "left")))
    more = [(F.col("before") + F.col("rank")).alias("rdc_works_id")] if given else []
    return told.unionByName(rest.select("apra_work_id", "track_id", "entity_id", *out, *more))

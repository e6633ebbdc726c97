"""Further queries over the catalogues: older scores of names, matches by any of several forms, partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import acts
from ..functions import strings as S
from ..functions.credits import credit_parts_col
from ..operators import ids, linkage
from ..runtime import clean_id, table
from . import reference as R

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


_F = r"trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'), '\s+', ' ', 'g'))"
_ANY = rf"""x AS (SELECT DISTINCT apra_work_id, {_F} AS f, replace({_F}, ' ', '') AS c, regexp_replace({_F}, '^(the|a|an) ', '') AS n FROM adcworks), y AS (SELECT DISTINCT track_id, {_F} AS f, replace({_F}, ' ', '') AS c, regexp_replace({_F}, '^(the|a|an) ', '') AS n FROM tracks)"""


@query(f"WITH {_ANY} SELECT DISTINCT apra_work_id, track_id FROM x JOIN y ON (x.f = y.f AND x.f <> '') OR (x.c = y.c AND x.c <> '') OR (x.n = y.n AND x.n <> '')")
def ref_title_any_form(spark, d) -> DataFrame:
    """Pairs whose titles agree in one of three forms: an equi-join for each form instead of a join on any."""

    def side(name, key):
        t, c = table(spark, d, name).select(key, "title").where("title is not null").distinct(), F.col("title")
        forms = F.array(*(F.struct(F.lit(k).alias("k"), f(c).alias("v")) for k, f in (("clean", S.clean_form), ("compact", S.compact_form), ("no article", S.no_article_form))))
        return t.select(key, F.explode(forms).alias("f")).select(key, "f.k", "f.v").where("v <> ''").distinct()

    return side("adcworks", "apra_work_id").join(side("tracks", "track_id"), ["k", "v"]).select("apra_work_id", "track_id").distinct()


def _act_pairs(spark, d) -> DataFrame:
    p = R.iswc_pairs(spark, d).select("apra_work_id", F.upper("track_id").alias("track_id")).distinct()
    a = table(spark, d, "adcartists").select("apra_work_id", F.col("name").alias("a")).where("a <> ''").distinct()
    m = table(spark, d, "recordings").select(clean_id("track_id").alias("track_id"), F.col("artist_name").alias("b")).where("b <> ''").distinct()
    return p.join(a, "apra_work_id").join(m, "track_id")


@query()
def ref_act_rules(spark, d) -> DataFrame:
    """Performers of matched records by rules, and which name is a variant of the other."""
    j = _act_pairs(spark, d)
    scored = j.select("a", "b").distinct().withColumn("rule_score", acts.rule_score_col("a", "b")).withColumn("_v", acts.variant_flags_col("a", "b")).select("a", "b", "rule_score", "_v.*")
    return j.join(scored, ["a", "b"])


@query()
def ref_act_arrays(spark, d) -> DataFrame:
    """Performers of a work beside those of a track, list against list."""
    p = R.iswc_pairs(spark, d).select("apra_work_id", F.upper("track_id").alias("track_id")).distinct()
    a = table(spark, d, "adcartists").where("name is not null").select("apra_work_id", F.explode(credit_parts_col("name")).alias("n")).groupBy("apra_work_id").agg(F.array_sort(F.collect_set("n")).alias("x"))
    m = table(spark, d, "recordings").where("artist_name is not null").select(clean_id("track_id").alias("track_id"), F.explode(credit_parts_col("artist_name")).alias("n")).groupBy("track_id").agg(F.array_sort(F.collect_set("n")).alias("y"))
    return p.join(a, "apra_work_id").join(m, "track_id").select("apra_work_id", "track_id", acts.array_score_col("x", "y").alias("array_score"))


@query()
def ref_parsed_names(spark, d) -> DataFrame:
    """Composers' names read once, with points and the other order."""
    n = table(spark, d, "adc_composers").select(F.upper(F.trim("name")).alias("name")).where("name <> ''").distinct()
    return n.withColumn("_r", acts.reading_col("name")).select("name", "_r.*")


@query()
def ref_point_scores(spark, d) -> DataFrame:
    """Composers of matched records by points and by composition."""
    n = R._name_lists(spark, d).select(F.explode("apra_names").alias("a"), "muzooka_names").select("a", F.explode("muzooka_names").alias("b")).distinct()
    return n.select("a", "b", acts.point_similarity_col("a", "b").alias("point_similarity"), acts.composition_ratio_col("a", "b").alias("composition_ratio"))


@query("SELECT row_number() OVER (ORDER BY k) AS rdc_isrc_id, k AS isrc_key FROM (SELECT DISTINCT " + R._ISRC + " AS k FROM recordings WHERE isrc IS NOT NULL)")
def ref_isrc_numbers(spark, d) -> DataFrame:
    """Identifiers of recordings numbered in order."""
    k = table(spark, d, "recordings").where("isrc is not null").select(S.isrc_key(F.col("isrc")).alias("isrc_key")).distinct()
    return ids.dense_ids(k, ["isrc_key"], "rdc_isrc_id")


@query()
def ref_work_buckets(spark, d) -> DataFrame:
    """Works per hash bucket of 100."""
    return table(spark, d, "adcworks").select("apra_work_id").distinct().groupBy(ids.hash_bucket("apra_work_id", 100).alias("partition_id")).agg(F.count(F.lit(1)).alias("n_works"))


@query(f"""WITH {R._PAIRS}, r AS (SELECT DISTINCT upper(p.track_id) AS track_id, p.apra_work_id, a.name FROM pairs p LEFT JOIN adcartists a USING (apra_work_id)) SELECT apra_work_id, track_id, count(name) AS n_artists FROM r GROUP BY ALL""")
def ref_artists_or_none(spark, d) -> DataFrame:
    """Artists of matched works, none where a work has none: the left form of the final join."""
    p = R.iswc_pairs(spark, d).select("apra_work_id", F.upper("track_id").alias("track_id")).distinct()
    return p.join(table(spark, d, "adcartists").select("apra_work_id", "name").distinct(), "apra_work_id", "left").groupBy("apra_work_id", "track_id").agg(F.count("name").alias("n_artists"))


@query(f"WITH {R._AA}, {R._MM} SELECT DISTINCT title FROM mm WHERE title NOT IN (SELECT title FROM aa)")
def ref_titles_without_partner(spark, d) -> DataFrame:
    return R._mm(spark, d).join(R._aa(spark, d), "title", "left_anti").select("title").distinct()


@query("SELECT DISTINCT adc_composer_id, name FROM adc_composers WHERE trim(name) <> '' AND upper(name) NOT IN ('TRAD', 'TRADITIONAL', 'ARR')")
def ref_named_composers(spark, d) -> DataFrame:
    """Composers with a name that is no placeholder."""
    c = table(spark, d, "adc_composers").select("adc_composer_id", "name")
    return c.where((F.trim("name") != "") & ~F.upper("name").isin("TRAD", "TRADITIONAL", "ARR")).distinct()


@query("SELECT coalesce(status, 'none') AS status, count(*) AS n, count(DISTINCT recordings_id) AS n_ids, count(DISTINCT CASE WHEN isrc IS NOT NULL THEN recordings_id END) AS n_coded FROM recordings GROUP BY 1")
def ref_status_counts(spark, d) -> DataFrame:
    return table(spark, d, "recordings").groupBy(F.coalesce("status", F.lit("none")).alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("recordings_id").alias("n_ids"), F.count_distinct(F.when(F.col("isrc").isNotNull(), F.col("recordings_id"))).alias("n_coded"))


@query()
def ref_title_minmax_pairs(spark, d) -> DataFrame:
    """Similar titles of both sides without an exact partner on either."""
    a, m = R._aa(spark, d), R._mm(spark, d)
    return linkage.prefix_block_titles(a.join(m.select("title").distinct(), "title", "left_anti"), m)

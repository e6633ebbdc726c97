"""Operators of earlier generations of the pipeline, and the pipeline over whole titles: a query and, where SQL can express it, its SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import older as O
from ..functions import strings as S
from ..functions.credits import credit_parts_col
from ..functions.similarity import jaro_winkler_col
from ..functions.titles import title_variants_col
from ..operators import composite, ids, linkage, pairs
from ..runtime import clean_id, cut, settled, table
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


def _jw_sql(a: str, b: str) -> str:
    """Jaro-Winkler with the prefix counted at every similarity; the SQL engine's own counts it above 0.7 only."""
    prefix = " ".join(f"WHEN length({a}) >= {n} AND {a}[1:{n}] = {b}[1:{n}] THEN {n}" for n in (4, 3, 2, 1))
    return f"(jaro_similarity({a}, {b}) + 0.1 * (CASE {prefix} ELSE 0 END) * (1 - jaro_similarity({a}, {b})))"


# --- titles -----------------------------------------------------------------------------------------------------------------------
@query(f"WITH {R._A}, {R._M} SELECT DISTINCT a.apra_work_id, m.track_id, a.title AS apra_title, m.title AS muzooka_title, 100.0::DOUBLE AS score, {R._FLAG} FROM a JOIN m ON a.title = m.title")
def ref_full_title_exact(spark, d):
    """Equal cleansed titles with every character they have: titles of any script join."""
    return linkage.exact_titles(R._a(spark, d), R._m(spark, d))


def variant_titles(df: DataFrame, key: str) -> DataFrame:
    """(key, original_title, title, iswc): the cleansed form of every title, or of each of its variants where it has any."""
    t = df.select(key, F.col("title").alias("original_title"), S.iswc_key(F.col("iswc")).alias("iswc")).where("original_title is not null").distinct()
    t = t.withColumn("_v", title_variants_col("original_title"))
    t = t.select(key, "original_title", "iswc", F.explode(F.when(F.size("_v") > 0, F.col("_v")).otherwise(F.array("original_title"))).alias("_t"))
    return t.select(key, "original_title", S.cleanse_title(F.col("_t")).alias("title"), "iswc").where("title <> ''").distinct()


def canonical_matched(spark, d) -> pairs.Matched:
    """The canonical pipeline: variants of both sides' titles, cleansed; equal ones, similar ones in blocks, both together with dense ids of the pairs."""
    a, m = variant_titles(table(spark, d, "adcworks"), "apra_work_id"), variant_titles(table(spark, d, "tracks"), "track_id")
    return pairs.matched(a, m).numbered()


@query()
def ref_canonical_matches(spark, d):
    return canonical_matched(spark, d).rows()


@query()
def ref_canonical_composers(spark, d):
    """Composers over the canonical matches: credits of both sides cut by the splitters of their kind, parts compared over all readings of the names."""
    return _canonical_names(spark, d, "composers")


@query()
def ref_canonical_artists(spark, d):
    """Artists over the canonical matches; the works' credits are cut at apostrophes too."""
    return _canonical_names(spark, d, "artists")


def _canonical_names(spark, d, kind: str) -> DataFrame:
    sides = {"composers": (("adc_composers", "apra_work_id", "adc_composer_id", "name"), ("composers", "track_id", "composer_id", "composer")), "artists": (("adcartists", "apra_work_id", "adc_artist_id", "name"), ("recordings", "track_id", "recordings_id", "artist_name"))}
    entity = kind.removesuffix("s")

    def names(side: str, tab: str, rec: str, ent: str, name: str) -> DataFrame:
        rows = table(spark, d, tab).select(clean_id(rec).alias(rec), F.col(ent).alias("entity_id"), F.col(name).alias("nm")).where(F.trim("nm") != "").where(F.col(rec).isNotNull()).distinct()
        parts = credit_parts_col("nm", "artist" if entity == "artist" else "composer", quotes_split=side == "a" and entity == "artist")
        # credits are split once, not for each of the steps that read them
        rows = cut(rows.withColumn("_parts", parts))
        return composite.count_parts(composite.expand_names(rows, "nm", entity, parts=F.col("_parts")).drop("_parts"), rec)

    def classes() -> tuple[DataFrame, DataFrame]:
        met = canonical_matched(spark, d)
        works = met.works.select("cls", clean_id("apra_work_id").alias("apra_work_id"), "before").where("apra_work_id is not null").distinct()
        return works, met.tracks.select("cls", clean_id("track_id").alias("track_id"), "rank").where("track_id is not null").distinct()

    works, tracks = settled(classes)
    a, m = settled(lambda: tuple(names(side, *x) for side, x in zip("am", sides[kind])))
    return pairs.names_over(a, m, works, tracks, kind, "names")


_PLAIN = r"trim(regexp_replace(translate(regexp_replace(replace(lower(coalesce(title, '')), 'ς', 'σ'), '^(a|an|the)\s+', ''), {p}, ''), '\s+', ' ', 'g'), ' ')".format(p="'" + O.PUNCTUATION.replace("'", "''") + "'")


@query(f"SELECT DISTINCT track_id, title, {_PLAIN} AS plain FROM tracks")
def ref_plain_titles(spark, d):
    return table(spark, d, "tracks").select("track_id", "title", O.plain_title(F.col("title")).alias("plain")).distinct()


@query(r"""SELECT DISTINCT track_id, title, upper(regexp_replace(title, '[^A-Z0-9\s]', ' ', 'g')) AS clean, upper(regexp_replace(title, '[^A-Z0-9]', '', 'g')) AS compact,
    upper(regexp_replace(regexp_replace(title, '[^A-Z0-9\s]', ' ', 'g'), '^(THE|A|AN)\s+', '')) AS no_article, CAST(len(regexp_extract_all(title, '[A-Z]')) AS INTEGER) AS n_capitals FROM tracks WHERE title IS NOT NULL AND regexp_full_match(title, '[ -~]*')""")
def ref_late_upper_forms(spark, d):
    """The earlier forms of plain ASCII titles, put into capitals after everything else was deleted; and how many capitals a title has."""
    t, c = table(spark, d, "tracks").where("title is not null").where(F.col("title").rlike("^[ -~]*$")).select("track_id", "title").distinct(), F.col("title")
    return t.select("track_id", "title", O.late_upper(c).alias("clean"), O.late_upper(c, "compact").alias("compact"), O.late_upper(c, "no_article").alias("no_article"), F.regexp_count(c, F.lit("[A-Z]")).alias("n_capitals"))


@query(rf"""WITH {R._TM}, w AS (SELECT x, y, fx, fy, list_filter(string_split(fx, ' '), lambda t: t <> '') AS wx, list_filter(string_split(fy, ' '), lambda t: t <> '') AS wy FROM q)
    SELECT x, y, round(greatest(CASE WHEN fx = '' OR fy = '' THEN 0 ELSE {_jw_sql('fx', 'fy')} END, CASE WHEN len(wx) > 0 AND len(wy) > 0 THEN 0.8 * len(list_filter(wx, lambda t: list_contains(wy, t))) / greatest(len(wx), len(wy)) ELSE 0 END), 9) AS similarity FROM w""")
def ref_title_overlap(spark, d):
    """The larger of Jaro-Winkler and 0.8 times the share of common words, over the clean forms."""
    t = R._title_pairs(spark, d).withColumn("jw", jaro_winkler_col("fx", "fy"))
    return t.select("x", "y", F.round(F.greatest(F.col("jw"), 0.8 * O.words_overlap(F.col("fx"), F.col("fy"))), 9).alias("similarity"))


@query(rf"WITH {R._TM} SELECT x, y FROM q WHERE lower(x) = lower(y) OR fx = fy OR cx = cy OR regexp_replace(fx, '^(the|a|an) ', '') = regexp_replace(fy, '^(the|a|an) ', '') OR (cx <> '' AND cy <> '' AND jaro_winkler_similarity(cx, cy) >= 0.9)")
def ref_any_form_or_alike(spark, d):
    """Pairs of titles that are equal in one of four forms or similar: equal ones are told first, and only the rest is scored."""
    t = R._title_pairs(spark, d)
    equal = (F.lower("x") == F.lower("y")) | (F.col("fx") == F.col("fy")) | (F.col("cx") == F.col("cy")) | (S.no_article_form(F.col("x")) == S.no_article_form(F.col("y")))
    rest = t.where(~equal).where("cx <> '' and cy <> ''").withColumn("jw", jaro_winkler_col("cx", "cy")).where("jw >= 0.9")
    return t.where(equal).select("x", "y").unionByName(rest.select("x", "y"))


@query()
def ref_round_variants(spark, d):
    """The older variants of the works' titles."""
    return table(spark, d, "adcworks").select("title").where("title is not null").distinct().select("title", F.explode(O.round_bracket_variants_col("title")).alias("variant"))


# --- names ------------------------------------------------------------------------------------------------------------------------
def _stop_sql(c: str) -> str:
    bare = rf"regexp_replace(upper(coalesce({c}, '')), '\([^)]*\)', '', 'g')"
    spaced = rf"""regexp_replace({bare}, '[''"`\-_&+\[\]]', ' ', 'g')"""
    kept = rf"trim(regexp_replace(regexp_replace({spaced}, '[^a-zA-Z0-9 ]', '', 'g'), '\s+', ' ', 'g'), ' ')"
    less = kept
    for w in O.STOP_WORDS:
        less = rf"regexp_replace({less}, '\b{w}\b', ' ', 'g')"
    less = rf"trim(regexp_replace({less}, '\s+', ' ', 'g'), ' ')"
    return f"CASE WHEN {kept} = '' THEN {bare} WHEN {less} = '' THEN trim({spaced}, ' ') ELSE {less} END"


# words next to other scripts' letters end where the engine's own tables say, so the SQL is of plain ASCII names
_ASCII_NAMES = "name IS NOT NULL AND regexp_full_match(name, '[ -~]*')"


@query(f"SELECT DISTINCT name, {_stop_sql('name')} AS clean FROM adcartists WHERE {_ASCII_NAMES}")
def ref_stop_word_names(spark, d):
    return table(spark, d, "adcartists").select("name").where("name is not null").where(F.col("name").rlike("^[ -~]*$")).distinct().select("name", O.stop_word_name(F.col("name")).alias("clean"))


def _expansion_sql(c: str) -> str:
    out = f"translate(upper({c}), '{O.EXPANSION_MARKS.replace(chr(39), chr(39) * 2)}', '{'/' * len(O.EXPANSION_MARKS)}')"
    for w in O.EXPANSION_WORDS:
        out = f"trim(replace(' ' || {out} || ' ', ' {w} ', '/'), ' ')"
    return f"list_filter(list_transform(string_split({out}, '/'), lambda p: trim(p, ' ')), lambda p: length(p) > 2 AND p <> {c})"


@query(f"SELECT DISTINCT adc_artist_id, name, 'ORIGINAL' AS kind FROM adcartists WHERE name IS NOT NULL UNION SELECT DISTINCT adc_artist_id, unnest({_expansion_sql('name')}) AS name, 'VARIANT' AS kind FROM adcartists WHERE name IS NOT NULL")
def ref_slash_expansion(spark, d):
    """A row for each name, and one for each part of it by the older expansion."""
    n = table(spark, d, "adcartists").select("adc_artist_id", "name").where("name is not null").distinct()
    more = n.select("adc_artist_id", F.explode(O.expansion_parts(F.col("name"))).alias("name"), F.lit("VARIANT").alias("kind"))
    return n.withColumn("kind", F.lit("ORIGINAL")).unionByName(more).distinct()


@query()
def ref_dash_parts(spark, d):
    return table(spark, d, "recordings").select("artist_name").where("artist_name is not null").distinct().select("artist_name", F.posexplode(O.dash_credit_parts_col("artist_name")).alias("pos", "part"))


@query()
def ref_older_name_scores(spark, d):
    """The earlier matchers over the names of matched records: the older score, points over five layouts, points that need a surname, and whether ensembles are apart."""
    n = R._name_lists(spark, d).select(F.explode("apra_names").alias("a"), "muzooka_names").select("a", F.explode("muzooka_names").alias("b")).distinct()
    return n.select("a", "b", O.older_name_score_col("a", "b").alias("older"), O.layout_similarity_col("a", "b").alias("layouts"), O.last_name_similarity_col("a", "b").alias("by_last_name"), O.ensembles_apart_col("a", "b").alias("apart"))


_PARTS = "list_filter(list_transform(regexp_split_to_array(name, '[/;]'), lambda p: trim(p, ' ')), lambda p: p <> '')"


@query(f"SELECT apra_work_id, count(DISTINCT upper(p)) AS n_names FROM (SELECT apra_work_id, unnest({_PARTS}) AS p FROM adcartists WHERE name IS NOT NULL) GROUP BY 1")
def ref_individual_names(spark, d):
    """Distinct single names of a work."""
    n = table(spark, d, "adcartists").select("apra_work_id", F.explode(S.slash_parts(F.col("name"))).alias("p"))
    return n.groupBy("apra_work_id").agg(F.count_distinct(F.upper("p")).alias("n_names"))


def _pairs_of_names(spark, d):
    a = table(spark, d, "adcartists").select("apra_work_id", "adc_artist_id", S.iswc_key(F.col("iswc")).alias("iswc"), R._ascii_name("name").alias("a")).where("a <> ''").distinct()
    m = table(spark, d, "recordings").select("recordings_id", S.iswc_key(F.col("iswc")).alias("iswc"), R._ascii_name("artist_name").alias("m")).where("m <> ''").distinct()
    return a, m


_NAMES = f"""na AS (SELECT DISTINCT apra_work_id, adc_artist_id, {R._ISWC} AS iswc, {R._NM.format(c="name")} AS a FROM adcartists WHERE {R._NM.format(c="name")} <> ''),
    nm AS (SELECT DISTINCT recordings_id, {R._ISWC} AS iswc, {R._NM.format(c="artist_name")} AS m FROM recordings WHERE {R._NM.format(c="artist_name")} <> '')"""
_FIRST = "row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, recordings_id) = 1"


def _scored_names(pairs: DataFrame, least: float) -> DataFrame:
    """pairs (a, m, ...) with the score of their names, `least` or more; distinct names are scored once."""
    texts = pairs.select("a", "m").distinct().withColumn("score", F.when(F.col("a") == F.col("m"), 1.0).otherwise(F.round(jaro_winkler_col("a", "m"), 9))).where(F.col("score") >= least)
    return pairs.join(texts, ["a", "m"])


@query(f"""WITH {_NAMES}, s AS (SELECT DISTINCT iswc, adc_artist_id, a, recordings_id, m, round(jaro_winkler_similarity(a, m), 9) AS score FROM na JOIN nm USING (iswc) WHERE iswc NOT IN ('', 'T0000000000')),
    b AS (SELECT * FROM s WHERE score >= 0.92 QUALIFY {_FIRST.format(keys="iswc, adc_artist_id, a")}) SELECT * FROM b""")
def ref_best_in_code_block(spark, d):
    """The best recording for each artist's name within equal identifiers; a pair counts once."""
    a, m = _pairs_of_names(spark, d)
    known = ~F.col("iswc").isin("", "T0000000000")
    pairs = a.where(known).select("iswc", "adc_artist_id", "a").distinct().join(m.where(known), "iswc")
    best = ids.best_of(_scored_names(pairs, 0.92), ["iswc", "adc_artist_id", "a"], [F.desc("score"), F.asc("recordings_id")])
    return best.select("iswc", "adc_artist_id", "a", "recordings_id", "m", "score")


@query(f"""WITH {_NAMES}, lone AS (SELECT DISTINCT adc_artist_id, a FROM na WHERE iswc IN ('', 'T0000000000') OR iswc NOT IN (SELECT iswc FROM nm)),
    tm AS (SELECT m, min(recordings_id) AS recordings_id FROM nm GROUP BY m),
    s AS (SELECT adc_artist_id, a, recordings_id, m, round(jaro_winkler_similarity(a, m), 9) AS score FROM lone JOIN tm ON a[1:3] = m[1:3] WHERE jaro_winkler_similarity(a, m) >= 0.92)
    SELECT * FROM s QUALIFY {_FIRST.format(keys="adc_artist_id, a")}""")
def ref_best_without_code(spark, d):
    """The fallback for artists whose identifier no recording has: the best name of all recordings that begins alike, not of the first rows only. Equal names of recordings are
    one, by their smallest id."""
    a, m = _pairs_of_names(spark, d)
    common = m.select("iswc").where(~F.col("iswc").isin("", "T0000000000")).distinct()
    lone = a.join(common, "iswc", "left_anti").select("adc_artist_id", "a").distinct()
    texts = m.groupBy("m").agg(F.min("recordings_id").alias("recordings_id"))
    block = lambda c: F.substring(c, 1, 3)
    # an equal name is the best there is, and one only; no other needs to be looked for
    equal = lone.select("a").distinct().join(texts, F.col("a") == F.col("m")).select("m", "a", F.lit(1.0).alias("score"), "recordings_id")
    others = lone.join(texts.select(F.col("m").alias("a")), "a", "left_anti")
    near = pairs.near_pairs(others.select(block("a").alias("k"), F.col("a").alias("t")), texts.select(block("m").alias("k"), F.col("m").alias("t")), 0.92)
    near = near.select(F.col("x").alias("a"), F.col("y").alias("m"), F.round("score", 9).alias("score")).join(texts, "m").select("m", "a", "score", "recordings_id").unionByName(equal)
    # the best name is the same for all artists of one name
    return lone.join(ids.best_of(near, ["a"], [F.desc("score"), F.asc("recordings_id")]), "a").select("adc_artist_id", "a", "recordings_id", "m", "score")


# --- older totals -----------------------------------------------------------------------------------------------------------------
_OLD = """s AS (SELECT apra_work_id, track_id, entity_id, sum(best) AS part_sum FROM b GROUP BY ALL),
    u AS (SELECT DISTINCT c.apra_work_id, c.track_id, c.entity_id, round(CASE WHEN greatest(c.apra_part_ct, coalesce(c.muzooka_part_ct, 0)) > 0 THEN coalesce(s.part_sum, 0) / greatest(c.apra_part_ct, coalesce(c.muzooka_part_ct, 0)) ELSE 0 END, 6) AS score,
          greatest(c.apra_total, coalesce(c.muzooka_total, 0)) AS most FROM cand c LEFT JOIN s USING (apra_work_id, track_id, entity_id))
    SELECT apra_work_id, track_id, round(sum(score), 5) AS match_total, round(sum(CASE WHEN score >= 0.92 THEN score ELSE 0 END), 5) AS high_total, max(most) AS most_names,
           round(sum(CASE WHEN score >= 0.92 THEN score ELSE 0 END) / max(most), 5) AS high_share FROM u GROUP BY ALL"""


def _old_totals(spark, d, kind):
    a, m, pairs = R._composite_inputs(spark, d, kind, R.code_pairs(spark, d))
    scores = composite.part_scores(a, m, pairs, "jaro_winkler").groupBy("apra_work_id", "track_id", "entity_id").agg(F.sum("best").alias("part_sum"))
    c = composite._candidates(a, m, pairs).join(scores, ["apra_work_id", "track_id", "entity_id"], "left")
    most = F.greatest("apra_part_ct", F.coalesce("muzooka_part_ct", F.lit(0)))
    score = F.round(F.when(most > 0, F.coalesce("part_sum", F.lit(0.0)) / most).otherwise(0.0), 6)
    u = c.select("apra_work_id", "track_id", "entity_id", score.alias("score"), F.greatest("apra_total", F.coalesce("muzooka_total", F.lit(0))).alias("most")).distinct()
    high = F.sum(F.when(F.col("score") >= 0.92, F.col("score")).otherwise(0.0))
    return u.groupBy("apra_work_id", "track_id").agg(F.round(F.sum("score"), 5).alias("match_total"), F.round(high, 5).alias("high_total"), F.max("most").alias("most_names"), F.round(high / F.max("most"), 5).alias("high_share"))


_COMPOSERS = (("adc_composers", "apra_work_id", "adc_composer_id", "name"), ("composers", R._TRACK, "composer_id", "composer"))
_ARTISTS = (("adcartists", "apra_work_id", "adc_artist_id", "name"), ("recordings", R._TRACK, "recordings_id", "artist_name"))


@query(f"WITH {R._composite_sql(*_ARTISTS)}, {_OLD}")
def ref_older_artist_totals(spark, d):
    """The older totals: all scores of a work's names, with and without the threshold."""
    return _old_totals(spark, d, "artists")


@query(f"WITH {R._composite_sql(*_COMPOSERS)}, {_OLD}")
def ref_older_composer_totals(spark, d):
    return _old_totals(spark, d, "composers")


@query(f"""WITH {R._composite_sql(*_COMPOSERS)}, nn AS (SELECT DISTINCT rec AS track_id, nm FROM m0), ca AS (SELECT DISTINCT pp.apra_work_id, pp.track_id, a0.entity_id, a0.nm FROM pp JOIN a0 ON a0.rec = pp.apra_work_id),
    sc AS (SELECT ca.apra_work_id, ca.track_id, ca.entity_id, ca.nm, round(max(coalesce({_jw_sql('ca.nm', 'nn.nm')}, 0)), 9) AS score FROM ca LEFT JOIN nn ON nn.track_id = ca.track_id GROUP BY ALL),
    n AS (SELECT rec AS apra_work_id, count(DISTINCT nm) AS n_names FROM a0 GROUP BY 1)
    SELECT apra_work_id, track_id, round(sum(score) / max(n_names), 5) AS writer_share, round(sum(score) * count(*) / max(n_names), 5) AS fanned_share FROM sc JOIN n USING (apra_work_id) GROUP BY ALL""")
def ref_unified_name_scores(spark, d):
    """Each writer's best score over all names of a track, summed over the work's names by their number; fanned_share keeps the older version's join that repeats each score for
    every name of the work."""
    side = lambda t, rec, ent, c: table(spark, d, t).select((clean_id(rec) if rec == "track_id" else F.col(rec)).alias(rec), F.col(ent).alias("entity_id"), R._ascii_name(c).alias("nm")).where("nm <> ''").where(F.col(rec).isNotNull()).distinct()
    a, m = side("adc_composers", "apra_work_id", "adc_composer_id", "name"), side("composers", "track_id", "composer_id", "composer").select("track_id", F.col("nm").alias("other")).distinct()
    ca = R.code_pairs(spark, d).join(a, "apra_work_id")
    both = ca.join(m, "track_id", "left")
    texts = both.select("nm", "other").where("other is not null").distinct().withColumn("jw", jaro_winkler_col("nm", "other"))
    sc = both.join(texts, ["nm", "other"], "left").groupBy("apra_work_id", "track_id", "entity_id", "nm").agg(F.round(F.max(F.coalesce("jw", F.lit(0.0))), 9).alias("score"))
    n = a.groupBy("apra_work_id").agg(F.count_distinct("nm").alias("n_names"))
    out = sc.join(n, "apra_work_id").groupBy("apra_work_id", "track_id")
    return out.agg(F.round(F.sum("score") / F.max("n_names"), 5).alias("writer_share"), F.round(F.sum("score") * F.count(F.lit(1)) / F.max("n_names"), 5).alias("fanned_share"))


# --- counts, windows, partitions --------------------------------------------------------------------------------------------------
@query("SELECT floor(match_score * 100 + 0.5) / 100 AS score_range, count(*) AS n FROM title_matches_lsh WHERE match_score IS NOT NULL GROUP BY 1")
def ref_score_rounds(spark, d):
    return table(spark, d, "title_matches_lsh").where("match_score is not null").groupBy((F.floor(F.col("match_score") * 100 + 0.5) / 100).alias("score_range")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT match_id, apra_work_id, row_number() OVER (PARTITION BY apra_work_id ORDER BY match_score DESC NULLS LAST, match_id) AS place FROM title_matches_lsh WHERE apra_work_id IS NOT NULL QUALIFY place <= 5")
def ref_first_matches(spark, d):
    """The first five rows of each work; the limit is pushed before and after the shuffle."""
    w = Window.partitionBy("apra_work_id").orderBy(F.desc_nulls_last("match_score"), "match_id")
    t = table(spark, d, "title_matches_lsh").select("match_id", "apra_work_id", "match_score").where("apra_work_id is not null")
    return t.withColumn("place", F.row_number().over(w).cast("bigint")).where("place <= 5").select("match_id", "apra_work_id", "place")


@query("SELECT CAST(match_id % 100 AS INTEGER) AS partition_id, 'matches_' || (match_id % 100) AS table_name, count(*) AS n_rows, count(DISTINCT apra_work_id) AS n_works FROM title_matches_lsh GROUP BY ALL")
def ref_partition_log(spark, d):
    """What a table cut into a hundred holds, part by part: the log beside sources.sinks.write_partitions."""
    part = (F.col("match_id") % 100).cast("int")
    return table(spark, d, "title_matches_lsh").groupBy(part.alias("partition_id")).agg(F.concat(F.lit("matches_"), F.first(part)).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("apra_work_id").alias("n_works"))


@query("SELECT DISTINCT track_id, length(title) || '+' || length(track_id) AS numbers FROM tracks WHERE title IS NOT NULL")
def ref_stored_numbers(spark, d):
    """Lists of numbers stored as text, read back: half of the rows as JSON, half with blanks and without brackets."""
    t = table(spark, d, "tracks").select("track_id", "title").where("title is not null").distinct()
    a, b = F.length("title").cast("string"), F.length("track_id").cast("string")
    text = F.when(F.length("title") % 2 == 0, F.concat(F.lit("["), a, F.lit(", "), b, F.lit("]"))).otherwise(F.concat(F.lit(" "), a, F.lit(" ,\n"), b, F.lit(" ,")))
    return t.select("track_id", F.array_join(O.stored_numbers(text).cast("array<string>"), "+").alias("numbers"))

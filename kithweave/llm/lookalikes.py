"""Visually identical text brought to one form.

Distinct values are mapped to one form (compatibility forms, odd blanks and hyphens, invisible characters, look-alike letters in Latin words), grouped under
Unicode's accent-sensitive collation in SQL, and each class gets one canonical member, which is joined back to the rows.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chars import looks_odd, unify
from ..runtime import table

NOT_ASCII = r"[^\x00-\x7F]"


def _map(column):
    @F.pandas_udf("mapped string, odd boolean")
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"mapped": [None if v is None else unify(v) for v in values], "odd": [None if v is None else looks_odd(v) for v in values]})

    return run(column)


def canonical_values(rows: DataFrame, value: str = "value") -> DataFrame:
    """(value, canonical, odd) of every distinct non-null value.

    The canonical member of a class is its most frequent value without odd characters, then the smallest by code point; where all members are odd, it is
    the mapped form. Values wholly in another script and properly accented ones are in a class of their own. Null values give no row, the empty
    value is its own canonical form, an empty table gives an empty result. Only non-ASCII values leave the JVM.
    """
    distinct = rows.select(F.col(value).alias("value")).where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    plain = distinct.where(~F.col("value").rlike(NOT_ASCII)).select("value", "n", F.col("value").alias("mapped"), F.lit(False).alias("odd"))
    other = distinct.where(F.col("value").rlike(NOT_ASCII)).withColumn("_m", _map("value")).select("value", "n", "_m.mapped", "_m.odd")
    plain.unionByName(other).createOrReplaceTempView("kithweave_mapped")
    return rows.sparkSession.sql("""
        WITH classes AS (
            SELECT mapped COLLATE UNICODE AS class,
                   min(CASE WHEN NOT odd THEN struct(-n AS n, CAST(value AS STRING) AS value) END).value AS clean, min(CAST(mapped AS STRING)) AS made
            FROM kithweave_mapped GROUP BY mapped COLLATE UNICODE)
        SELECT m.value, coalesce(c.clean, c.made) AS canonical, m.odd
        FROM kithweave_mapped m JOIN classes c ON m.mapped COLLATE UNICODE = c.class""")


def _rows(spark, sf_dir: str) -> DataFrame:
    composers = table(spark, sf_dir, "composers").select(F.lit("composers").alias("source_table"), F.col("composer_id").cast("string").alias("record_id"), F.col("composer").alias("value"))
    titles = table(spark, sf_dir, "title_matches_lsh").select(F.lit("title_matches_lsh").alias("source_table"), F.col("match_id").cast("string").alias("record_id"), F.col("muzooka_cleaned_title").alias("value"))
    return composers.unionByName(titles).where("value is not null")


def p5_found(spark, sf_dir: str) -> DataFrame:
    """Rows whose value has an odd character, with or without a known look-alike; repeated rows count once, null values are no case."""
    rows = _rows(spark, sf_dir)
    changed = canonical_values(rows).where("odd").select("value")
    return rows.where(F.col("value").rlike(NOT_ASCII)).join(changed, "value", "left_semi").select("source_table", "record_id").distinct()


def p5_canonical(spark, sf_dir: str) -> DataFrame:
    """(source_table, record_id, value, canonical) of every non-null value."""
    rows = _rows(spark, sf_dir)
    return rows.distinct().join(canonical_values(rows).select("value", "canonical"), "value").select("source_table", "record_id", "value", "canonical")



def _compatibility_class() -> str:
    """The characters whose compatibility form is another text, as a class of ranges; built by rule."""
    codes = [c for c in range(0xA0, 0x20000) if unicodedata.category(chr(c))[0] in "LNP" and unicodedata.normalize("NFKC", chr(c)) != unicodedata.normalize("NFC", chr(c))]
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


SQL: dict[str, str] = {
    "p5_found": rf"""
        WITH r AS (SELECT 'composers' AS source_table, CAST(composer_id AS VARCHAR) AS record_id, composer AS v FROM composers
                   UNION ALL SELECT 'title_matches_lsh', CAST(match_id AS VARCHAR), muzooka_cleaned_title FROM title_matches_lsh)
        SELECT DISTINCT source_table, record_id FROM r
        WHERE v IS NOT NULL AND (nfc_normalize(v) <> v OR regexp_matches(v, '[\p{{Cf}}\x{{34F}}\x{{115F}}\x{{1160}}\x{{17B4}}\x{{17B5}}\x{{180B}}-\x{{180D}}\x{{3164}}\x{{FE00}}-\x{{FE0F}}]')
            OR regexp_matches(v, '[\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{2010}}-\x{{2015}}\x{{2212}}\x{{2043}}]') OR regexp_matches(v, '[{_compatibility_class()}]')
            OR len(list_filter(regexp_split_to_array(v, '[ \n\t\r]+'), lambda w: regexp_matches(w, '\p{{Latin}}') AND regexp_matches(w, '[^\P{{L}}\p{{Latin}}]'))) > 0)"""
}

"""Several values packed in one field: one row per value, with its position."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.splitting import cached_splitter
from ..runtime import bounded_rows, table

#: A field without any of these holds one name at most, so it needn't leave the JVM.
MAY_SPLIT = r"(?iu)[,;|/\\&+\n\r\t\"\[({，；｜／＆＋、]|\b(feat|featuring|ft|vs|versus|with|and|x|by)\b"
#: More known names than this are no dictionary to be sent to every worker.
MOST_KNOWN = 200_000


def names_udf(known: list[str]):
    """Column function: the names of a field as an array, by the dictionary `known`."""
    state: dict = {}

    @F.pandas_udf("array<string>")
    def parts(s: pd.Series) -> pd.Series:
        if "f" not in state:
            state["f"] = cached_splitter(known)
        f = state["f"]
        return pd.Series([list(f(v)) if v is not None else [] for v in s], dtype=object)

    # else a filter on the result moves below a distinct, and each repeated row is split
    return parts.asNondeterministic()


def known_names(spark, sf_dir: str) -> list[str]:
    """act_names is a reference table that doesn't grow; its size is checked all the same."""
    return [r[0] for r in bounded_rows(table(spark, sf_dir, "act_names").select("act_name").where("act_name is not null").distinct(), MOST_KNOWN, "act_names")]


def split_fields(df: DataFrame, source: str, id_col: str, value_col: str, known: list[str]) -> DataFrame:
    """(source_table, record_id, pos, val) for every name of every field of df.

    Null and blank fields give no row, a field of one name gives one; repeated rows (same id and field) count once; an empty table gives an empty
    result; columns other than the two named are not read, so their names can't clash.
    """
    base = df.select(F.col(id_col).cast("string").alias("record_id"), F.col(value_col).alias("_v")).where(F.col("_v").rlike(r"(?U)\S")).distinct()
    one = base.where(~F.col("_v").rlike(MAY_SPLIT)).select("record_id", F.array(F.regexp_replace("_v", r"(?U)^\s+|\s+$", "")).alias("_p"))
    many = base.where(F.col("_v").rlike(MAY_SPLIT)).select("record_id", names_udf(known)("_v").alias("_p"))
    return one.unionByName(many).select(F.lit(source).alias("source_table"), "record_id", F.posexplode("_p").alias("pos", "val")).withColumn("pos", (F.col("pos") + 1).cast("int"))


def packed_fields(df: DataFrame, source: str, id_col: str, value_col: str, known: list[str]) -> DataFrame:
    """As split_fields, of the fields with two or more names only."""
    base = df.select(F.col(id_col).cast("string").alias("record_id"), F.col(value_col).alias("_v")).where(F.col("_v").rlike(MAY_SPLIT)).distinct()
    many = base.select("record_id", names_udf(known)("_v").alias("_p")).where(F.size("_p") > 1)
    return many.select(F.lit(source).alias("source_table"), "record_id", F.posexplode("_p").alias("pos", "val")).withColumn("pos", (F.col("pos") + 1).cast("int")).distinct()


def p7_found(spark, sf_dir: str) -> DataFrame:
    known = known_names(spark, sf_dir)
    return packed_fields(table(spark, sf_dir, "recordings"), "recordings", "recordings_id", "artist_name", known).unionByName(
        packed_fields(table(spark, sf_dir, "composers"), "composers", "composer_id", "composer", known)
    )


def p7_all_names(spark, sf_dir: str) -> DataFrame:
    """Every name of recordings and composers as a row of its own with its position, single names included."""
    known = known_names(spark, sf_dir)
    return split_fields(table(spark, sf_dir, "recordings"), "recordings", "recordings_id", "artist_name", known).unionByName(
        split_fields(table(spark, sf_dir, "composers"), "composers", "composer_id", "composer", known)
    )

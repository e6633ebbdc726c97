"""Writing: tables, partitions, merged updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(df: DataFrame, name: str) -> None:
    """Creates the table or takes its place."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def append(df: DataFrame, name: str, columns: list[str] | None = None) -> None:
    """Appends the distinct rows of the given columns."""
    (df.select(*columns) if columns else df).distinct().write.mode("append").format("parquet").saveAsTable(name)


def create_if_missing(spark: SparkSession, name: str, schema: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def write_partitions(df: DataFrame, path: str, column: str) -> None:
    """A folder for each value of a column; writing again replaces only the values at hand."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def merge_update(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """target with `columns` taken from source where the keys are there: rewritten in one plan, as plain files know no update. Keys must be unique in source."""
    s = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    j = target.join(s, keys, "left")
    for c in columns:
        old = F.col(c) if c in target.columns else F.lit(None)
        j = j.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old))
    return j.drop("_hit", *[f"_new_{c}" for c in columns])


def view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)

"""Reading: catalog tables, files, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV with a header; without a schema every column is a string."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", False).csv(path)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def sample_percent(df: DataFrame, percent: float, seed: int = 0) -> DataFrame:
    return df.sample(percent / 100, seed)


def sample_keys(df: DataFrame, key: str, percent: float, seed: int = 0) -> DataFrame:
    """All rows of a share of the distinct keys; which keys depends on the key and the seed only, so no distinct and no join are needed."""
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) < int(percent * 10_000))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows, the same on every run."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    df.printSchema()
    return df.limit(n)

"""Global numbers without a window over one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut


def dense_ids(df: DataFrame, keys: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """df with `name`, the dense rank of `keys` over the whole table: equal keys share a number, numbers run from 1 without gaps in the keys' order.

    The distinct keys are range-partitioned and numbered within their partition; the counts of the partitions before are added. Null keys rank first. An empty table stays empty.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.select(*keys).distinct().repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys])
    spread = cut(spread.withColumn("_p", F.spark_partition_id()))
    counts = spread.groupBy("_p").count()
    before = counts.select("_p", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_p").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    # one row for each partition: small enough to broadcast
    numbered = spread.withColumn("_k", F.row_number().over(inside)).join(F.broadcast(before), "_p").select(*keys, (F.col("_k") + F.col("_before")).cast("bigint").alias(name))
    same = None
    right = numbered.select(*[F.col(k).alias(f"_r_{k}") for k in keys], name)
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        same = c if same is None else same & c
    return df.join(right, same).select(*df.columns, name)


def hash_bucket(column: str, buckets: int):
    """The partition number of an id: even, and the same on every run."""
    return F.pmod(F.xxhash64(column), F.lit(buckets))


def best_of(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

"""New tracks linked as they arrive; an extension of this library, without a counterpart among the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.linkage import exact_titles, tracks_titles


def link_arrivals(tracks: DataFrame, works: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Exact title matches of each batch of arriving tracks, written once per batch: a batch that runs again replaces its own folder."""

    def batch(df: DataFrame, number: int) -> None:
        exact_titles(works, tracks_titles(df)).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return tracks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Late revisions as a stream: each micro-batch of observations replaces those of equal keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelwright.sources.tables import newest_first, upserted


def revision_stream(stream: DataFrame, path: str, keys: list[str], order: list[Column], checkpoint: str) -> StreamingQuery:
    """Apply revisions to the panel under ``path``: version v<n> holds the state after micro-batch n.

    Within a batch the first row in ``order`` wins; a batch that is run again rewrites its own version alone.
    """

    def apply(batch: DataFrame, number: int) -> None:
        new = newest_first(batch, keys, order)
        if number:
            new = upserted(batch.sparkSession.read.parquet(f"{path}/v{number - 1}"), new, keys)
        new.write.mode("overwrite").parquet(f"{path}/v{number}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_sums(stream: DataFrame, ts: str, length: str, late: str, keys: list[str], value: str) -> DataFrame:
    """start, keys, n and total by tumbling window; rows later than ``late`` are left out of a stream."""
    w = F.window(ts, length)
    return stream.withWatermark(ts, late).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")

"""Structured Streaming over the batch operators. An extension: the batch library has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from talweg.operators import freight


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """events (ts, event_type, value): counts and sums by window and type; late rows within the watermark count."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def score_routes(routes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Costs every micro-batch of routes and appends it to a table; a batch that is repeated is written again in its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        freight.unit_costs(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return routes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

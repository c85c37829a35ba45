"""The batch sinks and weekly counts over a stream of landed files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import merge_current


def keep_current(stream: DataFrame, root: str, key: str, newest: str, checkpoint: str) -> StreamingQuery:
    """Merge each batch into the current state, which never goes back: late rows and a replayed batch leave it as it is."""

    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            merge_current(batch, root, key, newest, forward=True)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def keep_snapshots(stream: DataFrame, root: str, checkpoint: str, day: dt.date) -> StreamingQuery:
    """Append each batch under its snapshot day; the file sink writes each batch once."""
    rows = stream.withColumn("snapshot_date", F.lit(day).cast("date"))
    writer = rows.writeStream.format("parquet").partitionBy("snapshot_date").option("path", root)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def weekly_events(stream: DataFrame, lateness: str = "7 days", event_id: str | None = None) -> DataFrame:
    """Events per brand, event name and week from Monday, late rows up to `lateness`.

    With `event_id` an event that is ingested again within that time counts once.
    """
    # Windows start on Thursdays by default (1970-01-01); four days later is a Monday.
    week = F.window("ts", "7 days", "7 days", "4 days")
    rows = stream.withWatermark("ts", lateness)
    rows = rows.dropDuplicatesWithinWatermark([event_id]) if event_id else rows
    counts = rows.groupBy("brand", "event", week).agg(F.count("*").alias("n"))
    return counts.select("brand", "event", F.to_date("window.start").alias("week"), "n")


def keep_weekly_events(stream: DataFrame, root: str, checkpoint: str, lateness: str = "7 days", event_id: str | None = "event_id", buckets: int = 8) -> StreamingQuery:
    """Keep weekly counts in a table: what has arrived is counted, merged by (brand, event, week), and the query ends.

    The next call goes on from the checkpoint's state. Each batch brings the new totals of the
    weeks it touched; a batch that is replayed brings the same again.
    """

    def merge(batch: DataFrame, _: int) -> None:
        keyed = batch.withColumn("key", F.to_json(F.struct(F.col("brand").cast("string").alias("b"), F.col("event").alias("e"), F.col("week").alias("w"))))
        if not keyed.isEmpty():
            merge_current(keyed, root, "key", "n", forward=True, buckets=buckets)

    writer = weekly_events(stream, lateness, event_id).writeStream.outputMode("update").foreachBatch(merge)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

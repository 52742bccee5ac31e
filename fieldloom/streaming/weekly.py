"""Weekly aggregates of events, as a stream and as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weekly(events: DataFrame, delay: str | None = None) -> DataFrame:
    """n_events and total by ISO week and type; with a delay, late rows are waited for that long (streams)."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if delay is not None:
        rows = rows.withWatermark("ts", delay)
    # windows start on Thursday 1970-01-01 unless moved by four days
    grouped = rows.groupBy(F.window("ts", "7 days", "7 days", "4 days").alias("w"), "event_type")
    return grouped.agg(F.count("*").alias("n_events"), F.sum("value").alias("total")).select(F.to_date("w.start").alias("week_start"), "event_type", "n_events", "total")

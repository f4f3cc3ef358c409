"""Event-time window metrics over a stream of events (or a table of them)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.dedup import keep_latest
from millrace.operators.filters import is_true, not_null


def window_metrics(
    events: DataFrame,
    width: str = "5 minutes",
    slide: str | None = None,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Metrics per window, factory and type: tumbling, or sliding with ``slide``.

    Repeated events count once, on a stream within the watermark. Events
    without an id cannot be told to repeat, so each of them counts. On a
    stream, a window is final once the watermark passes its end.
    """
    measured = ("event_id", "timestamp", "factory_id", "measurement_type", "value", "is_anomaly")
    events = without_repeats(events.select(*measured), lateness)
    frame = F.window("timestamp", width, slide) if slide else F.window("timestamp", width)
    return (
        events.groupBy(frame.alias("w"), "factory_id", "measurement_type")
        .agg(
            F.count(F.lit(1)).alias("leituras"),
            F.count_if(is_true("is_anomaly")).alias("anomalias"),
            F.avg("value").alias("avg_valor"),
            F.min("value").alias("min_valor"),
            F.max("value").alias("max_valor"),
        )
        .select(
            F.col("w.start").alias("inicio"),
            F.col("w.end").alias("fim"),
            "factory_id",
            "measurement_type",
            "leituras",
            "anomalias",
            "avg_valor",
            "min_valor",
            "max_valor",
        )
    )


def without_repeats(events: DataFrame, lateness: str) -> DataFrame:
    """One event for each id; those without an id stay as they are."""
    if events.isStreaming:
        events = events.withWatermark("timestamp", lateness)
    known, unknown = events.filter(not_null("event_id")), events.filter("event_id IS NULL")
    if events.isStreaming:
        known = known.dropDuplicatesWithinWatermark(["event_id"])
    else:
        known = keep_latest(known, ["event_id"], ["timestamp"])
    return known.unionByName(unknown)


def start_window_metrics(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    width: str = "5 minutes",
    slide: str | None = None,
    lateness: str = "10 minutes",
    available_now: bool = False,
) -> StreamingQuery:
    """Append each window to parquet once it is final."""
    writer = (
        window_metrics(events, width, slide, lateness)
        .withColumn("dia", F.to_date("inicio"))
        .writeStream.outputMode("append")
        .partitionBy("dia")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start(path)

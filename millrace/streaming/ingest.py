"""Stream ingest: validate, enrich, route to bronze, dead letter and alerts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.contract import Contract, with_reason
from millrace.session import session_conf
from millrace.sources.events import BATCH_COLUMN, BATCHES, message_text
from millrace.sources.plain import overwrite_partitions

REASON = "_dlq_reason"
EVENT_PARTITIONS = ("factory_id", "measurement_type", "dt")
DEAD_LETTER = "_dead_letter"
ALERTS = "_alerts"
INGEST_DAY = "_ingest_day"
OBSERVED = "ingest"


def _field(name: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("_event"), f"$.{name}", kind)


def event_day(text: Column) -> Column:
    """Day of an ISO timestamp in its own offset; unreadable text gives today."""
    readable = text.try_cast("timestamp").isNotNull()
    return F.coalesce(
        F.when(readable, F.substring(text, 1, 10).try_cast("date")), F.current_date()
    )


def classify(messages: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """Decode messages and add the reason (NULL = valid) and the routing columns.

    The text is parsed to a variant once; everything after reads the variant.
    """
    # Generated, as Spark makes one function of all projections up to the messages' source,
    # and one as long as that is not compiled well. What is generated starts another.
    text = messages.select(F.inline(F.array(F.struct(*message_text()))))
    parsed = text.withColumn("_event", F.try_parse_json("_text"))
    judged = with_reason(parsed, "_event", "_text", contract, REASON)
    anomaly = F.col(REASON).isNull() & F.coalesce(_field("is_anomaly", "boolean"), F.lit(False))
    # Generated, as a filter on a projected column is pushed down with a copy of its whole
    # expression for each time it is named: every message would be parsed many times.
    outcome = F.inline(F.array(F.struct(REASON, anomaly.alias("is_anomaly"))))
    return judged.select(*parsed.columns, outcome).select(
        "_text",
        "_event",
        "_kafka_offset",
        "_kafka_partition",
        "_kafka_topic",
        "_kafka_key",
        REASON,
        "is_anomaly",
        F.coalesce(_field("factory_id"), F.lit("UNKNOWN")).alias("factory_id"),
        F.coalesce(_field("measurement_type"), F.lit("UNKNOWN")).alias("measurement_type"),
        event_day(_field("timestamp")).alias("dt"),
        # Taken here: on a replay, columns of the stream have the first run's clock.
        F.current_date().alias(INGEST_DAY),
    )


def _json_line(extra: dict[str, Column]) -> Column:
    """The event with fields added, as JSON text; the event's own fields stay."""
    pairs = [part for k, c in extra.items() for part in (F.lit(k), _to_variant(c))]
    event = F.map_filter(
        F.try_variant_get("_event", "$", "map<string,variant>"),
        lambda k, _: ~k.isin(*extra),
    )
    return F.to_json(F.map_concat(event, F.create_map(*pairs)))


def _to_variant(column: Column) -> Column:
    return F.coalesce(column.cast("variant"), F.parse_json(F.lit("null")))


def valid_lines(classified: DataFrame) -> DataFrame:
    """NDJSON line and partition columns of every valid event.

    An event's own text is kept and the new fields go before its closing
    brace, which saves writing it anew. That needs text of one line that has
    none of the new fields; other events are written from their parsed form.
    """
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    added = {
        "_ingested_at": now,
        "_kafka_offset": F.col("_kafka_offset"),
        "_kafka_partition": F.col("_kafka_partition"),
        "_kafka_topic": F.col("_kafka_topic"),
        "_kafka_key": F.col("_kafka_key"),
    }
    as_json = F.to_json(
        F.struct(*[c.alias(k) for k, c in added.items()]), {"ignoreNullFields": "false"}
    )
    # In projections of their own: each is used more than once below.
    parts = classified.filter(F.col(REASON).isNull()).withColumns(
        {"_trimmed": F.rtrim(F.col("_text"), F.lit(" \t\r\n")), "_added": as_json}
    )
    needs_writing = F.col("_trimmed").rlike("[\r\n]") | F.arrays_overlap(
        F.json_object_keys("_text"), F.array(*[F.lit(k) for k in added])
    )
    spliced = F.concat(
        F.expr("left(_trimmed, length(_trimmed) - 1)"), F.lit(","), F.expr("substr(_added, 2)")
    )
    line = F.when(needs_writing, _json_line(added)).otherwise(spliced)
    return parts.select(line.alias("value"), *EVENT_PARTITIONS)


def dead_lines(classified: DataFrame) -> DataFrame:
    """NDJSON line and ingest day of every rejected message.

    An object keeps its fields; anything else is kept as raw text.
    """
    tags = {
        REASON: F.col(REASON),
        "_kafka_offset": F.col("_kafka_offset"),
        "_kafka_partition": F.col("_kafka_partition"),
    }
    is_object = F.try_variant_get("_event", "$", "map<string,variant>").isNotNull()
    raw = F.to_json(F.struct(F.col("_text").alias("_raw"), *[c.alias(k) for k, c in tags.items()]))
    invalid = classified.filter(F.col(REASON).isNotNull())
    return invalid.select(
        F.when(is_object, _json_line(tags)).otherwise(raw).alias("value"),
        F.col(INGEST_DAY).alias("dt"),
    )


def anomaly_alerts(classified: DataFrame) -> DataFrame:
    """One row per anomalous valid event, with the fields an alert needs."""
    return classified.filter("is_anomaly").select(
        _field("event_id").alias("event_id"),
        _field("sensor_id").alias("sensor_id"),
        _field("equipment_id").alias("equipment_id"),
        "factory_id",
        "measurement_type",
        _field("value", "double").alias("value"),
        _field("quality").alias("quality"),
        _field("timestamp").alias("timestamp"),
        "dt",
    )


def counter_columns() -> list[Column]:
    """Received, valid, invalid, anomalies and message bytes."""
    invalid = F.col(REASON).isNotNull()
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(~invalid).alias("written"),
        F.count_if(invalid).alias("invalid"),
        F.count_if(F.col("is_anomaly")).alias("anomalies"),
        F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("bytes"),
    ]


def counters(classified: DataFrame) -> DataFrame:
    return classified.agg(*counter_columns())


def _write_batch_lines(
    lines: DataFrame, path: str, partitions: tuple[str, ...], batch_id: int
) -> None:
    """Write a batch into folders of its own, replacing them on a replay."""
    columns = (*partitions, BATCH_COLUMN)
    (
        lines.withColumn(BATCH_COLUMN, F.lit(batch_id))
        .hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .text(path)
    )


def batch_writer(root: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: the outputs of one classified batch.

    They are the lines of valid events, the list of the folders these are in, dead
    letters and alerts.

    All outputs belong to one checkpointed batch. A failure in any of them
    fails the batch, and its replay rewrites the same folders.
    """
    root = root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        # Adaptive execution splits a hot factory over several tasks. Small
        # folders are merged into as many tasks as there are cores, not into one,
        # which would write them in turn.
        settings = {
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.coalescePartitions.enabled": "true",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        }

        def folders() -> None:
            overwrite_partitions(
                batch.filter(F.col(REASON).isNull())
                .select(*EVENT_PARTITIONS)
                .distinct()
                .withColumn(BATCH_COLUMN, F.lit(batch_id))
                .coalesce(1),
                f"{root}/{BATCHES}",
                [BATCH_COLUMN],
            )

        def dead() -> None:
            _write_batch_lines(dead_lines(batch), f"{root}/{DEAD_LETTER}", ("dt",), batch_id)

        def alerts() -> None:
            overwrite_partitions(
                anomaly_alerts(batch)
                .withColumn(BATCH_COLUMN, F.lit(batch_id))
                .hint("rebalance", "dt"),
                f"{root}/{ALERTS}",
                ["dt", BATCH_COLUMN],
            )

        spark = batch.sparkSession
        batch.persist()
        try:
            with session_conf(spark, settings):
                # First: it fills the cache, and folders that are listed are complete.
                _write_batch_lines(valid_lines(batch), root, EVENT_PARTITIONS, batch_id)
                # The others are small, and mostly wait for the driver.
                with ThreadPoolExecutor(3, thread_name_prefix="output") as threads:
                    writes = [
                        threads.submit(inheritable_thread_target(spark)(f))
                        for f in (folders, dead, alerts)
                    ]
                for done in writes:
                    done.result()
        finally:
            batch.unpersist()

    return write


def start_ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    *,
    contract: Contract = Contract(),
    interval: str = "30 seconds",
    available_now: bool = False,
    dry_run: bool = False,
) -> StreamingQuery:
    """Start the ingest of a streaming DataFrame of messages.

    ``available_now`` works off what is there and ends; otherwise a batch
    starts every ``interval``. Counters appear in the progress events under
    the name ``ingest``. A dry run validates and counts, and writes nothing.
    """
    classified = classify(messages, contract).observe(OBSERVED, *counter_columns())
    writer = classified.writeStream.queryName("bronze-events").option(
        "checkpointLocation", checkpoint
    )
    writer = writer.format("noop") if dry_run else writer.foreachBatch(batch_writer(root))
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """Rejected messages: their text lines with reason and position."""
    lines = spark.read.text(f"{root.rstrip('/')}/{DEAD_LETTER}")
    event = F.try_parse_json("value")
    return lines.select(
        "value",
        F.try_variant_get(event, f"$.{REASON}", "string").alias(REASON),
        F.try_variant_get(event, "$._kafka_offset", "long").alias("_kafka_offset"),
        F.try_variant_get(event, "$._kafka_partition", "int").alias("_kafka_partition"),
        "dt",
    )

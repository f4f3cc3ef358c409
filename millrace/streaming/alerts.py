"""Range alerts on the stream: limits read anew for each batch, one alert per event."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.lake import Lake
from millrace.plans.reports import ALERT_COLUMNS, out_of_normal_range, out_of_sensor_range
from millrace.sources.events import BATCH_COLUMN
from millrace.sources.files import matching
from millrace.sources.plain import overwrite_partitions

#: The rule that an alert breaks: the range of its sensor, or the normal one of its type.
RULE, SENSOR, TYPE = "regra", "sensor", "tipo"
DAY = "dia"

HISTORY = (
    "event_id string, sensor_id string, equipment_id string, factory_id string,"
    " measurement_type string, value double, timestamp timestamp, limite_min double,"
    f" limite_max double, {RULE} string, _processed_at timestamp, {DAY} date, {BATCH_COLUMN} int"
)


@dataclass(frozen=True)
class Limits:
    """Flat equipment documents, whose sensors have ranges, and measurement types; either may lack."""

    documents: DataFrame | None = None
    types: DataFrame | None = None


def lake_limits(lake: Lake) -> Callable[[], Limits]:
    """The newest limits of a lake, as its tables stand when a batch starts."""

    def read() -> Limits:
        documents, types = (
            lake.table(path) for path in ("bronze/mongo/equipamentos", "silver/postgres/tipos_medicao")
        )
        newest = None
        if documents.exists():
            whole = documents.read()
            last = whole.agg(F.max("_execution_date")).first()[0]
            newest = documents.read({"_execution_date": last})
        return Limits(newest, types.read() if types.exists() else None)

    return read


def range_alerts(events: DataFrame, limits: Limits) -> DataFrame:
    """Events outside a range, with the rule they break, each once a rule.

    Where a sensor has several ranges, the alert names the lowest that is broken. Events
    without an id cannot be told to repeat and are all kept.
    """
    empty = f"{HISTORY.split(f', {RULE}')[0]}, {RULE} string"
    found = events.sparkSession.createDataFrame([], empty)
    kinds = (
        (SENSOR, out_of_sensor_range, limits.documents),
        (TYPE, out_of_normal_range, limits.types),
    )
    for name, outside, ranges in kinds:
        if ranges is not None:
            broken = outside(events, ranges).withColumns(
                {c: F.col(c).cast("double") for c in ("limite_min", "limite_max")}
            )
            found = found.unionByName(broken.withColumn(RULE, F.lit(name)))
    first = Window.partitionBy(RULE, "event_id").orderBy("timestamp", "limite_min", "limite_max")
    known = found.filter("event_id IS NOT NULL").withColumn("_n", F.row_number().over(first))
    return known.filter("_n = 1").drop("_n").unionByName(found.filter("event_id IS NULL"))


def alert_writer(
    path: str, limits: Callable[[], Limits]
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: a batch's alerts join the history.

    The limits are asked for when a batch starts, so a change takes effect with the next
    one; alerts that are stored keep the limits they broke. An event that is delivered
    again, in this batch or a later one, has its alert already: it is looked for in the
    history of its day (without a readable time it has none, and may alert again). A
    replayed batch replaces its own folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = (
            range_alerts(batch.select(*ALERT_COLUMNS), limits())
            .withColumns({"_processed_at": F.current_timestamp(), DAY: F.to_date("timestamp")})
            .persist()
        )
        try:
            days = [r[0] for r in found.select(DAY).distinct().collect() if r[0] is not None]
            earlier = alert_history(spark, path, before=number).filter(F.col(DAY).isin(*days))
            known = earlier.select(RULE, "event_id", DAY)
            new = found.join(known, [RULE, "event_id", DAY], "left_anti") if days else found
            overwrite_partitions(
                new.withColumn(BATCH_COLUMN, F.lit(number)).hint("rebalance", DAY),
                path,
                [DAY, BATCH_COLUMN],
            )
        finally:
            found.unpersist()

    return write


def start_range_alerts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    limits: Callable[[], Limits],
    *,
    interval: str = "30 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Start the alerts of a streaming DataFrame of events."""
    writer = (
        events.select(*ALERT_COLUMNS)
        .writeStream.queryName("range-alerts")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(alert_writer(path, limits))
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def typed_events(classified: DataFrame) -> DataFrame:
    """Valid messages of the ingest (``classify``) as events with the columns of an alert."""
    kinds = {"value": "double", "timestamp": "string"}
    fields = {
        c: F.try_variant_get("_event", f"$.{c}", kinds.get(c, "string")) for c in ALERT_COLUMNS
    }
    fields["timestamp"] = fields["timestamp"].try_cast("timestamp")
    return classified.filter("_dlq_reason IS NULL").select(*[v.alias(c) for c, v in fields.items()])


def alert_history(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """All stored alerts, or those of the batches before one."""
    if not matching(spark, f"{path.rstrip('/')}/{DAY}=*"):
        return spark.createDataFrame([], HISTORY)
    stored = spark.read.schema(HISTORY).parquet(path)
    return stored if before is None else stored.filter(F.col(BATCH_COLUMN) < before)

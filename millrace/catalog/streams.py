"""Contract validation, stream ingest and event-time windows as queries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog import inputs as i
from millrace.catalog.registry import query
from millrace.functions.calendar import run_date
from millrace.functions.contract import MALFORMED, MEASUREMENT_TYPES, REQUIRED_FIELDS, Contract
from millrace.schemas import MESSAGE
from millrace.session import scratch_path
from millrace.sources.events import bronze_events, file_messages
from millrace.streaming.compaction import compact_day, crowded_days
from millrace.streaming.ingest import (
    ALERTS,
    anomaly_alerts,
    batch_writer,
    classify,
    counters,
    dead_letters,
    dead_lines,
    start_ingest,
    valid_lines,
)
from millrace.streaming.late import DAYS, corrected_metrics, start_corrected_metrics
from millrace.streaming.windows import start_window_metrics, window_metrics



#: Messages of a file where a query shows several micro-batches.
FILE_MESSAGES = 4000


def _topic(spark, d) -> str:
    """The messages as the files of a topic, in the partitions they come in."""
    path = scratch_path(spark, "topic")
    i.messages(spark, d).write.option("maxRecordsPerFile", FILE_MESSAGES).parquet(path)
    return path


def _received(spark, d) -> DataFrame:
    return i.messages(spark, d).select(*MESSAGE.names)


# -- contract ---------------------------------------------------------------

_REASONS = f'SELECT "offset", "partition", reason FROM ({i.SQL_MESSAGES})'


def _reasons(classified: DataFrame) -> DataFrame:
    return classified.select(
        F.col("_kafka_offset").alias("offset"),
        F.col("_kafka_partition").alias("partition"),
        F.col("_dlq_reason").alias("reason"),
    )


@query("str01", _REASONS)
def str01(spark, d):
    """The outcome of every message; NULL is valid."""
    return _reasons(classify(_received(spark, d)))


def _one_check(name: str, start: str, also: str = "") -> None:
    """All messages one check of the contract rejects."""
    starts = [s for s in (start, also) if s]
    condition = " OR ".join(f"starts_with(reason, '{s.replace(chr(39), chr(39) * 2)}')" for s in starts)

    @query(name, f"SELECT * FROM ({_REASONS}) WHERE {condition}")
    def run(spark, d):
        # One condition: the filter is pushed down with a copy of the whole
        # reason for each time it names it.
        found = F.col("reason").rlike("^(" + "|".join(starts) + ")")
        return _reasons(classify(_received(spark, d))).filter(found)


_one_check("str01a", "Evento deve ser dict", MALFORMED)
_one_check("str01b", "Campos ausentes")
_one_check("str01c", "'value' deve ser")
_one_check("str01d", "'is_anomaly' deve ser")
_one_check("str01e", "'quality' inv")
_one_check("str01f", "'measurement_type' inv")
_one_check("str01g", "'metadata' deve ser")

STRICT_SCHEMA = json.dumps(
    {
        "required": [f for f in REQUIRED_FIELDS if f != "unit"],
        "properties": {
            "quality": {"enum": ["good", "bad"]},
            "measurement_type": {"enum": [t for t in MEASUREMENT_TYPES if t != "current"]},
        },
    }
)


@query(
    "str02",
    f"""SELECT "offset", "partition", CASE
          WHEN reason IS NOT NULL AND k NOT IN (3, 7, 8, 9, 10) THEN reason
          WHEN k IN (3, 7) THEN '''quality'' inválido: otima (esperado: [''bad'', ''good''])'
          WHEN k = 8 THEN '''quality'' inválido: None (esperado: [''bad'', ''good''])'
          WHEN quality = 'warning' THEN '''quality'' inválido: warning (esperado: [''bad'', ''good''])'
          WHEN k = 9 THEN reason
          WHEN measurement_type = 'current' THEN '''measurement_type'' inválido: current'
          ELSE reason END AS reason
        FROM ({i.SQL_MESSAGES})""",
)
def str02(spark, d):
    """A contract read from a JSON Schema: other enums, ``unit`` optional."""
    contract = Contract.from_json_schema(STRICT_SCHEMA)
    return _reasons(classify(_received(spark, d), contract))


# -- enrichment and routing -------------------------------------------------

_VALID = f"SELECT * FROM ({i.SQL_MESSAGES}) WHERE reason IS NULL"
_INVALID = f"SELECT * FROM ({i.SQL_MESSAGES}) WHERE reason IS NOT NULL"
_ENRICHED = f"""
SELECT CASE k WHEN 12 THEN NULL ELSE event_id END AS event_id, "offset" AS _kafka_offset,
       "partition" AS _kafka_partition, 'iot-sensors-raw' AS _kafka_topic,
       equipment_id AS _kafka_key, TRUE AS carimbo, round(value, 2) AS value
FROM ({_VALID})"""


def _enriched(spark, d):
    """Valid events with their transport metadata, as written."""
    body = F.try_parse_json("value")

    def field(name: str, kind: str):
        return F.try_variant_get(body, f"$.{name}", kind).alias(name)

    return valid_lines(classify(_received(spark, d))).select(
        field("event_id", "string"),
        field("_kafka_offset", "long"),
        field("_kafka_partition", "int"),
        field("_kafka_topic", "string"),
        field("_kafka_key", "string"),
        field("_ingested_at", "string").endswith("Z").alias("carimbo"),
        field("value", "double"),
    )


query("prj10", _ENRICHED)(_enriched)
query("str03", _ENRICHED)(_enriched)


@query(
    "prj11",
    f"""SELECT reason AS _dlq_reason, "offset" AS _kafka_offset, "partition" AS _kafka_partition,
        FALSE AS carimbo FROM ({_INVALID})""",
)
def prj11(spark, d):
    """Rejected messages with reason and position, and no ingest stamp."""
    body = F.try_parse_json("value")
    return dead_lines(classify(_received(spark, d))).select(
        F.try_variant_get(body, "$._dlq_reason", "string").alias("_dlq_reason"),
        F.try_variant_get(body, "$._kafka_offset", "long").alias("_kafka_offset"),
        F.try_variant_get(body, "$._kafka_partition", "int").alias("_kafka_partition"),
        F.try_variant_get(body, "$._ingested_at", "string").isNotNull().alias("carimbo"),
    )


@query(
    "flt08",
    f"""SELECT reason IS NULL AS valida, count(*) AS mensagens FROM ({i.SQL_MESSAGES}) GROUP BY 1""",
)
def flt08(spark, d):
    classified = classify(_received(spark, d))
    return classified.groupBy(F.col("_dlq_reason").isNull().alias("valida")).agg(
        F.count(F.lit(1)).alias("mensagens")
    )


_ALERTS = f"""
SELECT CASE k WHEN 12 THEN NULL ELSE event_id END AS event_id, sensor_id, equipment_id,
       factory_id, measurement_type, round(value, 2) AS value, quality, dt
FROM ({_VALID}) WHERE is_anomaly"""


@query("str08", _ALERTS)
def str08(spark, d):
    return anomaly_alerts(classify(_received(spark, d))).drop("timestamp")


@query(
    "agg11",
    f"""SELECT count(*) AS received, count(*) FILTER (reason IS NULL) AS written,
        count(*) FILTER (reason IS NOT NULL) AS invalid,
        count(*) FILTER (reason IS NULL AND is_anomaly) AS anomalies FROM ({i.SQL_MESSAGES})""",
)
def agg11(spark, d):
    return counters(classify(_received(spark, d))).drop("bytes")


# -- written and read back --------------------------------------------------

_BRONZE = f"""
SELECT CASE k WHEN 12 THEN NULL ELSE event_id END AS event_id, "offset", sensor_id, equipment_id,
       factory_id, measurement_type, round(value, 2) AS value, quality, is_anomaly,
       CASE k WHEN 11 THEN NULL ELSE k END AS nivel_bateria, dt
FROM ({_VALID})"""


def _shown(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "event_id",
        F.col("_kafka_offset").alias("offset"),
        "sensor_id",
        "equipment_id",
        "factory_id",
        "measurement_type",
        F.col("value").try_cast("double").alias("value"),
        "quality",
        "is_anomaly",
        F.col("metadata.battery_level").alias("nivel_bateria"),
        "dt",
    )


def _written(spark, d, batches: int = 1) -> str:
    """Bronze of all messages, written as one batch (again on each replay)."""
    root = scratch_path(spark, "bronze-events")
    for _ in range(batches):
        batch_writer(root)(classify(_received(spark, d)), 0)
    return root


@query("src06", _BRONZE)
def src06(spark, d):
    return _shown(bronze_events(spark, _written(spark, d)))


@query(
    "src07",
    f"SELECT * FROM ({_BRONZE}) WHERE dt = (SELECT min(cast(ts AS date)) FROM events)",
)
def src07(spark, d):
    """One day of bronze: only that day's folders are listed."""
    first = i.table(spark, d, "events").agg(F.to_date(F.min("ts"))).first()[0]
    return _shown(bronze_events(spark, _written(spark, d), [first]))


@query(
    "snk06",
    f"""SELECT factory_id, measurement_type, dt, count(*) AS linhas FROM ({_VALID}) GROUP BY ALL""",
)
def snk06(spark, d):
    """Lines per Hive folder, read as text."""
    root = _written(spark, d)
    lines = spark.read.option("basePath", root).text(f"{root}/factory_id=*")
    return lines.groupBy("factory_id", "measurement_type", "dt").agg(
        F.count(F.lit(1)).alias("linhas")
    )


_DEAD = f"""
SELECT reason AS _dlq_reason, "offset" AS _kafka_offset, "partition" AS _kafka_partition
FROM ({_INVALID})"""


@query("snk07", _DEAD)
def snk07(spark, d):
    return dead_letters(spark, _written(spark, d)).drop("value", "dt")


@query("str06", _BRONZE)
def str06(spark, d):
    """A batch written twice leaves each event once."""
    return _shown(bronze_events(spark, _written(spark, d, batches=2)))


def _ingested(spark, d, per_batch: int | None = None) -> str:
    root = scratch_path(spark, "bronze-stream")
    source = file_messages(spark, _topic(spark, d), per_batch)
    query_ = start_ingest(source, root, f"{root}-checkpoint", available_now=True)
    query_.awaitTermination()
    return root


@query("brz10", _BRONZE)
def brz10(spark, d):
    """Stream to bronze, then read bronze."""
    return _shown(bronze_events(spark, _ingested(spark, d)))


@query("brz10_packed", _BRONZE)
def brz10_packed(spark, d):
    """Several micro-batches, whose days are packed into large files before bronze is read."""
    root = _ingested(spark, d, per_batch=3)
    for day in crowded_days(spark, root, run_date("2024-01-20"), least_batches=1):
        compact_day(spark, root, day)
    return _shown(bronze_events(spark, root))


@query("str05", _BRONZE)
def str05(spark, d):
    """The same in several micro-batches."""
    return _shown(bronze_events(spark, _ingested(spark, d, per_batch=8)))


@query(
    "str04",
    f"""SELECT 'valida' AS destino, count(*) AS mensagens FROM ({_VALID})
        UNION ALL SELECT 'rejeitada', count(*) FROM ({_INVALID})
        UNION ALL SELECT 'alerta', count(*) FROM ({_ALERTS})""",
)
def str04(spark, d):
    """How many messages each output of the stream holds."""
    root = _ingested(spark, d)
    outputs = {
        "valida": bronze_events(spark, root),
        "rejeitada": dead_letters(spark, root),
        "alerta": spark.read.parquet(f"{root}/{ALERTS}"),
    }
    counted = [
        df.agg(F.count(F.lit(1)).alias("mensagens")).select(F.lit(name).alias("destino"), "mensagens")
        for name, df in outputs.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("str07", _BRONZE)
def str07(spark, d):
    """Stopped and started again on its checkpoint: the rest follows."""
    path, root = _topic(spark, d), scratch_path(spark, "bronze-restart")
    for _ in range(2):
        source = file_messages(spark, path, 8)
        running = start_ingest(source, root, f"{root}-checkpoint", interval="0 seconds")
        running.processAllAvailable()
        running.stop()
    return _shown(bronze_events(spark, root))


@query("src09", f'SELECT "offset", "partition", equipment_id AS chave FROM ({i.SQL_MESSAGES})')
def src09(spark, d):
    """A stream of messages read to its end."""
    out = scratch_path(spark, "consumed")
    running = (
        file_messages(spark, _topic(spark, d))
        .select("offset", "partition", F.col("key").cast("string").alias("chave"))
        .writeStream.option("checkpointLocation", f"{out}-checkpoint")
        .trigger(availableNow=True)
        .start(out)
    )
    running.awaitTermination()
    return spark.read.parquet(out)


# -- event-time windows -----------------------------------------------------


def _window_sql(width: str, starts: str, closed: str = "") -> str:
    return f"""
SELECT inicio, inicio + INTERVAL {width} AS fim, factory_id, measurement_type,
       count(*) AS leituras, count(*) FILTER (is_anomaly) AS anomalias,
       round(avg(value), 6) AS avg_valor, min(value) AS min_valor, max(value) AS max_valor
FROM (SELECT *, {starts} AS inicio FROM ({i.SQL_EVENTS})) {closed}
GROUP BY ALL"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "inicio": i.ntz("inicio"),
            "fim": i.ntz("fim"),
            "avg_valor": F.round("avg_valor", 6),
        }
    )


_FIVE = "time_bucket(INTERVAL 5 MINUTE, \"timestamp\")"


@query("rmp01", _window_sql("5 MINUTE", _FIVE))
def rmp01(spark, d):
    """Tumbling windows of five minutes."""
    return _rounded(window_metrics(i.events(spark, d)))


@query(
    "rmp01_sliding",
    _window_sql(
        "5 MINUTE",
        "time_bucket(INTERVAL 1 MINUTE, \"timestamp\") - to_minutes(unnest(range(5)))",
    ),
)
def rmp01_sliding(spark, d):
    """Windows of five minutes, one starting each minute."""
    return _rounded(window_metrics(i.events(spark, d), slide="1 minute"))


_CLOSED = "WHERE inicio + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


@query("rmp01_stream", _window_sql("5 MINUTE", _FIVE, _CLOSED))
def rmp01_stream(spark, d):
    """The same as a stream: windows the watermark has closed.

    Some events have no id, and each of them counts.
    """
    source, out = scratch_path(spark, "events"), scratch_path(spark, "windows")
    clean = i.events(spark, d)
    clean = clean.withColumn("event_id", F.when(F.col("k") % 7 != 0, F.col("event_id")))
    clean.write.parquet(source)
    stream = spark.readStream.schema(clean.schema).parquet(source)
    start_window_metrics(
        stream, out, f"{out}-checkpoint", available_now=True
    ).awaitTermination()
    return _rounded(spark.read.parquet(out).drop("dia"))


@query("rmp01_late", _window_sql("5 MINUTE", _FIVE, _CLOSED))
def rmp01_late(spark, d):
    """Events in no order of time, some twice: closed windows and their corrections."""
    source, out = scratch_path(spark, "shuffled"), scratch_path(spark, "corrected")
    clean = i.events(spark, d)
    again = clean.filter(F.col("k") % 10 == 0).withColumn("n", F.col("n") + 7)
    arrival = F.pmod(F.xxhash64("n"), F.lit(4)).cast("int")
    # A batch has all files that came since the one before, written by as many tasks as read.
    for part in range(4):
        clean.unionByName(again).filter(arrival == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(clean.schema).parquet(source)
        start_corrected_metrics(
            stream, out, f"{out}-checkpoint", periods=DAYS, available_now=True
        ).awaitTermination()
    return _rounded(corrected_metrics(spark, out))

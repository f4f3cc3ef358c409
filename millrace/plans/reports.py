"""Questions asked of the star schema, and range alerts on events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.filters import is_true
from millrace.sources.files import input_bytes

#: Bytes of files of readings for each partition of the join with the dimensions.
PIECE = 8 << 20

ALERT_COLUMNS = (
    "event_id", "sensor_id", "equipment_id", "factory_id", "measurement_type",
    "value", "timestamp",
)


def out_of_sensor_range(events: DataFrame, documents: DataFrame) -> DataFrame:
    """Events outside the range their sensor's equipment document declares.

    An equi-join on the sensor; a sensor with a third of all events is split
    by adaptive execution's skew join where the ranges are not broadcast.
    """
    ranges = documents.select(F.explode("sensors").alias("s")).select(
        F.col("s.id").alias("sensor_id"),
        F.col("s.range.min").alias("limite_min"),
        F.col("s.range.max").alias("limite_max"),
    )
    joined = events.select(*ALERT_COLUMNS).join(ranges, "sensor_id")
    return joined.filter(~F.col("value").between(F.col("limite_min"), F.col("limite_max")))


def out_of_normal_range(events: DataFrame, types: DataFrame) -> DataFrame:
    """Events outside the normal range of their measurement type."""
    ranges = types.select(
        F.col("nome").alias("measurement_type"),
        F.col("faixa_normal_min").alias("limite_min"),
        F.col("faixa_normal_max").alias("limite_max"),
    )
    joined = events.select(*ALERT_COLUMNS).join(ranges, "measurement_type")
    return joined.filter(~F.col("value").between(F.col("limite_min"), F.col("limite_max")))


def alert_history(alerts: DataFrame, day: dt.date) -> DataFrame:
    """Alerts stamped with the run that found them, ready to be stored by date."""
    return alerts.withColumns(
        {"_execution_date": F.lit(day), "_processed_at": F.current_timestamp()}
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; NULL keys refer to nothing and pass."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def factory_metrics(daily: DataFrame, factories: DataFrame) -> DataFrame:
    """Readings and anomaly rate by factory and type, with subtotals.

    Aggregated before the dimension is joined: the join sees one row per
    factory and type.
    """
    totals = (
        daily.rollup("factory_id", "measurement_type")
        .agg(
            F.sum("total_leituras").alias("leituras"),
            F.sum("total_anomalias").alias("anomalias"),
            F.grouping_id().alias("nivel"),
        )
        .withColumn("taxa_anomalia", F.col("anomalias") / F.col("leituras"))
    )
    names = factories.select(
        F.col("fabrica_id").alias("factory_id"), F.col("nome").alias("fabrica")
    )
    return totals.join(names, "factory_id", "left")


def daily_trend(hourly: DataFrame, days: int = 7) -> DataFrame:
    """Daily mean per factory and type with a moving mean over ``days`` days.

    Means weigh each hour by its readings. The window runs over daily rows,
    so a partition holds one row per day however many events there were.
    """
    daily = (
        hourly.withColumn(
            "data", F.to_date(F.substring(F.col("date_key").cast("string"), 1, 8), "yyyyMMdd")
        )
        .groupBy("factory_id", "measurement_type", "data")
        .agg(
            F.sum(F.col("avg_valor") * F.col("count_leituras")).alias("soma"),
            F.sum("count_leituras").alias("leituras"),
        )
    )
    day_number = F.datediff(F.col("data"), F.lit(dt.date(1970, 1, 1)))
    frame = (
        Window.partitionBy("factory_id", "measurement_type")
        .orderBy(day_number)
        .rangeBetween(-(days - 1), 0)
    )
    return daily.select(
        "factory_id",
        "measurement_type",
        "data",
        "leituras",
        (F.col("soma") / F.col("leituras")).alias("media_dia"),
        F.sum("leituras").over(frame).alias("leituras_movel"),
        (F.sum("soma").over(frame) / F.sum("leituras").over(frame)).alias("media_movel"),
    )


def worst_sensors(daily: DataFrame, limit: int) -> DataFrame:
    """The sensors with most anomalies (a top-k report)."""
    return (
        daily.groupBy("sensor_id")
        .agg(
            F.sum("total_leituras").alias("leituras"),
            F.sum("total_anomalias").alias("anomalias"),
        )
        .orderBy(F.desc("anomalias"), F.asc("sensor_id"))
        .limit(limit)
    )


def readings_as_events(
    readings: DataFrame,
    statuses: DataFrame,
    sensors: DataFrame,
    equipment: DataFrame,
    types: DataFrame,
) -> DataFrame:
    """Relational readings in the shape of sensor events.

    A second source for the facts: add it to the events with ``unionByName``.
    """
    status = statuses.select(
        F.col("id").alias("status_qualidade_id"), F.col("nome").alias("quality")
    )
    sensor = sensors.select(
        F.col("id").alias("sensor_id"),
        F.col("equipamento_id").alias("equipment_id"),
        "tipo_medicao_id",
    )
    site = equipment.select(
        F.col("id").alias("equipment_id"), F.col("fabrica_id").alias("factory_id")
    )
    kind = types.select(
        F.col("id").alias("tipo_medicao_id"), F.col("nome").alias("measurement_type")
    )
    # Dimensions are joined to each other first, so that the readings are
    # joined (and, if it comes to that, shuffled) once.
    places = sensor.join(site, "equipment_id", "left").join(kind, "tipo_medicao_id", "left")
    # The join and the groups of a fact after it, at least one for each sensor and day, share
    # these partitions: without more of them for more readings, what a task holds would grow.
    pieces = input_bytes(readings) // PIECE
    if pieces > int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        readings = readings.repartition(pieces, "sensor_id")
    return (
        readings.join(status, "status_qualidade_id", "left")
        .join(places, "sensor_id", "left")
        .select(
            F.col("id").alias("event_id"),
            "sensor_id",
            "equipment_id",
            "factory_id",
            "measurement_type",
            F.col("valor").alias("value"),
            F.col("timestamp_leitura").alias("timestamp"),
            "quality",
            is_true("is_anomalia").alias("is_anomaly"),
        )
    )

"""Gold: five dimensions and two facts."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.calendar import calendar_columns
from millrace.operators.aggregates import (
    DAY_KEYS,
    HOUR_KEYS,
    daily_anomalies,
    hourly_metrics,
    with_type_ids,
)
from millrace.operators.columns import pick
from millrace.operators.filters import not_null, on_date
from millrace.operators.quality import Level, complete
from millrace.plans.lake import Lake
from millrace.plans.spec import TableSpec

W = Level.WARNING

FACTORY_COLUMNS = {
    "fabrica_id": "id", "nome": "nome", "latitude": "latitude", "longitude": "longitude",
}
SENSOR_COLUMNS = {
    "sensor_id": "id", "equipment_id": "equipamento_id",
    "tipo_medicao_id": "tipo_medicao_id", "status": "status",
    "data_instalacao": "data_instalacao",
}
TYPE_COLUMNS = {
    "tipo_medicao_id": "id", "nome": "nome", "unidade": "unidade",
    "valor_minimo": "valor_minimo", "valor_maximo": "valor_maximo",
    "faixa_normal_min": "faixa_normal_min", "faixa_normal_max": "faixa_normal_max",
}

EVENT_COLUMNS = (
    "sensor_id", "equipment_id", "factory_id", "measurement_type",
    "value", "timestamp", "quality", "is_anomaly",
)


def hours_of(days: DataFrame, column: str = "data") -> DataFrame:
    """The 24 hour rows of every day in ``days`` (one row per day)."""
    hours = days.select(
        F.col(column).cast("date").alias("data"),
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora"),
    )
    return hours.select(*calendar_columns(F.col("data"), F.col("hora")))


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Hour rows of a date range, both ends included."""
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("data")
    )
    return hours_of(days)


def keyed(df: DataFrame, columns: dict[str, str], key: str) -> DataFrame:
    """Select and rename the rows of known keys, which are unique in silver.

    The load fails if they are not, so no row is chosen at random here.
    """
    return pick(df, columns).filter(not_null(key))


def equipment_dimension(
    equipment: DataFrame, types: DataFrame, documents: DataFrame
) -> DataFrame:
    """Equipment with its type name and maintenance period (two left joins).

    Both joins are on a unique key of the right side. Spark broadcasts the
    sides that are measured to be small and sorts and merges the others.
    """
    types = pick(types, {"tipo_equipamento_id": "id", "tipo_equipamento": "nome"})
    periods = pick(
        documents,
        {
            "equipment_id": "equipamento_id",
            "periodicidade_manutencao": "periodicidade_manutencao",
        },
    )
    return (
        equipment.select(
            "id", "nome", "tipo_equipamento_id", "fabrica_id", "status", "data_instalacao"
        )
        .filter(not_null("id"))
        .withColumnRenamed("id", "equipment_id")
        .join(types, "tipo_equipamento_id", "left")
        .join(periods, "equipment_id", "left")
        .drop("tipo_equipamento_id")
    )


def _day_events(lake: Lake, day: dt.date) -> DataFrame:
    events = lake.read("silver/kafka/sensor_events", _execution_date=day)
    return events.select(*EVENT_COLUMNS)


def affected_events(events: DataFrame, day: dt.date, unit: str) -> DataFrame:
    """All events of every sensor and hour or day (``unit``) that a run date touched.

    A period may hold events of several run dates: those of the others belong
    to its metrics too. The span of the touched periods is looked up first. It
    is a range of the timestamp itself, which the scan of the other run dates
    can skip files by.
    """
    keyed = events.withColumn("_period", F.date_trunc(unit, "timestamp"))
    new = keyed.filter(on_date("_execution_date", day))
    span = new.agg(
        F.min("_period").alias("first"),
        (F.max("_period") + F.expr(f"INTERVAL 1 {unit}")).alias("end"),
    ).first()
    touched = new.select("sensor_id", "_period").distinct()
    in_span = (F.col("timestamp") >= F.lit(span["first"])) & (
        F.col("timestamp") < F.lit(span["end"])
    )
    return (
        keyed.filter(in_span)
        .join(touched, ["sensor_id", "_period"], "left_semi")
        .drop("_period")
    )


def _affected(lake: Lake, day: dt.date, unit: str) -> DataFrame:
    events = lake.read("silver/kafka/sensor_events")
    events = events.select(*EVENT_COLUMNS, "_execution_date")
    return affected_events(events, day, unit)


def _with_types(lake: Lake, metrics: DataFrame) -> DataFrame:
    return with_type_ids(metrics, lake.read("silver/postgres/tipos_medicao"))


DIMENSIONS = (
    TableSpec(
        "gold/dim/dim_tempo",
        lambda lake, day, _: calendar(lake.spark, day, day),
        complete("date_key", "data", "hora", "mes", "ano"),
        keys=("date_key",),
    ),
    TableSpec(
        "gold/dim/dim_fabrica",
        lambda lake, day, _: keyed(
            lake.read("silver/postgres/fabricas"), FACTORY_COLUMNS, "fabrica_id"
        ),
        complete(*FACTORY_COLUMNS),
        keys=("fabrica_id",),
        reads=("silver/postgres/fabricas",),
    ),
    TableSpec(
        "gold/dim/dim_equipamento",
        lambda lake, day, _: equipment_dimension(
            lake.read("silver/postgres/equipamentos"),
            lake.read("silver/postgres/tipos_equipamento"),
            lake.read("silver/mongo/equipamentos"),
        ),
        (
            *complete("equipment_id", "nome", "fabrica_id", "status"),
            *complete("tipo_equipamento", "periodicidade_manutencao", level=W),
        ),
        keys=("equipment_id",),
        reads=(
            "silver/postgres/equipamentos",
            "silver/postgres/tipos_equipamento",
            "silver/mongo/equipamentos",
        ),
    ),
    TableSpec(
        "gold/dim/dim_sensor",
        lambda lake, day, _: keyed(
            lake.read("silver/postgres/sensores"), SENSOR_COLUMNS, "sensor_id"
        ),
        complete("sensor_id", "equipment_id", "tipo_medicao_id", "status"),
        keys=("sensor_id",),
        reads=("silver/postgres/sensores",),
    ),
    TableSpec(
        "gold/dim/dim_tipo_medicao",
        lambda lake, day, _: keyed(
            lake.read("silver/postgres/tipos_medicao"), TYPE_COLUMNS, "tipo_medicao_id"
        ),
        complete(*TYPE_COLUMNS),
        keys=("tipo_medicao_id",),
        reads=("silver/postgres/tipos_medicao",),
    ),
)

# The keys of a fact are its whole grouping: with fewer, two groups of one
# sensor-hour would claim the same target row.
FACTS = (
    TableSpec(
        "gold/fct/fct_leituras_hora",
        lambda lake, day, _: _with_types(lake, hourly_metrics(_day_events(lake, day))),
        (
            *complete(*HOUR_KEYS, "avg_valor", "count_leituras"),
            *complete("tipo_medicao_id", "stddev_valor", level=W),
        ),
        keys=(*HOUR_KEYS, "tipo_medicao_id"),
        null_safe=("tipo_medicao_id",),
        partition_by=("measurement_type", "_execution_date"),
        replaces_day=True,
        reads=("silver/kafka/sensor_events", "silver/postgres/tipos_medicao"),
    ),
    TableSpec(
        "gold/fct/fct_anomalias_dia",
        lambda lake, day, _: daily_anomalies(_day_events(lake, day)),
        complete(*DAY_KEYS, "total_leituras", "total_anomalias", "taxa_anomalia"),
        keys=DAY_KEYS,
        partition_by=("_execution_date",),
        replaces_day=True,
        reads=("silver/kafka/sensor_events",),
    ),
)

# The same facts, with every touched hour or day counted from all its events
# instead of those of the run date alone. An option: run these in place of
# FACTS where events of one hour arrive under several run dates.
RECOMPUTED_FACTS = (
    replace(
        FACTS[0],
        build=lambda lake, day, _: _with_types(
            lake, hourly_metrics(_affected(lake, day, "hour"))
        ),
    ),
    replace(
        FACTS[1],
        build=lambda lake, day, _: daily_anomalies(_affected(lake, day, "day")),
    ),
)

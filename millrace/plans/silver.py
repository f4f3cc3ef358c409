"""Silver: typed, filtered, one row per key, upserted."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.contract import MEASUREMENT_TYPES, QUALITIES
from millrace.operators.filters import less_than, not_null, one_of
from millrace.operators.quality import Level, complete, contained_in, unique
from millrace.plans.bronze import (
    EQUIPMENT_RULES,
    NAMED_RULES,
    READING_METADATA_RULES,
    READING_RULES,
    SENSOR_RULES,
    SITE_RULES,
    STATUSES,
)
from millrace.plans.lake import Lake
from millrace.plans.spec import Consuming, Refinement, TableSpec
from millrace.sources.consumed import SeenLog
from millrace.sources.events import batch_folders, bronze_events, events_of_folders

W = Level.WARNING

# Equipment states of the document source.
DOCUMENT_STATUSES = ("active", "inactive", "maintenance")

FACTORIES = Refinement(
    keys=("id",),
    casts={"id": "string", "nome": "string", "latitude": "double", "longitude": "double"},
    filters=lambda: (not_null("id"),),
)
EQUIPMENT = Refinement(
    keys=("id",),
    casts={
        "id": "string", "nome": "string", "tipo_equipamento_id": "int",
        "fabrica_id": "string", "data_instalacao": "date", "status": "string",
    },
    filters=lambda: (not_null("id"), one_of("status", STATUSES)),
)
SENSORS = Refinement(
    keys=("id",),
    casts={
        "id": "string", "equipamento_id": "string", "tipo_medicao_id": "int",
        "data_instalacao": "date", "status": "string",
    },
    filters=lambda: (not_null("id"), one_of("status", STATUSES)),
)
NAMED = Refinement(
    keys=("id",),
    casts={"id": "int", "nome": "string"},
    filters=lambda: (not_null("id"),),
)
MEASUREMENT_KINDS = Refinement(
    keys=("id",),
    casts={
        "id": "int", "nome": "string", "unidade": "string",
        "valor_minimo": "double", "valor_maximo": "double",
        "faixa_normal_min": "double", "faixa_normal_max": "double",
    },
    filters=lambda: (
        not_null("id"),
        less_than("valor_minimo", "valor_maximo"),
        less_than("faixa_normal_min", "faixa_normal_max"),
    ),
)
READINGS = Refinement(
    keys=("id",),
    casts={
        "id": "string", "sensor_id": "string", "valor": "double",
        "status_qualidade_id": "int", "timestamp_leitura": "timestamp",
        "is_anomalia": "boolean",
    },
    filters=lambda: (not_null("id", "valor", "timestamp_leitura"),),
    # Readings are re-extracted for weeks, so their run date moves. They are
    # stored by the day they were taken, which does not.
    derive={"_dia_leitura": lambda: F.to_date(F.col("timestamp_leitura").try_cast("timestamp"))},
)
READING_METADATA = Refinement(
    keys=("leitura_id",),
    casts={
        "leitura_id": "string", "versao_firmware": "string",
        "nivel_bateria": "int", "forca_sinal_dbm": "int",
    },
    filters=lambda: (not_null("leitura_id"),),
)
DOCUMENTS = Refinement(
    keys=("equipamento_id",),
    casts={
        "equipamento_id": "string", "nome": "string", "tipo": "string",
        "fabrica_id": "string", "fabrica_nome": "string", "status": "string",
        "periodicidade_manutencao": "string", "latitude": "double", "longitude": "double",
    },
    filters=lambda: (not_null("equipamento_id"), one_of("status", DOCUMENT_STATUSES)),
)
SENSOR_EVENTS = Refinement(
    keys=("event_id",),
    casts={
        "event_id": "string", "sensor_id": "string", "equipment_id": "string",
        "factory_id": "string", "measurement_type": "string", "value": "double",
        "unit": "string", "timestamp": "timestamp", "quality": "string",
        "is_anomaly": "boolean", "versao_firmware": "string", "nivel_bateria": "int",
        "_ingested_at": "timestamp",
    },
    filters=lambda: (
        not_null("event_id", "value", "timestamp"),
        one_of("quality", QUALITIES),
        one_of("measurement_type", MEASUREMENT_TYPES),
    ),
    order_by=("_ingested_at",),
    derive={
        "versao_firmware": lambda: F.col("metadata.firmware_version"),
        "nivel_bateria": lambda: F.col("metadata.battery_level"),
    },
    drop=("metadata", "_kafka_offset", "_kafka_partition", "_kafka_topic", "_kafka_key"),
)


def _refined(source: str, refinement: Refinement):
    """Refine the extract of the run date.

    Rows of earlier extracts are in the table already, or were replaced by
    newer ones there.
    """

    def build(lake: Lake, day: dt.date, before: Observation | None) -> DataFrame:
        return refinement.apply(lake.read(f"bronze/{source}", _execution_date=day), before)

    return build


def _events(lake: Lake, day: dt.date, before: Observation | None) -> DataFrame:
    lines = bronze_events(lake.spark, lake.events_path, [day])
    return SENSOR_EVENTS.apply(lines, before)


def _unseen_events(lake: Lake, day: dt.date, before: Observation | None) -> Consuming:
    """Events of all days up to the run date whose folders no run has read yet."""
    log = SeenLog(lake.spark, f"{lake.table(LATE_EVENTS.path).path}/_seen")
    seen = log.read()
    # One row for each new folder: what is read by path has to be known by path.
    listed = batch_folders(lake.spark, lake.events_path, after=seen.up_to).collect()
    new = [f for f in listed if f["dt"] <= day and not seen.has(f["dt"], f["_batch"])]
    left = {f["_batch"] for f in listed if f["dt"] > day}
    whole = max((f["_batch"] for f in listed), default=seen.up_to)
    after = seen.after(
        {(f["dt"], f["_batch"]) for f in new}, min(left) - 1 if left else whole
    )
    lines = events_of_folders(lake.spark, lake.events_path, new)
    return Consuming(SENSOR_EVENTS.apply(lines, before), lambda: log.write(after))


def _spec(
    source, refinement, rules, partition_by=(), build=None,
    keys_stay=False, indexed=False, skips_unchanged=False,
):
    return TableSpec(
        f"silver/{source}",
        build or _refined(source, refinement),
        tuple(rules),
        keys=refinement.keys,
        partition_by=partition_by,
        keys_stay=keys_stay,
        indexed=indexed,
        skips_unchanged=skips_unchanged,
        counts_duplicates=True,
        reads=() if build else (f"bronze/{source}",),  # events are lines of the stream
    )


SILVER = (
    _spec("postgres/fabricas", FACTORIES, SITE_RULES),
    _spec("postgres/equipamentos", EQUIPMENT, EQUIPMENT_RULES),
    _spec("postgres/sensores", SENSORS, SENSOR_RULES),
    _spec("postgres/tipos_equipamento", NAMED, NAMED_RULES),
    _spec(
        "postgres/tipos_medicao",
        MEASUREMENT_KINDS,
        (*complete(*MEASUREMENT_KINDS.casts), unique("nome", W)),
    ),
    _spec("postgres/status_qualidade", NAMED, NAMED_RULES),
    _spec(
        "postgres/leituras",
        READINGS,
        READING_RULES,
        partition_by=("_dia_leitura",),
        keys_stay=True,  # a reading keeps the time it was taken
        skips_unchanged=True,  # and comes again with every extract of two months
    ),
    _spec(
        "postgres/metadados_leitura",
        READING_METADATA,
        READING_METADATA_RULES,
        partition_by=("_execution_date",),
        indexed=True,  # a reading is extracted for weeks, under every run date
    ),
    _spec(
        "mongo/equipamentos",
        DOCUMENTS,
        (
            *complete("equipamento_id", "nome", "tipo", "fabrica_id", "status"),
            contained_in("status", DOCUMENT_STATUSES),
            *complete("latitude", "longitude", "periodicidade_manutencao", level=W),
        ),
    ),
    _spec(
        "kafka/sensor_events",
        SENSOR_EVENTS,
        (
            *complete(
                "event_id", "sensor_id", "equipment_id", "factory_id",
                "measurement_type", "value", "timestamp", "quality",
            ),
            contained_in("quality", QUALITIES),
            contained_in("measurement_type", MEASUREMENT_TYPES),
            *complete("is_anomaly", "versao_firmware", "nivel_bateria", level=W),
        ),
        partition_by=("measurement_type", "_execution_date"),
        build=_events,
        indexed=True,  # an event may be delivered again on any day
    ),
)

# Events whenever they arrive, instead of those of the run date's day alone. An
# option: with it, run gold's RECOMPUTED_FACTS in place of FACTS.
LATE_EVENTS = replace(SILVER[-1], build=_unseen_events)

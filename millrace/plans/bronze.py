"""Bronze: extracts stored as they come, one partition per run date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.calendar import extract_window
from millrace.operators.quality import Level, complete, contained_in, non_negative, unique
from millrace.plans.lake import Lake
from millrace.plans.spec import Build, TableSpec
from millrace.sources.documents import flatten_equipment

W = Level.WARNING

# Equipment and sensor states of the relational source.
STATUSES = ("ativo", "inativo", "manutencao")

RUN_DATE = ("_execution_date",)


def _whole(table: str, then: Callable[[DataFrame], DataFrame] = lambda df: df) -> Build:
    return lambda lake, day, _: then(lake.relations.table(table))


def status_as_text(df: DataFrame) -> DataFrame:
    """The source keeps the status as an enumeration type of its own."""
    return df.withColumn("status", F.col("status").cast("string"))


def _readings(lake: Lake, day: dt.date, _) -> DataFrame:
    return lake.relations.window("leituras", "timestamp_leitura", *extract_window(day))


def _reading_metadata(lake: Lake, day: dt.date, _) -> DataFrame:
    return lake.relations.children_of_window(
        "metadados_leitura", "leitura_id",
        "leituras", "id", "timestamp_leitura", *extract_window(day),
    )


def _documents(lake: Lake, day: dt.date, _) -> DataFrame:
    return flatten_equipment(lake.documents())


EQUIPMENT_RULES = (
    *complete("id", "nome", "tipo_equipamento_id", "fabrica_id", "status"),
    contained_in("status", STATUSES),
    *complete("data_instalacao", level=W),
)
SENSOR_RULES = (
    *complete("id", "equipamento_id", "tipo_medicao_id", "status"),
    contained_in("status", STATUSES),
    *complete("data_instalacao", level=W),
)
NAMED_RULES = (*complete("id", "nome"), unique("nome"))
SITE_RULES = complete("id", "nome", "latitude", "longitude")
READING_RULES = (
    *complete("id", "sensor_id", "valor", "status_qualidade_id", "timestamp_leitura"),
    *complete("is_anomalia", level=W),
)
READING_METADATA_RULES = (
    *complete("leitura_id"),
    *complete("versao_firmware", "nivel_bateria", "forca_sinal_dbm", level=W),
)


def _spec(path: str, build: Build, *rules) -> TableSpec:
    return TableSpec(path, build, tuple(rules), partition_by=RUN_DATE)


BRONZE = (
    _spec("bronze/postgres/fabricas", _whole("fabricas"), *SITE_RULES),
    _spec(
        "bronze/postgres/equipamentos",
        _whole("equipamentos", status_as_text),
        *EQUIPMENT_RULES,
    ),
    _spec("bronze/postgres/sensores", _whole("sensores", status_as_text), *SENSOR_RULES),
    _spec("bronze/postgres/tipos_equipamento", _whole("tipos_equipamento"), *NAMED_RULES),
    _spec(
        "bronze/postgres/tipos_medicao",
        _whole("tipos_medicao"),
        *complete("id", "nome", "unidade", "valor_minimo", "valor_maximo"),
        unique("nome"),
        *complete("faixa_normal_min", "faixa_normal_max", level=W),
    ),
    _spec("bronze/postgres/status_qualidade", _whole("status_qualidade"), *NAMED_RULES),
    _spec("bronze/postgres/leituras", _readings, *READING_RULES, non_negative("valor")),
    _spec(
        "bronze/postgres/metadados_leitura", _reading_metadata, *READING_METADATA_RULES
    ),
    _spec(
        "bronze/mongo/equipamentos",
        _documents,
        *complete("equipamento_id", "nome", "tipo", "fabrica_id", "status"),
        *complete("instalado_em", "latitude", "longitude", level=W),
    ),
)

"""Bronze, silver and gold tables over the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog import inputs as i
from millrace.catalog.registry import query
from millrace.functions.calendar import extract_window, run_date
from millrace.operators.aggregates import daily_anomalies, hourly_metrics, with_type_ids
from millrace.operators.columns import add_metadata
from millrace.plans import silver as s
from millrace.plans.bronze import status_as_text
from millrace.plans.gold import (
    FACTORY_COLUMNS,
    SENSOR_COLUMNS,
    TYPE_COLUMNS,
    equipment_dimension,
    hours_of,
    keyed,
)
from millrace.plans.lake import Lake
from millrace.plans.runner import find_table
from millrace.plans.spec import Refinement
from millrace.sources.documents import flatten_equipment
from millrace.sources.relational import FrameRelations

# The run of the windowed extracts below.
RUN = run_date("2001-08-05")
FIRST, LAST = extract_window(RUN)


def source(spark, folder) -> FrameRelations:
    """The mapped tables as a relational source."""
    tables = {
        "fabricas": i.factories,
        "equipamentos": i.equipment,
        "sensores": i.sensors,
        "tipos_equipamento": i.equipment_types,
        "leituras": i.readings,
        "metadados_leitura": i.reading_metadata,
    }
    return FrameRelations(lambda name: tables[name](spark, folder))


def _extracted(df: DataFrame, origin: str) -> DataFrame:
    return add_metadata(df, RUN, origin).drop("_processed_at")


_STAMP = f"DATE '{RUN}' AS _execution_date, 'postgres' AS _data_source"


@query(
    "brz01",
    f"""SELECT 'FAB-' || cast(n_nationkey AS varchar) AS id, n_name AS nome,
        cast(n_nationkey * 1.5 - 20 AS double) AS latitude,
        cast(n_regionkey * -10.25 AS double) AS longitude, {_STAMP} FROM nation""",
)
def brz01(spark, d):
    df = _extracted(source(spark, d).table("fabricas"), "postgres")
    return df.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


@query(
    "brz02",
    f"""SELECT 'EQ-' || cast(s_suppkey AS varchar) AS id, s_name AS nome,
        cast(s_nationkey % 7 + 1 AS varchar) AS tipo_equipamento_id,
        'FAB-' || cast(s_nationkey AS varchar) AS fabrica_id,
        CASE WHEN s_acctbal > 9000 THEN 'n/a' ELSE
          cast(cast(DATE '2020-01-01' + cast(s_nationkey AS integer) AS date) AS varchar) END
          AS data_instalacao,
        {i.SQL_STATUS.format(b="s_acctbal")} AS status, {_STAMP} FROM supplier""",
)
def brz02(spark, d):
    return _extracted(status_as_text(source(spark, d).table("equipamentos")), "postgres")


@query(
    "brz03",
    f"""SELECT 'SENS-' || cast(c_custkey AS varchar) AS id,
        'EQ-' || cast(c_custkey % 50 AS varchar) AS equipamento_id,
        cast(length(c_mktsegment) % 5 + 1 AS varchar) AS tipo_medicao_id,
        cast(cast(DATE '2021-01-01' + cast(c_nationkey AS integer) AS date) AS varchar)
          AS data_instalacao,
        {i.SQL_STATUS.format(b="c_acctbal")} AS status, {_STAMP} FROM customer""",
)
def brz03(spark, d):
    return _extracted(status_as_text(source(spark, d).table("sensores")), "postgres")


@query(
    "brz04",
    f"""SELECT p_type AS nome, cast(min(p_partkey) AS varchar) AS id,
        max(p_name) AS descricao, {_STAMP} FROM part GROUP BY p_type""",
)
def brz04(spark, d):
    return _extracted(source(spark, d).table("tipos_equipamento"), "postgres")


_STORED = "_execution_date, _processed_at"


def _both_days(sql: str, old: str) -> str:
    """Two extracts: the old wording of a column on the first day."""
    return f"""SELECT *, DATE '{i.SNAPSHOT_DAYS[0]}' AS _execution_date FROM ({old})
        UNION ALL SELECT *, DATE '{i.SNAPSHOT_DAYS[1]}' FROM ({sql})"""


def _daily_extracts(spark, name: str, snapshots: DataFrame) -> DataFrame:
    """The batches of a bronze table for two days, of a source that has ``snapshots``."""
    spec, batches = find_table(f"bronze/postgres/{name}"), []
    for text in i.SNAPSHOT_DAYS:
        day = run_date(text)
        held = snapshots.filter(F.col("_execution_date") == F.lit(day))
        relations = FrameRelations(lambda _, held=held: held.drop("_execution_date", "_processed_at"))
        lake = Lake(spark, "unused", "hmg", relations)
        batches.append(add_metadata(spec.build(lake, day, None), day, spec.source))
    return batches[0].unionByName(batches[1]).drop("_processed_at", "_data_source")


_KINDS = """SELECT cast(p_partkey AS varchar) AS id, p_name AS nome, {} AS unidade,
    cast(p_size AS double) AS valor_minimo,
    cast(cast(p_retailprice - 900 AS decimal(10,2)) AS double) AS valor_maximo,
    cast(length(p_brand) AS double) AS faixa_normal_min,
    cast(length(p_name) AS double) AS faixa_normal_max FROM part"""


@query("brz05", _both_days(_KINDS.format("lower(p_type)"), _KINDS.format("p_type")))
def brz05(spark, d):
    df = _daily_extracts(spark, "tipos_medicao", i.measurement_kinds_bronze(spark, d))
    numbers = ("valor_minimo", "valor_maximo", "faixa_normal_min", "faixa_normal_max")
    return df.withColumns({c: F.col(c).cast("double") for c in numbers})


_PRIORITIES = """SELECT {} AS nome, cast(min(o_orderkey) AS varchar) AS id
    FROM orders GROUP BY o_orderpriority"""


@query(
    "brz06",
    _both_days(_PRIORITIES.format("lower(o_orderpriority)"), _PRIORITIES.format("o_orderpriority")),
)
def brz06(spark, d):
    return _daily_extracts(spark, "status_qualidade", i.statuses_bronze(spark, d))


@query(
    "brz07",
    f"""SELECT id, sensor_id, valor, status_qualidade_id, is_anomalia, timestamp_leitura
        FROM ({i.SQL_READINGS})
        WHERE cast(timestamp_leitura AS date) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'""",
)
def brz07(spark, d):
    df = source(spark, d).window("leituras", "timestamp_leitura", FIRST, LAST)
    return df.select(
        "id",
        "sensor_id",
        F.col("valor").try_cast("double").alias("valor"),
        F.col("status_qualidade_id").cast("int").alias("status_qualidade_id"),
        F.col("is_anomalia").cast("boolean").alias("is_anomalia"),
        "timestamp_leitura",
    )


@query(
    "brz08",
    f"""SELECT leitura_id, versao_firmware, nivel_bateria, forca_sinal_dbm
        FROM ({i.SQL_READING_METADATA})
        WHERE leitura_id IN (SELECT id FROM ({i.SQL_READINGS})
          WHERE cast(timestamp_leitura AS date) BETWEEN DATE '{FIRST}' AND DATE '{LAST}')""",
)
def brz08(spark, d):
    df = source(spark, d).children_of_window(
        "metadados_leitura", "leitura_id", "leituras", "id", "timestamp_leitura", FIRST, LAST
    )
    return df.select(
        "leitura_id",
        "versao_firmware",
        F.col("nivel_bateria").cast("int").alias("nivel_bateria"),
        F.col("forca_sinal_dbm").cast("int").alias("forca_sinal_dbm"),
    )


def _shown_documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_sensors", F.size("sensors")).withColumn(
        "instalado_em", i.ntz("instalado_em")
    ).drop("sensors")


@query("brz09", i.SQL_DOCUMENTS)
def brz09(spark, d):
    return _shown_documents(flatten_equipment(i.documents(spark, d)))


# -- silver -----------------------------------------------------------------


def _refined(refinement: Refinement, bronze: DataFrame) -> DataFrame:
    return refinement.apply(bronze).drop("_processed_at")


_NEWEST = f"DATE '{i.SNAPSHOT_DAYS[1]}' AS _execution_date"


@query("slv01", f"SELECT *, {_NEWEST} FROM ({i.SQL_FACTORIES})")
def slv01(spark, d):
    return _refined(s.FACTORIES, i.factories_bronze(spark, d))


@query("slv02", f"SELECT *, {_NEWEST} FROM ({i.SQL_EQUIPMENT})")
def slv02(spark, d):
    return _refined(s.EQUIPMENT, i.equipment_bronze(spark, d))


@query("slv03", f"SELECT *, {_NEWEST} FROM ({i.SQL_SENSORS})")
def slv03(spark, d):
    return _refined(s.SENSORS, i.sensors_bronze(spark, d))


@query("slv04", f"SELECT *, {_NEWEST} FROM ({i.SQL_EQUIPMENT_TYPES})")
def slv04(spark, d):
    return _refined(s.NAMED, i.equipment_types_bronze(spark, d))


@query("slv05", f"SELECT *, {_NEWEST} FROM ({i.SQL_MEASUREMENT_KINDS})")
def slv05(spark, d):
    return _refined(s.MEASUREMENT_KINDS, i.measurement_kinds_bronze(spark, d))


@query("slv06", f"SELECT *, {_NEWEST} FROM ({i.SQL_STATUSES})")
def slv06(spark, d):
    return _refined(s.NAMED, i.statuses_bronze(spark, d))


SQL_SILVER_READINGS = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY _processed_at DESC) AS rn
  FROM ({i.SQL_READINGS}) WHERE valor IS NOT NULL)
WHERE rn = 1"""


@query(
    "slv07",
    f"""SELECT id, sensor_id, valor, status_qualidade_id, is_anomalia, timestamp_leitura,
        cast(timestamp_leitura AS date) AS _dia_leitura, DATE '{i.SNAPSHOT_DAYS[0]}' AS _execution_date
        FROM ({SQL_SILVER_READINGS})""",
)
def slv07(spark, d):
    day = run_date(i.SNAPSHOT_DAYS[0])
    bronze = i.readings(spark, d).filter(F.col("_execution_date") == F.lit(day))
    df = _refined(s.READINGS, bronze)
    return df.withColumn("timestamp_leitura", i.ntz("timestamp_leitura"))


@query(
    "slv08",
    f"""SELECT leitura_id, versao_firmware, nivel_bateria, forca_sinal_dbm,
        DATE '{i.SNAPSHOT_DAYS[0]}' AS _execution_date FROM (
          SELECT *, row_number() OVER (PARTITION BY leitura_id ORDER BY _processed_at DESC) AS rn
          FROM ({i.SQL_READING_METADATA})) WHERE rn = 1""",
)
def slv08(spark, d):
    return _refined(s.READING_METADATA, i.reading_metadata(spark, d))


SQL_SILVER_DOCUMENTS = f"SELECT * FROM ({i.SQL_DOCUMENTS}) WHERE status <> 'broken'"


@query("slv09", SQL_SILVER_DOCUMENTS)
def slv09(spark, d):
    bronze = flatten_equipment(i.documents(spark, d))
    return _shown_documents(s.DOCUMENTS.apply(bronze))


@query("slv10", i.SQL_SILVER_EVENTS)
def slv10(spark, d):
    df = s.SENSOR_EVENTS.apply(i.bronze_lines(spark, d))
    return df.withColumns({c: i.ntz(c) for c in ("timestamp", "_ingested_at")})


# -- gold -------------------------------------------------------------------

SQL_CALENDAR = """
SELECT cast(strftime(data, '%Y%m%d') AS bigint) * 100 + hora AS date_key, data,
       cast(hora AS integer) AS hora,
       cast(dayofweek(data) + 1 AS integer) AS dia_semana,
       cast(weekofyear(data) AS integer) AS semana_ano,
       cast(month(data) AS integer) AS mes, cast(quarter(data) AS integer) AS trimestre,
       cast(year(data) AS integer) AS ano,
       ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro',
        'Outubro','Novembro','Dezembro'][month(data)] AS nome_mes
FROM (SELECT DISTINCT cast({column} AS date) AS data FROM {table}), range(24) h(hora)"""


@query("gld01", SQL_CALENDAR.format(column="l_shipdate", table="lineitem"))
def gld01(spark, d):
    """Hour rows for every day that has line items."""
    days = i.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("data"))
    return hours_of(days.distinct())


@query(
    "gld02",
    f"SELECT id AS fabrica_id, nome, latitude, longitude FROM ({i.SQL_FACTORIES})",
)
def gld02(spark, d):
    return keyed(_refined(s.FACTORIES, i.factories_bronze(spark, d)), FACTORY_COLUMNS, "fabrica_id")


@query(
    "gld03",
    f"""SELECT e.id AS equipment_id, e.nome, e.fabrica_id, e.status, e.data_instalacao,
        t.nome AS tipo_equipamento, m.periodicidade_manutencao
        FROM ({i.SQL_EQUIPMENT}) e
        LEFT JOIN ({i.SQL_EQUIPMENT_TYPES}) t ON e.tipo_equipamento_id = t.id
        LEFT JOIN ({SQL_SILVER_DOCUMENTS}) m ON e.id = m.equipamento_id""",
)
def gld03(spark, d):
    return equipment_dimension(
        _refined(s.EQUIPMENT, i.equipment_bronze(spark, d)),
        _refined(s.NAMED, i.equipment_types_bronze(spark, d)),
        s.DOCUMENTS.apply(flatten_equipment(i.documents(spark, d))),
    )


@query(
    "gld04",
    f"""SELECT id AS sensor_id, equipamento_id AS equipment_id, tipo_medicao_id, status,
        data_instalacao FROM ({i.SQL_SENSORS})""",
)
def gld04(spark, d):
    return keyed(_refined(s.SENSORS, i.sensors_bronze(spark, d)), SENSOR_COLUMNS, "sensor_id")


@query(
    "gld05",
    f"""SELECT id AS tipo_medicao_id, * EXCLUDE (id) FROM ({i.SQL_MEASUREMENT_KINDS})""",
)
def gld05(spark, d):
    kinds = _refined(s.MEASUREMENT_KINDS, i.measurement_kinds_bronze(spark, d))
    return keyed(kinds, TYPE_COLUMNS, "tipo_medicao_id")


SQL_HOURLY = f"""
SELECT cast(strftime("timestamp", '%Y%m%d%H') AS bigint) AS date_key, sensor_id, equipment_id,
       factory_id, t.id AS tipo_medicao_id, measurement_type,
       round(avg(value), 6) AS avg_valor, min(value) AS min_valor, max(value) AS max_valor,
       round(stddev_samp(value), 6) AS stddev_valor, count(*) AS count_leituras,
       cast(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS bigint) AS count_anomalias,
       cast(sum(CASE WHEN quality = 'good' THEN 1 ELSE 0 END) AS double) / count(*)
         AS pct_qualidade_boa
FROM ({i.SQL_EVENTS}) LEFT JOIN ({i.SQL_TYPES}) t ON measurement_type = t.nome
GROUP BY ALL"""

SQL_DAILY = f"""
SELECT cast("timestamp" AS date) AS data, sensor_id, equipment_id, factory_id, measurement_type,
       count(*) AS total_leituras,
       cast(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS bigint) AS total_anomalias,
       cast(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS double) / count(*) AS taxa_anomalia,
       max(value) AS max_valor_dia, min(value) AS min_valor_dia
FROM ({i.SQL_EVENTS}) GROUP BY ALL"""


def hourly_fact(spark, d) -> DataFrame:
    return with_type_ids(hourly_metrics(i.events(spark, d)), i.types(spark))


@query("gld06", SQL_HOURLY)
def gld06(spark, d):
    return hourly_fact(spark, d).withColumns(
        {c: F.round(c, 6) for c in ("avg_valor", "stddev_valor")}
    )


@query("gld07", SQL_DAILY)
def gld07(spark, d):
    return daily_anomalies(i.events(spark, d))

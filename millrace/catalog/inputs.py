"""The given tables seen as sensor data: DataFrames, and the same as SQL.

``events`` stands for sensor events, ``supplier`` for equipment, ``customer``
for sensors, ``nation`` for factories, ``lineitem`` for relational readings
and ``part``, ``orders`` for lookup tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Measurement types with their normal ranges.
TYPE_ROWS = (
    (1, "temperature", "celsius", 20.0, 100.0, 30.0, 70.0),
    (2, "humidity", "percent", 0.0, 100.0, 40.0, 60.0),
    (3, "pressure", "bar", 0.0, 20.0, 5.0, 15.0),
    (4, "vibration", "mm/s", 0.0, 50.0, 0.0, 10.0),
    (5, "current", "ampere", 0.0, 100.0, 10.0, 50.0),
)
TYPE_SCHEMA = (
    "id int, nome string, unidade string, valor_minimo double, valor_maximo double,"
    " faixa_normal_min double, faixa_normal_max double"
)
# Which kind of event stands for which measurement type.
EVENT_KINDS = {
    "view": "temperature",
    "click": "humidity",
    "signup": "pressure",
    "purchase": "vibration",
    "error": "current",
}

SNAPSHOT_DAYS = ("2024-01-01", "2024-01-02")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ntz(column: str | Column) -> Column:
    """A timestamp as wall-clock time, the way SQL engines without zones show it."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TYPE_ROWS, TYPE_SCHEMA)


SQL_TYPES = (
    "SELECT * FROM (VALUES "
    + ", ".join(str(row) for row in TYPE_ROWS)
    + ") t(id, nome, unidade, valor_minimo, valor_maximo, faixa_normal_min, faixa_normal_max)"
)


def _by_kind(column: str, answers: dict[str, Column]) -> Column:
    result = F.lit(None)
    for kind, answer in answers.items():
        result = F.when(F.col(column) == kind, answer).otherwise(result)
    return result


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of ``events`` as a clean sensor event."""
    raw = table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    by_type = {row[1]: row for row in TYPE_ROWS}
    outside = {
        kind: ~F.col("value").between(by_type[name][5], by_type[name][6])
        for kind, name in EVENT_KINDS.items()
    }
    return raw.withColumn("k", k).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("SENS-"), F.col("user_id").cast("string")).alias("sensor_id"),
        F.concat(F.lit("EQ-"), (F.col("user_id") % 50).cast("string")).alias("equipment_id"),
        F.concat(F.lit("FAB-"), (F.col("user_id") % 3).cast("string")).alias("factory_id"),
        _by_kind("event_type", {a: F.lit(b) for a, b in EVENT_KINDS.items()}).alias(
            "measurement_type"
        ),
        "value",
        _by_kind(
            "event_type", {a: F.lit(by_type[b][2]) for a, b in EVENT_KINDS.items()}
        ).alias("unit"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("k") % 6 < 4, "good")
        .when(F.col("k") % 6 == 4, "warning")
        .otherwise("bad")
        .alias("quality"),
        _by_kind("event_type", outside).alias("is_anomaly"),
        "k",
        F.col("event_id").alias("n"),
    )


_KIND_SQL = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_KINDS.items())
_UNIT_SQL = " ".join(
    f"WHEN '{a}' THEN '{next(r[2] for r in TYPE_ROWS if r[1] == b)}'"
    for a, b in EVENT_KINDS.items()
)
_OUTSIDE_SQL = " ".join(
    "WHEN '{}' THEN value NOT BETWEEN {} AND {}".format(
        a, *next((r[5], r[6]) for r in TYPE_ROWS if r[1] == b)
    )
    for a, b in EVENT_KINDS.items()
)
SQL_EVENTS = f"""
SELECT cast(event_id AS varchar) AS event_id,
       'SENS-' || cast(user_id AS varchar) AS sensor_id,
       'EQ-' || cast(user_id % 50 AS varchar) AS equipment_id,
       'FAB-' || cast(user_id % 3 AS varchar) AS factory_id,
       CASE event_type {_KIND_SQL} END AS measurement_type,
       value,
       CASE event_type {_UNIT_SQL} END AS unit,
       ts AS "timestamp",
       CASE WHEN k % 6 < 4 THEN 'good' WHEN k % 6 = 4 THEN 'warning' ELSE 'bad' END AS quality,
       CASE event_type {_OUTSIDE_SQL} END AS is_anomaly,
       k, event_id AS n
FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS integer) AS k FROM events)
"""

# -- event messages, with faults by k -----------------------------------


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a topic message; small values of ``k`` get a fault each."""
    e = events(spark, folder)
    k = F.col("k")

    def quoted(column: str) -> Column:
        return F.concat(F.lit('"'), F.col(column), F.lit('"'))

    def pair(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    wall = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    number = F.col("value").cast("decimal(12,2)").cast("string")
    fields = [
        pair("event_id", F.when(k == 12, F.lit("null")).otherwise(quoted("event_id"))),
        F.when(k != 2, pair("sensor_id", quoted("sensor_id"))),
        pair("equipment_id", quoted("equipment_id")),
        pair("factory_id", quoted("factory_id")),
        pair(
            "measurement_type",
            F.when(k == 9, F.lit('"torque"')).otherwise(quoted("measurement_type")),
        ),
        pair(
            "value",
            F.when(k == 4, F.lit('"abc"')).when(k == 5, F.lit("true")).otherwise(number),
        ),
        F.when(k != 3, pair("unit", quoted("unit"))),
        pair(
            "timestamp",
            F.when(k == 13, F.lit('"31/12"')).otherwise(
                F.concat(
                    F.lit('"'), wall, F.when(k == 14, F.lit("-03:00")).otherwise(""), F.lit('"')
                )
            ),
        ),
        pair(
            "quality",
            F.when(k.isin(3, 7), F.lit('"otima"'))
            .when(k == 8, F.lit("null"))
            .otherwise(quoted("quality")),
        ),
        pair(
            "is_anomaly",
            F.when(k == 6, F.lit('"sim"')).otherwise(F.col("is_anomaly").cast("string")),
        ),
        pair(
            "metadata",
            F.when(k == 10, F.lit('"text"'))
            .when(k == 11, F.lit("{}"))
            .otherwise(
                F.concat(
                    F.lit('{"firmware_version":"1.'), (k % 10).cast("string"),
                    F.lit('","battery_level":'), k.cast("string"),
                    F.lit(',"signal_strength":-'), k.cast("string"), F.lit("}"),
                )
            ),
        ),
    ]
    text = (
        F.when(k == 0, F.lit("{bad"))
        .when(k == 1, F.lit('"so texto"'))
        .otherwise(F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    )
    return e.select(
        F.col("equipment_id").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit("iot-sensors-raw").alias("topic"),
        (F.col("n") % 3).cast("int").alias("partition"),
        F.col("n").alias("offset"),
        F.col("timestamp"),
    )


# What the contract says about each message, by the fault it was given.
SQL_MESSAGES = f"""
SELECT *,
  CASE k
    WHEN 0 THEN 'Mensagem não é JSON válido'
    WHEN 1 THEN 'Evento deve ser dict, recebeu: str'
    WHEN 2 THEN 'Campos ausentes: [''sensor_id'']'
    WHEN 3 THEN 'Campos ausentes: [''unit'']'
    WHEN 4 THEN '''value'' deve ser numérico, recebeu: str'
    WHEN 5 THEN '''value'' deve ser numérico, recebeu: bool'
    WHEN 6 THEN '''is_anomaly'' deve ser bool, recebeu: str'
    WHEN 7 THEN '''quality'' inválido: otima (esperado: [''bad'', ''good'', ''warning''])'
    WHEN 8 THEN '''quality'' inválido: None (esperado: [''bad'', ''good'', ''warning''])'
    WHEN 9 THEN '''measurement_type'' inválido: torque'
    WHEN 10 THEN '''metadata'' deve ser um objeto JSON'
  END AS reason,
  n AS "offset", cast(n % 3 AS integer) AS "partition",
  CASE k WHEN 13 THEN current_date ELSE cast("timestamp" AS date) END AS dt
FROM ({SQL_EVENTS})
"""


def bronze_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice, as bronze lines.

    The second delivery comes an hour later with a changed value, and with a
    fault where ``k`` is below 50.
    """
    e = events(spark, folder)

    def delivery(second: bool) -> DataFrame:
        def unless(low: int, high: int, good: Column, bad: Column) -> Column:
            faulty = F.col("k").between(low, high) & F.lit(second)
            return F.when(faulty, bad).otherwise(good)

        null = F.lit(None).cast("string")
        value = (F.col("value") + (1.0 if second else 0.0)).cast("string")
        hours = F.expr(f"INTERVAL {2 if second else 1} HOURS")
        return e.select(
            unless(20, 29, F.col("event_id"), null).alias("event_id"),
            "sensor_id",
            "equipment_id",
            unless(10, 19, value, F.lit("n/a")).alias("value"),
            "unit",
            unless(30, 39, F.col("timestamp").cast("string"), F.lit("yesterday")).alias(
                "timestamp"
            ),
            unless(0, 9, F.col("quality"), F.lit("otima")).alias("quality"),
            "is_anomaly",
            F.struct(
                F.concat(F.lit("1."), (F.col("k") % 10).cast("string")).alias("firmware_version"),
                F.col("k").alias("battery_level"),
                (-F.col("k")).alias("signal_strength"),
            ).alias("metadata"),
            (F.col("timestamp") + hours).cast("string").alias("_ingested_at"),
            F.col("n").alias("_kafka_offset"),
            (F.col("n") % 3).cast("int").alias("_kafka_partition"),
            F.lit("iot-sensors-raw").alias("_kafka_topic"),
            F.col("equipment_id").alias("_kafka_key"),
            "factory_id",
            unless(40, 49, F.col("measurement_type"), F.lit("torque")).alias("measurement_type"),
            F.to_date("timestamp").alias("dt"),
        )

    return delivery(False).unionByName(delivery(True))


# The clean event after refinement: the second delivery where it has no fault.
SQL_SILVER_EVENTS = f"""
SELECT event_id, sensor_id, equipment_id, factory_id, measurement_type,
       CASE WHEN k < 50 THEN value ELSE value + 1.0 END AS value,
       unit, "timestamp", quality, is_anomaly,
       '1.' || cast(k % 10 AS varchar) AS versao_firmware, k AS nivel_bateria,
       "timestamp" + CASE WHEN k < 50 THEN INTERVAL 1 HOUR ELSE INTERVAL 2 HOUR END AS _ingested_at,
       cast("timestamp" AS date) AS dt
FROM ({SQL_EVENTS})
"""

# -- relational tables, as two stored extracts ---------------------------


def _two_extracts(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """The table as extracted on two days; ``changes`` hold on the second."""
    days = [F.lit(day).cast("date") for day in SNAPSHOT_DAYS]
    first = df.withColumn("_execution_date", days[0])
    second = df.withColumns(changes).withColumn("_execution_date", days[1])
    return first.unionByName(second).withColumn(
        "_processed_at", F.col("_execution_date").cast("timestamp")
    )


def _status(balance: str) -> Column:
    b = F.col(balance)
    return (
        F.when(b < 0, "quebrado").when(b < 3000, "ativo").when(b < 6000, "inativo")
        .otherwise("manutencao")
    )


SQL_STATUS = """CASE WHEN {b} < 0 THEN 'quebrado' WHEN {b} < 3000 THEN 'ativo'
  WHEN {b} < 6000 THEN 'inativo' ELSE 'manutencao' END"""


def factories(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "nation")
    return n.select(
        F.concat(F.lit("FAB-"), F.col("n_nationkey").cast("string")).alias("id"),
        F.col("n_name").alias("nome"),
        (F.col("n_nationkey") * 1.5 - 20).cast("decimal(9,6)").alias("latitude"),
        (F.col("n_regionkey") * -10.25).cast("decimal(9,6)").alias("longitude"),
    )


def factories_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return _two_extracts(
        factories(spark, folder), {"nome": F.concat("nome", F.lit(" II"))}
    )


SQL_FACTORIES = """
SELECT 'FAB-' || cast(n_nationkey AS varchar) AS id, n_name || ' II' AS nome,
       cast(n_nationkey * 1.5 - 20 AS double) AS latitude,
       cast(n_regionkey * -10.25 AS double) AS longitude
FROM nation"""


def equipment(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier")
    bad_date = F.col("s_acctbal") > 9000
    return s.select(
        F.concat(F.lit("EQ-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_name").alias("nome"),
        (F.col("s_nationkey") % 7 + 1).cast("string").alias("tipo_equipamento_id"),
        F.concat(F.lit("FAB-"), F.col("s_nationkey").cast("string")).alias("fabrica_id"),
        F.when(bad_date, "n/a")
        .otherwise(
            F.date_add(F.lit("2020-01-01").cast("date"), F.col("s_nationkey")).cast("string")
        )
        .alias("data_instalacao"),
        _status("s_acctbal").alias("status"),
    )


def equipment_bronze(spark: SparkSession, folder: str) -> DataFrame:
    renamed = F.concat(F.col("nome"), F.lit(" B"))
    return _two_extracts(equipment(spark, folder), {"nome": renamed})


SQL_EQUIPMENT = f"""
SELECT 'EQ-' || cast(s_suppkey AS varchar) AS id, s_name || ' B' AS nome,
       cast(s_nationkey % 7 + 1 AS integer) AS tipo_equipamento_id,
       'FAB-' || cast(s_nationkey AS varchar) AS fabrica_id,
       CASE WHEN s_acctbal <= 9000
            THEN cast(DATE '2020-01-01' + cast(s_nationkey AS integer) AS date) END AS data_instalacao,
       {SQL_STATUS.format(b="s_acctbal")} AS status
FROM supplier WHERE s_acctbal >= 0"""


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    return c.select(
        F.concat(F.lit("SENS-"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lit("EQ-"), (F.col("c_custkey") % 50).cast("string")).alias("equipamento_id"),
        (F.length("c_mktsegment") % 5 + 1).cast("string").alias("tipo_medicao_id"),
        F.date_add(F.lit("2021-01-01").cast("date"), F.col("c_nationkey")).cast("string").alias(
            "data_instalacao"
        ),
        _status("c_acctbal").alias("status"),
    )


def sensors_bronze(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.date_add(F.col("data_instalacao").cast("date"), 1).cast("string")
    return _two_extracts(sensors(spark, folder), {"data_instalacao": moved})


SQL_SENSORS = f"""
SELECT 'SENS-' || cast(c_custkey AS varchar) AS id,
       'EQ-' || cast(c_custkey % 50 AS varchar) AS equipamento_id,
       cast(length(c_mktsegment) % 5 + 1 AS integer) AS tipo_medicao_id,
       cast(DATE '2021-01-02' + cast(c_nationkey AS integer) AS date) AS data_instalacao,
       {SQL_STATUS.format(b="c_acctbal")} AS status
FROM customer WHERE c_acctbal >= 0"""


def equipment_types(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part type; its first part serves as id."""
    p = table(spark, folder, "part")
    return p.groupBy(F.col("p_type").alias("nome")).agg(
        F.min("p_partkey").cast("string").alias("id"), F.max("p_name").alias("descricao")
    )


def equipment_types_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return _two_extracts(
        equipment_types(spark, folder), {"descricao": F.upper("descricao")}
    )


SQL_EQUIPMENT_TYPES = """
SELECT cast(min(p_partkey) AS integer) AS id, p_type AS nome, upper(max(p_name)) AS descricao
FROM part GROUP BY p_type"""


def measurement_kinds_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as measurement types, many with ranges that make no sense."""
    p = table(spark, folder, "part")
    kinds = p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("nome"),
        F.col("p_type").alias("unidade"),
        F.col("p_size").cast("decimal(10,2)").alias("valor_minimo"),
        (F.col("p_retailprice") - 900).cast("decimal(10,2)").alias("valor_maximo"),
        F.length("p_brand").cast("decimal(10,2)").alias("faixa_normal_min"),
        F.length("p_name").cast("decimal(10,2)").alias("faixa_normal_max"),
    )
    return _two_extracts(kinds, {"unidade": F.lower("unidade")})


SQL_MEASUREMENT_KINDS = """
SELECT * FROM (
  SELECT cast(p_partkey AS integer) AS id, p_name AS nome, lower(p_type) AS unidade,
         cast(p_size AS double) AS valor_minimo,
         cast(cast(p_retailprice - 900 AS decimal(10,2)) AS double) AS valor_maximo,
         cast(length(p_brand) AS double) AS faixa_normal_min,
         cast(length(p_name) AS double) AS faixa_normal_max
  FROM part)
WHERE valor_minimo < valor_maximo AND faixa_normal_min < faixa_normal_max"""


def statuses(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("nome")).agg(
        F.min("o_orderkey").cast("string").alias("id")
    )


def statuses_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return _two_extracts(statuses(spark, folder), {"nome": F.lower("nome")})


SQL_STATUSES = """
SELECT cast(min(o_orderkey) AS integer) AS id, lower(o_orderpriority) AS nome
FROM orders GROUP BY o_orderpriority"""


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a reading; ids repeat, some values are not numbers."""
    return readings_of(table(spark, folder, "lineitem"))


def readings_of(li: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("id"),
        F.concat(F.lit("SENS-"), F.col("l_partkey").cast("string")).alias("sensor_id"),
        F.when(F.col("l_discount") == 0, "err")
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
        .alias("valor"),
        F.when(flag == "A", "1").when(flag == "N", "2").otherwise("3").alias("status_qualidade_id"),
        (F.col("l_linestatus") == "F").cast("string").alias("is_anomalia"),
        F.col("l_shipdate").alias("timestamp_leitura"),
        F.lit(SNAPSHOT_DAYS[0]).cast("date").alias("_execution_date"),
        F.timestamp_add(
            "SECOND", F.col("l_partkey") * 100000 + F.col("l_suppkey"), F.col("l_shipdate")
        ).alias("_processed_at"),
    )


SQL_READINGS = """
SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS id,
       'SENS-' || cast(l_partkey AS varchar) AS sensor_id,
       CASE WHEN l_discount <> 0 THEN l_extendedprice END AS valor,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS status_qualidade_id,
       l_linestatus = 'F' AS is_anomalia, l_shipdate AS timestamp_leitura,
       l_shipdate + to_seconds(l_partkey * 100000 + l_suppkey) AS _processed_at
FROM lineitem"""


def reading_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return reading_metadata_of(table(spark, folder, "lineitem"))


def reading_metadata_of(li: DataFrame) -> DataFrame:
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("leitura_id"),
        F.concat(F.lit("v"), F.col("l_linenumber").cast("string")).alias("versao_firmware"),
        F.col("l_quantity").cast("short").alias("nivel_bateria"),
        (-(F.col("l_suppkey") % 100)).cast("short").alias("forca_sinal_dbm"),
        F.lit(SNAPSHOT_DAYS[0]).cast("date").alias("_execution_date"),
        F.timestamp_add(
            "SECOND", F.col("l_partkey") * 100000 + F.col("l_suppkey"), F.col("l_shipdate")
        ).alias("_processed_at"),
    )


SQL_READING_METADATA = """
SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS leitura_id,
       'v' || cast(l_linenumber AS varchar) AS versao_firmware,
       cast(l_quantity AS integer) AS nivel_bateria,
       cast(-(l_suppkey % 100) AS integer) AS forca_sinal_dbm,
       l_shipdate + to_seconds(l_partkey * 100000 + l_suppkey) AS _processed_at
FROM lineitem"""


# -- documents -------------------------------------------------------------


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as nested equipment documents, two sensors each."""
    s, n = table(spark, folder, "supplier"), table(spark, folder, "nation")
    joined = s.join(n, s.s_nationkey == n.n_nationkey, "left")

    def sensor(shift: int, kind: str, low: float, high: Column) -> Column:
        return F.struct(
            F.concat(F.lit("SENS-"), (F.col("s_suppkey") + shift).cast("string")).alias("id"),
            F.lit(kind).alias("type"),
            F.struct(F.lit(low).alias("min"), high.alias("max")).alias("range"),
        )

    balance = F.col("s_acctbal")
    located = F.col("s_nationkey") != 0
    return joined.select(
        F.concat(F.lit("EQ-"), F.col("s_suppkey").cast("string")).alias("_id"),
        F.col("s_name").alias("name"),
        F.lit("pump").alias("type"),
        F.struct(
            F.concat(F.lit("FAB-"), F.col("s_nationkey").cast("string")).alias("id"),
            F.col("n_name").alias("name"),
            F.when(
                located,
                F.struct(
                    (F.col("n_nationkey") * 1.5 - 20).alias("lat"),
                    (F.col("n_regionkey") * -10.25).alias("lng"),
                ),
            ).alias("location"),
        ).alias("factory"),
        F.array(
            sensor(0, "temperature", 1.0, F.lit(60.0)),
            sensor(1000000, "vibration", 0.0, balance),
        ).alias("sensors"),
        F.when(balance < 5000, "monthly").otherwise("weekly").alias("maintenance_schedule"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("s_nationkey"))
        .cast("timestamp")
        .alias("installed_at"),
        F.when(balance < 0, "broken").when(balance < 4000, "active")
        .when(balance < 8000, "inactive").otherwise("maintenance").alias("status"),
    )


SQL_DOCUMENTS = """
SELECT 'EQ-' || cast(s_suppkey AS varchar) AS equipamento_id, s_name AS nome, 'pump' AS tipo,
       'FAB-' || cast(s_nationkey AS varchar) AS fabrica_id, n_name AS fabrica_nome,
       CASE WHEN s_nationkey <> 0 THEN cast(n_nationkey * 1.5 - 20 AS double) END AS latitude,
       CASE WHEN s_nationkey <> 0 THEN cast(n_regionkey * -10.25 AS double) END AS longitude,
       CASE WHEN s_acctbal < 5000 THEN 'monthly' ELSE 'weekly' END AS periodicidade_manutencao,
       cast(DATE '2023-01-01' + cast(s_nationkey AS integer) AS timestamp) AS instalado_em,
       CASE WHEN s_acctbal < 0 THEN 'broken' WHEN s_acctbal < 4000 THEN 'active'
            WHEN s_acctbal < 8000 THEN 'inactive' ELSE 'maintenance' END AS status,
       2 AS n_sensors
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

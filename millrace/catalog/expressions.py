"""Projections, filters, joins, aggregates, functions and rules as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs as i
from millrace.catalog.layers import SQL_CALENDAR, SQL_SILVER_DOCUMENTS, hourly_fact
from millrace.catalog.registry import query
from millrace.functions.calendar import (
    calendar_columns,
    extract_window,
    extract_window_start,
    hour_key,
    hour_key_of,
    month_name,
    run_date,
)
from millrace.functions.contract import MEASUREMENT_TYPES, QUALITIES, REQUIRED_FIELDS
from millrace.operators import quality as dq
from millrace.operators.aggregates import (
    daily_anomalies,
    hourly_metrics,
    share,
    with_type_ids,
)
from millrace.operators.columns import add_metadata, cast_columns, pick
from millrace.operators.dedup import keep_latest
from millrace.operators.filters import (
    in_days,
    is_true,
    less_than,
    not_null,
    on_date,
    one_of,
)
from millrace.plans.bronze import STATUSES, status_as_text
from millrace.plans.gold import equipment_dimension
from millrace.plans.silver import DOCUMENTS, EQUIPMENT, NAMED
from millrace.sources.documents import flatten_equipment
from millrace.streaming.ingest import classify, event_day

# -- projections ------------------------------------------------------------


@query("prj01", "SELECT s_suppkey AS equipment_id, s_name AS nome FROM supplier")
def prj01(spark, d):
    return pick(i.table(spark, d, "supplier"), {"equipment_id": "s_suppkey", "nome": "s_name"})


@query("prj02", i.SQL_DOCUMENTS)
def prj02(spark, d):
    """Flatten nested documents; the sensor array stays an array."""
    flat = flatten_equipment(i.documents(spark, d))
    return flat.select(
        *[c for c in flat.columns if c not in ("sensors", "instalado_em")],
        i.ntz("instalado_em").alias("instalado_em"),
        F.size("sensors").alias("n_sensors"),
    )


@query(
    "prj03",
    f"""SELECT n, '1.' || cast(k % 10 AS varchar) AS versao_firmware, k AS nivel_bateria,
        -k AS signal_strength FROM ({i.SQL_EVENTS}), (VALUES (1), (2)) v(delivery)""",
)
def prj03(spark, d):
    """Firmware, battery and signal out of the metadata struct."""
    return i.bronze_lines(spark, d).select(
        F.col("_kafka_offset").alias("n"),
        F.col("metadata.firmware_version").alias("versao_firmware"),
        F.col("metadata.battery_level").alias("nivel_bateria"),
        F.col("metadata.signal_strength").alias("signal_strength"),
    )


@query(
    "prj04",
    f"""SELECT id, sensor_id, valor, status_qualidade_id, is_anomalia, timestamp_leitura
        FROM ({i.SQL_READINGS})""",
)
def prj04(spark, d):
    """Text columns to numbers and flags; what does not parse becomes NULL."""
    return cast_columns(
        i.readings(spark, d).drop("_execution_date", "_processed_at"),
        {"valor": "double", "status_qualidade_id": "int", "is_anomalia": "boolean"},
    )


@query("prj05", "SELECT s_suppkey, cast(s_nationkey AS varchar) AS status FROM supplier")
def prj05(spark, d):
    s = i.table(spark, d, "supplier")
    return status_as_text(s.select("s_suppkey", F.col("s_nationkey").alias("status")))


@query("prj06", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def prj06(spark, d):
    return i.table(spark, d, "orders").drop("o_orderstatus", "o_orderdate", "o_orderpriority")


@query("prj07", "SELECT c_custkey AS sensor_id, * EXCLUDE (c_custkey) FROM customer")
def prj07(spark, d):
    return i.table(spark, d, "customer").withColumnRenamed("c_custkey", "sensor_id")


@query(
    "prj08",
    """SELECT *, cast(o_orderdate AS date) AS _execution_date, 'postgres' AS _data_source,
       TRUE AS stamped FROM orders""",
)
def prj08(spark, d):
    """Metadata columns: an existing run date stays, the stamp is always new."""
    o = i.table(spark, d, "orders").withColumn("_execution_date", F.to_date("o_orderdate"))
    stamped = add_metadata(o, run_date("2024-01-01"), "postgres")
    return stamped.withColumn("stamped", F.col("_processed_at").isNotNull()).drop("_processed_at")


@query("prj09", "SELECT *, DATE '2024-01-01' AS data, 'part' AS origem FROM part")
def prj09(spark, d):
    return i.table(spark, d, "part").withColumns(
        {"data": F.lit(run_date("2024-01-01")), "origem": F.lit("part")}
    )


@query(
    "prj12",
    f"""SELECT n, CASE WHEN k < 2 THEN 'UNKNOWN' ELSE factory_id END AS factory_id,
        CASE WHEN k < 2 THEN 'UNKNOWN' WHEN k = 9 THEN 'torque' ELSE measurement_type END
          AS measurement_type,
        CASE WHEN k < 2 THEN current_date ELSE dt END AS dt FROM ({i.SQL_MESSAGES})""",
)
def prj12(spark, d):
    """Partition key of each message."""
    return classify(i.messages(spark, d)).select(
        F.col("_kafka_offset").alias("n"), "factory_id", "measurement_type", "dt"
    )


# -- filters ----------------------------------------------------------------


@query("flt01", f"SELECT id, valor FROM ({i.SQL_READINGS}) WHERE valor IS NOT NULL")
def flt01(spark, d):
    typed = cast_columns(i.readings(spark, d), {"valor": "double"})
    return typed.filter(not_null("id", "valor")).select("id", "valor")


@query("flt02", "SELECT * FROM orders WHERE o_orderstatus IN ('O', 'F')")
def flt02(spark, d):
    return i.table(spark, d, "orders").filter(one_of("o_orderstatus", ("O", "F")))


@query("flt03", "SELECT * FROM part WHERE p_size < p_retailprice - 900")
def flt03(spark, d):
    p = i.table(spark, d, "part").withColumn("limite", F.col("p_retailprice") - 900)
    return p.filter(less_than("p_size", "limite")).drop("limite")


DAY = run_date("1998-09-01")


@query("flt04", f"SELECT * FROM lineitem WHERE l_shipdate = TIMESTAMP '{DAY}'")
def flt04(spark, d):
    return i.table(spark, d, "lineitem").filter(on_date("l_shipdate", DAY))


@query(
    "flt05",
    "SELECT * FROM lineitem WHERE cast(l_shipdate AS date)"
    " BETWEEN DATE '1998-01-01' AND DATE '1998-09-01'",
)
def flt05(spark, d):
    days = run_date("1998-01-01"), DAY
    return i.table(spark, d, "lineitem").filter(in_days("l_shipdate", *days))


@query(
    "flt06",
    f"""SELECT cast("timestamp" AS date) AS data, count(*) AS n FROM ({i.SQL_EVENTS})
        WHERE NOT (k BETWEEN 30 AND 39) GROUP BY 1
        UNION ALL SELECT cast("timestamp" AS date), count(*) FROM ({i.SQL_EVENTS}) GROUP BY 1""",
)
def flt06(spark, d):
    """No group for a NULL key: the filter goes below the aggregate."""
    lines = i.bronze_lines(spark, d)
    second = F.hour(F.col("_ingested_at").cast("timestamp")) != F.hour(
        F.col("timestamp").try_cast("timestamp") + F.expr("INTERVAL 1 HOUR")
    )
    days = lines.select(
        F.to_date(F.col("timestamp").try_cast("timestamp")).alias("data"),
        F.coalesce(second, F.lit(True)).alias("second"),
    )
    counts = days.groupBy("data", "second").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(not_null("data")).drop("second")


@query(
    "flt09",
    f"""SELECT n, coalesce(is_anomaly, FALSE) AND k >= 10 AS anomala FROM ({i.SQL_EVENTS})""",
)
def flt09(spark, d):
    """A NULL flag counts as not anomalous."""
    flagged = i.events(spark, d).withColumn(
        "is_anomaly", F.when(F.col("k") >= 10, F.col("is_anomaly"))
    )
    return flagged.select("n", is_true("is_anomaly").alias("anomala"))


@query(
    "flt10",
    f"""SELECT event_id, value FROM ({i.SQL_EVENTS})
        WHERE factory_id = 'FAB-1' AND cast("timestamp" AS date) = DATE '2024-01-15'""",
)
def flt10(spark, d):
    """A predicate given as SQL text."""
    e = i.events(spark, d).withColumn("dt", F.to_date("timestamp"))
    return e.filter("factory_id = 'FAB-1' AND dt = '2024-01-15'").select("event_id", "value")


# -- joins ------------------------------------------------------------------


@query(
    "join01",
    f"""SELECT e.id AS equipment_id, t.nome AS tipo_equipamento FROM ({i.SQL_EQUIPMENT}) e
        LEFT JOIN ({i.SQL_EQUIPMENT_TYPES}) t ON e.tipo_equipamento_id = t.id""",
)
def join01(spark, d):
    return _equipment_dimension(spark, d).select("equipment_id", "tipo_equipamento")


@query(
    "join02",
    f"""SELECT e.id AS equipment_id, m.periodicidade_manutencao FROM ({i.SQL_EQUIPMENT}) e
        LEFT JOIN ({SQL_SILVER_DOCUMENTS}) m ON e.id = m.equipamento_id""",
)
def join02(spark, d):
    return _equipment_dimension(spark, d).select("equipment_id", "periodicidade_manutencao")


def _equipment_dimension(spark, d):
    return equipment_dimension(
        EQUIPMENT.apply(i.equipment_bronze(spark, d)),
        NAMED.apply(i.equipment_types_bronze(spark, d)),
        DOCUMENTS.apply(flatten_equipment(i.documents(spark, d))),
    )


@query(
    "join03",
    f"""SELECT cast(strftime("timestamp", '%Y%m%d%H') AS bigint) AS date_key, sensor_id,
        measurement_type, t.id AS tipo_medicao_id, count(*) AS count_leituras
        FROM ({i.SQL_EVENTS}) LEFT JOIN (
          SELECT * FROM ({i.SQL_TYPES}) WHERE nome <> 'current'
          UNION ALL SELECT 6, 'humidity', 'percent', 0, 0, 0, 0) t
        ON measurement_type = t.nome GROUP BY 1, 2, 3, 4""",
)
def join03(spark, d):
    """Type ids by name: one type is unknown, one name has two ids."""
    known = i.types(spark).filter("nome <> 'current'")
    twice = known.filter("nome = 'humidity'").withColumn("id", F.lit(6))
    metrics = hourly_metrics(i.events(spark, d))
    return with_type_ids(metrics, known.unionByName(twice)).select(
        "date_key", "sensor_id", "measurement_type", "tipo_medicao_id", "count_leituras"
    )


# -- aggregates -------------------------------------------------------------

_HOUR_GROUP = """cast(strftime("timestamp", '%Y%m%d%H') AS bigint) AS date_key, sensor_id,
    equipment_id, factory_id, measurement_type"""


@query(
    "agg01",
    f"SELECT {_HOUR_GROUP}, count(*) AS count_leituras FROM ({i.SQL_EVENTS}) GROUP BY ALL",
)
def agg01(spark, d):
    return hourly_metrics(i.events(spark, d)).select(
        "date_key", "sensor_id", "equipment_id", "factory_id", "measurement_type",
        "count_leituras",
    )


@query(
    "agg02",
    f"""SELECT cast("timestamp" AS date) AS data, sensor_id, equipment_id, factory_id,
        measurement_type, count(*) AS total_leituras FROM ({i.SQL_EVENTS}) GROUP BY ALL""",
)
def agg02(spark, d):
    return daily_anomalies(i.events(spark, d)).select(
        "data", "sensor_id", "equipment_id", "factory_id", "measurement_type", "total_leituras"
    )


def _by_sensor(aggregate: str) -> str:
    return f"SELECT sensor_id, {aggregate} FROM ({i.SQL_EVENTS}) GROUP BY sensor_id"


def _sensors(spark, d):
    return i.events(spark, d).groupBy("sensor_id")


@query("agg03", _by_sensor("round(avg(value), 6) AS avg_valor"))
def agg03(spark, d):
    return _sensors(spark, d).agg(F.round(F.avg("value"), 6).alias("avg_valor"))


@query("agg04", _by_sensor("min(value) AS min_valor, max(value) AS max_valor"))
def agg04(spark, d):
    return _sensors(spark, d).agg(
        F.min("value").alias("min_valor"), F.max("value").alias("max_valor")
    )


@query("agg05", _by_sensor("round(stddev_samp(value), 6) AS stddev_valor"))
def agg05(spark, d):
    return _sensors(spark, d).agg(F.round(F.stddev("value"), 6).alias("stddev_valor"))


@query("agg06", _by_sensor("count(*) AS n"))
def agg06(spark, d):
    return _sensors(spark, d).agg(F.count(F.lit(1)).alias("n"))


@query("agg07", _by_sensor("count(*) FILTER (WHERE is_anomaly) AS anomalias"))
def agg07(spark, d):
    return _sensors(spark, d).agg(F.count_if(is_true("is_anomaly")).alias("anomalias"))


@query(
    "agg08",
    _by_sensor("cast(count(*) FILTER (WHERE quality = 'good') AS double) / count(*) AS boa"),
)
def agg08(spark, d):
    return _sensors(spark, d).agg(share(F.col("quality") == "good").alias("boa"))


@query(
    "agg09",
    f"""SELECT (SELECT count(*) FROM lineitem) AS lidas,
        (SELECT count(*) FROM lineitem WHERE l_discount <> 0) AS validas,
        (SELECT count(DISTINCT id) FROM ({i.SQL_READINGS}) WHERE valor IS NOT NULL) AS distintas""",
)
def agg09(spark, d):
    """Batch size, rows left by the filter, rows left by deduplication."""
    r = i.readings(spark, d)
    valid = F.col("valor").try_cast("double").isNotNull()
    # Pre-aggregated per id: the distinct count shuffles one row per id.
    per_id = r.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("v"))
    return per_id.agg(
        F.sum("n").alias("lidas"),
        F.sum("v").alias("validas"),
        F.count_if(F.col("v") > 0).alias("distintas"),
    )


@query(
    "ddp01",
    """SELECT * EXCLUDE (rn) FROM (
         SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
         FROM lineitem) WHERE rn = 1""",
)
def ddp01(spark, d):
    li = i.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )
    return keep_latest(
        li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    )


@query("ddp02", "SELECT DISTINCT o_custkey AS sensor_id FROM orders")
def ddp02(spark, d):
    o = i.table(spark, d, "orders").select(F.col("o_custkey").alias("sensor_id"))
    return o.dropDuplicates(["sensor_id"])


# -- scalar functions -------------------------------------------------------


@query(
    "fn01",
    f"""SELECT n, cast(strftime("timestamp", '%Y%m%d%H') AS bigint) AS date_key
        FROM ({i.SQL_EVENTS})""",
)
def fn01(spark, d):
    return i.events(spark, d).select("n", hour_key_of(F.col("timestamp")).alias("date_key"))


@query(
    "fn02",
    """SELECT o_orderkey, cast(year(o_orderdate) AS bigint) * 1000000 + month(o_orderdate) * 10000
       + day(o_orderdate) * 100 + o_custkey % 24 AS date_key FROM orders""",
)
def fn02(spark, d):
    key = hour_key(F.col("o_orderdate"), F.col("o_custkey") % 24)
    return i.table(spark, d, "orders").select("o_orderkey", key.alias("date_key"))


@query("fn03", "SELECT o_orderkey, cast(o_orderdate AS date) AS data FROM orders")
def fn03(spark, d):
    return i.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("data"))


def _order_calendar(*names: str):
    """Calendar attributes of every order date."""

    def build(spark, d):
        o = i.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dia"))
        columns = calendar_columns(F.col("dia"), F.lit(0))
        return o.select("o_orderkey", *columns).select("o_orderkey", *names)

    return build


query(
    "fn04",
    """SELECT o_orderkey, cast(year(o_orderdate) AS integer) AS ano,
       cast(month(o_orderdate) AS integer) AS mes FROM orders""",
)(_order_calendar("ano", "mes"))
query(
    "fn05",
    "SELECT o_orderkey, cast(dayofweek(o_orderdate) + 1 AS integer) AS dia_semana FROM orders",
)(_order_calendar("dia_semana"))
query(
    "fn06",
    "SELECT o_orderkey, cast(weekofyear(o_orderdate) AS integer) AS semana_ano FROM orders",
)(_order_calendar("semana_ano"))
query(
    "fn07",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) <= 3 THEN 1 WHEN month(o_orderdate) <= 6
       THEN 2 WHEN month(o_orderdate) <= 9 THEN 3 ELSE 4 END AS trimestre FROM orders""",
)(_order_calendar("trimestre"))


@query(
    "fn08",
    """SELECT o_orderkey, CASE month(o_orderdate) WHEN 1 THEN 'Janeiro' WHEN 2 THEN 'Fevereiro'
       WHEN 3 THEN 'Março' WHEN 4 THEN 'Abril' WHEN 5 THEN 'Maio' WHEN 6 THEN 'Junho'
       WHEN 7 THEN 'Julho' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Setembro' WHEN 10 THEN 'Outubro'
       WHEN 11 THEN 'Novembro' ELSE 'Dezembro' END AS nome_mes FROM orders""",
)
def fn08(spark, d):
    return i.table(spark, d, "orders").select(
        "o_orderkey", month_name(F.col("o_orderdate")).alias("nome_mes")
    )


@query(
    "fn09",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1.0::double ELSE 0.0::double END AS aberto"
    " FROM orders",
)
def fn09(spark, d):
    opened = F.when(F.col("o_orderstatus") == "O", F.lit(1.0)).otherwise(F.lit(0.0))
    return i.table(spark, d, "orders").select("o_orderkey", opened.alias("aberto"))


@query("fn10", "SELECT o_orderkey, TRUE AS agora FROM orders")
def fn10(spark, d):
    """One instant for the whole query, in the present."""
    now = F.current_timestamp()
    return i.table(spark, d, "orders").select(
        "o_orderkey", (now > F.lit("2020-01-01").cast("timestamp")).alias("agora")
    )


@query("fn11", f"SELECT n, k <> 0 AS parsed FROM ({i.SQL_EVENTS})")
def fn11(spark, d):
    """JSON text to an object; broken text is NULL, not an error."""
    text = F.col("value").cast("string")
    return i.messages(spark, d).select(
        F.col("offset").alias("n"), F.try_parse_json(text).isNotNull().alias("parsed")
    )


@query(
    "fn12",
    """SELECT p_partkey, '{"id":' || cast(p_partkey AS varchar) || ',"nome":"Peça ' || p_name
       || '"}' AS linha FROM part""",
)
def fn12(spark, d):
    p = i.table(spark, d, "part")
    fields = F.struct(
        F.col("p_partkey").alias("id"), F.concat(F.lit("Peça "), F.col("p_name")).alias("nome")
    )
    return p.select("p_partkey", F.to_json(fields).alias("linha"))


@query("fn13", f"SELECT n, equipment_id AS chave FROM ({i.SQL_EVENTS})")
def fn13(spark, d):
    return i.messages(spark, d).select(
        F.col("offset").alias("n"), F.col("key").cast("string").alias("chave")
    )


@query(
    "fn14",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN current_date
       ELSE cast(o_orderdate AS date) END AS dt FROM orders""",
)
def fn14(spark, d):
    """Day of an ISO timestamp in its own offset; today if it does not parse."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(F.col("o_orderstatus") == "P", "31/12")
        .when(F.col("o_orderstatus") == "O", F.concat(day, F.lit("T23:30:00-03:00")))
        .otherwise(F.concat(day, F.lit("T00:30:00Z")))
    )
    return i.table(spark, d, "orders").select("o_orderkey", event_day(text).alias("dt"))


@query(
    "fn15",
    f"SELECT n, CASE WHEN k IN (0, 1, 2) THEN 'UNKNOWN' ELSE sensor_id END AS sensor_id"
    f" FROM ({i.SQL_EVENTS})",
)
def fn15(spark, d):
    """A default for a key that is not there."""
    body = F.try_parse_json(F.col("value").cast("string"))
    found = F.try_variant_get(body, "$.sensor_id", "string")
    return i.messages(spark, d).select(
        F.col("offset").alias("n"), F.coalesce(found, F.lit("UNKNOWN")).alias("sensor_id")
    )


@query(
    "fn16",
    f"""SELECT n, CASE k WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 4 THEN 'STRING'
        WHEN 5 THEN 'BOOLEAN' ELSE 'DECIMAL' END AS tipo FROM ({i.SQL_EVENTS})""",
)
def fn16(spark, d):
    """JSON type of the value field."""
    body = F.try_parse_json(F.col("value").cast("string"))
    kind = F.schema_of_variant(F.try_variant_get(body, "$.value", "variant"))
    # A whole number of cents prints without a fraction only as BIGINT.
    bare = F.regexp_replace(F.regexp_extract(kind, "^([A-Z]+)", 1), "BIGINT", "DECIMAL")
    return i.messages(spark, d).select(F.col("offset").alias("n"), bare.alias("tipo"))


_WINDOW_SQL = """
SELECT DISTINCT cast(o_orderdate AS date) AS data,
  cast(CASE WHEN day(o_orderdate) <= 10
    THEN date_trunc('month', o_orderdate) - INTERVAL 1 MONTH
    ELSE date_trunc('month', o_orderdate) END AS date) AS inicio
FROM orders"""


@query("fn17", _WINDOW_SQL)
def fn17(spark, d):
    return _windows(spark, d)


@query("job01", _WINDOW_SQL)
def job01(spark, d):
    """The extract window of every day that has orders."""
    return _windows(spark, d)


def _windows(spark, d):
    days = i.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("data")).distinct()
    return days.withColumn("inicio", extract_window_start(F.col("data")))


@query(
    "job02",
    "SELECT o_orderkey, cast(o_orderdate AS date) AS data FROM orders",
)
def job02(spark, d):
    """Run dates given as text, back to dates."""
    o = i.table(spark, d, "orders")
    given = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("texto")).distinct()
    # As many rows as there are run dates.
    days = [(row["texto"], run_date(row["texto"])) for row in given.collect()]
    known = spark.createDataFrame(days, "texto string, data date")
    dated = o.withColumn("texto", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return dated.join(known, "texto").select("o_orderkey", "data")


# -- data quality -----------------------------------------------------------

W = dq.Level.WARNING
CHECK_DAY = run_date("2024-01-01")


def _check_sql(table: str, checks: list[tuple[str, str, str]]) -> str:
    """The result table of a suite: (label, level, violation count) per rule."""

    def share(label: str) -> str:
        """What a failed rule reports: rows that keep it; of values, those that occur once."""
        if not label.startswith("isUnique("):
            return "NULL::double"
        c = label[len("isUnique(") : -1]
        return f"""(SELECT count(*) FILTER (n = 1) FROM (SELECT count(*) AS n FROM {table}
            WHERE {c} IS NOT NULL GROUP BY {c}))::double / count({c})"""

    rows = " UNION ALL ".join(
        f"""SELECT '{label}' AS "constraint", '{level}' AS check_level,
            cast({count} AS bigint) AS violations, count(*) AS "rows",
            {share(label)} AS share FROM {table}"""
        for label, level, count in checks
    )
    return f"""
SELECT "constraint", check_level,
  CASE WHEN violations = 0 THEN 'Success' ELSE 'Failure' END AS constraint_status,
  CASE WHEN violations = 0 THEN '' ELSE 'Value: ' ||
    cast(cast(coalesce(share, 1.0::double - violations::double / "rows") AS decimal(7,6))
      AS varchar) ||
    ' does not meet the constraint requirement!' END AS constraint_message,
  violations, "rows", DATE '{CHECK_DAY}' AS _execution_date
FROM ({rows})"""


def _checked(df, *rules):
    return dq.evaluate(df, rules, CHECK_DAY).drop("_processed_at")


@query(
    "dq01",
    _check_sql(
        f"({i.SQL_READINGS})",
        [
            ("isComplete(id)", "Error", "count(*) FILTER (id IS NULL)"),
            ("isComplete(valor)", "Error", "count(*) FILTER (valor IS NULL)"),
        ],
    ),
)
def dq01(spark, d):
    df = cast_columns(i.readings(spark, d), {"valor": "double"})
    return _checked(df, *dq.complete("id", "valor"))


@query(
    "dq02",
    _check_sql(
        "orders",
        [
            ("isUnique(o_orderkey)", "Error", "count(o_orderkey) - count(DISTINCT o_orderkey)"),
            ("isUnique(o_custkey)", "Warning", "count(o_custkey) - count(DISTINCT o_custkey)"),
        ],
    ),
)
def dq02(spark, d):
    return _checked(
        i.table(spark, d, "orders"), dq.unique("o_orderkey"), dq.unique("o_custkey", W)
    )


@query(
    "dq03",
    _check_sql(
        "orders",
        [
            ("isContainedIn(o_orderstatus,[O,F,P])", "Error",
             "count(*) FILTER (o_orderstatus NOT IN ('O','F','P'))"),
            ("isContainedIn(o_orderstatus,[O,F])", "Warning",
             "count(*) FILTER (o_orderstatus NOT IN ('O','F'))"),
        ],
    ),
)
def dq03(spark, d):
    return _checked(
        i.table(spark, d, "orders"),
        dq.contained_in("o_orderstatus", ("O", "F", "P")),
        dq.contained_in("o_orderstatus", ("O", "F"), W),
    )


@query(
    "dq04",
    _check_sql(
        "customer",
        [
            ("isNonNegative(c_custkey)", "Error", "count(*) FILTER (c_custkey < 0)"),
            ("isNonNegative(c_acctbal)", "Warning", "count(*) FILTER (c_acctbal < 0)"),
        ],
    ),
)
def dq04(spark, d):
    return _checked(
        i.table(spark, d, "customer"), dq.non_negative("c_custkey"), dq.non_negative("c_acctbal", W)
    )


_EVENT_CHECKS = [
    ("isComplete(event_id)", "Error", "count(*) FILTER (event_id IS NULL)"),
    ("isContainedIn(quality,[good,warning,bad])", "Error",
     "count(*) FILTER (quality NOT IN ('good','warning','bad'))"),
    ("isContainedIn(measurement_type,[temperature,humidity,pressure,vibration,current])", "Error",
     "count(*) FILTER (measurement_type NOT IN ('temperature','humidity','pressure','vibration','current'))"),
    ("isUnique(event_id)", "Error", "count(event_id) - count(DISTINCT event_id)"),
    ("isNonNegative(value)", "Warning", "count(*) FILTER (value < 0)"),
    ("isComplete(is_anomaly)", "Warning", "count(*) FILTER (is_anomaly IS NULL)"),
]


def _event_suite():
    return (
        *dq.complete("event_id"),
        dq.contained_in("quality", QUALITIES),
        dq.contained_in("measurement_type", MEASUREMENT_TYPES),
        dq.unique("event_id"),
        dq.non_negative("value", W),
        *dq.complete("is_anomaly", level=W),
    )


@query("dq06", _check_sql(f"({i.SQL_EVENTS})", _EVENT_CHECKS))
def dq06(spark, d):
    """A whole suite as one aggregate, one result row per rule."""
    return _checked(i.events(spark, d), *_event_suite())


_FAILING = _check_sql(
    "customer",
    [
        ("isUnique(c_nationkey)", "Error", "count(c_nationkey) - count(DISTINCT c_nationkey)"),
        ("isNonNegative(c_acctbal)", "Warning", "count(*) FILTER (c_acctbal < 0)"),
        ("isComplete(c_name)", "Error", "count(*) FILTER (c_name IS NULL)"),
    ],
)


def _failing(spark, d):
    return _checked(
        i.table(spark, d, "customer"),
        dq.unique("c_nationkey"),
        dq.non_negative("c_acctbal", W),
        *dq.complete("c_name"),
    )


@query(
    "dq05",
    f"""SELECT check_level, count(*) AS reprovadas, bool_or(check_level = 'Error') AS aborta
        FROM ({_FAILING}) WHERE constraint_status <> 'Success' GROUP BY check_level""",
)
def dq05(spark, d):
    """Failures per level: Error stops the load, Warning does not."""
    return (
        dq.failures(_failing(spark, d))
        .groupBy("check_level")
        .agg(
            F.count(F.lit(1)).alias("reprovadas"),
            F.bool_or(F.col("check_level") == dq.Level.ERROR.value).alias("aborta"),
        )
    )


@query("flt07", f"SELECT * FROM ({_FAILING}) WHERE constraint_status <> 'Success' AND check_level = 'Error'")
def flt07(spark, d):
    return dq.failures(_failing(spark, d), dq.Level.ERROR)


@query(
    "agg10",
    f"""SELECT count(*) AS reprovadas, count(*) FILTER (check_level = 'Error') AS erros
        FROM ({_FAILING}) WHERE constraint_status <> 'Success'""",
)
def agg10(spark, d):
    return dq.failures(_failing(spark, d)).agg(
        F.count(F.lit(1)).alias("reprovadas"),
        F.count_if(F.col("check_level") == dq.Level.ERROR.value).alias("erros"),
    )


@query(
    "set01",
    f"""SELECT * FROM ({_check_sql("customer", [
            ("isComplete(c_name)", "Error", "count(*) FILTER (c_name IS NULL)")])})
        UNION ALL SELECT * FROM ({_check_sql("orders", [
            ("isUnique(o_custkey)", "Warning", "count(o_custkey) - count(DISTINCT o_custkey)")])})""",
)
def set01(spark, d):
    """Results of two suites as one table."""
    first = _checked(i.table(spark, d, "customer"), *dq.complete("c_name"))
    second = _checked(i.table(spark, d, "orders"), dq.unique("o_custkey", W))
    return first.unionByName(second)


@query(
    "set02",
    f"""SELECT n, CASE WHEN k = 2 THEN 'sensor_id' WHEN k = 3 THEN 'unit' ELSE '' END AS ausentes
        FROM ({i.SQL_EVENTS}) WHERE k > 1""",
)
def set02(spark, d):
    """Required keys less the keys of each message (messages that are objects)."""
    keys = F.json_object_keys(F.col("value").cast("string"))
    required = F.array(*[F.lit(f) for f in REQUIRED_FIELDS])
    return (
        i.messages(spark, d)
        .select(F.col("offset").alias("n"), keys.alias("keys"))
        .filter(F.col("keys").isNotNull())
        .select("n", F.array_join(F.array_sort(F.array_except(required, "keys")), ",").alias("ausentes"))
    )


@query(
    "dq08",
    _check_sql(
        f"({i.SQL_READINGS})",
        [
            ("hasDataType(valor,double)", "Error", "count(*) FILTER (valor IS NULL)"),
            ("hasDataType(status_qualidade_id,int)", "Error", "0"),
        ],
    ),
)
def dq08(spark, d):
    return _checked(
        i.readings(spark, d),
        dq.has_type("valor", "double"),
        dq.has_type("status_qualidade_id", "int"),
    )

"""Alerts, star-schema reports and whole runs as queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog import inputs as i
from millrace.catalog.layers import (
    SQL_DAILY,
    SQL_SILVER_READINGS,
    hourly_fact,
)
from millrace.catalog.registry import query
from millrace.catalog.streams import _VALID
from millrace.functions.calendar import run_date
from millrace.operators.aggregates import daily_anomalies
from millrace.operators.columns import pick
from millrace.operators.quality import QualityError, complete, evaluate, non_negative, unique
from millrace.plans import reports, silver
from millrace.plans.gold import FACTORY_COLUMNS
from millrace.plans.graph import run_graph
from millrace.plans.lake import Lake
from millrace.plans.runner import ALL_TABLES, LATE_TABLES, find_table, run
from millrace.plans.spec import TableSpec
from millrace.session import scratch_path
from millrace.sources.check_state import CheckState
from millrace.sources.documents import flatten_equipment
from millrace.sources.plain import overwrite_partitions
from millrace.sources.relational import FrameRelations
from millrace.sources.tables import SnapshotTable
from millrace.streaming.alerts import Limits, alert_history, start_range_alerts
from millrace.streaming.ingest import batch_writer, classify

RUN = run_date("2024-01-15")

_ALERT = """event_id, e.sensor_id, equipment_id, factory_id, measurement_type, value,
    "timestamp", limite_min, limite_max"""
_SENSOR_ALERTS = f"""
SELECT {_ALERT} FROM ({i.SQL_EVENTS}) e
JOIN (SELECT 'SENS-' || cast(s_suppkey AS varchar) AS sensor_id, 1.0::double AS limite_min,
             60.0::double AS limite_max FROM supplier
      UNION ALL SELECT 'SENS-' || cast(s_suppkey + 1000000 AS varchar), 0.0, s_acctbal FROM supplier) r
  ON e.sensor_id = r.sensor_id
WHERE value NOT BETWEEN limite_min AND limite_max"""


@query("rmp02", _SENSOR_ALERTS)
def rmp02(spark, d):
    """Events outside their sensor's own range."""
    alerts = reports.out_of_sensor_range(
        i.events(spark, d), flatten_equipment(i.documents(spark, d))
    )
    return alerts.withColumn("timestamp", i.ntz("timestamp"))


_TYPE_ALERTS = f"""
SELECT {_ALERT} FROM ({i.SQL_EVENTS}) e
JOIN (SELECT nome, faixa_normal_min::double AS limite_min, faixa_normal_max::double AS limite_max
      FROM ({i.SQL_TYPES})) t ON e.measurement_type = t.nome
WHERE value NOT BETWEEN limite_min AND limite_max"""


@query("rmp03", _TYPE_ALERTS)
def rmp03(spark, d):
    """Events outside the normal range of their type."""
    alerts = reports.out_of_normal_range(i.events(spark, d), i.types(spark))
    return alerts.withColumn("timestamp", i.ntz("timestamp"))


@query(
    "rmp04",
    f"""SELECT event_id, value, day AS _execution_date FROM ({_TYPE_ALERTS}),
        (VALUES (DATE '2024-01-15'), (DATE '2024-01-16')) v(day)""",
)
def rmp04(spark, d):
    """Alerts of two runs in the stored history, the second run twice."""
    path = scratch_path(spark, "alerts")
    alerts = reports.out_of_normal_range(i.events(spark, d), i.types(spark))
    for day in ("2024-01-15", "2024-01-16", "2024-01-16"):
        history = reports.alert_history(alerts, run_date(day))
        overwrite_partitions(history, path, ["_execution_date"])
    return spark.read.parquet(path).select("event_id", "value", "_execution_date")


def _alerts_of_stream(spark, d, limits, batches: int = 2) -> DataFrame:
    """Every event in one of two batches, a part of the first again in the second.

    ``limits`` gives those of a batch by its number.
    """
    path = scratch_path(spark, "range-alerts")
    source, asked = f"{path}-events", []
    events = i.events(spark, d).select(*reports.ALERT_COLUMNS, "n")

    def next_limits() -> Limits:
        asked.append(len(asked))
        return limits(asked[-1])

    # A batch has all files that came since the one before, written by as many tasks as read.
    for part in range(batches):
        again = F.col("n") % (5 * batches) == 0 if part else F.lit(False)
        late = events.filter((F.col("n") % batches == part) | again)
        late.drop("n").write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.drop("n").schema).parquet(source)
        start_range_alerts(stream, path, f"{path}-checkpoint", next_limits, available_now=True).awaitTermination()
    return alert_history(spark, path).withColumn("timestamp", i.ntz("timestamp"))


_STREAM_COLUMNS = (*reports.ALERT_COLUMNS, "limite_min", "limite_max")


@query("rmp02_stream", _SENSOR_ALERTS)
def rmp02_stream(spark, d):
    """The sensor alerts of a stream."""
    documents = flatten_equipment(i.documents(spark, d))
    found = _alerts_of_stream(spark, d, lambda _: Limits(documents, i.types(spark)))
    return found.filter("regra = 'sensor'").select(*_STREAM_COLUMNS)


@query("rmp03_stream", _TYPE_ALERTS)
def rmp03_stream(spark, d):
    """The type alerts of a stream."""
    found = _alerts_of_stream(spark, d, lambda _: Limits(types=i.types(spark)))
    return found.select(*_STREAM_COLUMNS)


@query(
    "rmp04_stream",
    f"""SELECT event_id, limite_max FROM ({_TYPE_ALERTS}) WHERE cast(event_id AS bigint) % 2 = 0
        UNION ALL SELECT event_id, faixa_normal_max - 10 FROM ({i.SQL_EVENTS}) e
        JOIN ({i.SQL_TYPES}) t ON e.measurement_type = t.nome
        WHERE (n % 2 = 1 OR n % 10 = 0 AND value BETWEEN faixa_normal_min AND faixa_normal_max)
            AND value NOT BETWEEN faixa_normal_min AND faixa_normal_max - 10""",
)
def rmp04_stream(spark, d):
    """Limits that are lowered between two batches: stored alerts stay, later events meet the new ones."""

    def limits(batch: int) -> Limits:
        lowered = F.col("faixa_normal_max") - 10 * batch
        return Limits(types=i.types(spark).withColumn("faixa_normal_max", lowered))

    return _alerts_of_stream(spark, d, limits).select("event_id", "limite_max")


@query(
    "rmp05",
    """SELECT 'SENS-' || cast(l_partkey AS varchar) AS sensor_id, count(*) AS leituras
       FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = l_partkey)
       GROUP BY 1""",
)
def rmp05(spark, d):
    """Readings of unknown sensors, counted per sensor."""
    r = i.readings(spark, d).groupBy("sensor_id").agg(F.count(F.lit(1)).alias("leituras"))
    return reports.orphans(r, i.sensors(spark, d), "sensor_id", "id")


@query(
    "rmp06",
    f"""SELECT "constraint", violations, "rows", DATE '{RUN}' AS _execution_date FROM (
          SELECT 'isComplete(valor)' AS "constraint",
                 count(*) FILTER (valor IS NULL) AS violations, count(*) AS "rows"
          FROM ({i.SQL_READINGS})
          UNION ALL SELECT 'isNonNegative(valor)', 0, count(*) FROM ({i.SQL_READINGS}))""",
)
def rmp06(spark, d):
    """A check report, stored and read back."""
    path = scratch_path(spark, "checks")
    typed = i.readings(spark, d).withColumn("valor", F.col("valor").try_cast("double"))
    results = evaluate(typed, (*complete("valor"), non_negative("valor")), RUN)
    overwrite_partitions(results.withColumn("tabela", F.lit("leituras")), path, ["tabela"])
    return spark.read.parquet(path).select("constraint", "violations", "rows", "_execution_date")


@query(
    "rmp07",
    f"""SELECT f.factory_id, f.measurement_type, cast(f.leituras AS bigint) AS leituras,
          cast(f.anomalias AS bigint) AS anomalias, cast(nivel AS bigint) AS nivel,
          f.anomalias::double / f.leituras AS taxa_anomalia, n.nome AS fabrica
        FROM (SELECT factory_id, measurement_type, sum(total_leituras) AS leituras,
                sum(total_anomalias) AS anomalias, grouping(factory_id, measurement_type) AS nivel
              FROM ({SQL_DAILY}) GROUP BY ROLLUP (factory_id, measurement_type)) f
        LEFT JOIN (SELECT 'FAB-' || cast(n_nationkey AS varchar) AS id, n_name AS nome FROM nation) n
          ON f.factory_id = n.id""",
)
def rmp07(spark, d):
    """Readings and anomaly rate by factory and type, with subtotals."""
    daily = daily_anomalies(i.events(spark, d))
    return reports.factory_metrics(daily, pick(i.factories(spark, d), FACTORY_COLUMNS))


@query(
    "rmp07_trend",
    f"""SELECT factory_id, measurement_type, data, n AS leituras,
          round(soma, 2) / n AS media_dia, cast(sum(n) OVER w AS bigint) AS leituras_movel,
          round(sum(soma) OVER w, 2) / (sum(n) OVER w) AS media_movel
        FROM (SELECT factory_id, measurement_type, cast("timestamp" AS date) AS data,
                count(*) AS n, sum(value) AS soma FROM ({i.SQL_EVENTS}) GROUP BY ALL)
        WINDOW w AS (PARTITION BY factory_id, measurement_type ORDER BY data
                     RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
)
def rmp07_trend(spark, d):
    """Daily means with a moving mean of seven days.

    Sums of values in cents are rounded to cents, so that both engines divide
    the same number.
    """
    trend = reports.daily_trend(hourly_fact(spark, d))

    def in_cents(mean: str, n: str):
        return F.round(F.col(mean) * F.col(n), 2) / F.col(n)

    return trend.withColumns(
        {
            "media_dia": in_cents("media_dia", "leituras"),
            "media_movel": in_cents("media_movel", "leituras_movel"),
        }
    )


@query(
    "rmp07_worst",
    f"""SELECT sensor_id, count(*) AS leituras, count(*) FILTER (is_anomaly) AS anomalias
        FROM ({i.SQL_EVENTS}) GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
)
def rmp07_worst(spark, d):
    """The ten sensors with most anomalies."""
    return reports.worst_sensors(daily_anomalies(i.events(spark, d)), 10)


@query(
    "rmp08",
    f"""SELECT cast(timestamp_leitura AS date) AS data, r.sensor_id, s.equipamento_id AS equipment_id,
          e.fabrica_id AS factory_id, t.nome AS measurement_type, count(*) AS total_leituras,
          count(*) FILTER (is_anomalia) AS total_anomalias,
          count(*) FILTER (is_anomalia)::double / count(*) AS taxa_anomalia,
          max(valor) AS max_valor_dia, min(valor) AS min_valor_dia
        FROM ({SQL_SILVER_READINGS}) r
        LEFT JOIN ({i.SQL_SENSORS}) s ON r.sensor_id = s.id
        LEFT JOIN (SELECT 'EQ-' || cast(s_suppkey AS varchar) AS id,
                          'FAB-' || cast(s_nationkey AS varchar) AS fabrica_id FROM supplier) e
          ON s.equipamento_id = e.id
        LEFT JOIN ({i.SQL_TYPES}) t ON s.tipo_medicao_id = t.id
        GROUP BY ALL""",
)
def rmp08(spark, d):
    """The daily fact over relational readings instead of events."""
    statuses = spark.createDataFrame(
        [(1, "good"), (2, "warning"), (3, "bad")], "id int, nome string"
    )
    known = i.equipment(spark, d)
    events = reports.readings_as_events(
        silver.READINGS.apply(i.readings(spark, d)),
        statuses,
        silver.SENSORS.apply(i.sensors_bronze(spark, d)),
        known,
        i.types(spark),
    )
    return daily_anomalies(events)


# -- whole runs -------------------------------------------------------------


def _lake(spark, d) -> Lake:
    relations = FrameRelations(lambda name: i.equipment(spark, d))
    return Lake(spark, scratch_path(spark, "lake"), "hmg", relations)


_STORED_CHECKS = [
    ("isComplete(id)", "Error", "0"),
    ("isComplete(nome)", "Error", "0"),
    ("isComplete(tipo_equipamento_id)", "Error", "0"),
    ("isComplete(fabrica_id)", "Error", "0"),
    ("isComplete(status)", "Error", "0"),
    ("isContainedIn(status,[ativo,inativo,manutencao])", "Error", "count(*) FILTER (s_acctbal < 0)"),
    ("isComplete(data_instalacao)", "Warning", "0"),
]
_JOB05_SQL = " UNION ALL ".join(
    f"""SELECT '{label}' AS "constraint", '{level}' AS check_level,
        CASE WHEN {n} = 0 THEN 'Success' ELSE 'Failure' END AS constraint_status,
        cast({n} AS bigint) AS violations, count(*) AS "rows" FROM supplier"""
    for label, level, n in _STORED_CHECKS
)

@query("job05", _JOB05_SQL)
def job05(spark, d):
    """One table's life cycle: a bronze load that breaks an Error rule.

    Equipment in an undeclared state stops the load of its table; the stored
    report says which rule broke and how often.
    """
    lake = _lake(spark, d)
    try:
        run(lake, find_table("bronze/postgres/equipamentos"), RUN)
    except QualityError:
        pass
    stored = spark.read.parquet(lake.quality_path)
    return stored.select("constraint", "check_level", "constraint_status", "violations", "rows")


_DAY_FACT = f"""
SELECT cast(momento AS date) AS data, sensor_id, equipment_id, factory_id, measurement_type,
       count(*) AS total_leituras, count(*) FILTER (is_anomaly) AS total_anomalias,
       count(*) FILTER (is_anomaly)::double / count(*) AS taxa_anomalia,
       max(value) AS max_valor_dia, min(value) AS min_valor_dia
FROM (SELECT *, "timestamp" + CASE k WHEN 14 THEN INTERVAL 3 HOUR ELSE INTERVAL 0 HOUR END AS momento
      FROM ({_VALID}) WHERE k <> 12 AND dt = DATE '{RUN}')
GROUP BY ALL"""


def _day_run(spark, d, times: int):
    """Ingest all messages, then load the event tables of one run date."""
    lake = _lake(spark, d)
    batch_writer(lake.events_path)(classify(i.messages(spark, d)), 0)
    for _ in range(times):
        for path in ("silver/kafka/sensor_events", "gold/fct/fct_anomalias_dia"):
            run(lake, find_table(path), RUN)
    fact = lake.read("gold/fct/fct_anomalias_dia")
    return fact.drop("_execution_date", "_processed_at", "_data_source")


def _plant(spark, d) -> Lake:
    """A lake over all sources, without the rows whose state no table accepts."""

    def source(name: str) -> DataFrame:
        shifted = F.date_add(F.lit(RUN), -F.col("l_linenumber")).cast("timestamp")
        lines = i.table(spark, d, "lineitem").withColumn("l_shipdate", shifted)
        stamps = ("_execution_date", "_processed_at")
        tables = {
            "fabricas": lambda: i.factories(spark, d),
            "equipamentos": lambda: i.equipment(spark, d).filter("status <> 'quebrado'"),
            "sensores": lambda: i.sensors(spark, d).filter("status <> 'quebrado'"),
            "tipos_equipamento": lambda: i.equipment_types(spark, d),
            "tipos_medicao": lambda: i.types(spark),
            "status_qualidade": lambda: i.statuses(spark, d),
            "leituras": lambda: i.readings_of(lines).filter("valor <> 'err'").drop(*stamps)
            .withColumn("valor", F.col("valor").cast("decimal(12,2)")),
            "metadados_leitura": lambda: i.reading_metadata_of(lines).drop(*stamps),
        }
        return tables[name]()

    def documents() -> DataFrame:
        return i.documents(spark, d).filter("status <> 'broken'")

    root = scratch_path(spark, "plant")
    lake = Lake(spark, root, "hmg", FrameRelations(source), documents)
    batch_writer(lake.events_path)(classify(i.messages(spark, d)), 0)
    return lake


def _whole_run(spark, d) -> Lake:
    lake = _plant(spark, d)
    outcomes = run_graph(lake, RUN)
    if not all(outcome.status == "loaded" for outcome in outcomes.values()):
        raise RuntimeError(f"not loaded: {[o for o in outcomes.values() if o.status != 'loaded']}")
    return lake


@query("job06", _DAY_FACT)
def job06(spark, d):
    """All tables of all layers, each once those it reads are loaded: the daily fact."""
    fact = _whole_run(spark, d).read("gold/fct/fct_anomalias_dia")
    return fact.drop("_execution_date", "_processed_at", "_data_source")


_DAY_EVENTS = f"""SELECT *, "timestamp" + CASE k WHEN 14 THEN INTERVAL 3 HOUR ELSE INTERVAL 0 HOUR END AS momento
    FROM ({_VALID}) WHERE k <> 12 AND dt = DATE '{RUN}'"""
_HOUR_GROUPS = f"""SELECT 1 FROM ({_DAY_EVENTS})
    GROUP BY time_bucket(INTERVAL 1 HOUR, momento), sensor_id, equipment_id, factory_id, measurement_type"""
_TABLE_COUNTS = {
    "postgres/fabricas": ("SELECT 1 FROM nation",) * 2,
    "postgres/equipamentos": ("SELECT 1 FROM supplier WHERE s_acctbal >= 0",) * 2,
    "postgres/sensores": ("SELECT 1 FROM customer WHERE c_acctbal >= 0",) * 2,
    "postgres/tipos_equipamento": ("SELECT DISTINCT p_type FROM part",) * 2,
    "postgres/tipos_medicao": (i.SQL_TYPES,) * 2,
    "postgres/status_qualidade": ("SELECT DISTINCT o_orderpriority FROM orders",) * 2,
    "postgres/leituras": (
        "SELECT 1 FROM lineitem WHERE l_discount <> 0",
        "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_discount <> 0",
    ),
    "postgres/metadados_leitura": (
        """SELECT 1 FROM lineitem WHERE (l_orderkey, l_linenumber) IN
           (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_discount <> 0)""",
        "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_discount <> 0",
    ),
    "mongo/equipamentos": ("SELECT 1 FROM supplier WHERE s_acctbal >= 0",) * 2,
}
_GOLD_COUNTS = {
    "gold/dim/dim_tempo": "SELECT 1 FROM range(24)",
    "gold/dim/dim_fabrica": "SELECT 1 FROM nation",
    "gold/dim/dim_equipamento": "SELECT 1 FROM supplier WHERE s_acctbal >= 0",
    "gold/dim/dim_sensor": "SELECT 1 FROM customer WHERE c_acctbal >= 0",
    "gold/dim/dim_tipo_medicao": i.SQL_TYPES,
    "gold/fct/fct_leituras_hora": _HOUR_GROUPS,
    "gold/fct/fct_anomalias_dia": _DAY_FACT,
    "silver/kafka/sensor_events": _DAY_EVENTS,
}
_JOB06_TABLES = " UNION ALL ".join(
    f"SELECT '{path}' AS tabela, count(*) AS linhas FROM ({sql})"
    for path, sql in [
        *((f"bronze/{t}", sql[0]) for t, sql in _TABLE_COUNTS.items()),
        *((f"silver/{t}", sql[1]) for t, sql in _TABLE_COUNTS.items()),
        *_GOLD_COUNTS.items(),
    ]
)


@query("job06_tables", _JOB06_TABLES)
def job06_tables(spark, d):
    """The rows of every table after one run of all."""
    lake = _whole_run(spark, d)
    counts = [
        lake.read(spec.path).agg(F.lit(spec.path).alias("tabela"), F.count(F.lit(1)).alias("linhas"))
        for spec in ALL_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query("job07", _DAY_FACT)
def job07(spark, d):
    """A run date loaded twice gives the same table."""
    return _day_run(spark, d, 2)


# -- checks of whole tables -------------------------------------------------


@query(
    "dq06_state",
    """SELECT 'isComplete(id)' AS "constraint", 0::bigint AS violations, count(*) AS "rows" FROM lineitem
       UNION ALL SELECT 'isNonNegative(valor)', count(*) FILTER (l_quantity < 5), count(*) FROM lineitem
       UNION ALL SELECT 'isUnique(id)', count(*) - count(DISTINCT (l_orderkey, l_linenumber)), count(*) FROM lineitem""",
)
def dq06_state(spark, d):
    """A report on all partitions from states; the second load's are the only ones read then."""
    lines = i.table(spark, d, "lineitem")
    rows = lines.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        (F.col("l_quantity") - 5).alias("valor"),
        (F.col("l_partkey") % 8).alias("parte"),
    )
    table = SnapshotTable(spark, scratch_path(spark, "checked"))
    state = CheckState(table, (*complete("id"), non_negative("valor"), unique("id")))
    for half in (0, 1):
        table.replace_partitions(table.stage(rows.filter(F.col("parte") % 2 == half), ["parte"]))
        found = state.report(RUN)
    return found.select("constraint", "violations", "rows")


# -- extracts that bring the same again -------------------------------------

CORRECTED = "l_linenumber = 1 AND l_orderkey % 50 = 0"


@query(
    "slv07_reload",
    f"""SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS id,
        l_extendedprice + CASE WHEN {CORRECTED} THEN 1 ELSE 0 END AS valor,
        DATE '{RUN}' - cast(l_linenumber AS integer) AS _dia_leitura,
        CASE WHEN {CORRECTED} THEN DATE '{RUN}' + 1 ELSE DATE '{RUN}' END AS _execution_date
        FROM (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS l_extendedprice
              FROM lineitem GROUP BY ALL)""",
)
def slv07_reload(spark, d):
    """A window extracted on two days, with corrections on the second: all else stays as first loaded."""
    lines = i.table(spark, d, "lineitem")
    taken = F.date_add(F.lit(RUN), -F.col("l_linenumber").cast("int")).cast("timestamp")
    first = lines.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("price")).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.lit("SENS-1").alias("sensor_id"),
        F.col("price").alias("valor"),
        F.lit(1).alias("status_qualidade_id"),
        F.lit(False).alias("is_anomalia"),
        taken.alias("timestamp_leitura"),
        F.expr(CORRECTED).alias("corrected"),
    )
    second = first.withColumn("valor", F.col("valor") + F.col("corrected").cast("int"))
    root = scratch_path(spark, "reloaded")
    for days, extract in enumerate([first, second]):
        relations = FrameRelations(lambda _, extract=extract: extract.drop("corrected"))
        lake = Lake(spark, root, "hmg", relations)
        for layer in ("bronze", "silver"):
            run(lake, find_table(f"{layer}/postgres/leituras"), RUN + dt.timedelta(days))
    found = lake.read("silver/postgres/leituras")
    return found.select("id", "valor", "_dia_leitura", "_execution_date")


# -- events that arrive after their day was loaded --------------------------

LAST = run_date("2024-01-31")
_ALL_MOMENTS = f"""SELECT *, "timestamp" + CASE k WHEN 14 THEN INTERVAL 3 HOUR ELSE INTERVAL 0 HOUR END AS momento
    FROM ({_VALID}) WHERE k NOT IN (12, 13)"""


def _late_run(spark, d, path: str) -> DataFrame:
    """A third of the messages, a run in the middle of the month, then the rest and another run."""
    lake = _lake(spark, d)
    write, all_ = batch_writer(lake.events_path), i.messages(spark, d)
    in_time = F.col("offset") % 3 == 0
    for batch, (part, day) in enumerate([(in_time, RUN), (~in_time, LAST)]):
        write(classify(all_.filter(part)), batch)
        for table in dict.fromkeys(("silver/kafka/sensor_events", path)):
            run(lake, find_table(table, LATE_TABLES), day)
    return lake.read(path)


@query(
    "slv10_late",
    f"""SELECT event_id, sensor_id, equipment_id, factory_id, measurement_type, round(value, 2) AS value,
        date_trunc('second', momento) AS "timestamp", quality, is_anomaly,
        CASE WHEN n % 3 = 0 AND dt <= DATE '{RUN}' THEN DATE '{RUN}' ELSE DATE '{LAST}' END AS _execution_date
        FROM ({_ALL_MOMENTS})""",
)
def slv10_late(spark, d):
    """Events of days that were loaded before they came: each is read once, by the next run."""
    found = _late_run(spark, d, "silver/kafka/sensor_events")
    return found.select(
        "event_id", "sensor_id", "equipment_id", "factory_id", "measurement_type", "value",
        i.ntz("timestamp").alias("timestamp"), "quality", "is_anomaly", "_execution_date",
    )


@query("gld07_late", _DAY_FACT.replace(f"k <> 12 AND dt = DATE '{RUN}'", "k NOT IN (12, 13)"))
def gld07_late(spark, d):
    """The days that late events touched are counted anew, from all their events."""
    fact = _late_run(spark, d, "gold/fct/fct_anomalias_dia")
    return fact.drop("_execution_date", "_processed_at", "_data_source")


def _loaded(lake: Lake, path: str, df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A table of no declared rules, loaded with ``df`` and read back."""
    run(lake, TableSpec(path, lambda *_: df, keys=keys), RUN)
    return lake.read(path)


@query("dq07", "SELECT * FROM part")
def dq07(spark, d):
    """A table without rules is loaded, with a warning in the log."""
    stored = _loaded(_lake(spark, d), "silver/plant/part", i.table(spark, d, "part"), ("p_partkey",))
    return stored.drop("_execution_date", "_processed_at", "_data_source")


@query(
    "job03",
    """SELECT 'hmg' AS ambiente, count(*) AS linhas FROM supplier
       UNION ALL SELECT 'prd', count(*) FROM customer""",
)
def job03(spark, d):
    """One table path in two environments: two tables."""
    root = scratch_path(spark, "environments")
    held = {"hmg": "supplier", "prd": "customer"}
    lakes = {name: Lake(spark, root, name) for name in held}
    for name, content in held.items():
        _loaded(lakes[name], "silver/plant/sensores", i.table(spark, d, content))
    counts = [
        lake.read("silver/plant/sensores").agg(
            F.lit(name).alias("ambiente"), F.count(F.lit(1)).alias("linhas")
        )
        for name, lake in lakes.items()
    ]
    return counts[0].unionByName(counts[1])


@query("job04", "SELECT 'plant' AS _data_source, count(*) AS linhas FROM orders")
def job04(spark, d):
    """Layer, source and name come from the end of a path; the source is stamped."""
    stored = _loaded(_lake(spark, d), "/any/folder/silver/plant/orders/", i.table(spark, d, "orders"))
    return stored.groupBy("_data_source").agg(F.count(F.lit(1)).alias("linhas"))


@query(
    "str09",
    f"""SELECT equipment_id AS chave, count(*) AS mensagens, min(n) AS primeira, max(n) AS ultima
        FROM ({i.SQL_EVENTS}) GROUP BY 1""",
)
def str09(spark, d):
    """Messages are keyed by equipment: what each key carries."""
    m = i.messages(spark, d).groupBy(F.col("key").cast("string").alias("chave"))
    return m.agg(
        F.count(F.lit(1)).alias("mensagens"),
        F.min("offset").alias("primeira"),
        F.max("offset").alias("ultima"),
    )

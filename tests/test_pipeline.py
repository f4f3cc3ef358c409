"""Whole runs: JDBC and documents to bronze, silver and gold."""

import datetime as dt
import json
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from millrace.operators.quality import QualityError
from millrace.plans.gold import FACTS, RECOMPUTED_FACTS
from millrace.plans.lake import Lake
from millrace.plans.runner import ALL_TABLES, find_table, run, run_all
from millrace.sources.documents import json_documents
from millrace.sources.relational import FrameRelations, JdbcRelations
from millrace.streaming.ingest import start_ingest
from millrace.sources.events import file_messages
from conftest import event, messages, rows

DAY = dt.date(2026, 6, 5)


def ts(text):
    return dt.datetime.fromisoformat(text)


NOW = ts("2026-01-01T00:00:00")

TABLES = {
    "fabricas": (
        "id string, nome string, latitude decimal(9,6), longitude decimal(9,6),"
        " created_at timestamp",
        [
            ("FAB-SP-01", "Fábrica São Paulo", D("-23.550500"), D("-46.633300"), NOW),
            ("FAB-RJ-01", "Fábrica Rio de Janeiro", D("-22.906800"), D("-43.172900"), NOW),
        ],
    ),
    "tipos_equipamento": (
        "id int, nome string, descricao string",
        [(1, "compressor", "Compressor industrial"), (2, "pump", "Bomba hidráulica")],
    ),
    "tipos_medicao": (
        "id int, nome string, unidade string, valor_minimo decimal(10,2),"
        " valor_maximo decimal(10,2), faixa_normal_min decimal(10,2),"
        " faixa_normal_max decimal(10,2)",
        [
            (1, "temperature", "celsius", D(20), D(100), D(30), D(70)),
            (2, "humidity", "percent", D(0), D(100), D(40), D(60)),
            (9, "swapped", "x", D(9), D(1), D(0), D(1)),
        ],
    ),
    "status_qualidade": ("id int, nome string", [(1, "good"), (2, "warning"), (3, "bad")]),
    "equipamentos": (
        "id string, nome string, tipo_equipamento_id int, fabrica_id string,"
        " data_instalacao date, status string",
        [
            ("EQ-1", "Compressor A1", 1, "FAB-SP-01", dt.date(2021, 3, 15), "ativo"),
            ("EQ-2", "Bomba B2", 2, "FAB-SP-01", None, "inativo"),
            ("EQ-3", "Sem tipo", 7, "FAB-RJ-01", dt.date(2020, 1, 1), "manutencao"),
        ],
    ),
    "sensores": (
        "id string, equipamento_id string, tipo_medicao_id int, data_instalacao date,"
        " status string",
        [
            ("S-1", "EQ-1", 1, dt.date(2021, 3, 15), "ativo"),
            ("S-2", "EQ-2", 2, dt.date(2021, 3, 15), "ativo"),
        ],
    ),
    "leituras": (
        "id string, sensor_id string, valor decimal(10,2), status_qualidade_id int,"
        " is_anomalia boolean, timestamp_leitura timestamp",
        [
            ("r0", "S-1", D("1.10"), 1, False, ts("2026-04-30T23:59:59")),
            ("r1", "S-1", D("45.30"), 1, False, ts("2026-05-01T00:00:00")),
            ("r2", "S-2", D("72.80"), 2, True, ts("2026-06-05T23:59:59")),
            ("r3", "S-2", D("9.00"), 3, False, ts("2026-06-06T00:00:00")),
        ],
    ),
    "metadados_leitura": (
        "leitura_id string, versao_firmware string, nivel_bateria short,"
        " forca_sinal_dbm short",
        [
            ("r0", "v1", 10, -50),
            ("r1", "v2.1.4", 87, -65),
            ("r2", "v2.0.9", 45, -80),
            ("r3", "v9", 1, -1),
        ],
    ),
}

DOCUMENTS = [
    {
        "_id": "EQ-1",
        "name": "Compressor Industrial A1",
        "type": "compressor",
        "factory": {
            "id": "FAB-SP-01",
            "name": "Fábrica São Paulo",
            "location": {"lat": -23.5505, "lng": -46.6333},
        },
        "sensors": [{"id": "S-1", "type": "temperature", "range": {"min": 0, "max": 50}}],
        "maintenance_schedule": "monthly",
        "installed_at": "2023-06-15T00:00:00Z",
        "status": "active",
    },
    {
        "_id": "EQ-2",
        "name": "Sem local",
        "type": "pump",
        "factory": {"id": "FAB-SP-01", "name": "Fábrica São Paulo"},
        "sensors": [],
        "maintenance_schedule": "weekly",
        "installed_at": "2023-07-12T00:00:00Z",
        "status": "active",
    },
    {"_id": "EQ-9", "name": "x", "type": "y", "factory": {"id": "f"}, "status": "broken"},
]


@pytest.fixture(scope="module")
def derby(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    for name, (schema, data) in TABLES.items():
        df = spark.createDataFrame(data, schema)
        texts = ", ".join(f"{c} VARCHAR(64)" for c, t in df.dtypes if t == "string")
        writer = df.write.option("createTableColumnTypes", texts)
        writer.jdbc(url, f'"{name}"', mode="overwrite")
    return url


def make_lake(spark, root, derby):
    documents = root / "documents.json"
    documents.write_text("\n".join(json.dumps(d) for d in DOCUMENTS))
    return Lake(
        spark,
        str(root / "lake"),
        "hmg",
        JdbcRelations(spark, derby, window_reads=2),
        lambda: json_documents(spark, str(documents)),
        owner="tests",
    )


def ingest(spark, lake, root, payloads):
    source = str(root / f"topic-{uuid.uuid4().hex}")
    messages(spark, payloads).write.parquet(source)
    start_ingest(
        file_messages(spark, source),
        lake.events_path,
        str(root / f"checkpoint-{uuid.uuid4().hex}"),
        available_now=True,
    ).awaitTermination()


def day_event(n, **changes):
    defaults = {
        "event_id": f"e{n}",
        "sensor_id": "S-1",
        "equipment_id": "EQ-1",
        "factory_id": "FAB-SP-01",
        "timestamp": f"2026-06-05T10:{n:02d}:00Z",
        "metadata": {"firmware_version": "v1", "battery_level": 80, "signal_strength": -60},
    }
    return event(**{**defaults, **changes})


@pytest.fixture(scope="module")
def loaded(spark, derby, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    lake = make_lake(spark, root, derby)
    ingest(
        spark,
        lake,
        root,
        [
            day_event(1, value=10.0),
            day_event(2, value=20.0, is_anomaly=True, quality="bad"),
            day_event(3, value=5, measurement_type="humidity", sensor_id="S-2"),
            day_event(4, measurement_type="current", sensor_id="S-2"),
            day_event(4, measurement_type="current", sensor_id="S-2"),
            day_event(5, event_id=None),
            day_event(6, quality="otima"),
        ],
    )
    return lake, run_all(lake, DAY)


def test_every_table_is_loaded(loaded):
    lake, results = loaded
    assert [r.table for r in results] == [s.path for s in ALL_TABLES]
    assert {r.status for r in results} == {"loaded"}


def test_windowed_extracts(loaded):
    lake, _ = loaded
    assert rows(lake.read("bronze/postgres/leituras").select("id"), "id") == [("r1",), ("r2",)]
    assert rows(lake.read("bronze/postgres/metadados_leitura").select("leitura_id"), "leitura_id") == [
        ("r1",),
        ("r2",),
    ]


def test_relational_silver(loaded):
    lake, _ = loaded
    kinds = lake.read("silver/postgres/tipos_medicao")
    assert rows(kinds.select("id", "valor_maximo"), "id") == [(1, 100.0), (2, 100.0)]
    sites = lake.read("silver/postgres/fabricas")
    assert "created_at" in sites.columns and dict(sites.dtypes)["latitude"] == "double"
    readings = lake.read("silver/postgres/leituras")
    assert rows(readings.select("id", "valor", "_dia_leitura"), "id") == [
        ("r1", 45.3, dt.date(2026, 5, 1)),
        ("r2", 72.8, dt.date(2026, 6, 5)),
    ]


def test_document_silver(loaded):
    lake, _ = loaded
    docs = lake.read("silver/mongo/equipamentos")
    assert rows(docs.select("equipamento_id", "latitude", F.size("sensors")), "equipamento_id") == [
        ("EQ-1", -23.5505, 1),
        ("EQ-2", None, 0),
    ]


def test_event_silver(loaded):
    lake, results = loaded
    events = lake.read("silver/kafka/sensor_events")
    assert rows(events.select("event_id", "value", "nivel_bateria", "_data_source", "dt"), "event_id") == [
        ("e1", 10.0, 80, "kafka", DAY),
        ("e2", 20.0, 80, "kafka", DAY),
        ("e3", 5.0, 80, "kafka", DAY),
        ("e4", 3.25, 80, "kafka", DAY),
    ]
    result = next(r for r in results if r.table == "silver/kafka/sensor_events")
    assert result.duplicates == 1


def test_dimensions(loaded):
    lake, _ = loaded
    equipment = lake.read("gold/dim/dim_equipamento")
    assert rows(
        equipment.select("equipment_id", "tipo_equipamento", "periodicidade_manutencao", "_data_source"),
        "equipment_id",
    ) == [
        ("EQ-1", "compressor", "monthly", "dim"),
        ("EQ-2", "pump", "weekly", "dim"),
        ("EQ-3", None, None, "dim"),
    ]
    hours = lake.read("gold/dim/dim_tempo")
    assert hours.count() == 24
    assert rows(hours.filter("hora = 14").select("date_key", "nome_mes", "dia_semana")) == [
        (2026060514, "Junho", 6)
    ]


def test_facts(loaded):
    lake, results = loaded
    hourly = lake.read("gold/fct/fct_leituras_hora")
    assert rows(
        hourly.select(
            "date_key", "sensor_id", "tipo_medicao_id", "avg_valor",
            "count_leituras", "count_anomalias", "pct_qualidade_boa",
        ),
        "sensor_id", "tipo_medicao_id",
    ) == [
        (2026060510, "S-1", 1, 15.0, 2, 1, 0.5),
        (2026060510, "S-2", None, 3.25, 1, 0, 1.0),
        (2026060510, "S-2", 2, 5.0, 1, 0, 1.0),
    ]
    result = next(r for r in results if r.table == "gold/fct/fct_leituras_hora")
    assert result.warnings == ("isComplete(tipo_medicao_id)", "isComplete(stddev_valor)")
    daily = lake.read("gold/fct/fct_anomalias_dia")
    assert rows(daily.select("sensor_id", "measurement_type", "total_leituras", "taxa_anomalia"), "sensor_id", "measurement_type") == [
        ("S-1", "temperature", 2, 0.5),
        ("S-2", "current", 1, 0.0),
        ("S-2", "humidity", 1, 0.0),
    ]


def test_check_results_are_stored(loaded, spark):
    lake, _ = loaded
    stored = spark.read.parquet(lake.quality_path)
    assert stored.select("table_path").distinct().count() == len(ALL_TABLES)
    failed = stored.filter("constraint_status != 'Success'")
    assert failed.filter("check_level = 'Error'").count() == 0
    assert stored.filter("table_path = 'bronze/postgres/equipamentos'").count() == 7


def snapshot(lake, spec):
    df = lake.read(spec.path).drop("_processed_at", "_ingested_at")
    columns = sorted(df.columns)
    return sorted(repr(tuple(r)) for r in df.select(columns).collect())


def test_rerun_changes_nothing(loaded):
    lake, _ = loaded
    before = {s.path: snapshot(lake, s) for s in ALL_TABLES}
    run_all(lake, DAY)
    assert {s.path: snapshot(lake, s) for s in ALL_TABLES} == before


def test_next_day_leaves_old_partitions_alone(loaded, spark, tmp_path):
    lake, _ = loaded
    after = DAY + dt.timedelta(days=1)
    ingest(spark, lake, tmp_path, [day_event(30, timestamp="2026-06-06T01:00:00")])
    spec = find_table("silver/kafka/sensor_events")
    old = lake.table(spec.path).manifest().parts
    result = run(lake, spec, after)
    assert result.rewritten == ()
    new = lake.table(spec.path).manifest().parts
    assert {p: s for p, s in new.items() if p in old} == dict(old)
    assert set(new) - set(old) == {"measurement_type=temperature/_execution_date=2026-06-06"}
    fact = find_table("gold/fct/fct_anomalias_dia")
    assert run(lake, fact, after).rewritten == ()
    assert lake.read(fact.path).select("data").distinct().count() == 2


def test_recomputed_facts_count_all_run_dates(spark, derby, tmp_path):
    """An evening event with an offset belongs to an hour of the next UTC day."""
    lake = make_lake(spark, tmp_path, derby)
    evening = day_event(1, timestamp="2026-06-05T23:00:00-03:00", value=10.0)
    night = day_event(2, timestamp="2026-06-06T02:30:00Z", value=30.0)
    ingest(spark, lake, tmp_path, [evening, night])
    run(lake, find_table("bronze/postgres/tipos_medicao"), DAY)
    run(lake, find_table("silver/postgres/tipos_medicao"), DAY)
    for day in (DAY, DAY + dt.timedelta(days=1)):
        run(lake, find_table("silver/kafka/sensor_events"), day)
        run_all(lake, day, FACTS)
    hourly = lake.read("gold/fct/fct_leituras_hora").select("date_key", "count_leituras", "avg_valor")
    assert rows(hourly) == [(2026060602, 1, 30.0)]
    run_all(lake, day, RECOMPUTED_FACTS)
    hourly = lake.read("gold/fct/fct_leituras_hora").select("date_key", "count_leituras", "avg_valor")
    assert rows(hourly) == [(2026060602, 2, 20.0)]
    daily = lake.read("gold/fct/fct_anomalias_dia").select("data", "total_leituras")
    assert rows(daily) == [(dt.date(2026, 6, 6), 2)]


def test_error_rule_stops_the_load(spark, tmp_path):
    bad = spark.createDataFrame([(1, None), (2, "x")], "id int, nome string")
    lake = Lake(spark, str(tmp_path), "prd", FrameRelations(lambda name: bad))
    spec = find_table("bronze/postgres/status_qualidade")
    with pytest.raises(QualityError, match="isComplete.nome."):
        run(lake, spec, DAY)
    assert not lake.table(spec.path).exists()
    assert not list(tmp_path.rglob("*=s-*"))
    assert spark.read.parquet(lake.quality_path).filter("constraint_status = 'Failure'").count() == 1


def test_empty_batch_loads_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id int, nome string")
    lake = Lake(spark, str(tmp_path), "hmg", FrameRelations(lambda name: empty))
    spec = find_table("bronze/postgres/status_qualidade")
    assert run(lake, spec, DAY).status == "empty"
    assert not lake.table(spec.path).exists()
    assert not list(tmp_path.rglob("*=s-*"))


def test_environments():
    assert Lake(None, "/x", "hmg").layer_path("silver") == "/x/silver-hmg"
    assert Lake(None, "/x/", "prd").layer_path("silver") == "/x/silver"
    with pytest.raises(ValueError, match="options"):
        Lake(None, "/x", "dev")


def test_jdbc_window_is_pushed_to_the_database(spark, derby):
    relations = JdbcRelations(spark, derby)
    df = relations.window("leituras", "timestamp_leitura", dt.date(2026, 5, 1), DAY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1]
    assert "*GreaterThanOrEqual(timestamp_leitura,2026-05-01" in pushed
    assert "Filter (" not in plan


def test_frames_and_jdbc_agree(spark, derby):
    frames = FrameRelations(lambda n: spark.createDataFrame(TABLES[n][1], TABLES[n][0]))
    jdbc = JdbcRelations(spark, derby)
    args = ("metadados_leitura", "leitura_id", "leituras", "id", "timestamp_leitura", dt.date(2026, 5, 1), DAY)
    assert rows(frames.children_of_window(*args), "leitura_id") == rows(
        jdbc.children_of_window(*args), "leitura_id"
    )

"""Contract reasons, ingest outputs, replays and windows."""

import datetime as dt
import importlib
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import DAY, event, messages, rows, values
from millrace.functions.contract import Contract
from millrace.sources.events import TOPIC, bronze_events, file_messages
from millrace.streaming.ingest import (
    ALERTS,
    INGEST_DAY,
    anomaly_alerts,
    batch_writer,
    classify,
    counters,
    dead_letters,
    dead_lines,
    start_ingest,
    valid_lines,
)
from millrace.streaming.windows import start_window_metrics, window_metrics

TODAY = dt.datetime.now(dt.timezone.utc).date()

CASES = [
    (event(), None),
    (event(drop=["sensor_id"]), "Campos ausentes: ['sensor_id']"),
    (event(drop=["unit", "event_id"]), "Campos ausentes: ['event_id', 'unit']"),
    (event(value="doze"), "'value' deve ser numérico, recebeu: str"),
    (event(value=None), "'value' deve ser numérico, recebeu: NoneType"),
    (event(value=[1]), "'value' deve ser numérico, recebeu: list"),
    (event(value={"a": 1}), "'value' deve ser numérico, recebeu: dict"),
    (event(value=True), "'value' deve ser numérico, recebeu: bool"),
    (event(value=1), None),
    (event(value=1.5), None),
    (event(value=-5), None),
    (event(value=0), None),
    (event(value=1e300), None),
    (event(value=12345678901234567890123), None),
    (event(is_anomaly="sim"), "'is_anomaly' deve ser bool, recebeu: str"),
    (event(is_anomaly=0), "'is_anomaly' deve ser bool, recebeu: int"),
    (event(is_anomaly=0.5), "'is_anomaly' deve ser bool, recebeu: float"),
    (event(quality="good"), None),
    (event(quality="warning"), None),
    (event(quality="bad"), None),
    (
        event(quality="otima"),
        "'quality' inválido: otima (esperado: ['bad', 'good', 'warning'])",
    ),
    (event(quality=None), "'quality' inválido: None (esperado: ['bad', 'good', 'warning'])"),
    (event(quality=True), "'quality' inválido: True (esperado: ['bad', 'good', 'warning'])"),
    (event(measurement_type="torque"), "'measurement_type' inválido: torque"),
    (event(metadata="string"), "'metadata' deve ser um objeto JSON"),
    (event(metadata=None), "'metadata' deve ser um objeto JSON"),
    (event(metadata={"lote": 7}), None),
    ("so texto", "Mensagem não é JSON válido"),
    ('"so texto"', "Evento deve ser dict, recebeu: str"),
    ("[1, 2]", "Evento deve ser dict, recebeu: list"),
    ("null", "Evento deve ser dict, recebeu: NoneType"),
    ("1.5", "Evento deve ser dict, recebeu: float"),
    ("{}", None),
    (event(drop=["unit"], quality="nope"), "Campos ausentes: ['unit']"),
    (event(event_id=None), None),
    ("{bad json", "Mensagem não é JSON válido"),
    ('{"a": 1, "a": 2}', "Mensagem não é JSON válido"),
    ('{"a": NaN}', "Mensagem não é JSON válido"),
]


def test_reasons(spark):
    found = values(classify(messages(spark, [p for p, _ in CASES])), "_dlq_reason", "_kafka_offset")
    for (payload, expected), reason in zip(CASES, found):
        if payload == "{}":
            assert reason.startswith("Campos ausentes: ['equipment_id', 'event_id'")
        else:
            assert reason == expected, payload


def test_messages_without_value(spark):
    df = messages(spark, [event()]).withColumn("value", F.lit(None).cast("binary"))
    assert values(classify(df), "_dlq_reason") == ["Mensagem não é JSON válido"]


def test_contract_from_schema(spark):
    schema = {"required": ["event_id"], "properties": {"quality": {"enum": ["ok"]}}}
    contract = Contract.from_json_schema(json.dumps(schema))
    assert contract.measurement_types == Contract().measurement_types
    assert Contract.from_json_schema(None) == Contract()
    payloads = [event(quality="ok", drop=["unit"]), event(), event(value=True, quality="ok")]
    lenient = Contract.from_json_schema(json.dumps(schema), bool_is_number=True)
    found = values(classify(messages(spark, payloads), lenient), "_dlq_reason", "_kafka_offset")
    assert found == [None, "'quality' inválido: good (esperado: ['ok'])", None]


def test_partition_columns(spark):
    payloads = [
        event(),
        event(timestamp="31/12"),
        event(timestamp="2031-03-14T23:00:00-03:00"),
        event(timestamp="2031-03-14T00:30:00Z"),
        event(factory_id=None),
        {},
    ]
    found = classify(messages(spark, payloads)).orderBy("_kafka_offset")
    first = DAY.date()
    assert rows(found.select("factory_id", "measurement_type", "dt")) == [
        ("factory_id-0", "temperature", first),
        ("factory_id-0", "temperature", TODAY),
        ("factory_id-0", "temperature", first),
        ("factory_id-0", "temperature", first),
        ("UNKNOWN", "temperature", first),
        ("UNKNOWN", "UNKNOWN", TODAY),
    ]


def lines(df):
    return [json.loads(r.value) for r in df.collect()]


def test_valid_events_are_enriched(spark):
    extra = event(local="São Paulo", nested={"a": [1, {"b": None}]})
    [line] = lines(valid_lines(classify(messages(spark, [extra]))))
    assert {k: line[k] for k in extra} == extra
    assert line["_ingested_at"].endswith("Z")
    assert (line["_kafka_offset"], line["_kafka_partition"]) == (0, 0)
    assert (line["_kafka_topic"], line["_kafka_key"]) == (TOPIC, "0")


def test_lines_stay_single_and_keys_unique(spark):
    payloads = [
        json.dumps(event(), indent=2),
        json.dumps(event(_kafka_offset=99, _ingested_at="x")) + " \n",
        json.dumps(event()) + "\t ",
    ]
    written = valid_lines(classify(messages(spark, payloads)))
    texts = [r.value for r in written.collect()]
    assert not any("\n" in t for t in texts)
    offsets = []
    for text in texts:
        pairs = json.loads(text, object_pairs_hook=list)
        assert len(pairs) == len(dict(pairs)) == 16
        offsets.append(dict(pairs)["_kafka_offset"])
    assert sorted(offsets) == [0, 1, 2]


def test_missing_key_is_null(spark):
    df = messages(spark, [event()]).withColumn("key", F.lit(None).cast("binary"))
    [line] = lines(valid_lines(classify(df)))
    assert line["_kafka_key"] is None


def test_rejected_messages(spark):
    payloads = [event(value="bad"), "{bad", '"text"']
    found = lines(dead_lines(classify(messages(spark, payloads))).orderBy("value"))
    by_offset = {line["_kafka_offset"]: line for line in found}
    assert by_offset[0]["value"] == "bad" and "'value'" in by_offset[0]["_dlq_reason"]
    assert by_offset[1]["_raw"] == "{bad" and by_offset[2]["_raw"] == '"text"'
    assert not any("_ingested_at" in line for line in found)


def test_counters_and_alerts(spark):
    payloads = [event(is_anomaly=True), event(), event(is_anomaly=True), event(value="x", is_anomaly=True)]
    classified = classify(messages(spark, payloads))
    counted = counters(classified).first()
    assert counted[:4] == (4, 3, 1, 2) and counted["bytes"] > 0
    assert rows(anomaly_alerts(classified).select("sensor_id", "value")) == [("sensor_id-0", 3.25)] * 2


def ingest(spark, source, root, **options):
    stream = file_messages(spark, str(source), options.pop("per_batch", None))
    query = start_ingest(
        stream, str(root), f"{root}-checkpoint", available_now=True, **options
    )
    query.awaitTermination()
    return query


def test_stream_writes_all_outputs(spark, tmp_path):
    payloads = [event(event_id=f"e{n}", is_anomaly=n == 2) for n in range(4)] + ["{bad"]
    messages(spark, payloads).write.parquet(str(tmp_path / "in"))
    query = ingest(spark, tmp_path / "in", tmp_path / "bronze")
    bronze = bronze_events(spark, str(tmp_path / "bronze"))
    assert values(bronze, "event_id") == ["e0", "e1", "e2", "e3"]
    assert dead_letters(spark, str(tmp_path / "bronze")).count() == 1
    assert spark.read.parquet(str(tmp_path / "bronze" / ALERTS)).count() == 1
    observed = query.recentProgress[0]["observedMetrics"]["ingest"]
    assert (observed["received"], observed["written"], observed["invalid"]) == (5, 4, 1)


def test_folders_follow_the_hive_layout(spark, tmp_path):
    batch_writer(str(tmp_path))(classify(messages(spark, [event()])), 7)
    folder = tmp_path / "factory_id=factory_id-0" / "measurement_type=temperature" / "dt=2031-03-14"
    assert folder.is_dir()


def test_replayed_batch_replaces_itself(spark, tmp_path):
    write = batch_writer(str(tmp_path))
    classified = classify(messages(spark, [event(), event(value="x")]))
    write(classified, 0)
    write(classified, 0)
    write(classified, 1)
    assert bronze_events(spark, str(tmp_path)).count() == 2
    assert dead_letters(spark, str(tmp_path)).count() == 2


def test_dead_letters_keep_the_day_of_their_batch(spark, tmp_path):
    """The day comes with the batch, so that a replay after midnight finds its folder."""
    yesterday = F.lit(dt.date(2031, 1, 1))
    batch = classify(messages(spark, ["{bad"])).withColumn(INGEST_DAY, yesterday)
    for _ in range(2):
        batch_writer(str(tmp_path))(batch, 0)
    assert rows(dead_letters(spark, str(tmp_path)).select("dt")) == [(dt.date(2031, 1, 1),)]


def test_failed_batch_is_replayed(spark, tmp_path):
    """A batch that fails leaves the offset; a restart delivers it."""
    messages(spark, [event(event_id=f"e{n}") for n in range(3)]).write.parquet(str(tmp_path / "in"))
    (tmp_path / "bronze").write_text("in the way")
    with pytest.raises(Exception):
        ingest(spark, tmp_path / "in", tmp_path / "bronze")
    (tmp_path / "bronze").unlink()
    ingest(spark, tmp_path / "in", tmp_path / "bronze")
    assert bronze_events(spark, str(tmp_path / "bronze")).count() == 3


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    for n in range(2):
        messages(spark, [event(event_id=f"e{n}")]).write.mode("append").parquet(str(tmp_path / "in"))
        ingest(spark, tmp_path / "in", tmp_path / "bronze", per_batch=1)
    assert values(bronze_events(spark, str(tmp_path / "bronze")), "event_id") == ["e0", "e1"]


def test_days_select_folders(spark, tmp_path):
    days = ["2025-01-01", "2025-01-02", "2025-01-03"]
    payloads = [event(event_id=d, timestamp=f"{d}T10:00:00") for d in days]
    batch_writer(str(tmp_path))(classify(messages(spark, payloads)), 0)
    second = bronze_events(spark, str(tmp_path), [dt.date(2025, 1, 2)])
    assert values(second, "event_id") == ["2025-01-02"]
    assert len(second.inputFiles()) == 1
    assert bronze_events(spark, str(tmp_path), [dt.date(1999, 1, 1)]).count() == 0


def test_path_wins_over_body(spark, tmp_path):
    folder = tmp_path / "factory_id=F1" / "measurement_type=pressure" / "dt=2025-01-01"
    folder.mkdir(parents=True)
    (folder / "x.ndjson").write_text(json.dumps(event(factory_id="OTHER")) + "\n")
    assert rows(bronze_events(spark, str(tmp_path)).select("factory_id", "measurement_type")) == [
        ("F1", "pressure")
    ]


def test_window_stream_drops_repeats_and_closes_windows(spark, tmp_path):
    schema = (
        "event_id string, factory_id string, measurement_type string, value double,"
        " is_anomaly boolean, timestamp timestamp"
    )

    def at(minute):
        return dt.datetime(2025, 1, 1, 10, minute)

    data = [
        ("e1", "F1", "temperature", 1.0, False, at(1)),
        ("e1", "F1", "temperature", 1.0, False, at(1)),
        ("e2", "F1", "temperature", 3.0, True, at(4)),
        ("e3", "F1", "temperature", 9.0, None, at(6)),
        (None, "F2", "temperature", 5.0, False, at(2)),
        (None, "F2", "temperature", 7.0, False, at(2)),
        (None, "F3", "temperature", 7.0, False, at(3)),
        ("e4", "F1", "temperature", 5.0, False, at(59)),
    ]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    start_window_metrics(stream, out, f"{out}-checkpoint", available_now=True).awaitTermination()
    shown = ("factory_id", "inicio", "leituras", "anomalias", "avg_valor")
    want = [
        ("F1", at(0), 2, 1, 2.0), ("F1", at(5), 1, 0, 9.0), ("F2", at(0), 2, 0, 6.0), ("F3", at(0), 1, 0, 7.0)
    ]
    assert rows(spark.read.parquet(out).select(*shown), *shown) == want
    batch = window_metrics(spark.createDataFrame(data, schema)).where(F.col("inicio") < at(55))
    assert rows(batch.select(*shown), *shown) == want


def test_dead_letters_are_hidden_from_readers_of_the_parent(spark, tmp_path):
    batch_writer(str(tmp_path))(classify(messages(spark, [event(), "{bad"])), 0)
    assert "_dead_letter" in os.listdir(tmp_path)
    assert spark.read.text(str(tmp_path)).count() == 1


def test_dry_run_counts_and_writes_nothing(spark, tmp_path):
    messages(spark, [event(), "{bad"]).write.parquet(str(tmp_path / "in"))
    query = ingest(spark, tmp_path / "in", tmp_path / "bronze", dry_run=True)
    observed = query.recentProgress[0]["observedMetrics"]["ingest"]
    assert (observed["received"], observed["invalid"]) == (2, 1)
    assert not (tmp_path / "bronze").exists()


def test_a_filter_on_the_outcome_does_not_judge_each_message_again(spark):
    classified = classify(messages(spark, [event(), "{bad json"]))
    for filtered in (
        classified.filter("_dlq_reason IS NOT NULL").select("_kafka_offset", "_dlq_reason"),
        classified.filter(F.col("_dlq_reason").rlike("^Mensagem")).select("_kafka_offset", "_dlq_reason"),
        anomaly_alerts(classified),
    ):
        plan = filtered._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("array_except(") == 1, plan
    assert values(classified.filter("_dlq_reason IS NOT NULL"), "_kafka_offset", "_kafka_offset") == [1]


def test_tasks_of_a_small_batch_do_not_follow_the_shuffle_partitions(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    spark.sparkContext.setJobGroup("small-batch", "")
    try:
        batch_writer(str(tmp_path))(classify(messages(spark, [event(), event(is_anomaly=True), "{bad"])), 0)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("small-batch")]
    stages = {s: tracker.getStageInfo(s) for job in jobs for s in job.stageIds}
    assert jobs and sum(s.numTasks for s in stages.values() if s) < 150
    assert (bronze_events(spark, str(tmp_path)).count(), dead_letters(spark, str(tmp_path)).count()) == (2, 1)
    assert spark.read.parquet(f"{tmp_path}/{ALERTS}").count() == 1


@pytest.mark.parametrize(
    "module, name, batches", [("reporting", "rmp04_stream", 2), ("streams", "rmp01_late", 4)]
)
def test_the_source_of_a_stream_is_written_by_several_tasks(spark, tmp_path, monkeypatch, module, name, batches):
    catalog = importlib.import_module(f"millrace.catalog.{module}")
    monkeypatch.setattr(catalog, "scratch_path", lambda _, kind: f"{tmp_path}/{kind}")
    tables = "/root/testdata/sf0.001"
    spark.read.parquet(f"{tables}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/in/events.parquet")
    found = catalog.__dict__[name](spark, f"{tmp_path}/in").count()
    folder = {"rmp04_stream": "range-alerts-events", "rmp01_late": "shuffled"}[name]
    assert found and len(list((tmp_path / folder).glob("part-*.parquet"))) > batches
    offsets = [p for p in tmp_path.glob("*-checkpoint/offsets/*") if p.name.isdigit()]
    assert len(offsets) == batches

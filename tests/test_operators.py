"""Columns, filters, deduplication, aggregates, calendar, rules, reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows, values
from millrace.functions.calendar import extract_window, extract_window_start, hour_key_of, run_date
from millrace.operators import quality as dq
from millrace.operators.aggregates import daily_anomalies, hourly_metrics, with_type_ids
from millrace.operators.columns import add_metadata, cast_columns, pick
from millrace.operators.dedup import keep_latest
from millrace.operators.filters import in_days, is_true, less_than, not_null, on_date, one_of
from millrace.plans import reports
from millrace.plans.gold import calendar
from millrace.sources.plain import append_parquet, dry_run, overwrite_partitions, read_parquet

DAY = dt.date(2026, 6, 22)


def at(text):
    return dt.datetime.fromisoformat(text)


# -- columns and filters ------------------------------------------------------


def test_casts_turn_bad_values_into_null(spark):
    df = spark.createDataFrame([("1", "x", "keep"), ("nope", "2.5", "keep")], "a string, b string, c string")
    cast = cast_columns(df, {"a": "int", "b": "double"}, drop=["none"])
    assert rows(cast) == [(1, None, "keep"), (None, 2.5, "keep")]
    with pytest.raises(ValueError, match="missing"):
        cast_columns(df, {"zz": "int"})


def test_pick_reaches_into_structs(spark):
    df = spark.sql("SELECT named_struct('id', 'F', 'location', named_struct('lat', 1.5D)) AS f")
    assert rows(pick(df, {"id": "f.id", "latitude": "f.location.lat"})) == [("F", 1.5)]


def test_metadata_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    stamped = add_metadata(df, DAY, "postgres")
    assert rows(stamped.select("_execution_date", "_data_source")) == [(DAY, "postgres")]
    again = add_metadata(stamped, dt.date(2000, 1, 1), "other")
    assert rows(again.select("_execution_date", "_data_source")) == [(DAY, "postgres")]
    assert dict(again.dtypes)["_processed_at"] == "timestamp"


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "a", at("2026-06-22T00:00:00")), (2, "b", at("2026-06-23T23:59:59")), (3, None, None)],
        "n int, s string, t timestamp",
    )
    assert values(df.filter(not_null("n", "s")), "n") == [1, 2]
    assert values(df.filter(one_of("s", ["a", "z"])), "n") == [1]
    assert values(df.filter(in_days("t", DAY, DAY)), "n") == [1]
    assert values(df.filter(in_days("t", DAY, dt.date(2026, 6, 23))), "n") == [1, 2]
    assert values(df.filter(on_date("t", DAY)), "n") == [1]
    assert values(df.withColumn("m", F.lit(2)).filter(less_than("n", "m")), "n") == [1]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert flags.filter(is_true("f")).count() == 1


# -- deduplication ------------------------------------------------------------


def test_keep_latest(spark):
    df = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "only", None), (3, "x", 1), (3, "y", 1)],
        "id int, v string, d int",
    )
    kept = keep_latest(df, ["id"], ["d", "absent"])
    assert rows(kept.filter("id < 3").select("id", "v"), "id") == [(1, "new"), (2, "only")]
    # A tie is broken the same way whatever the order of the rows.
    tied = {values(keep_latest(df.orderBy(o), ["id"], ["d"]).filter("id = 3"), "v")[0] for o in ("v", F.desc("v"))}
    assert len(tied) == 1


def test_keep_latest_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


# -- calendar -----------------------------------------------------------------


@pytest.mark.parametrize(
    "day, first",
    [
        ("2026-06-18", "2026-06-01"),
        ("2026-06-05", "2026-05-01"),
        ("2026-06-10", "2026-05-01"),
        ("2026-06-11", "2026-06-01"),
        ("2026-01-03", "2025-12-01"),
    ],
)
def test_extract_window(spark, day, first):
    assert extract_window(run_date(day)) == (run_date(first), run_date(day))
    start = spark.range(1).select(extract_window_start(F.lit(run_date(day)))).first()[0]
    assert start == run_date(first)


def test_run_date_is_strict():
    with pytest.raises(ValueError):
        run_date("22/06/2026")


def test_calendar(spark):
    hours = calendar(spark, DAY, DAY)
    assert hours.count() == 24
    row = hours.filter("hora = 14").first().asDict()
    assert row == {
        "date_key": 2026062214, "data": DAY, "hora": 14, "dia_semana": 2, "semana_ano": 26,
        "mes": 6, "trimestre": 2, "ano": 2026, "nome_mes": "Junho",
    }
    assert calendar(spark, dt.date(2026, 2, 27), dt.date(2026, 3, 2)).count() == 96
    late = calendar(spark, dt.date(2200, 12, 31), dt.date(2200, 12, 31))
    assert values(late.filter("hora = 23"), "date_key") == [2200123123]
    assert values(calendar(spark, dt.date(2027, 1, 1), dt.date(2027, 1, 1)).limit(1), "semana_ano") == [53]


def test_hour_key_equals_formatted_text(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'1999-12-31 22:59:59', timestamp'2000-03-01 01:00:00', interval 53 minutes)) t")
    text = F.date_format("t", "yyyyMMddHH").cast("long")
    assert df.filter(hour_key_of(F.col("t")) != text).count() == 0


# -- facts --------------------------------------------------------------------

EVENTS = [
    ("s1", 10.0, "2026-06-22T10:05:00", "good", False),
    ("s1", 20.0, "2026-06-22T10:55:00", "bad", True),
    ("s1", 30.0, "2026-06-22T11:00:00", "good", None),
    ("s2", 1.0, None, "good", True),
]


@pytest.fixture(scope="module")
def sensor_events(spark):
    data = [(s, v, at(t) if t else None, q, a) for s, v, t, q, a in EVENTS]
    return spark.createDataFrame(
        data, "sensor_id string, value double, timestamp timestamp, quality string, is_anomaly boolean"
    ).withColumns(
        {"equipment_id": F.lit("e"), "factory_id": F.lit("f"), "measurement_type": F.lit("temperature")}
    )


def test_hourly_metrics(spark, sensor_events):
    found = rows(
        hourly_metrics(sensor_events).select(
            "date_key", "avg_valor", "min_valor", "max_valor", F.round("stddev_valor", 4),
            "count_leituras", "count_anomalias", "pct_qualidade_boa",
        ),
        "date_key",
    )
    assert found == [
        (2026062210, 15.0, 10.0, 20.0, 7.0711, 2, 1, 0.5),
        (2026062211, 30.0, 30.0, 30.0, None, 1, 0, 1.0),
    ]


def test_daily_anomalies(sensor_events):
    found = daily_anomalies(sensor_events)
    assert rows(found.select("data", "total_leituras", "total_anomalias", F.round("taxa_anomalia", 4))) == [
        (DAY, 3, 1, 0.3333)
    ]
    assert dict(found.dtypes)["taxa_anomalia"] == "double"


def test_type_ids_join_like_raw_events_would(spark, sensor_events):
    kinds = spark.createDataFrame([(1, "temperature"), (2, "temperature"), (3, "other")], "id int, nome string")
    ours = with_type_ids(hourly_metrics(sensor_events), kinds)
    raw = sensor_events.join(
        kinds.select(F.col("id").alias("tipo_medicao_id"), F.col("nome").alias("measurement_type")),
        "measurement_type", "left",
    )
    expected = (
        raw.filter("timestamp IS NOT NULL")
        .groupBy(hour_key_of(F.col("timestamp")).alias("date_key"), "tipo_medicao_id")
        .agg(F.avg("value").alias("avg_valor"), F.count(F.lit(1)).alias("n"))
    )
    assert rows(ours.select("date_key", "tipo_medicao_id", "avg_valor", "count_leituras"), "date_key", "tipo_medicao_id") == rows(
        expected, "date_key", "tipo_medicao_id"
    )


# -- rules --------------------------------------------------------------------


@pytest.fixture(scope="module")
def measured_rows(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0, "1"), (2, "b", -1.0, "x"), (2, None, None, None)],
        "id int, s string, v double, n string",
    )


def test_rules(measured_rows):
    rules = (
        *dq.complete("id", "s"),
        dq.unique("id"),
        dq.unique("s"),
        dq.contained_in("s", ["a"], dq.Level.WARNING),
        dq.non_negative("v"),
        dq.has_type("n", "int"),
    )
    found = dq.evaluate(measured_rows, rules, DAY)
    assert rows(found.select("constraint", "check_level", "constraint_status", "violations")) == [
        ("isComplete(id)", "Error", "Success", 0),
        ("isComplete(s)", "Error", "Failure", 1),
        ("isUnique(id)", "Error", "Failure", 1),
        ("isUnique(s)", "Error", "Success", 0),
        ("isContainedIn(s,[a])", "Warning", "Failure", 1),
        ("isNonNegative(v)", "Error", "Failure", 1),
        ("hasDataType(n,int)", "Error", "Failure", 1),
    ]
    assert dq.failures(found).count() == 5
    assert dq.failures(found, dq.Level.WARNING).count() == 1
    message = found.filter("constraint = 'isComplete(s)'").first()
    assert message.constraint_message == "Value: 0.666667 does not meet the constraint requirement!"
    assert message._execution_date == DAY
    # one of three known values occurs once
    unique = found.filter("constraint = 'isUnique(id)'").first()
    assert unique.constraint_message.startswith("Value: 0.333333 ")


def test_gate(measured_rows):
    warning = (dq.non_negative("v", dq.Level.WARNING),)
    row = dq.measure(measured_rows, warning).first()
    dq.gate(row, warning)
    assert dq.broken_rules(row, warning, dq.Level.WARNING) == ["isNonNegative(v)"]
    error = dq.complete("s")
    with pytest.raises(dq.QualityError, match="isComplete.s."):
        dq.gate(dq.measure(measured_rows, error).first(), error)


def test_unknown_rule():
    with pytest.raises(ValueError):
        dq.Rule("isOdd", "x").violations()


def test_one_pass_per_suite(spark, measured_rows):
    rules = (*dq.complete("id", "s", "v"), dq.non_negative("v"))
    plan = dq.measure(measured_rows, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


# -- plain folders ------------------------------------------------------------


def test_append_and_partition_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    append_parquet(df, str(tmp_path / "x"), ["p"])
    append_parquet(df, str(tmp_path / "x"), ["p"])
    assert read_parquet(spark, str(tmp_path / "x")).count() == 4
    overwrite_partitions(df.filter("p = 'a'"), str(tmp_path / "x"), ["p"])
    assert values(read_parquet(spark, str(tmp_path / "x")), "n") == [1, 2, 2]


def test_dry_run(spark, measured_rows):
    counted = dry_run(measured_rows, F.sum("id").alias("ids"))
    assert counted == {"rows": 3, "ids": 5}


# -- reports ------------------------------------------------------------------


def test_sensor_ranges(spark):
    documents = spark.sql(
        "SELECT array(named_struct('id','s1','type','t','range',named_struct('min',0D,'max',15D))) AS sensors"
    )
    events = spark.createDataFrame(
        [("e1", "s1", 10.0), ("e2", "s1", 20.0), ("e3", "s2", 99.0), ("e4", "s1", None)],
        "event_id string, sensor_id string, value double",
    ).withColumns({c: F.lit("x") for c in ("equipment_id", "factory_id", "measurement_type", "timestamp")})
    assert values(reports.out_of_sensor_range(events, documents), "event_id") == ["e2"]


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert values(reports.orphans(child, parent, "k", "id"), "k") == ["b"]


def test_second_source_of_events(spark):
    readings = spark.createDataFrame(
        [("r1", "s1", 5.0, 1, None, at("2026-06-22T10:00:00")), ("r2", "s9", 6.0, 9, True, at("2026-06-22T10:00:00"))],
        "id string, sensor_id string, valor double, status_qualidade_id int, is_anomalia boolean, timestamp_leitura timestamp",
    )
    found = reports.readings_as_events(
        readings,
        spark.createDataFrame([(1, "good")], "id int, nome string"),
        spark.createDataFrame([("s1", "q1", 1)], "id string, equipamento_id string, tipo_medicao_id int"),
        spark.createDataFrame([("q1", "f1")], "id string, fabrica_id string"),
        spark.createDataFrame([(1, "temperature")], "id int, nome string"),
    )
    assert rows(found.select("event_id", "equipment_id", "factory_id", "measurement_type", "quality", "is_anomaly"), "event_id") == [
        ("r1", "q1", "f1", "temperature", "good", False),
        ("r2", None, None, None, None, True),
    ]

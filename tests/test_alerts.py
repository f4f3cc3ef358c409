"""Range alerts on the stream: limits of the moment, one alert per event."""

import datetime as dt

import pytest

from conftest import event, messages, rows
from millrace.plans.lake import Lake
from millrace.plans.reports import ALERT_COLUMNS
from millrace.sources.events import file_messages
from millrace.streaming import alerts
from millrace.streaming.alerts import (
    Limits,
    alert_history,
    alert_writer,
    lake_limits,
    range_alerts,
    start_range_alerts,
    typed_events,
)
from millrace.streaming.ingest import classify

EVENTS = (
    "event_id string, sensor_id string, equipment_id string, factory_id string,"
    " measurement_type string, value double, timestamp timestamp"
)
NOON = dt.datetime(2031, 3, 14, 12)


def one(number, value, sensor="S1", days=0):
    name = None if number is None else f"e{number}"
    return (name, sensor, "EQ", "F", "pressure", value, NOON + dt.timedelta(days=days))


def types(spark, low, high):
    return spark.createDataFrame(
        [("pressure", low, high)], "nome string, faixa_normal_min double, faixa_normal_max double"
    )


def documents(spark, *ranges):
    sensors = [{"id": s, "type": "t", "range": {"min": low, "max": high}} for s, low, high in ranges]
    schema = "sensors array<struct<id:string,type:string,range:struct<min:double,max:double>>>"
    return spark.createDataFrame([(sensors,)], schema)


def feed(spark, path, limits, *batches):
    write = alert_writer(str(path), limits)
    for number, data in enumerate(batches):
        write(spark.createDataFrame(data, EVENTS), number)


def stored(spark, path, *columns):
    return rows(alert_history(spark, str(path)).select(*columns), *columns)


def test_one_alert_per_event_and_rule(spark):
    limits = Limits(documents(spark, ("S1", 0.0, 5.0), ("S1", 1.0, 4.0), ("S2", 0.0, 9.0)), types(spark, 2.0, 6.0))
    data = [one(1, 7.0), one(1, 7.0), one(2, 4.5), one(3, 7.0, "S2"), one(4, 3.0), one(5, None), one(None, 7.0, "S3")]
    found = range_alerts(spark.createDataFrame([*data, data[-1]], EVENTS), limits)
    got = rows(found.select("regra", "event_id", "limite_min", "limite_max"), "regra", "event_id")
    assert got == [
        ("sensor", "e1", 0.0, 5.0), ("sensor", "e2", 1.0, 4.0),
        ("tipo", None, 2.0, 6.0), ("tipo", None, 2.0, 6.0), ("tipo", "e1", 2.0, 6.0), ("tipo", "e3", 2.0, 6.0),
    ]
    assert range_alerts(spark.createDataFrame(data, EVENTS), Limits()).count() == 0


def test_limits_that_change_take_effect_with_the_next_batch(spark, tmp_path):
    highs = iter([6.0, 3.0, 9.0])
    first, second = [one(1, 5.0), one(2, 7.0)], [one(3, 5.0), one(2, 7.0), one(1, 5.0)]
    feed(spark, tmp_path, lambda: Limits(types=types(spark, 0.0, next(highs))), first, second, [one(4, 8.0)])
    # e1 was in range when it came first; the same event delivered again breaks the new limit
    assert stored(spark, tmp_path, "event_id", "limite_max", "_batch") == [("e1", 3.0, 1), ("e2", 6.0, 0), ("e3", 3.0, 1)]


def test_replays_and_repeats_leave_one_row(spark, tmp_path, monkeypatch):
    limits = lambda: Limits(types=types(spark, 0.0, 6.0))
    write = alert_writer(str(tmp_path), limits)
    batches = [[one(1, 7.0), one(2, 7.0, days=1)], [one(1, 7.0), one(3, 8.0), one(None, 9.0)], [one(4, 1.0)]]
    frames = [spark.createDataFrame(data, EVENTS) for data in batches]
    for number in (0, 0, 1):
        write(frames[number], number)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(alerts, "overwrite_partitions", lost)
        with pytest.raises(OSError):
            write(frames[2], 2)
    for number in (1, 2, 2):
        write(frames[number], number)
    got = stored(spark, tmp_path, "event_id", "dia", "_batch")
    day = NOON.date()
    assert got == [(None, day, 1), ("e1", day, 0), ("e2", day + dt.timedelta(1), 0), ("e3", day, 1)]


def test_limits_of_a_lake_as_they_stand(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    limits = lake_limits(lake)
    assert limits() == Limits()
    table = lake.table("bronze/mongo/equipamentos")
    for n, high in enumerate((5.0, 3.0)):
        df = documents(spark, ("S1", 0.0, high)).selectExpr("*", f"DATE '2031-03-1{n}' AS _execution_date")
        table.replace_partitions(table.stage(df, ["_execution_date"]))
        found = range_alerts(spark.createDataFrame([one(1, 4.0)], EVENTS), limits())
        assert found.count() == n  # the newest documents count


def test_messages_to_alerts_as_a_stream(spark, tmp_path):
    sent = [event(event_id="a", value=9, measurement_type="pressure"), event(event_id="b", measurement_type="pressure"), "{bad"]
    sent.append(event(event_id="c", value=9.5, measurement_type="pressure", timestamp="31/12"))
    messages(spark, sent).coalesce(1).write.parquet(str(tmp_path / "in"))
    events = typed_events(classify(file_messages(spark, str(tmp_path / "in"))))
    assert tuple(events.columns) == ALERT_COLUMNS
    path, limits = str(tmp_path / "out"), lambda: Limits(types=types(spark, 0.0, 6.0))
    for _ in range(2):
        start_range_alerts(events, path, f"{path}-checkpoint", limits, available_now=True).awaitTermination()
    assert stored(spark, path, "event_id", "value", "dia") == [("a", 9.0, dt.date(2031, 3, 14)), ("c", 9.5, None)]

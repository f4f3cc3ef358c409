"""Windows that late events correct, against one run over all events."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.streaming import late
from millrace.streaming.late import (
    DAYS,
    closed_windows,
    corrected_metrics,
    corrected_writer,
    corrections,
    late_events,
    start_corrected_metrics,
)
from millrace.streaming.windows import window_metrics

SCHEMA = (
    "event_id string, timestamp timestamp, factory_id string, measurement_type string,"
    " value double, is_anomaly boolean"
)
SHOWN = ("inicio", "factory_id", "leituras", "anomalias", "avg_valor", "min_valor", "max_valor")


def at(minute, second=0):
    return dt.datetime(2031, 3, 14, 10) + dt.timedelta(minutes=minute, seconds=second)


def one(number, minute, value=1.0, factory="F1", anomaly=False):
    name = None if number is None else f"e{number}"
    return (name, at(minute), factory, "temperature", value, anomaly)


def feed(spark, root, batches, **options):
    write = corrected_writer(str(root), **options)
    for number, data in enumerate(batches):
        write(spark.createDataFrame(data, SCHEMA).coalesce(1), number)


def shown(df):
    rounded = df.withColumn("avg_valor", F.round("avg_valor", 9))
    return rows(rounded.select(*SHOWN), *SHOWN)


def whole(spark, batches, closed_before, **options):
    """The batch form over all events, each once, of windows that ended in time."""
    data = list(dict.fromkeys(e for b in batches for e in b if e[0])) + [e for b in batches for e in b if not e[0]]
    df = window_metrics(spark.createDataFrame(data, SCHEMA), **options)
    return shown(df.filter(F.col("fim") <= F.lit(closed_before)))


def test_late_events_become_corrections(spark, tmp_path):
    batches = [
        [one(1, 1), one(2, 4, 3.0, anomaly=True), one(3, 31)],  # closes what ends by 10:21
        [one(4, 2, 8.0), one(1, 1), one(5, 32), one(6, 18, 5.0, "F2")],  # three late, one of them a repeat
        [one(4, 2, 8.0), one(None, 3, None), one(None, 3, None), one(7, 60)],
    ]
    feed(spark, tmp_path, batches)
    got = rows(closed_windows(spark, str(tmp_path)).select("inicio", "leituras", "_batch"), "inicio")
    assert got == [(at(0), 2, 0), (at(30), 2, 2)]
    late_parts = corrections(spark, str(tmp_path)).select("inicio", "factory_id", "leituras", "valores", "_batch")
    assert rows(late_parts, "_batch", "inicio") == [(at(0), "F1", 1, 1, 1), (at(15), "F2", 1, 1, 1), (at(0), "F1", 2, 0, 2)]
    kept = rows(late_events(spark, str(tmp_path)).select("event_id", "_batch"), "_batch", "event_id")
    assert kept == [("e4", 1), ("e6", 1), (None, 2), (None, 2)]
    assert shown(corrected_metrics(spark, str(tmp_path))) == whole(spark, batches, at(50))


def test_any_order_of_arrival_gives_the_batch_form(spark, tmp_path):
    rng = random.Random(7)
    events = [one(n, rng.randrange(0, 120), float(n), f"F{n % 2}", n % 3 == 0) for n in range(80)]
    events += [one(None, rng.randrange(0, 120), 2.0) for _ in range(10)] + events[:20]
    rng.shuffle(events)
    batches = [events[n::4] for n in range(4)]
    closed = max(e[1] for e in events) - dt.timedelta(minutes=10)
    for name, options in (("hours", {}), ("sliding", {"slide": "2 minutes"})):
        periods = {"periods": DAYS} if name == "sliding" else {}
        feed(spark, tmp_path / name, batches, **options, **periods)
        assert shown(corrected_metrics(spark, str(tmp_path / name))) == whole(spark, batches, closed, **options)
        assert corrections(spark, str(tmp_path / name)).count() > 0


def test_a_replay_changes_nothing(spark, tmp_path, monkeypatch):
    """A batch that fails at its end has shown nothing, and counts once when it is done again."""
    batches = [[one(1, 1), one(3, 31)], [one(4, 2, 8.0), one(9, 90)], [one(5, 3), one(10, 120)]]
    feed(spark, tmp_path, batches[:1])
    write = corrected_writer(str(tmp_path))
    second = spark.createDataFrame(batches[1], SCHEMA)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(late, "create_text", lost)
        with pytest.raises(OSError):
            write(second, 1)
    assert corrections(spark, str(tmp_path)).count() == 0
    assert [r[0] for r in closed_windows(spark, str(tmp_path)).select("_batch").collect()] == [0]
    for _ in range(2):
        write(second, 1)
    write(spark.createDataFrame(batches[2], SCHEMA), 2)
    assert shown(corrected_metrics(spark, str(tmp_path))) == whole(spark, batches, at(110))


def test_empty_batches_and_events_without_time(spark, tmp_path):
    nothing = [(None, None, "F1", "temperature", 1.0, True)]
    feed(spark, tmp_path, [[], nothing, [one(1, 0)], [], [one(2, 30)], nothing])
    assert shown(corrected_metrics(spark, str(tmp_path))) == [(at(0), "F1", 1, 0, 1.0, 1.0, 1.0)]
    assert late_events(spark, str(tmp_path)).count() == 0


def test_as_a_stream_that_stops_and_goes_on(spark, tmp_path):
    batches = [[one(1, 1), one(3, 31)], [one(4, 2, 8.0), one(9, 90)]]
    for data in batches:
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        out = str(tmp_path / "out")
        start_corrected_metrics(stream, out, f"{out}-checkpoint", available_now=True).awaitTermination()
    assert shown(corrected_metrics(spark, out)) == whole(spark, batches, at(80))

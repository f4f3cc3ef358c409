"""Runs of many tables by what they read, and events that arrive late."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from conftest import event, messages, rows
from millrace.operators.quality import complete
from millrace.plans.gold import RECOMPUTED_FACTS
from millrace.plans.graph import POOL, dependencies, run_graph
from millrace.plans.lake import Lake
from millrace.plans.runner import ALL_TABLES, LATE_TABLES, RunResult, find_table, run
from millrace.plans.silver import LATE_EVENTS
from millrace.plans.spec import TableSpec
from millrace.sources import consumed
from millrace.sources.consumed import Seen, SeenLog
from millrace.sources.events import batch_folders, events_of_folders
from millrace.streaming.ingest import batch_writer, classify

DAY = dt.date(2031, 3, 14)
EVENTS = "silver/kafka/sensor_events"


def lake(spark, path):
    return Lake(spark, str(path))


def spec(name, *reads):
    return TableSpec(f"silver/x/{name}", lambda *_: None, reads=tuple(f"silver/x/{r}" for r in reads))


# -- the graph ----------------------------------------------------------------


def test_tables_name_what_they_read():
    """Every table's declared reads are tables, of a layer before its own."""
    order = ["bronze", "silver", "gold"]
    known = {s.path for s in ALL_TABLES}
    for s in ALL_TABLES:
        assert set(s.reads) <= known
        assert all(order.index(r.split("/")[0]) < order.index(s.layer) for r in s.reads)
    assert sum(map(len, dependencies(ALL_TABLES).values())) == 9 + 1 + 3 + 1 + 1 + 2 + 1
    assert len(dependencies(ALL_TABLES)) == 26
    assert [s.path for s in LATE_TABLES] == [s.path for s in ALL_TABLES]


def test_declared_reads_are_those_made(spark, tmp_path, monkeypatch):
    """What a build asks the lake for is what its table declares."""
    asked = []

    class Asked(Exception):
        pass

    def read(self, path, **where):
        asked.append(path)
        return spark.createDataFrame([], "id int, nome string, tipo_equipamento_id int")

    monkeypatch.setattr(Lake, "read", read)
    for s in ALL_TABLES:
        if s.layer == "bronze":
            continue
        asked.clear()
        try:
            s.build(lake(spark, tmp_path), DAY, None)
        except Exception:  # the stand-in has not all columns
            pass
        assert set(asked) <= set(s.reads) and bool(asked) == bool(s.reads), s.path


def test_a_failure_stops_only_what_depends_on_it(spark, tmp_path):
    loaded = []

    def load(_, s, day):
        if s.name == "b":
            raise ValueError("no b today")
        loaded.append(s.name)
        return RunResult(s.path, "loaded", 3)

    tables = [spec("d", "c", "b"), spec("c", "a"), spec("b", "a"), spec("a"), spec("e", "d"), spec("f", "c")]
    found = run_graph(lake(spark, tmp_path), DAY, tables, load=load)
    assert list(found) == [s.path for s in tables]
    status = {o.table[-1]: o.status for o in found.values()}
    assert status == {"a": "loaded", "b": "failed", "c": "loaded", "d": "skipped", "e": "skipped", "f": "loaded"}
    assert loaded.index("a") < loaded.index("c") < loaded.index("f")
    assert "no b today" in found["silver/x/b"].why and "silver/x/b" in found["silver/x/d"].why
    assert found["silver/x/a"].rows == 3 and not found["silver/x/e"].ok


def test_independent_tables_overlap_each_in_its_pool(spark, tmp_path):
    """Two tables wait for each other inside their loads: alone, neither would end."""
    both = threading.Barrier(2, timeout=30)
    pools = {}

    def load(_, s, day):
        if s.name != "last":
            both.wait()
        spark.range(10).count()
        pools[s.name] = spark.sparkContext.getLocalProperty(POOL)
        return RunResult(s.path, "loaded")

    tables = [spec("one"), spec("two"), spec("last", "one", "two")]
    found = run_graph(lake(spark, tmp_path), DAY, tables, at_once=2, load=load)
    assert all(o.status == "loaded" for o in found.values())
    assert pools == {n: f"silver/x/{n}" for n in ("one", "two", "last")}


def test_spark_jobs_of_two_tables_overlap(spark, tmp_path):
    """The batches of two tables are computed at one time, by the clock of their rows."""

    def slow(lake_, day, before):
        def spend(batches):
            import time

            for batch in batches:
                start = time.time()
                time.sleep(1.5)
                batch["start"], batch["end"] = start, time.time()
                yield batch

        return spark.range(1).coalesce(1).mapInPandas(spend, "id long, start double, end double")

    tables = [TableSpec(f"silver/x/{n}", slow, complete("id"), keys=("id",)) for n in "ab"]
    home = lake(spark, tmp_path)
    assert all(o.status == "loaded" for o in run_graph(home, DAY, tables).values())
    (a,), (b,) = (home.read(t.path).select("start", "end").collect() for t in tables)
    assert max(a["start"], b["start"]) < min(a["end"], b["end"])


def test_circles_and_tables_that_are_there_already(spark, tmp_path):
    from graphlib import CycleError

    done = []

    def load(_, s, day):
        done.append(s.name)
        return RunResult(s.path, "empty")

    with pytest.raises(CycleError):
        run_graph(lake(spark, tmp_path), DAY, [spec("a", "b"), spec("b", "a")], load=load)
    assert done == []
    found = run_graph(lake(spark, tmp_path), DAY, [spec("a", "elsewhere")], load=load)
    assert done == ["a"] and found["silver/x/a"].ok
    assert run_graph(lake(spark, tmp_path), DAY, []) == {}


# -- late events ----------------------------------------------------------------


def at(day, number, **changes):
    moment = dt.datetime.combine(day, dt.time(6)).isoformat()
    return event(event_id=f"e{number}", timestamp=moment, **changes)


def arrive(spark, home, batch, *events):
    batch_writer(home.events_path)(classify(messages(spark, events)), batch)


def ids(home):
    return [r[0] for r in rows(home.read(EVENTS).select("event_id"), "event_id")]


def days(n):
    return DAY + dt.timedelta(days=n)


def test_late_events_reach_silver_and_their_facts(spark, tmp_path):
    home = lake(spark, tmp_path)
    facts = RECOMPUTED_FACTS[1]
    arrive(spark, home, 0, at(DAY, 0), at(DAY, 1), at(days(1), 2), at(days(9), 3))
    assert run(home, LATE_EVENTS, DAY).rows == 2
    run(home, facts, DAY)
    # an event of a loaded day and one of the next, in a batch of its own
    arrive(spark, home, 1, at(DAY, 4, value=9.0), at(days(1), 5))
    assert run(home, LATE_EVENTS, days(1)).rows == 3
    run(home, facts, days(1))
    assert ids(home) == ["e0", "e1", "e2", "e4", "e5"]
    counted = home.read(facts.path).select("data", "total_leituras", "max_valor_dia")
    assert rows(counted, "data") == [(DAY, 3, 9.0), (days(1), 2, 3.25)]
    # a run again reads nothing, and changes nothing
    assert run(home, LATE_EVENTS, days(1)).status == "empty"
    run(home, facts, days(1))
    assert rows(home.read(facts.path).select("data", "total_leituras"), "data") == [(DAY, 3), (days(1), 2)]
    # the event of the future comes on its day
    assert run(home, LATE_EVENTS, days(9)).rows == 1
    assert ids(home)[3] == "e3"
    assert SeenLog(spark, f"{home.table(EVENTS).path}/_seen").read() == Seen(1)


def test_what_was_not_noted_is_read_again(spark, tmp_path, monkeypatch):
    home = lake(spark, tmp_path)
    arrive(spark, home, 0, at(DAY, 0), at(DAY, 1))

    def lost(self, seen):
        raise OSError("lost before the note")

    with monkeypatch.context() as broken:
        broken.setattr(consumed.SeenLog, "write", lost)
        with pytest.raises(OSError):
            run(home, LATE_EVENTS, DAY)
    arrive(spark, home, 1, at(DAY, 2))
    assert run(home, LATE_EVENTS, DAY).rows == 3
    assert ids(home) == ["e0", "e1", "e2"]


def test_a_batch_counts_once_all_of_it_is_written(spark, tmp_path, monkeypatch):
    """Lines of a batch that has not ended are not read; its replay's are."""
    from millrace.streaming import ingest

    home = lake(spark, tmp_path)
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "overwrite_partitions", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            arrive(spark, home, 0, at(DAY, 0))
    assert run(home, LATE_EVENTS, DAY).status == "empty"
    arrive(spark, home, 0, at(DAY, 0))
    assert run(home, LATE_EVENTS, DAY).rows == 1


def test_only_new_folders_are_read(spark, tmp_path):
    """After a run, lines that were read may even be gone."""
    from millrace.sources.files import delete_tree, matching

    home = lake(spark, tmp_path)
    arrive(spark, home, 0, at(DAY, 0), at(days(1), 1))
    run(home, LATE_EVENTS, days(1))
    for folder in matching(spark, f"{home.events_path}/factory_id=*"):
        delete_tree(spark, folder)
    arrive(spark, home, 1, at(DAY, 2))
    assert run(home, LATE_EVENTS, days(1)).rows == 1
    assert ids(home) == ["e0", "e1", "e2"]


def test_folders_of_odd_names(spark, tmp_path):
    names = ["a b", "é:1", "x/y", "50%", "", "{a,b}*?[c]", "=", "#", "back\\slash", 'quo"te']
    home = lake(spark, tmp_path)
    arrive(spark, home, 7, *[at(DAY, n, factory_id=name) for n, name in enumerate(names)])
    folders = batch_folders(spark, home.events_path).collect()
    assert len(folders) == len(names)
    found = events_of_folders(spark, home.events_path, folders)
    assert rows(found.select("event_id"), "event_id") == [(f"e{n}",) for n in range(len(names))]
    assert events_of_folders(spark, home.events_path, []).count() == 0
    assert batch_folders(spark, str(tmp_path / "none")).count() == 0
    assert batch_folders(spark, home.events_path, after=7).count() == 0


def test_seen_state():
    seen = Seen().after([(DAY, 0), (days(1), 0), (DAY, 1)], 0)
    assert seen == Seen(0, {DAY.isoformat(): [1]})
    assert seen.has(days(5), 0) and seen.has(DAY, 1) and not seen.has(days(1), 1)
    assert seen.after([], -1) == seen
    assert find_table(EVENTS, LATE_TABLES) is LATE_EVENTS


def test_command_line_takes_late_events():
    from millrace.__main__ import parse

    given = ["--execution_date", "2031-03-14", "--environment", "hmg", "--owner", "o", "--root", "/r"]
    assert not parse(given).late_events and parse([*given, "--late_events"]).late_events
    assert parse([*given, "--tables_at_once", "2"]).tables_at_once == 2


def test_result_does_not_depend_on_the_order_of_arrival(spark, tmp_path):
    """All events in one run, or in runs between batches: the same facts."""
    events = [at(days(n % 3), n, value=float(n)) for n in range(24)]
    one, many = lake(spark, tmp_path / "one"), lake(spark, tmp_path / "many")
    arrive(spark, one, 0, *events)
    run(one, LATE_EVENTS, days(3))
    run(one, RECOMPUTED_FACTS[1], days(3))
    for batch in range(3):
        arrive(spark, many, batch, *events[batch::3][::-1])
        run(many, LATE_EVENTS, days(batch + 1))
        run(many, RECOMPUTED_FACTS[1], days(batch + 1))

    def shown(home):
        fact = home.read("gold/fct/fct_anomalias_dia").drop("_execution_date", "_processed_at")
        return rows(fact.select([F.col(c) for c in sorted(fact.columns)]), "data")

    assert shown(one) == shown(many)

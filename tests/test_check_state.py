"""Reports of whole tables from the states of their partitions."""

import datetime as dt
import re

import pytest

from conftest import rows
from millrace.operators.quality import complete, contained_in, measure, non_negative, report, unique
from millrace.sources import check_state
from millrace.sources.check_state import CheckState
from millrace.sources.files import delete_tree
from millrace.sources.tables import SnapshotTable

DAY = dt.date(2031, 3, 14)
SCHEMA = "k int, v string, p string"
RULES = (*complete("k"), unique("v"), non_negative("k"), contained_in("v", ["a", "b"]), unique("k"))


def load(spark, table, data):
    table.replace_partitions(table.stage(spark.createDataFrame(data, SCHEMA), ["p"]))


def shown(df):
    return rows(df.drop("_processed_at"), "constraint")


def recomputed(table):
    return shown(report(measure(table.read(), RULES), RULES, DAY))


def test_states_add_up_to_a_report_of_all(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path))
    state = CheckState(table, RULES)
    assert state.refresh() == []
    load(spark, table, [(1, "a", "x y"), (2, "b", "x y"), (None, None, "é:1"), (-4, "c", "z+1")])
    assert shown(state.report(DAY)) == recomputed(table)
    # values of other partitions repeat; one partition is replaced
    load(spark, table, [(1, "d", "w"), (7, "a", "w"), (8, "a", "z+1")])
    assert [p[2:] for p in state.refresh()] == ["w", "z+1"]
    assert state.refresh() == []
    assert shown(state.report(DAY)) == recomputed(table)


def test_only_new_partitions_are_read(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path))
    load(spark, table, [(n, f"v{n}", "old") for n in range(5)])
    state = CheckState(table, RULES)
    state.refresh()
    delete_tree(spark, table._folder(table.manifest().parts["p=old"], "p=old"))
    load(spark, table, [(3, "v9", "new")])
    found = {r["constraint"]: (r["violations"], r["rows"]) for r in state.report(DAY).collect()}
    assert found["isUnique(k)"] == (1, 6) and found["isUnique(v)"] == (0, 6)


def test_a_run_that_failed_half_way_counts_nothing(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path))
    load(spark, table, [(1, "a", "x"), (2, "a", "y")])
    state, write = CheckState(table, RULES), CheckState._write

    def lost(self, rows_, names, name, number):
        if name == "counts":
            raise OSError("lost")
        write(self, rows_, names, name, number)

    with monkeypatch.context() as broken:
        broken.setattr(CheckState, "_write", lost)
        with pytest.raises(OSError):
            state.refresh()
    assert shown(state.report(DAY)) == recomputed(table)


def test_values_are_counted_in_partitions_by_the_size_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(check_state, "PIECE", 100)
    table = SnapshotTable(spark, str(tmp_path))
    state, settings, write = CheckState(table, RULES), [], CheckState._write

    def noted(self, *args):
        settings.append(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None))
        write(self, *args)

    monkeypatch.setattr(CheckState, "_write", noted)
    for half in (0, 1):
        load(spark, table, [(n % 70, f"v{n % 90}" if n % 8 else None, f"p{n % 6}{half}") for n in range(120)])
        assert shown(state.report(DAY)) == recomputed(table)
    assert all(int(n) > 8 for n in settings[::2]) and settings[1::2] == [None, None]
    plan = state.measured()._jdf.queryExecution().optimizedPlan().toString()
    numbers = [int(n) for n in re.findall(r"RepartitionByExpression \[value#\d+\], (\d+)", plan)]
    assert numbers and min(numbers) > 8
